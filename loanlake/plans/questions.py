"""The five business questions and the KPI report, as DataFrame plans over the views and mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.functions import expr as X
from loanlake.operators import windows as W


def q1_disbursement(disb_daily: DataFrame) -> DataFrame:
    """Daily disbursement with a running total per city and each row's share of its day.

    The day x city x segment x product grain is not ordered by day alone, so segment and product
    (NULLs last) break ties inside a city to make the running total deterministic.
    """
    order = [F.col("disbursement_date").asc(), F.col("segment").asc_nulls_last(),
             F.col("product").asc_nulls_last()]
    return disb_daily.select(
        "disbursement_date", "city", "segment", "product", "n_loans", "total_disbursed", "avg_disbursed",
        X.money(W.running_sum("total_disbursed", ["city"], order)).alias("running_city_total"),
        X.safe_pct(F.col("total_disbursed"), W.partition_total("total_disbursed", ["disbursement_date"]))
        .alias("day_share_pct"),
    ).orderBy(F.col("disbursement_date").desc(), F.col("total_disbursed").desc())


def q2_collections(coll_daily: DataFrame) -> DataFrame:
    """Daily collections with a running total and a 7-row moving average (one row per day, so
    the global window runs over a calendar-bounded input)."""
    order = [F.col("collection_date").asc()]
    return coll_daily.select(
        "collection_date", "n_payments", "total_collected", "collected_arrears", "collected_current",
        "arrears_pct",
        X.money(W.running_sum("total_collected", [], order)).alias("running_total"),
        W.moving_avg_rows("total_collected", order, 6).alias("moving_avg_7"),
    ).orderBy(F.col("collection_date").desc())


def q2_collections_calendar(coll_daily: DataFrame) -> DataFrame:
    """Question 2 with a true 7-calendar-day moving average (days without payments are gaps in
    the frame, not skipped rows)."""
    order = [F.col("collection_date").asc()]
    return coll_daily.select(
        "collection_date", "total_collected",
        X.money(W.running_sum("total_collected", [], order)).alias("running_total"),
        W.moving_avg_days("total_collected", "collection_date", 7).alias("moving_avg_7d"),
    ).orderBy(F.col("collection_date").desc())


def q3_cohort_health(cohorts: DataFrame) -> DataFrame:
    return cohorts.select(
        F.col("cohort_month").alias("cohort"), "n_loans", "total_disbursed", "balance_current",
        "balance_arrears", "balance_open", "arrears_pct", "max_days_late", "n_loans_arrears",
        "loans_arrears_pct", X.cohort_health(F.col("arrears_pct")).alias("cohort_class"),
    ).orderBy(F.col("cohort").asc_nulls_last())


def q4_top_delinquent(mart: DataFrame, k: int = 10) -> DataFrame:
    """Top-k loans in arrears by worst delay, then arrears balance (loan id breaks ties)."""
    last = F.col("last_payment_date")
    rows = mart.where(F.col("in_arrears") == F.lit(True)).select(
        "loan_id", "customer_name", "city", "segment", "product", "loan_status", "principal",
        "balance_arrears", "balance_open", "max_days_late", "aging_bucket", "n_arrears",
        "n_installments", "last_payment_date",
        F.when(last.isNotNull(), X.days_between(F.col("as_of"), last)).alias("days_since_payment"),
        X.safe_pct(F.col("balance_arrears"), F.col("principal")).alias("arrears_share_pct"),
    )
    order = [F.col("max_days_late").desc(), F.col("balance_arrears").desc(), F.col("loan_id").asc()]
    top = W.top_k_numbered(rows, order, k, "rank")
    return top.select("rank", *[c for c in rows.columns]).orderBy("rank")


def q5_bi_ordered(bi: DataFrame) -> DataFrame:
    return bi.orderBy(F.col("origination_date").desc(), F.col("principal").desc(), F.col("loan_id").asc())


def q5_exec_summary(bi: DataFrame) -> DataFrame:
    """Executive summary per cut-off date."""
    return bi.groupBy("as_of").agg(
        F.count("loan_id").alias("n_loans"),
        X.money(F.sum("principal")).alias("portfolio"),
        X.money(F.sum("balance_arrears")).alias("arrears_total"),
        X.money(F.sum("balance_current")).alias("current_total"),
        X.safe_pct(F.sum("balance_arrears"), F.sum("balance_open")).alias("arrears_pct"),
        X.count_when(F.col("in_arrears") == F.lit(True)).alias("n_in_arrears"),
        X.money(F.sum("collected")).alias("collected_total"),
        F.count_distinct("city").alias("n_cities"),
        F.count_distinct("segment").alias("n_segments"),
    )


def portfolio_kpis(mart: DataFrame) -> DataFrame:
    """One-row KPI report. The arrears index has no zero guard in the original report; here a
    zero open balance yields NULL instead of an infinity."""
    return mart.agg(
        F.count("loan_id").alias("n_loans"),
        X.money(F.sum("principal")).alias("portfolio"),
        X.money(F.sum("balance_arrears")).alias("arrears_total"),
        X.safe_pct(F.sum("balance_arrears"), F.sum("balance_open")).alias("arrears_pct"),
        X.count_when(F.col("in_arrears") == F.lit(True)).alias("n_in_arrears"),
        F.max("max_days_late").alias("max_days_late"),
    )
