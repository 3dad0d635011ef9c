"""Analytic views over staging and the mart: daily disbursement, daily collections, cohort
portfolio and the flat BI dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.functions import expr as X
from loanlake.operators import rollups


def disbursement_daily(stg_loans: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Loans disbursed per day x city x segment x product (closed loans included; NULL city and
    segment when the customer was rejected)."""
    cust = stg_customers.select("customer_id", "city", "segment")
    j = stg_loans.select("loan_id", "customer_id", "origination_date", "principal_amount", "product_type") \
        .join(cust, "customer_id", "left")
    p = F.col("principal_amount")
    return j.groupBy(
        F.col("origination_date").alias("disbursement_date"), "city", "segment",
        F.col("product_type").alias("product"),
    ).agg(
        F.count("loan_id").alias("n_loans"),
        X.money(F.sum(p)).alias("total_disbursed"),
        F.try_divide(F.sum(p).cast("double"), F.count(p).cast("double")).alias("avg_disbursed"),
        F.max(p).alias("max_disbursed"),
        F.min(p).alias("min_disbursed"),
    )


def collections_daily(stg_payments: DataFrame, stg_installments: DataFrame) -> DataFrame:
    """Daily cash from non-orphan payments, split into cash applied to installments in arrears
    and the rest.

    Skew-safe shape: payments are pre-aggregated per (day, installment) map-side, so a hot
    installment or day never reaches the installment join as more than one row per map task.
    The per-row LEFT JOIN of the SQL form is preserved: a duplicated installment id on the
    right multiplies the partial sums exactly as it would multiply the payment rows.
    """
    pre = (stg_payments.where(~F.col("orphan_installment"))
           .groupBy("payment_date", "installment_id")
           .agg(F.count("payment_id").alias("_n"), F.sum("payment_amount").alias("_amt")))
    inst = stg_installments.select(F.col("installment_id").alias("_iid"), F.col("in_arrears").alias("_arr"))
    j = pre.join(inst, pre.installment_id == inst._iid, "left")
    applied = X.flag(F.col("_arr") == F.lit(True))
    total = F.sum("_amt")
    arrears = X.sum_when(applied, F.col("_amt"))
    return j.groupBy(F.col("payment_date").alias("collection_date")).agg(
        F.sum("_n").cast("bigint").alias("n_payments"),
        X.money(total).alias("total_collected"),
        X.money(arrears).alias("collected_arrears"),
        X.money(X.sum_when(~applied, F.col("_amt"))).alias("collected_current"),
        X.safe_pct(arrears, total).alias("arrears_pct"),
    )


def collections_daily_by_lookup(payments: DataFrame, lookup: DataFrame) -> DataFrame:
    """``collections_daily`` of clean payments without orphan flags: payments are combined per day and installment,
    and these partial rows meet the installments once. A payment counts once per staged installment of its id,
    at least once, as in the per-row join."""
    pre = payments.groupBy("payment_date", "installment_id").agg(
        F.count("payment_id").alias("_n"), F.sum("payment_amount").alias("_amt"))
    found = rollups.payments_looked_up(pre, lookup).where(~F.col("orphan_installment"))
    times = F.greatest(F.col("n_staged"), F.lit(1))
    amount = F.col("_amt").cast("decimal(27,2)")
    whole, late = amount * times.cast("decimal(10,0)"), amount * F.col("n_late").cast("decimal(10,0)")
    total, arrears = F.sum(whole), F.sum(late)
    return found.groupBy(F.col("payment_date").alias("collection_date")).agg(
        F.sum(F.col("_n") * times).cast("bigint").alias("n_payments"),
        X.money(total).alias("total_collected"),
        X.money(arrears).alias("collected_arrears"),
        X.money(F.sum(whole - late)).alias("collected_current"),
        X.safe_pct(arrears, total).alias("arrears_pct"),
    )


def cohort_portfolio(mart: DataFrame) -> DataFrame:
    """Open-loan balances and arrears by origination cohort month."""
    n_arrears = X.count_when(F.col("in_arrears") == F.lit(True))
    return mart.groupBy("cohort_month").agg(
        F.count("loan_id").alias("n_loans"),
        X.money(F.sum("principal")).alias("total_disbursed"),
        X.money(F.sum("balance_current")).alias("balance_current"),
        X.money(F.sum("balance_arrears")).alias("balance_arrears"),
        X.money(F.sum("balance_open")).alias("balance_open"),
        X.safe_pct(F.sum("balance_arrears"), F.sum("balance_open")).alias("arrears_pct"),
        F.max("max_days_late").alias("max_days_late"),
        n_arrears.alias("n_loans_arrears"),
        X.safe_pct(n_arrears, F.count("loan_id")).alias("loans_arrears_pct"),
    )


BI_COLUMNS = [
    "as_of", "origination_date", "cohort_month", "orig_year", "orig_month", "orig_quarter",
    "loan_id", "customer_id", "customer_name", "city", "segment", "product", "loan_status",
    "in_arrears", "aging_bucket", "principal", "annual_rate", "annual_rate_pct", "term_months",
    "monthly_income", "debt_burden_pct", "n_installments", "n_paid", "n_arrears", "n_upcoming",
    "progress_pct", "balance_open", "balance_arrears", "balance_current", "recovered_est",
    "recovery_pct", "max_days_late", "bucket_rank", "n_payments", "collected", "collected_arrears",
    "last_payment_date", "arrears_coverage_pct", "days_since_payment",
]


def bi_dataset(mart: DataFrame) -> DataFrame:
    """Flat BI dataset: the mart plus calendar parts and derived ratios (39 columns)."""
    as_of = F.col("as_of")
    last = F.col("last_payment_date")
    installment_share = F.col("principal").cast("double") / F.col("term_months").cast("double")
    derived = {
        "orig_year": F.year("origination_date"),
        "orig_month": F.month("origination_date"),
        "orig_quarter": F.quarter("origination_date"),
        "annual_rate_pct": F.round(F.col("annual_rate") * F.lit(100), 2).cast("decimal(10,2)"),
        "debt_burden_pct": X.safe_pct(installment_share, F.col("monthly_income")),
        "progress_pct": X.safe_pct(F.col("n_paid"), F.col("n_installments")),
        "recovery_pct": X.safe_pct(F.col("recovered_est"), F.col("principal")),
        "bucket_rank": X.bucket_rank(F.col("max_days_late")),
        "days_since_payment": F.when(last.isNotNull(), X.days_between(as_of, last)),
    }
    return mart.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in BI_COLUMNS])
