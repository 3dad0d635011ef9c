"""Per-loan rollups of staged installments and payments (aggregated *before* joining the loan
table, so the mart join never fans out)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.functions import expr as X
from loanlake.operators import staging
from loanlake.operators.existence import salted, with_in_flag
from loanlake.session import DEFAULT_AS_OF


def installment_rollup(stg_installments: DataFrame, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    """Counts, balances and worst delay per loan (all staged loans, open or not)."""
    today = X.as_of_lit(as_of)
    status, due, total = F.col("installment_status"), F.col("due_date"), F.col("total_due")
    upcoming = (status == F.lit("DUE")) & (due >= today)
    return stg_installments.groupBy("loan_id").agg(
        F.count(F.lit(1)).alias("n_installments"),
        X.count_when(status == F.lit("PAID")).alias("n_paid"),
        X.count_when(F.col("in_arrears")).alias("n_arrears"),
        X.count_when(upcoming).alias("n_upcoming"),
        X.money(X.sum_when(status != F.lit("PAID"), total)).alias("balance_open"),
        X.money(X.sum_when(F.col("in_arrears"), total)).alias("balance_arrears"),
        X.money(X.sum_when(upcoming, total)).alias("balance_current"),
        F.max("days_late").alias("max_days_late"),
        F.max(F.when(F.col("days_late") > 0, F.col("installment_number"))).alias("worst_installment_number"),
    )


def arrears_installment_ids(stg_installments: DataFrame) -> DataFrame:
    return stg_installments.where(F.col("in_arrears")).select("installment_id")


def installment_lookup(raw_installments: DataFrame, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    """Per installment id, as payments name it: ``_p_key`` (``k`` and the id, ``n`` for null), ``_p_cnt`` raw rows
    of that very id, ``n_staged`` clean rows of the trimmed id and ``n_late`` of them in arrears. One grouping of
    the raw table answers both questions of a payment: is its installment there, and is it in arrears."""
    flagged = staging.flag_installments(raw_installments.withColumn("_raw", F.col("installment_id")), as_of, keep=["_raw"])
    clean = F.lit(True)
    for name, _ in staging.INSTALLMENT_SPEC.flags:
        clean = clean & ~F.col(name)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    staged = F.when(clean, one).otherwise(none)
    late = F.when(clean & F.col("in_arrears"), one).otherwise(none)
    mark = lambda c: F.coalesce(F.concat(F.lit("k"), c), F.lit("n"))
    entry = lambda key, a, b, c: F.struct(key.alias("_p_key"), a.alias("cnt"), b.alias("staged"), c.alias("late"))
    raw, trimmed = mark(F.col("_raw")), mark(F.col("installment_id"))
    both = F.when(raw == trimmed, F.array(entry(raw, one, staged, late))).otherwise(
        F.array(entry(raw, one, none, none), entry(trimmed, none, staged, late)))
    return (flagged.select(F.explode(both).alias("_e")).groupBy("_e._p_key").agg(
        F.sum("_e.cnt").alias("_p_cnt"), F.sum("_e.staged").alias("n_staged"), F.sum("_e.late").alias("n_late")))


def payments_looked_up(pre: DataFrame, lookup: DataFrame) -> DataFrame:
    """Pre-aggregated payments (with ``installment_id``) and what ``lookup`` says of them: ``orphan_installment``
    (NOT IN with SQL's NULL rules), ``n_staged`` and ``n_late`` (0 where there is none)."""
    facts = lookup.agg(F.struct(
        F.coalesce(F.sum("_p_cnt"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("_p_key") == "n", F.col("_p_cnt"))), F.lit(0)).alias("nn")).alias("f")).scalar()
    keyed = pre.withColumn("_l_null", F.col("installment_id").isNull()).withColumn(
        "_l_key", salted(F.col("installment_id"), pre.columns))
    rows = keyed.join(lookup, F.col("_l_key") == F.col("_p_key"), "left")
    absent = F.coalesce(F.col("_p_cnt"), F.lit(0)) == 0
    orphan = (facts["n"] == 0) | (~F.col("_l_null") & absent & (facts["nn"] == 0))
    zero = F.lit(0).cast("long")
    return rows.select(*pre.columns, orphan.alias("orphan_installment"), F.coalesce("n_staged", zero).alias("n_staged"),
                       F.coalesce("n_late", zero).alias("n_late"))


def payment_rollup_by_lookup(payments: DataFrame, lookup: DataFrame) -> DataFrame:
    """``payment_rollup`` of clean payments without orphan flags: payments are combined per loan and installment
    first, and only these partial rows meet the installments, once."""
    pre = payments.groupBy("loan_id", "installment_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("payment_amount").alias("_amt"), F.max("payment_date").alias("_last"))
    applied = ~F.col("orphan_installment") & (F.col("n_late") > 0)
    return payments_looked_up(pre, lookup).groupBy("loan_id").agg(
        F.sum("_n").alias("n_payments"), X.money(F.sum("_amt")).alias("collected"),
        F.max("_last").alias("last_payment_date"), X.money(X.sum_when(applied, F.col("_amt"))).alias("collected_arrears"))


def payment_rollup(stg_payments: DataFrame, stg_installments: DataFrame) -> DataFrame:
    """Payment count, cash, last date and cash applied to installments in arrears, per loan.

    Skew-safe shape: payments are first pre-aggregated per (loan, installment, orphan) with
    map-side partial aggregation, so a hot loan or installment collapses to one row per map task
    before any shuffle; only those partial rows meet the arrears-installment keys.
    """
    pre = stg_payments.groupBy("loan_id", "installment_id", "orphan_installment").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("payment_amount").alias("_amt"),
        F.max("payment_date").alias("_last"),
    )
    flagged = with_in_flag(pre, F.col("installment_id"), arrears_installment_ids(stg_installments),
                           "installment_id", "_to_arrears")
    applied = (~F.col("orphan_installment")) & F.col("_to_arrears")
    return flagged.groupBy("loan_id").agg(
        F.sum("_n").alias("n_payments"),
        X.money(F.sum("_amt")).alias("collected"),
        F.max("_last").alias("last_payment_date"),
        X.money(X.sum_when(applied, F.col("_amt"))).alias("collected_arrears"),
    )
