"""Maintaining the mart's rollups by signed changes.

A change of a table is a set of rows with a sign: -1 for a row that is gone, 1 for one that came, both for a row
that changed. Counts and balances are sums, so a rollup is kept by adding signed sums. A maximum cannot be taken
back that way; for it the state keeps, per loan, how often each value occurs (days late, payment days), and
the rollup takes the greatest value that still occurs.

States: installments per (loan, days late); payments per (loan, installment, orphan) and per (loan, day). Every
state has ``n``, the number of rows behind it, and rows of n = 0 leave it. All steps are groupings with partial
aggregation on the state's key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlake.functions import expr as X
from loanlake.operators.existence import with_in_flag
from loanlake.operators.rollups import arrears_installment_ids

SIGN = "_sign"
INSTALLMENT_KEY, CASH_KEY, DAY_KEY = ["loan_id", "days_late"], ["loan_id", "installment_id", "orphan_installment"], [
    "loan_id", "payment_date"]


def signed_changes(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Rows of one of the two tables but not of the other, with ``SIGN`` times how often (-1: old, 1: new)."""
    rows = new.withColumn(SIGN, F.lit(1))
    if old is not None:
        rows = rows.unionByName(old.select(*new.columns).withColumn(SIGN, F.lit(-1)))
    return rows.groupBy(*new.columns).agg(F.sum(SIGN).alias(SIGN)).where(F.col(SIGN) != 0)


def _when(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value * F.col(SIGN)).otherwise(F.lit(0)))


def installment_state(signed: DataFrame, as_of: dt.date) -> DataFrame:
    today = X.as_of_lit(as_of)
    status, total, one = F.col("installment_status"), F.col("total_due"), F.lit(1)
    upcoming = (status == F.lit("DUE")) & (F.col("due_date") >= today)
    unpaid, late = status != F.lit("PAID"), F.col("in_arrears")
    return signed.groupBy(*INSTALLMENT_KEY).agg(
        F.sum(SIGN).alias("n"), _when(status == F.lit("PAID"), one).alias("n_paid"), _when(late, one).alias("n_arrears"),
        _when(upcoming, one).alias("n_upcoming"), X.money(_when(unpaid, total)).alias("balance_open"),
        X.money(_when(late, total)).alias("balance_arrears"), X.money(_when(upcoming, total)).alias("balance_current"))


def cash_state(signed: DataFrame) -> DataFrame:
    return signed.groupBy(*CASH_KEY).agg(
        F.sum(SIGN).alias("n"), X.money(F.sum(F.col("payment_amount") * F.col(SIGN))).alias("amount"))


def day_state(signed: DataFrame) -> DataFrame:
    return signed.groupBy(*DAY_KEY).agg(F.sum(SIGN).alias("n"))


def added(state: DataFrame, change: DataFrame, key: list[str]) -> DataFrame:
    """The state after a change of the same columns. A key is there as long as rows are behind it."""
    values = [c for c in state.columns if c not in key]
    sums = [F.sum(c).cast(state.schema[c].dataType).alias(c) for c in values]
    return state.unionByName(change.select(*state.columns)).groupBy(*key).agg(*sums).where("n <> 0").select(*state.columns)


def installment_rollup(state: DataFrame) -> DataFrame:
    sums = ["n_paid", "n_arrears", "n_upcoming"]
    money = ["balance_open", "balance_arrears", "balance_current"]
    return state.groupBy("loan_id").agg(
        F.sum("n").alias("n_installments"), *[F.sum(c).alias(c) for c in sums],
        *[X.money(F.sum(c)).alias(c) for c in money], F.max("days_late").alias("max_days_late"))


def payment_rollup(cash: DataFrame, days: DataFrame, stg_installments: DataFrame) -> DataFrame:
    """Per loan: payments, cash, cash applied to installments in arrears, last day."""
    flagged = with_in_flag(cash, F.col("installment_id"), arrears_installment_ids(stg_installments), "installment_id",
                           "_to_arrears")
    applied = (~F.col("orphan_installment")) & F.col("_to_arrears")
    sums = flagged.groupBy("loan_id").agg(
        F.sum("n").alias("n_payments"), X.money(F.sum("amount")).alias("collected"),
        X.money(X.sum_when(applied, F.col("amount"))).alias("collected_arrears"))
    last = days.groupBy(F.col("loan_id").alias("_of")).agg(F.max("payment_date").alias("last_payment_date"))
    return sums.join(last, F.col("loan_id").eqNullSafe(F.col("_of"))).drop("_of")
