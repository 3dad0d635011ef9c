"""Portfolio mart: one row per open loan (ACTIVE or DEFAULT) with customer dimensions, installment
and payment rollups, aging bucket, arrears flag and coverage ratio."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.functions import expr as X
from loanlake.session import DEFAULT_AS_OF

MART_COLUMNS = [
    "loan_id", "customer_id", "customer_name", "city", "segment", "product", "origination_date",
    "cohort_month", "principal", "annual_rate", "term_months", "loan_status", "monthly_income",
    "n_installments", "n_paid", "n_arrears", "n_upcoming", "balance_open", "balance_arrears",
    "balance_current", "recovered_est", "max_days_late", "aging_bucket", "in_arrears", "n_payments",
    "collected", "collected_arrears", "last_payment_date", "arrears_coverage_pct", "as_of",
]


def open_loans(stg_loans: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Open loans with their customer's name, city, segment and income (NULL if the customer
    was rejected). The customer side is unique by id; Spark broadcasts it only when its measured
    size is under the broadcast threshold, otherwise both sides shuffle on customer_id."""
    loans = stg_loans.where(F.col("loan_status").isin(*X.OPEN_LOAN_STATUSES))
    cust = stg_customers.select("customer_id", "full_name", "city", "segment", "monthly_income")
    return loans.join(cust, "customer_id", "left")


PAYMENT_COLUMNS = ["n_payments", "collected", "collected_arrears", "last_payment_date",
                   "arrears_coverage_pct"]


def _z(c: str):
    return F.coalesce(F.col(c), F.lit(0))


def _coverage(bal_arrears, coll_arrears):
    return (F.when(bal_arrears == 0, F.lit(None).cast("double"))
            .otherwise(X.safe_pct(coll_arrears, bal_arrears)))


def portfolio_mart(open_loans_df: DataFrame, inst_rollup: DataFrame, pay_rollup: DataFrame,
                   as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    inst = inst_rollup.drop("worst_installment_number")
    j = open_loans_df.join(inst, "loan_id", "left").join(pay_rollup, "loan_id", "left")
    z = _z
    max_days = F.coalesce(F.col("max_days_late"), F.lit(0))
    bal_arrears = X.money(z("balance_arrears"))
    coll_arrears = X.money(z("collected_arrears"))
    coverage = _coverage(bal_arrears, coll_arrears)
    return j.select(
        "loan_id", "customer_id",
        F.col("full_name").alias("customer_name"),
        "city", "segment",
        F.col("product_type").alias("product"),
        "origination_date", "cohort_month",
        F.col("principal_amount").alias("principal"),
        "annual_rate", "term_months", "loan_status", "monthly_income",
        z("n_installments").cast("bigint").alias("n_installments"),
        z("n_paid").cast("bigint").alias("n_paid"),
        z("n_arrears").cast("bigint").alias("n_arrears"),
        z("n_upcoming").cast("bigint").alias("n_upcoming"),
        X.money(z("balance_open")).alias("balance_open"),
        bal_arrears.alias("balance_arrears"),
        X.money(z("balance_current")).alias("balance_current"),
        X.money(F.col("principal_amount") - X.money(z("balance_open"))).alias("recovered_est"),
        max_days.alias("max_days_late"),
        X.loan_bucket(max_days).alias("aging_bucket"),
        X.flag((F.col("loan_status") == F.lit("DEFAULT")) | (z("n_arrears") > 0)).alias("in_arrears"),
        z("n_payments").cast("bigint").alias("n_payments"),
        X.money(z("collected")).alias("collected"),
        coll_arrears.alias("collected_arrears"),
        "last_payment_date",
        coverage.alias("arrears_coverage_pct"),
        X.as_of_lit(as_of).alias("as_of"),
    )


def refresh_payments(mart: DataFrame, pay_rollup_affected: DataFrame, affected_loans: DataFrame) -> DataFrame:
    """Delta refresh: replace the payment columns of the loans in ``affected_loans`` with a
    rollup recomputed for those loans only; every other mart row passes through unchanged.

    Valid while the cut-off and the installments are those the mart was built with (payments
    only move their own loan's rollup); aging still needs the daily full build. Only the
    payments of affected loans are re-aggregated (the caller semi-joins them on the changed loan
    ids); the rest of the mart passes through an anti join untouched.
    """
    keys = affected_loans.select("loan_id").distinct()
    keep = mart.join(keys, "loan_id", "left_anti")
    touched = (mart.join(keys, "loan_id", "left_semi").drop(*PAYMENT_COLUMNS)
               .join(pay_rollup_affected, "loan_id", "left"))
    coll_arrears = X.money(_z("collected_arrears"))
    cols = {
        "n_payments": _z("n_payments").cast("bigint"),
        "collected": X.money(_z("collected")),
        "collected_arrears": coll_arrears,
        "last_payment_date": F.col("last_payment_date"),
        "arrears_coverage_pct": _coverage(F.col("balance_arrears"), coll_arrears),
    }
    touched = touched.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in MART_COLUMNS])
    return keep.unionByName(touched)
