"""Staging of the four raw tables: trim/canonicalise, derive business columns, flag bad rows,
keep the clean rows and route the rest to a rejected-rows frame with the reasons.

Every flag is ``CASE WHEN cond THEN TRUE ELSE FALSE``, so a NULL condition (e.g. a NULL status
tested with NOT IN) passes validation, exactly like the SQL it mirrors. Audit stamps
(``staged_at``) are added by the sink at write time, not here, so these plans are deterministic.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.functions import expr as X
from loanlake.operators.existence import with_not_in_flag
from loanlake.session import DEFAULT_AS_OF


@dataclass(frozen=True)
class StageSpec:
    columns: list[str]          # output columns of the clean table, in order
    flags: list[tuple[str, str]]  # (flag column, reason label), in reason order


CUSTOMER_SPEC = StageSpec(
    ["customer_id", "full_name", "city", "segment", "monthly_income", "created_at"],
    [("_f_no_id", "missing_id"), ("_f_income", "invalid_income"), ("_f_segment", "invalid_segment")],
)
LOAN_SPEC = StageSpec(
    ["loan_id", "customer_id", "origination_date", "principal_amount", "annual_rate", "monthly_rate",
     "term_months", "loan_status", "product_type", "cohort_month", "level_payment"],
    [("_f_no_id", "missing_id"), ("_f_no_customer", "missing_customer"), ("_f_amount", "invalid_amount"),
     ("_f_rate", "invalid_rate"), ("_f_term", "invalid_term"), ("_f_status", "invalid_status")],
)
INSTALLMENT_SPEC = StageSpec(
    ["installment_id", "loan_id", "installment_number", "due_date", "principal_due", "interest_due",
     "total_due", "installment_status", "days_late", "in_arrears", "aging_bucket"],
    [("_f_no_id", "missing_id"), ("_f_no_loan", "missing_loan"), ("_f_status", "invalid_status"),
     ("_f_outlier", "outlier_number")],
)
PAYMENT_SPEC = StageSpec(
    ["payment_id", "loan_id", "installment_id", "payment_date", "payment_amount", "payment_channel",
     "payment_status", "orphan_installment", "loaded_at"],
    [("_f_no_id", "missing_id"), ("_f_amount", "invalid_amount"), ("_f_status", "invalid_status"),
     ("_f_reversed", "reversed"), ("_f_pending", "pending")],
)


# ------------------------------------------------------------------------------ flagged frames

def flag_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        X.clean("customer_id").alias("customer_id"),
        X.clean("full_name").alias("full_name"),
        X.clean("city").alias("city"),
        X.clean("segment").alias("segment"),
        "monthly_income", "created_at",
        X.flag(X.is_blank("customer_id")).alias("_f_no_id"),
        X.flag(X.not_positive("monthly_income")).alias("_f_income"),
        X.flag(X.not_in(X.clean("segment"), X.CUSTOMER_SEGMENTS)).alias("_f_segment"),
    )


def flag_loans(raw: DataFrame) -> DataFrame:
    rate = F.col("annual_rate")
    return raw.select(
        X.clean("loan_id").alias("loan_id"),
        X.clean("customer_id").alias("customer_id"),
        "origination_date", "principal_amount", "annual_rate",
        X.monthly_rate(rate).alias("monthly_rate"),
        "term_months",
        X.canon("loan_status").alias("loan_status"),
        X.clean("product_type").alias("product_type"),
        X.cohort_month(F.col("origination_date")).alias("cohort_month"),
        X.level_payment(F.col("principal_amount"), rate, F.col("term_months")).alias("level_payment"),
        X.flag(X.is_blank("loan_id")).alias("_f_no_id"),
        X.flag(X.is_blank("customer_id")).alias("_f_no_customer"),
        X.flag(X.not_positive("principal_amount")).alias("_f_amount"),
        X.flag(rate.isNull() | (rate <= 0) | (rate > 1)).alias("_f_rate"),
        X.flag(X.not_positive("term_months")).alias("_f_term"),
        X.flag(X.not_in(X.canon("loan_status"), X.LOAN_STATUSES)).alias("_f_status"),
    )


def flag_installments(raw: DataFrame, as_of: dt.date = DEFAULT_AS_OF, keep: list[str] | None = None) -> DataFrame:
    """``keep``: further columns of ``raw`` to carry."""
    today = X.as_of_lit(as_of)
    status = X.canon("installment_status")
    due = F.col("due_date")
    return raw.select(
        X.clean("installment_id").alias("installment_id"),
        X.clean("loan_id").alias("loan_id"),
        "installment_number", "due_date", "principal_due", "interest_due",
        (F.coalesce(F.col("principal_due"), F.lit(0)) + F.coalesce(F.col("interest_due"), F.lit(0)))
        .cast("decimal(19,2)").alias("total_due"),
        status.alias("installment_status"),
        X.days_past_due(status, due, today).alias("days_late"),
        X.installment_in_arrears(status, due, today).alias("in_arrears"),
        X.installment_bucket(status, due, today).alias("aging_bucket"),
        X.flag(X.is_blank("installment_id")).alias("_f_no_id"),
        X.flag(X.is_blank("loan_id")).alias("_f_no_loan"),
        X.flag(X.not_in(status, X.INSTALLMENT_STATUSES)).alias("_f_status"),
        X.flag(F.col("installment_number") == X.OUTLIER_INSTALLMENT_NUMBER).alias("_f_outlier"),
        *(keep or []),
    )


def flag_payment_rows(raw: DataFrame) -> DataFrame:
    """The row rules of payments, without the orphan flag (which no rule needs)."""
    status = X.canon("payment_status")
    return raw.select(
        X.clean("payment_id").alias("payment_id"),
        X.clean("loan_id").alias("loan_id"),
        X.clean("installment_id").alias("installment_id"),
        "payment_date", "payment_amount",
        F.coalesce(X.clean("payment_channel"), F.lit(X.UNKNOWN_CHANNEL)).alias("payment_channel"),
        status.alias("payment_status"),
        "loaded_at",
        X.flag(X.is_blank("payment_id")).alias("_f_no_id"),
        X.flag(X.not_positive("payment_amount")).alias("_f_amount"),
        X.flag(X.not_in(status, X.PAYMENT_STATUSES)).alias("_f_status"),
        X.flag(status == F.lit("REVERSED")).alias("_f_reversed"),
        X.flag(status == F.lit("PENDING")).alias("_f_pending"),
    )


def flag_payments(raw: DataFrame, raw_installments: DataFrame) -> DataFrame:
    # Orphan: the trimmed installment id is NOT IN the *raw* installment ids (untrimmed).
    return with_not_in_flag(flag_payment_rows(raw), F.col("installment_id"), raw_installments, "installment_id",
                            "orphan_installment")


# ------------------------------------------------------------------------------ strict variants

def strict_customers(raw: DataFrame) -> DataFrame:
    """As ``flag_customers``, but an unknown (NULL) segment is invalid too."""
    return flag_customers(raw).withColumn("_f_segment", F.col("_f_segment") | F.col("segment").isNull())


def strict_loans(raw: DataFrame) -> DataFrame:
    """As ``flag_loans``, but an unknown status is invalid too."""
    return flag_loans(raw).withColumn("_f_status", F.col("_f_status") | F.col("loan_status").isNull())


def strict_installments(raw: DataFrame, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    """As ``flag_installments``, but an unknown status is invalid and nothing is in arrears before it is due."""
    overdue = F.coalesce(F.col("due_date") < X.as_of_lit(as_of), F.lit(False))
    return (flag_installments(raw, as_of)
            .withColumn("_f_status", F.col("_f_status") | F.col("installment_status").isNull())
            .withColumn("in_arrears", F.col("in_arrears") & overdue))


def strict_payments(raw: DataFrame, raw_installments: DataFrame) -> DataFrame:
    """As ``flag_payments``, but an unknown status is invalid too."""
    return flag_payments(raw, raw_installments).withColumn(
        "_f_status", F.col("_f_status") | F.col("payment_status").isNull())


# ------------------------------------------------------------------------------ clean / rejected

def _clean(flagged: DataFrame, spec: StageSpec) -> DataFrame:
    keep = None
    for name, _ in spec.flags:
        cond = ~F.col(name)
        keep = cond if keep is None else keep & cond
    return flagged.where(keep).select(*spec.columns)


def layer_counts(flagged: DataFrame, spec: StageSpec, table: str) -> DataFrame:
    """(layer, table_name, n_rows) of the raw, staged and rejected rows in one pass over the table: a
    rejected row is one that is not staged."""
    broken = F.lit(False)
    for name, _ in spec.flags:
        broken = broken | F.col(name)
    n = flagged.agg(F.count(F.lit(1)).alias("n"), F.count_if(broken).alias("bad"))
    return n.selectExpr(f"stack(3, 'raw', '{table}', n, 'staging', '{table}', n - bad, 'rejected', '{table}', bad) "
                        "AS (layer, table_name, n_rows)")


def _rejected(flagged: DataFrame, spec: StageSpec) -> DataFrame:
    any_bad = None
    for name, _ in spec.flags:
        any_bad = F.col(name) if any_bad is None else any_bad | F.col(name)
    reasons = F.concat_ws(",", *[F.when(F.col(n), F.lit(label)) for n, label in spec.flags])
    return flagged.where(any_bad).select(*spec.columns, reasons.alias("reject_reasons"))


def stage_customers(raw: DataFrame, strict: bool = False) -> DataFrame:
    return _clean((strict_customers if strict else flag_customers)(raw), CUSTOMER_SPEC)


def stage_loans(raw: DataFrame, strict: bool = False) -> DataFrame:
    return _clean((strict_loans if strict else flag_loans)(raw), LOAN_SPEC)


def stage_installments(raw: DataFrame, as_of: dt.date = DEFAULT_AS_OF, strict: bool = False) -> DataFrame:
    return _clean((strict_installments if strict else flag_installments)(raw, as_of), INSTALLMENT_SPEC)


def clean_payment_rows(raw: DataFrame) -> DataFrame:
    """Clean payments without the orphan flag: a filter, no join."""
    columns = [c for c in PAYMENT_SPEC.columns if c != "orphan_installment"]
    return _clean(flag_payment_rows(raw), StageSpec(columns, PAYMENT_SPEC.flags))


def stage_payments(raw: DataFrame, raw_installments: DataFrame, strict: bool = False) -> DataFrame:
    """Clean payments: CONFIRMED (or NULL-status, unless ``strict``) with a positive amount; orphans are kept
    with a flag."""
    return _clean((strict_payments if strict else flag_payments)(raw, raw_installments), PAYMENT_SPEC)


def normalize_channels(payments: DataFrame, master: DataFrame) -> DataFrame:
    """Replace ``payment_channel`` by the master table's name for it (``alias`` -> ``channel``; aliases are
    unique). Unlisted channels stay. Spark broadcasts the master if its measured size allows."""
    known = master.select(F.upper(F.trim("alias")).alias("_alias"), F.col("channel").alias("_channel"))
    joined = payments.join(known, F.upper(F.col("payment_channel")) == F.col("_alias"), "left")
    return joined.select(*[F.coalesce("_channel", "payment_channel").alias(c) if c == "payment_channel" else c
                           for c in payments.columns])


def rejected_customers(raw: DataFrame) -> DataFrame:
    return _rejected(flag_customers(raw), CUSTOMER_SPEC)


def rejected_loans(raw: DataFrame) -> DataFrame:
    return _rejected(flag_loans(raw), LOAN_SPEC)


def rejected_installments(raw: DataFrame, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    return _rejected(flag_installments(raw, as_of), INSTALLMENT_SPEC)


def rejected_payments(raw: DataFrame, raw_installments: DataFrame) -> DataFrame:
    return _rejected(flag_payments(raw, raw_installments), PAYMENT_SPEC)
