"""Explicit schemas of the four raw model tables (the raw edge is never schema-inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY_T = T.DecimalType(18, 2)

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("full_name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("monthly_income", MONEY_T),
    T.StructField("created_at", T.DateType()),
])

LOANS = T.StructType([
    T.StructField("loan_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("origination_date", T.DateType()),
    T.StructField("principal_amount", MONEY_T),
    T.StructField("annual_rate", T.DecimalType(6, 4)),
    T.StructField("term_months", T.IntegerType()),
    T.StructField("loan_status", T.StringType()),
    T.StructField("product_type", T.StringType()),
])

INSTALLMENTS = T.StructType([
    T.StructField("installment_id", T.StringType()),
    T.StructField("loan_id", T.StringType()),
    T.StructField("installment_number", T.IntegerType()),
    T.StructField("due_date", T.DateType()),
    T.StructField("principal_due", MONEY_T),
    T.StructField("interest_due", MONEY_T),
    T.StructField("installment_status", T.StringType()),
])

PAYMENTS = T.StructType([
    T.StructField("payment_id", T.StringType()),
    T.StructField("loan_id", T.StringType()),
    T.StructField("installment_id", T.StringType()),
    T.StructField("payment_date", T.DateType()),
    T.StructField("payment_amount", MONEY_T),
    T.StructField("payment_channel", T.StringType()),
    T.StructField("payment_status", T.StringType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])

RAW = {"customers": CUSTOMERS, "loans": LOANS, "installments": INSTALLMENTS, "payments": PAYMENTS}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema`` (names and types), failing loudly on a missing column."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def assert_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Check names and types of a stage output against its contract."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    if got != want:
        raise AssertionError(f"schema mismatch:\n got  {got}\n want {want}")
    return df


# ------------------------------------------------------------------ stage output contracts
_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
    "money": T.DecimalType(18, 2), "money19": T.DecimalType(19, 2), "money38": T.DecimalType(38, 2),
    "rate": T.DecimalType(6, 4), "pct2": T.DecimalType(10, 2),
}


def _contract(spec: str) -> T.StructType:
    """``"name:type, ..."`` with the short type names above."""
    fields = [f.strip().split(":") for f in spec.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in fields])


STAGED = {
    "customers": _contract("customer_id:string, full_name:string, city:string, segment:string, "
                           "monthly_income:money, created_at:date"),
    "loans": _contract("loan_id:string, customer_id:string, origination_date:date, principal_amount:money, "
                       "annual_rate:rate, monthly_rate:double, term_months:int, loan_status:string, "
                       "product_type:string, cohort_month:string, level_payment:double"),
    "installments": _contract("installment_id:string, loan_id:string, installment_number:int, due_date:date, "
                              "principal_due:money, interest_due:money, total_due:money19, "
                              "installment_status:string, days_late:int, in_arrears:boolean, aging_bucket:string"),
    "payments": _contract("payment_id:string, loan_id:string, installment_id:string, payment_date:date, "
                          "payment_amount:money, payment_channel:string, payment_status:string, "
                          "orphan_installment:boolean, loaded_at:timestamp_ntz"),
}

MART = _contract(
    "loan_id:string, customer_id:string, customer_name:string, city:string, segment:string, product:string, "
    "origination_date:date, cohort_month:string, principal:money, annual_rate:rate, term_months:int, "
    "loan_status:string, monthly_income:money, n_installments:bigint, n_paid:bigint, n_arrears:bigint, "
    "n_upcoming:bigint, balance_open:money38, balance_arrears:money38, balance_current:money38, "
    "recovered_est:money38, max_days_late:int, aging_bucket:string, in_arrears:boolean, n_payments:bigint, "
    "collected:money38, collected_arrears:money38, last_payment_date:date, arrears_coverage_pct:double, "
    "as_of:date")
