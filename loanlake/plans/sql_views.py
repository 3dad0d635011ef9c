"""Expose the model as SQL temp views so analysts can keep querying it with SQL.

Registers the raw, staged and analytic layers under stable names; each view is the lazy
DataFrame plan (Catalyst inlines it into whatever SQL runs on top). Example::

    register_views(spark, LendingModel.from_driver(spark, "/data/sf1"))
    spark.sql("SELECT cohort_month, arrears_pct FROM cohort_portfolio ORDER BY cohort_month")
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from loanlake.plans import questions as Q
from loanlake.plans import views as V
from loanlake.plans.model import LendingModel


def register_views(spark: SparkSession, m: LendingModel, prefix: str = "") -> list[str]:
    disb = V.disbursement_daily(m.loans, m.customers)
    coll = V.collections_daily(m.payments, m.installments)
    frames = {
        "raw_customers": m.raw.customers, "raw_loans": m.raw.loans,
        "raw_installments": m.raw.installments, "raw_payments": m.raw.payments,
        "stg_customers": m.customers, "stg_loans": m.loans,
        "stg_installments": m.installments, "stg_payments": m.payments,
        "portfolio_mart": m.mart,
        "disbursement_daily": disb,
        "collections_daily": coll,
        "cohort_portfolio": V.cohort_portfolio(m.mart),
        "bi_dataset": V.bi_dataset(m.mart),
        "portfolio_kpis": Q.portfolio_kpis(m.mart),
    }
    names = []
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
