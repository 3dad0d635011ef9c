"""Invariants on the driver tables."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from loanlake.operators import staging
from loanlake.plans import views as V
from loanlake.plans.model import LendingModel

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def m(spark):
    return LendingModel.from_driver(spark, SF)


def test_staged_plus_rejected_is_raw(m):
    raw = m.raw
    assert m.customers.count() + staging.rejected_customers(raw.customers).count() == raw.customers.count()
    assert m.loans.count() + staging.rejected_loans(raw.loans).count() == raw.loans.count()
    assert (m.installments.count() + staging.rejected_installments(raw.installments, m.as_of).count()
            == raw.installments.count())
    assert (m.payments.count() + staging.rejected_payments(raw.payments, raw.installments).count()
            == raw.payments.count())


def test_mart_rows_are_open_loans(m):
    assert m.mart.count() == m.loans.where(F.col("loan_status").isin("ACTIVE", "DEFAULT")).count()
    assert m.mart.select("loan_id").distinct().count() == m.mart.count()


def test_payment_rollup_covers_all_staged_payments(m):
    agg = m.payment_rollup.agg(F.sum("n_payments").alias("n"), F.sum("collected").alias("c")).first()
    staged = m.payments.agg(F.count(F.lit(1)).alias("n"), F.sum("payment_amount").alias("c")).first()
    assert (agg["n"], agg["c"]) == (staged["n"], staged["c"])
    mart = m.mart.agg(F.sum("collected").alias("c")).first()["c"]
    assert mart <= staged["c"]


def test_daily_split_and_balances(m):
    for r in V.collections_daily(m.payments, m.installments).collect():
        assert r["collected_arrears"] + r["collected_current"] == r["total_collected"]
    negative = m.installments.where("total_due < 0").select("loan_id").distinct()  # planted defects
    bad = (m.mart.join(negative, "loan_id", "left_anti")
           .where(F.col("balance_open") < F.col("balance_arrears")).count())
    assert bad == 0


def test_running_total_ends_at_city_total(spark, m):
    from loanlake.plans import questions as Q
    q1 = Q.q1_disbursement(V.disbursement_daily(m.loans, m.customers))
    last = {}
    for r in q1.collect():
        key = r["city"]
        if key not in last or (r["running_city_total"] > last[key]):
            last[key] = r["running_city_total"]
    totals = {r["city"]: r["t"] for r in V.disbursement_daily(m.loans, m.customers)
              .groupBy("city").agg(F.sum("total_disbursed").alias("t")).collect()}
    assert last == totals
    shares = q1.groupBy("disbursement_date").agg(F.sum("day_share_pct").alias("s")).collect()
    assert all(abs(r["s"] - 100) < 0.01 * 60 for r in shares)  # rounding of up to 60 rows per day
    assert D("0") not in last.values()


def test_no_machine_local_checkpoints_on_a_cluster():
    import pytest

    from loanlake.session import ensure_checkpoint_dir, is_local

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        def __init__(self, **kw):
            self.conf = Conf({k.replace("_", "."): v for k, v in kw.items()})

    for master in ("yarn", "spark://host:1", "local-cluster[2,1,1024]", "k8s://x"):
        session = Session(spark_master=master)
        assert not is_local(session)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(session)
    assert is_local(Session(spark_master="local[4]")) and is_local(Session(spark_master="local"))
    assert ensure_checkpoint_dir(Session(spark_master="yarn", **{"spark_checkpoint_dir": "s3://b/c"})) == "s3://b/c"
