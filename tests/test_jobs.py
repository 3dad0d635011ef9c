import datetime as dt

import pytest

from fixtures import AS_OF
from loanlake.plans import jobs
from loanlake.sources import sinks
from loanlake.streaming.incremental import merge_payments, read_mark
from conftest import SMALL


def test_full_job_then_incremental_and_export(spark, scratch):
    out = jobs.run_full(spark, SMALL, scratch)
    assert out["checks"] == 30
    mart = sinks.read_table(spark, scratch, "portfolio_mart")
    assert mart.count() == out["kpis"]["n_loans"]
    assert "refreshed_at" in mart.columns
    for name in ("stg_customers", "stg_loans", "stg_installments", "stg_payments",
                 "rejected_payments", "quality_report"):
        assert sinks.current_path(spark, scratch, name) is not None
    # the full run stored the mark, so a second incremental pass finds nothing new
    again = jobs.run_incremental(spark, SMALL, scratch)
    assert again["new_rows"] == 0
    jobs.run_export(spark, scratch, f"{scratch}/csv")
    back = spark.read.option("header", True).csv(f"{scratch}/csv")
    assert back.count() == mart.count() and len(back.columns) == 39


def raw_states(spark):
    """Raw tables before and after: new, changed, reversed and late payments, a late installment."""
    from pyspark.sql import functions as F

    from fixtures import FixtureRaw, ts
    full = FixtureRaw(spark)
    staged = merge_payments(None, full.payments, full.installments)
    known = staged.where("not orphan_installment").orderBy("loaded_at", "payment_id").select(
        "payment_id", "installment_id").collect()
    reversed_id, late_installment = known[0]["payment_id"], known[1]["installment_id"]
    early = full.payments.where(F.col("loaded_at") <= ts(3))
    before = FixtureRaw(spark, {"payments": early, "installments": full.installments.where(
        F.col("installment_id") != late_installment)})
    change = (early.where(F.trim("payment_id") == reversed_id).withColumn("payment_status", F.lit("REVERSED"))
              .withColumn("loaded_at", F.lit(ts(5)).cast("timestamp_ntz")))
    late = (early.limit(1).withColumn("payment_id", F.lit("LATE-1")).withColumn("payment_status", F.lit("CONFIRMED"))
            .withColumn("payment_amount", F.lit(77).cast("decimal(18,2)"))
            .withColumn("loaded_at", F.lit(ts(3) - dt.timedelta(hours=6)).cast("timestamp_ntz")))
    after = FixtureRaw(spark, {"payments": full.payments.unionByName(change).unionByName(late)})
    return before, after, reversed_id


def published(spark, root):
    return {n: sorted(map(tuple, sinks.read_table(spark, root, n).drop("refreshed_at", "staged_at").collect()), key=str)
            for n in ("stg_customers", "stg_loans", "stg_installments", "stg_payments", "portfolio_mart", "rejected_payments")}


def test_incremental_job_equals_a_full_build(spark, scratch):
    before, after, gone = raw_states(spark)
    jobs.run_full(spark, None, f"{scratch}/a", AS_OF, raw=before)
    r = jobs.run_incremental(spark, None, f"{scratch}/a", AS_OF, raw=after)
    jobs.run_full(spark, None, f"{scratch}/b", AS_OF, raw=after)
    assert r["new_rows"] > 0 and published(spark, f"{scratch}/a") == published(spark, f"{scratch}/b")
    ids = {x["payment_id"] for x in sinks.read_table(spark, f"{scratch}/a", "stg_payments").collect()}
    assert gone not in ids and "LATE-1" in ids
    assert sinks.vacuum(spark, f"{scratch}/a", keep=1) > 0
    assert published(spark, f"{scratch}/a") == published(spark, f"{scratch}/b")


@pytest.mark.parametrize("where", ["stg_payments", "stg_installments", "portfolio_mart", "commit"])
def test_failed_run_changes_nothing_and_the_retry_finishes(spark, scratch, monkeypatch, where):
    before, after, _ = raw_states(spark)
    jobs.run_full(spark, None, scratch, AS_OF, raw=before)
    state, mark = published(spark, scratch), read_mark(spark, scratch)
    write, commit = sinks.Publication.write, sinks.Publication.commit

    def failing_write(self, df, name, *a, **k):
        path = write(self, df, name, *a, **k)
        if name == where:
            raise RuntimeError("lost after the write")
        return path

    def failing_commit(self, marks=None):
        raise RuntimeError("lost before the commit")

    monkeypatch.setattr(sinks.Publication, "write", failing_write)
    if where == "commit":
        monkeypatch.setattr(sinks.Publication, "commit", failing_commit)
    with pytest.raises(RuntimeError):
        jobs.run_incremental(spark, None, scratch, AS_OF, raw=after)
    monkeypatch.setattr(sinks.Publication, "write", write)
    monkeypatch.setattr(sinks.Publication, "commit", commit)
    assert published(spark, scratch) == state and read_mark(spark, scratch) == mark
    jobs.run_incremental(spark, None, scratch, AS_OF, raw=after)
    jobs.run_full(spark, None, f"{scratch}/again", AS_OF, raw=after)
    assert published(spark, scratch) == published(spark, f"{scratch}/again")


def test_unreadable_commit_log_is_an_error(spark, scratch):
    import os
    before, _, _ = raw_states(spark)
    p = sinks.Publication(spark, scratch)
    p.write(before.payments, "stg_payments")
    p.commit()
    for name in os.listdir(f"{scratch}/_commits"):
        if name.startswith("part-"):
            with open(f"{scratch}/_commits/{name}", "wb") as f:
                f.write(b"not a parquet file")
            os.remove(f"{scratch}/_commits/.{name}.crc")
    with pytest.raises(Exception):
        sinks.current_path(spark, scratch, "stg_payments")
    with pytest.raises(Exception):
        jobs.run_incremental(spark, None, scratch, AS_OF, raw=before)
    assert sinks.current_path(spark, f"{scratch}/nothing-here", "stg_payments") is None


def test_checks_can_stop_the_job_and_errors_are_rows(spark, scratch):
    before, _, _ = raw_states(spark)
    with pytest.raises(jobs.ChecksFailed):
        failing = {r["check_name"] for r in jobs.run_checks(before) if not r["passed"]}
        jobs.run_full(spark, None, scratch, AS_OF, raw=before, fail_on=failing)
    assert sinks.current_path(spark, scratch, "portfolio_mart") is None
    from fixtures import FixtureRaw
    broken = FixtureRaw(spark, {"payments": before.payments.drop("payment_channel")})
    rows = {r["seq"]: r for r in jobs.run_checks(broken)}
    assert len(rows) == 30 and rows[25]["failed_count"] == -1 and not rows[25]["passed"]
    assert all(r["failed_count"] >= 0 for seq, r in rows.items() if seq != 25)


def test_mart_files_follow_months(spark, scratch):
    import glob
    jobs.run_full(spark, "/root/testdata/sf0.01", scratch)
    path = sinks.current_path(spark, scratch, "portfolio_mart")
    months = glob.glob(f"{path}/cohort_month=*")
    assert len(glob.glob(f"{path}/cohort_month=*/part-*")) <= len(months) + 8


def test_job_mart_lands_the_installments_once(spark, monkeypatch):
    from loanlake.plans import catalog
    plans = []
    monkeypatch.setattr(jobs, "run_incremental", lambda s, d, root, raw: plans.append(
        raw.installments._jdf.queryExecution().executedPlan().toString()))
    with pytest.raises(FileNotFoundError):  # the job that publishes is left out
        catalog.QUERIES["incremental_job_mart"](spark, SMALL)
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)
