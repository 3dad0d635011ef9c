import datetime as dt

from pyspark.sql import functions as F

from fixtures import FixtureRaw, ts
from loanlake.operators import staging
from loanlake.operators.upsert import append_new, dedup_latest, upsert
from loanlake.sources import schemas, sinks
from loanlake.streaming.incremental import (MARK, IncrementalPayments, merge_payments, next_staging_mark,
                                            read_mark, stream_payments)


def ids(df):
    return sorted(r["payment_id"] for r in df.select("payment_id").collect())


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def test_two_batches_equal_one_full_load(spark, scratch):
    raw = FixtureRaw(spark)
    full = merge_payments(None, raw.payments, raw.installments)

    def run(payments):
        p = sinks.Publication(spark, scratch)
        staged = p.read("stg_payments") if p.path("stg_payments") else None
        r = IncrementalPayments(spark, read_mark(spark, scratch)).run(
            payments, raw.installments, staged, lambda df: p.write(df, "stg_payments"))
        p.commit({MARK: r["new_mark"]})
        return r

    r1 = run(raw.payments.where(F.col("loaded_at") <= ts(3)))
    assert r1["new_mark"] == ts(3) and read_mark(spark, scratch) == ts(3)
    r2 = run(raw.payments)
    assert r2["previous_mark"] == ts(3) and r2["new_mark"] == ts(6)
    final = sinks.read_table(spark, scratch, "stg_payments")
    assert rows(final) == rows(full)
    # replaying with nothing new leaves the table and advances nothing
    r3 = run(raw.payments)
    assert r3["new_rows"] == 0 and rows(sinks.read_table(spark, scratch, "stg_payments")) == rows(full)


def test_merge_removes_reversed_and_reflags_orphans(spark):
    raw = FixtureRaw(spark)
    staged = merge_payments(None, raw.payments, raw.installments)
    first = staged.where("not orphan_installment").first()
    change = (raw.payments.where(F.trim("payment_id") == first["payment_id"])
              .withColumn("payment_status", F.lit("REVERSED"))
              .withColumn("loaded_at", F.lit(dt.datetime(2031, 1, 1)).cast("timestamp_ntz")))
    fewer = raw.installments.where(F.col("installment_id") != staged.where("not orphan_installment").orderBy(
        F.desc("payment_id")).first()["installment_id"])
    before = merge_payments(None, raw.payments, fewer)
    after = merge_payments(before, change, raw.installments)
    want = merge_payments(None, raw.payments.unionByName(change), raw.installments)
    assert first["payment_id"] not in ids(after) and rows(after) == rows(want)
    # an older version that arrives late changes nothing
    late = raw.payments.withColumn("loaded_at", F.lit(dt.datetime(2001, 1, 1)).cast("timestamp_ntz"))
    assert rows(merge_payments(after, late.where(F.trim("payment_id").isin(*ids(after))), raw.installments)) == rows(after)


def test_staging_mark(spark):
    raw = FixtureRaw(spark)
    staged = merge_payments(None, raw.payments, raw.installments)
    got = next_staging_mark(staged).first()
    assert got["n_rows"] == staged.count() and got["last_loaded_at"] <= ts(6)


def test_upsert_replay_is_idempotent_and_updates_win(spark):
    raw = FixtureRaw(spark)
    staged = staging.stage_payments(raw.payments, raw.installments)
    again = upsert(staged, staged, ["payment_id"], ["loaded_at"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, staged.collect()))
    change = staged.where(F.col("payment_id") == "P1").withColumn("payment_amount", F.col("payment_amount") + 1)
    merged = {r["payment_id"]: r for r in upsert(staged, change, ["payment_id"], ["loaded_at"]).collect()}
    assert merged["P1"]["payment_amount"] == staged.where("payment_id = 'P1'").first()["payment_amount"] + 1
    appended = append_new(staged, change, ["payment_id"])  # insert-only keeps the stored row
    assert appended.count() == staged.count()


def test_dedup_keeps_latest_stamp(spark):
    raw = FixtureRaw(spark)
    staged = staging.stage_payments(raw.payments, raw.installments)
    later = staged.where("payment_id = 'P2'").withColumn("loaded_at", F.lit(dt.datetime(2031, 1, 1)).cast("timestamp_ntz"))
    out = {r["payment_id"]: r for r in dedup_latest(staged.unionByName(later), ["payment_id"], ["loaded_at"]).collect()}
    assert len(out) == staged.count() and out["P2"]["loaded_at"] == dt.datetime(2031, 1, 1)


def test_available_now_stream_upserts_landing_files(spark, scratch):
    raw = FixtureRaw(spark)
    landing = f"{scratch}/landing"
    raw.payments.where(F.col("loaded_at") <= ts(3)).write.parquet(f"{landing}/batch1")
    target = f"{scratch}/target"

    def on_batch(df, epoch_id):
        delta = staging.stage_payments(df, raw.installments)
        cur = sinks.current_path(spark, target, "stg_payments")
        merged = delta if cur is None else upsert(spark.read.parquet(cur), delta, ["payment_id"], ["loaded_at"])
        sinks.write_table(merged, target, "stg_payments")

    ck = f"{scratch}/ck"
    stream_payments(spark, f"{landing}/*", "parquet", schemas.PAYMENTS, ck, on_batch)
    first = ids(sinks.read_table(spark, target, "stg_payments"))
    raw.payments.where(F.col("loaded_at") > ts(3)).write.parquet(f"{landing}/batch2")
    stream_payments(spark, f"{landing}/*", "parquet", schemas.PAYMENTS, ck, on_batch)
    final = ids(sinks.read_table(spark, target, "stg_payments"))
    assert set(first) < set(final)
    assert final == ids(staging.stage_payments(raw.payments, raw.installments))


def test_stream_drops_redelivered_ids_within_watermark(spark, scratch):
    raw = FixtureRaw(spark)
    landing = f"{scratch}/landing"
    raw.payments.write.parquet(f"{landing}/b1")
    raw.payments.where(F.col("payment_id").isin("P1", "P2")).write.parquet(f"{landing}/b2")  # re-delivery
    seen = []

    def on_batch(df, epoch_id):
        seen.extend(r["payment_id"] for r in df.select("payment_id").collect())

    stream_payments(spark, f"{landing}/*", "parquet", schemas.PAYMENTS, f"{scratch}/ck", on_batch,
                    dedup_delay="1 day")
    assert sorted(seen) == sorted(r["payment_id"] for r in raw.payments.collect())
