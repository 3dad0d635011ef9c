"""A payment stream whose installments land before, after or never."""

import datetime as dt

from pyspark.sql import functions as F

from loanlake.streaming.orphans import settle_orphans, write_settled

T0 = dt.datetime(2030, 1, 1)
PAY, INST = "payment_id string, installment_id string, loaded_at timestamp_ntz", "installment_id string, landed_at timestamp_ntz"


def h(hours):
    return T0 + dt.timedelta(hours=hours)


def run(spark, root):
    pays = spark.readStream.schema(PAY).parquet(f"{root}/pays")
    inst = spark.readStream.schema(INST).parquet(f"{root}/inst")
    return write_settled(settle_orphans(pays, inst, wait="24 hours", reach="100 hours", delay="1 hour"), f"{root}/out", f"{root}/ck")


def land(spark, root, pays, inst):
    spark.createDataFrame(pays, PAY).coalesce(1).write.mode("append").parquet(f"{root}/pays")
    spark.createDataFrame(inst, INST).coalesce(1).write.mode("append").parquet(f"{root}/inst")


def settled(spark, root):
    rows = spark.read.parquet(f"{root}/out").select("payment_id", "orphan_installment").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1] for r in rows}


def test_orphans_wait_for_their_installments(spark, scratch):
    batches = [
        ([("before", "i1", h(2)), ("after", "i2", h(2)), ("never", "i9", h(3)), ("no id", None, h(3)), ("undated", "i1", None)], [("i1", h(1)), ("i1", h(1))]),
        ([("late row", "i1", h(1)), ("mid", "i3", h(20))], [("i2", h(22))]),       # 20 hours after its payment
        ([("too early", "i4", h(30))], [("i3", h(40))]),
        ([("x", None, h(60))], [("i4", h(56))]),                                    # 26 hours after: past the wait
        ([("y", None, h(400))], [("i5", h(400))]),
        ([("far", "i2", h(405)), ("z", None, h(800))], [("i6", h(800))]),           # i2 landed out of its reach
        ([("end", None, h(2000))], [("i7", h(2000))]),
    ]
    seen, sizes = {}, []
    for pays, inst in batches:  # each a run of its own: the checkpoint carries what is held
        land(spark, scratch, pays, inst)
        query = run(spark, scratch)
        now = settled(spark, scratch)
        assert seen.items() <= now.items()
        seen = now
        sizes.append(sum(s["numRowsTotal"] for s in (query.lastProgress or {"stateOperators": []})["stateOperators"]))
        if len(sizes) == 1:
            assert seen == {"no id": False, "undated": True, "before": False}
    assert seen == {"before": False, "after": False, "never": True, "no id": False, "undated": True, "late row": False, "mid": False,
                    "too early": True, "x": False, "y": False, "far": True, "z": False, "end": False}
    assert sizes[-1] <= 4  # what the watermark passed has left the state
    run(spark, scratch)
    assert settled(spark, scratch) == seen
    # where every installment lands within the wait and the reach, the result is the batch flag
    pays, inst = spark.read.schema(PAY).parquet(f"{scratch}/pays"), spark.read.schema(INST).parquet(f"{scratch}/inst")
    known = {r[0] for r in inst.collect()}
    for r in pays.where(F.col("payment_id").isin("before", "after", "never", "no id", "late row", "mid")).collect():
        assert seen[r.payment_id] == (r.installment_id is not None and r.installment_id not in known)
