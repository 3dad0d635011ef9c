"""Segmented tables: the key index, scoped writes, vacuum."""

import hashlib
import os
import random

from pyspark.sql import functions as F

from loanlake.sources import segments, sinks

ROW = "id string, ref string, month string, v long"


def files(p, name, skip=()):
    """Digest of every data file of the segments not in ``skip``."""
    out = {}
    for e in p.entries(name):
        if e["segment"] not in skip:
            for f in os.listdir(e["path"]):
                if f.endswith(".parquet"):
                    with open(f"{e['path']}/{f}", "rb") as file:
                        out[f"{e['path']}/{f}"] = hashlib.sha256(file.read()).hexdigest()
    return out


def test_index_finds_exactly_the_segments_of_a_key(spark, scratch):
    rng = random.Random(3)
    rows = [(f"k{rng.randrange(4000)}", rng.choice([None, f"r{rng.randrange(50)}"]), f"s{rng.randrange(12)}", i) for i in range(6000)]
    p = sinks.Publication(spark, scratch)
    p.write_segments(spark.createDataFrame(rows, ROW), "t", F.col("month"), ["id", "ref"])
    ids, refs = [f"k{i}" for i in range(0, 5000, 617)] + ["", "zzz"], ["r3", "r49", "r99"]
    for key, column, values in (("id", 0, ids), ("ref", 1, refs)):
        for v in values:
            asked = spark.createDataFrame([(key, v), (key, None)], "key string, value string")
            assert p.holding("t", asked) == {r[2] for r in rows if r[column] == v}
    every = spark.createDataFrame([("id", v) for v in ids] + [("ref", v) for v in refs], "key string, value string")
    assert p.holding("t", every) == {r[2] for r in rows if r[0] in ids or r[1] in refs}
    assert p.holding("t", every.limit(0)) == set()


def test_replaced_segments_leave_the_others_as_they_are(spark, scratch):
    rows = [(f"k{i}", None, f"s{i % 5}", i) for i in range(500)] + [("gone", None, "-s1", 1)]
    p = sinks.Publication(spark, scratch)
    names = p.write_segments(spark.createDataFrame(rows, ROW), "t", F.col("month"), ["id"])
    p.commit()
    assert names == {"s0", "s1", "s2", "s3", "s4", "-s1"} and p.read("t").count() == 500
    assert p.read_segments("t", {"-s1"}).first()["id"] == "gone"
    before = files(p, "t", {"s2"})
    p = sinks.Publication(spark, scratch)
    new = p.read_segments("t", {"s2"}).drop(segments.SEGMENT).where("v > 100").withColumn("v", F.col("v") + 1)
    p.write_segments(new.unionByName(spark.createDataFrame([("n", "r", "s9", 7)], ROW)), "t", F.col("month"), ["id"], replace={"s2"})
    p.commit()
    assert files(p, "t", {"s2", "s9"}) == before
    want = sorted([r for r in rows[:-1] if r[2] != "s2"] + [(*r[:3], r[3] + 1) for r in rows if r[2] == "s2" and r[3] > 100] + [("n", "r", "s9", 7)], key=str)
    assert sorted(map(tuple, sinks.read_table(spark, scratch, "t").collect()), key=str) == want
    # appended segments share a name; vacuum keeps what the newest manifest names
    p.write_segments(spark.createDataFrame([("more", None, "s9", 8)], ROW), "t", F.col("month"), ["id"], replace=set())
    p.commit()
    assert p.holding("t", spark.createDataFrame([("id", "more")], "key string, value string")) == {"s9"}
    assert sinks.vacuum(spark, scratch, keep=1) == 2  # two manifests; each data version still has a segment in use
    assert sinks.read_table(spark, scratch, "t").count() == len(want) + 1
    p.write_segments(spark.createDataFrame([], ROW), "t", F.col("month"), ["id"])
    p.commit()
    assert sinks.read_table(spark, scratch, "t").columns == ["id", "ref", "month", "v"]
    assert sinks.read_table(spark, scratch, "t").count() == 0 and p.holding("t", spark.createDataFrame([("id", "k1")], "key string, value string")) == set()
    assert sinks.vacuum(spark, scratch, keep=1) > 0


def test_filters_are_built_without_a_join_by_segment(spark):
    rows = spark.createDataFrame([(str(i), "s202401") for i in range(50)], f"payment_id string, {segments.SEGMENT} string")
    filters = segments._filters(rows, ["payment_id"], {"s202401": 10})
    plan = filters._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {r["segment"] for r in filters.collect()} == {"s202401"} and filters.count() <= 10
