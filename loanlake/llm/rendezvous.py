"""Sharding by weighted rendezvous hashing, in DataFrame functions only.

Each (record key, shard) pair has a score -ln(u) / weight, u in (0, 1) from the MD5 of key and
shard; the record goes to the shard of the smallest score. A shard's share is its weight's share,
and a new shard takes records only into itself, from all others in proportion.

``slot`` numbers the records of a shard from 0 without gaps. Records are spread over 4,096 hash
buckets a shard, numbered inside each bucket by a window, and shifted by the running total of the
bucket counts (at most 4,096 rows a shard). Equal records are counted before the shuffle and
expanded after, so a frequent one is a single row of its window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEX_DIGITS = 12  # of the MD5 that make u
BUCKET_DIGITS = 3


def score(key: Column, shard: int, weight: float) -> Column:
    """The pair's score as a double; ``key`` is a string."""
    digest = F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary"))
    u = (F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double") + 0.5) / float(16 ** HEX_DIGITS)
    return -F.log(u) / F.lit(float(weight))


def choose_shard(key: Column, weights: list[float]) -> Column:
    """Number of the shard with the smallest score (ties: the smaller number). A shard of weight 0
    takes nothing."""
    if any(w < 0 for w in weights) or not any(w > 0 for w in weights):
        raise ValueError("weights are 0 or more, one of them more")
    scored = [F.struct(score(key, s, w).alias("score"), F.lit(s).alias("shard"))
              for s, w in enumerate(weights) if w > 0]
    return F.array_min(F.array(*scored))["shard"]


def shard_records(rows: DataFrame, key: str, weights: list[float], added_weight: float | None = None,
                  columns: list[str] | None = None) -> DataFrame:
    """Rows of (key, ``columns``) with ``shard``, ``slot`` and ``grown_shard`` (the shard if one of
    weight ``added_weight`` joined; null without it).

    Only the key decides: rows of one key share a shard. A null key is the key ``\\N``. Repeated
    rows take a slot each. Empty input: empty result. ``columns`` are carried as they are; their
    names must not be ``shard``, ``slot`` or ``grown_shard``.
    """
    carried = [key, *(columns or [])]
    clash = {"shard", "slot", "grown_shard"} & set(carried)
    if clash:
        raise ValueError(f"reserved names: {sorted(clash)}")
    named = rows.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)])
    text = F.coalesce(F.col("c0").cast("string"), F.lit("\\N"))
    shown = F.concat_ws("|", *[F.coalesce(F.col(f"c{i}").cast("string"), F.lit("\\N"))
                               for i in range(len(carried))])
    cols = [f"c{i}" for i in range(len(carried))]
    # one row per distinct record; counted before the shuffle
    counted = named.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))
    placed = (counted.withColumn("shard", choose_shard(text, weights))
              .withColumn("bucket", F.substring(F.md5(shown.cast("binary")), 1, BUCKET_DIGITS)))
    if added_weight is None:
        placed = placed.withColumn("grown_shard", F.lit(None).cast("int"))
    else:
        placed = placed.withColumn("grown_shard", choose_shard(text, [*weights, added_weight]))
    inside = Window.partitionBy("shard", "bucket").orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    numbered = placed.withColumn("upto", F.sum("copies").over(inside))
    totals = placed.groupBy("shard", "bucket").agg(F.sum("copies").alias("rows"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    last = F.col("base") + F.col("upto") - 1
    out = numbered.join(offsets, ["shard", "bucket"]).withColumn(
        "slot", F.explode(F.sequence(last - F.col("copies") + 1, last)))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)],
                      F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
                      F.col("grown_shard").cast("int").alias("grown_shard"))
