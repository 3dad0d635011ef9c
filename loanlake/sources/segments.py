"""Segmented tables: a table as immutable folders of rows, with an index that finds the folders of a key.

A segment is a folder of Parquet files named by a value that every row knows (a load month, a hash bucket).
The manifest lists the segments with their rows and, per indexed key, the smallest and greatest value and the
size of a Bloom filter; the filters are Parquet tables of 64-bit words beside the data. A writer replaces or
adds segments and writes a new manifest; all others stay the files they are. Which manifest counts is said by the
commit (``sources/sinks.py``).

Finding the segments of many keys is three joins, none of which reads other columns: by key range, by filter
words, and by the key columns of the segments that are left, so the answer is exact. Segments whose name starts
with ``-`` are kept beside the table (versions that are not part of it) and read only by name.

Only manifests, a row per segment, are held by the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT = "_segment"
BITS_PER_KEY, HASHES = 12, 6
ENTRY = ("segment string, path string, bloom string, n_rows long, "
         "keys array<struct<name: string, lo: string, hi: string, words: long>>, row_schema string")


def hidden(segment: str) -> bool:
    return segment.startswith("-")


def _positions(value: Column, words: Column) -> Column:
    """Bit numbers of a value in a filter of ``words`` 64-bit words."""
    return F.array(*[F.pmod(F.xxhash64(value, F.lit(i)), words * 64) for i in range(HASHES)])


def _bit(position: str) -> Column:
    return F.expr(f"shiftleft(1L, cast({position} % 64 AS int))")


def _stacked(df: DataFrame, keys: list[str]) -> DataFrame:
    """(segment, key, value) of the non-null values of the key columns."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys])
    return (df.select(SEGMENT, F.explode(pairs).alias("_p")).select(SEGMENT, "_p.key", "_p.value")
            .where("value IS NOT NULL"))


def _filters(rows: DataFrame, keys: list[str], words: dict[str, int]) -> DataFrame:
    """(segment, key, word, bits) of the filters. The sizes, a row per segment, are broadcast: a join by segment would
    bring all values of a month together in one task."""
    sizes = F.broadcast(rows.sparkSession.createDataFrame(list(words.items()), "_of string, words long"))
    bits = (_stacked(rows, keys).join(sizes, F.col(SEGMENT) == F.col("_of"))
            .select(F.col(SEGMENT).alias("segment"), "key",
                    F.explode(_positions(F.col("value"), F.col("words"))).alias("position")))
    return bits.groupBy("segment", "key", F.expr("position div 64").alias("word")).agg(
        F.bit_or(_bit("position")).alias("bits"))


def describe(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> list[tuple]:
    """Index the segments below ``path`` (written by ``SEGMENT``) and return their manifest entries."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(SEGMENT, T.StringType())])).parquet(path)
    bounds = [f(F.col(k).cast("string")) for k in keys for f in (F.min, F.max)]
    stats = rows.groupBy(SEGMENT).agg(F.count(F.lit(1)), *bounds).collect()
    words = {r[0]: max(1, -(-r[1] * BITS_PER_KEY // 64)) for r in stats}
    bloom = f"{path}/_bloom"
    if keys and stats:
        _filters(rows, keys, words).write.partitionBy("segment").parquet(bloom)
    out = []
    for r in stats:
        spans = [(k, r[2 + 2 * i], r[3 + 2 * i], words[r[0]]) for i, k in enumerate(keys) if r[2 + 2 * i] is not None]
        out.append((r[0], f"{path}/{SEGMENT}={r[0]}", f"{bloom}/segment={r[0]}" if spans else None, r[1], spans, None))
    return out


def read(spark: SparkSession, entries: list, schema: T.StructType, named: bool = False) -> DataFrame:
    """The rows of the given entries; ``named`` adds their segment."""
    fields = [*schema.fields, *([T.StructField(SEGMENT, T.StringType())] if named else [])]
    if not entries:
        return spark.createDataFrame([], T.StructType(fields))
    rows = spark.read.schema(schema).parquet(*[e[1] for e in entries])
    if not named:
        return rows
    name = F.regexp_extract(F.col("_metadata.file_path"), f"/{SEGMENT}=([^/]+)/", 1)
    return rows.select("*", name.alias(SEGMENT))


def holding(spark: SparkSession, entries: list, schema: T.StructType, values: DataFrame) -> set[str]:
    """Names of the segments that hold any of ``values`` (key, value), hidden ones included."""
    spans = spark.createDataFrame([(e[0], *k) for e in entries for k in e[4]],
                                  "segment string, key string, lo string, hi string, words long")
    if not entries:
        return set()
    # one array of all spans (a row per segment and key), so that ranges need no join by inequality
    every = spans.agg(F.collect_list(F.struct("segment", "key", "lo", "hi", "words"))).scalar()
    inside = F.filter("_spans", lambda s: (s["key"] == F.col("key")) & F.col("value").between(s["lo"], s["hi"]))
    ranged = (values.where("value IS NOT NULL").distinct().withColumn("_spans", every)
              .select("key", "value", F.explode(inside).alias("s"))
              .select("key", "value", "s.segment", F.posexplode(_positions(F.col("value"), F.col("s.words"))))
              .select("key", "value", "segment", "pos", F.col("col").alias("position"), F.expr("col div 64").alias("word")))
    filters = [e[2] for e in entries if e[2]]
    if not filters:
        return set()
    stored = spark.read.schema("key string, word long, bits long").parquet(*filters)
    stored = stored.select("key", "word", "bits", F.regexp_extract(
        F.col("_metadata.file_path"), "/segment=([^/]+)/", 1).alias("segment"))
    maybe = (ranged.join(stored, ["segment", "key", "word"]).where(F.col("bits").bitwiseAND(_bit("position")) != 0)
             .groupBy("segment", "key", "value").agg(F.countDistinct("pos").alias("n")).where(F.col("n") == HASHES)
             .drop("n").checkpoint())
    left = {r[0] for r in maybe.select("segment").distinct().collect()}
    kept = [e for e in entries if e[0] in left]
    if not kept:
        return set()
    found = _stacked(read(spark, kept, schema, named=True), sorted({k[0] for e in kept for k in e[4]}))
    exact = found.join(maybe.withColumnRenamed("segment", SEGMENT), [SEGMENT, "key", "value"], "left_semi")
    return {r[0] for r in exact.select(SEGMENT).distinct().collect()}


def keyed(df: DataFrame, key: str, column: str | None = None) -> DataFrame:
    """(key, value) rows for ``holding``."""
    return df.select(F.lit(key).alias("key"), F.col(column or key).cast("string").alias("value"))


def union(frames: Iterable[DataFrame]) -> DataFrame:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out
