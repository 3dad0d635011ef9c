"""Exact top-k search over binary codes by incremental multi-index hashing.

Codes of ``bits`` bits are cut into m segments. If two codes differ in at most m*(a+1) - 1 bits, some
segment differs in at most a bits. Round a probes the index with every value at distance exactly a
from each query segment, so after it every code within distance m*(a+1) - 1 has been met. A query
is finished as soon as its k-th verified distance is within that bound; the others go on with a+1.
The last possible radius covers every code, so the result is exact with no limit on candidates.

The index holds every code. Equal codes are one entry with their k smallest ids (no other copy can
be among the k nearest by distance and id), so a frequent code cannot flood a query; entries of a
frequent segment value are spread over salts and the probes follow them.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlake.llm.common import stored

ENTRIES_EACH = 4096  # entries of one segment value in one salt, about


def sign_code(embedding: str, bits: int = 64):
    """Long code: bit i is set where component i is positive. Null where the vector is null, has
    another length than ``bits``, or a null or non-finite component."""
    vec = F.col(embedding)
    fine = (F.size(vec) == bits) & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    packed = F.aggregate(
        F.transform(vec, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i))
                    .otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(x))
    return F.when(fine, packed)


def _segments(bits: int, width: int) -> list[tuple[int, int]]:
    m = math.ceil(bits / width)
    edges = [round(i * bits / m) for i in range(m + 1)]
    return list(zip(edges[:-1], (b - a for a, b in zip(edges, edges[1:]))))


def _segment(code: str, at: int, n: int):
    part = F.shiftrightunsigned(F.col(code), at)
    return part if at + n >= 64 else part.bitwiseAND(F.lit((1 << n) - 1).cast("long"))


@functools.lru_cache(maxsize=8)
def _flips(n: int, a: int) -> np.ndarray:
    """All n-bit words of weight a."""
    words = np.zeros(1, dtype=np.int64)
    for _ in range(a):
        top = np.zeros(len(words), dtype=np.int64)
        some = words > 0
        top[some] = np.floor(np.log2(words[some])).astype(np.int64) + 1
        words = np.concatenate([words[i:i + 1] | (1 << np.arange(t, n)) for i, t in enumerate(top)]
                               or [words[:0]])
    return words


def _probe_batches(batches: Iterator[pa.RecordBatch], segments: list[tuple[int, int]], a: int):
    """(query, code, bound) -> a row per segment and value at distance a from the query's segment."""
    m = len(segments)
    for batch in batches:
        query, code, bound = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        for s, (at, n) in enumerate(segments):
            need = np.flatnonzero(s < bound - m * a + 1)
            if a > n or not len(need):
                continue
            flips = _flips(n, a)
            mine = (code.view(np.uint64) >> np.uint64(at)).astype(np.int64) & ((1 << n) - 1)
            each = max(1, (1 << 16) // len(flips))
            for f in range(0, len(need), each):
                rows = np.repeat(need[f:f + each], len(flips))
                value = (mine[need[f:f + each], None] ^ flips).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query[rows]), pa.array(code[rows]), pa.array(bound[rows]),
                     pa.array(np.full(len(rows), s, dtype=np.int32)), pa.array(value)],
                    names=["query", "code", "bound", "seg", "value"])


def top_k(rows: DataFrame, queries: DataFrame, vec_id: str = "vec_id", code: str = "code",
          k: int = 10, bits: int = 64, segment_bits: int | None = None) -> DataFrame:
    """(query_id, rank, the id column, distance): the k nearest other rows by Hamming distance,
    ties by smaller id, of every query row.

    * ``segment_bits`` defaults to log2 of the number of rows less 4 (8 to 24): an index cell then
      holds some 16 codes, as a probe is a shuffled row and a comparison an XOR inside the join.
    * Rows or queries with a null id or code are left out. A query is never its own answer (rows
      with its id are left out of its answers); repeated ids of one code are one row.
    * Fewer than k other rows: all of them. Empty tables: empty result.
    """
    spark = rows.sparkSession
    index = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(code).cast("long").alias("entry"))
    index = index.where("id is not null and entry is not null").distinct()
    if bits < 64:
        index = index.withColumn("entry", F.col("entry").bitwiseAND(F.lit((1 << bits) - 1).cast("long")))
    nth = F.row_number().over(Window.partitionBy("entry", "part").orderBy("id"))
    nth_all = F.row_number().over(Window.partitionBy("entry").orderBy("id"))
    # the k + 1 smallest ids of each code, first within 64 parts of a frequent code, then overall
    entries = (index.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(64)))
               .withColumn("nth", nth).where(F.col("nth") <= k + 1)
               .withColumn("nth", nth_all).where(F.col("nth") <= k + 1)
               .groupBy("entry").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.min("id").alias("first")))
    entries = stored(entries, "codes")
    n = entries.count()
    width = segment_bits or max(8, min(24, round(math.log2(max(n, 2))) - 4))
    segments = _segments(bits, width)
    indexed = entries.select("entry", "first", F.explode(F.array(*[
        F.struct(F.lit(s).alias("seg"), _segment("entry", at, m).alias("value"))
        for s, (at, m) in enumerate(segments)])).alias("x")).select("entry", "first", "x.seg", "x.value")
    cells = indexed.groupBy("seg", "value").agg(
        F.ceil(F.count(F.lit(1)) / ENTRIES_EACH).cast("int").alias("salts"))
    indexed = stored(indexed.join(cells, ["seg", "value"]).withColumn(
        "salt", F.pmod(F.xxhash64("entry"), F.col("salts")).cast("int")), "segments")
    frequent = cells.where("salts > 1")

    q = queries.select(F.col(vec_id).cast("long").alias("query"), F.col(code).cast("long").alias("code"))
    q = q.where("query is not null and code is not null").distinct()
    if bits < 64:
        q = q.withColumn("code", F.col("code").bitwiseAND(F.lit((1 << bits) - 1).cast("long")))
    open_ = stored(q.withColumn("bound", F.lit(bits)), "queries")
    found = stored(spark.createDataFrame([], "query long, code long, entry long, first long, distance int"), "found")
    done = []
    by_distance = Window.partitionBy("query", "code").orderBy("distance", "first")
    for a in range(max(m for _, m in segments) + 1):
        probes = open_.mapInArrow(functools.partial(_probe_batches, segments=segments, a=a),
                                  "query long, code long, bound int, seg int, value long")
        probes = (probes.join(frequent, ["seg", "value"], "left")
                  .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
                  .drop("salts"))
        distance = F.bit_count(F.col("code").bitwiseXOR(F.col("entry")))
        met = (probes.join(indexed.drop("salts"), ["seg", "value", "salt"])
               .where(distance <= F.col("bound")).withColumn("distance", distance)
               .select("query", "code", "entry", "first", "distance").distinct())
        # the k nearest ids are in the k + 1 nearest entries by distance and first id: each of these
        # has an id at or before those of all later ones, and only one can be the query's own
        live = found.union(met).distinct()
        best = stored(live.withColumn("nth", F.row_number().over(by_distance))
                      .where(F.col("nth") <= k + 1).drop("nth"), "found")
        sized = best.join(entries.drop("first"), "entry").select(
            "query", "code", "first", "distance",
            F.size(F.array_except("ids", F.array("query"))).alias("n"))
        upto = F.sum("n").over(by_distance)
        kth = (sized.withColumn("upto", upto).where(F.col("upto") >= k)
               .groupBy("query", "code").agg(F.min("distance").alias("kth")))
        covered = len(segments) * (a + 1) - 1
        last = covered >= bits or a == max(m for _, m in segments)
        state = open_.drop("bound").join(kth, ["query", "code"], "left")
        over = F.lit(True) if last else F.coalesce(F.col("kth") <= covered, F.lit(False))
        state = stored(state.withColumn("over", over), "state")
        done.append(best.join(state.where("over").select("query", "code"), ["query", "code"]))
        open_ = state.where("not over").select("query", "code", F.coalesce("kth", F.lit(bits)).alias("bound"))
        found = best.join(open_.select("query", "code"), ["query", "code"])
        if last or open_.isEmpty():
            break
    answers = functools.reduce(DataFrame.union, done)
    rank = F.row_number().over(Window.partitionBy("query", "code").orderBy("distance", "id"))
    out = (answers.join(entries, "entry").select("query", "code", "distance", F.explode("ids").alias("id"))
           .where("id <> query").dropDuplicates(["query", "code", "id"])
           .withColumn("rank", rank).where(F.col("rank") <= k))
    return out.select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"),
                      F.col("id").alias(vec_id), F.col("distance").cast("int").alias("distance"))
