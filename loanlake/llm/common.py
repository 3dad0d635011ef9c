"""Helpers shared by the operators: stored tables, Arrow rows, hot-group blocks, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.session import default_parallelism, ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there, so a lost
    executor costs a re-read and never a recomputation of what led to the table."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string or binary column as Python bytes; null is empty."""
    col = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_binary(col.type):
        col = col.cast(pa.binary())
    return [b"" if v is None else v for v in col.to_pylist()]


def flat_binary(array: np.ndarray) -> pa.Array:
    """Rows of a 2-d array as binary values."""
    data = np.ascontiguousarray(array)
    return pa.array([row.tobytes() for row in data], type=pa.binary())


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of equal ``keys`` from batches that come sorted by them. A yielded table holds
    one or more whole groups; only the group that is still open is held back."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
                for k in keys]
        change = np.zeros(n, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        if held:
            last = held[-1]
            change[0] = any(last.column(last.schema.get_field_index(k))[-1].as_py() != c[0]
                            for k, c in zip(keys, cols))
        starts = np.flatnonzero(change)
        cut = int(starts[-1]) if len(starts) else 0
        if len(starts) and (held or cut):
            done = held + ([batch.slice(0, cut)] if cut else [])
            if done:
                yield pa.Table.from_batches(done)
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Start of each group in a table sorted by ``keys``, and the table's end."""
    n = t.num_rows
    change = np.zeros(n, dtype=bool)
    change[:1] = True
    for k in keys:
        c = t.column(k).to_numpy()
        change[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(change), n)


def shared_key_blocks(keyed: DataFrame, node: str, block: int, drop_lonely: bool = False) -> DataFrame:
    """Split the groups of equal ``key`` into pairs of blocks.

    ``keyed`` has ``key`` and ``node``. A group of more than ``block`` rows is cut by a hash of the node
    into ceil(rows / block) blocks, and each row goes to every pair (lo, hi) of blocks that its own
    block is part of; so each pair of rows of a group meets, in a task of about two blocks however
    large the group is. Rows are counted before the shuffle, and nothing is paired here: the tasks
    compare the two blocks and emit links only. ``drop_lonely`` leaves out keys of a single row (for
    rows that would carry much).
    """
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("group_rows"))
    if drop_lonely:
        sized = keyed.join(counts.where("group_rows > 1"), "key")
    else:
        sized = keyed.join(counts.where(F.col("group_rows") > block), "key", "left")
    blocks = F.ceil(F.coalesce("group_rows", F.lit(1)) / F.lit(block)).cast("int")
    return (sized.withColumn("own_block", F.pmod(F.xxhash64(node), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("lo", F.least("own_block", "other"))
            .withColumn("hi", F.greatest("own_block", "other"))
            .drop("other", "group_rows"))


def spanning_links(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a boolean adjacency matrix (rows x columns of one numbering): whole
    neighbour rows are merged at a time, so dense groups cost no Python step per link."""
    n = len(linked)
    seen = np.zeros(n, dtype=bool)
    out = []
    has = linked.any(axis=1)
    for start in np.flatnonzero(has):
        if seen[start]:
            continue
        seen[start] = True
        stack = [int(start)]
        while stack:
            i = stack.pop()
            new = np.flatnonzero(linked[i] & ~seen)
            seen[new] = True
            out.extend((i, int(j)) for j in new)
            stack.extend(new.tolist())
    return out


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links (a, b) of longs: one row (node, root) per linked node,
    root being the component's smallest node.

    Alternating large-star and small-star steps (a known scheme for graphs that fit no machine)
    shrink the links to stars. Each step is a minimum per node, combined before the shuffle, and an
    equi-join that splits skewed nodes; each round is written to the shared folder and read back, in no
    more files than twice the cluster's cores. It ends when every component is a star around its
    smallest node, which one join and one count per round tell.
    """
    spark = edges.sparkSession
    files = 2 * default_parallelism(spark)

    def are_stars(e: DataFrame) -> bool:
        centres = e.select(F.col("lo").alias("hi")).distinct()
        inner = e.join(centres, "hi", "left_semi").select("hi")
        twice = e.groupBy("hi").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hi")
        return inner.union(twice).isEmpty()

    e = stored(edges.where("a <> b")
               .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
               .coalesce(files), "links")
    while not are_stars(e):
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u and v <> m")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(low, "hi").where("lo <> m")
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(low.select("hi", F.col("m").alias("lo"))).distinct())
        e = stored(small.coalesce(files), "links")
    roots = e.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots)
