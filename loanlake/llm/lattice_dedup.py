"""Embedding near-dedup by lattice hashing: links of cosine >= threshold and their components.

Unit vectors are projected at random, per table to ``blocks`` groups of eight coordinates, and each
group is decoded to its nearest E8 lattice point. A vector's keys are, per table, its own cell and
the ``probes`` nearest neighbouring cells; two vectors that share any key are compared by cosine
in double precision. With the defaults a pair of cosine 0.93 shares a key with a probability of
0.999 (measured over random pairs, see tests), a closer pair with more, an unrelated one 0.001.

Equal vectors are collapsed before; groups of a frequent cell are compared in pairs of blocks.
A pair that shares several keys counts in the first of them only, so a task can emit for each
vector its number of links and a spanning forest instead of pairs.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.llm.common import (components, flat_binary, group_bounds, shared_key_blocks,
                                 sorted_groups, spanning_links, stored)
from loanlake.llm.e8 import LatticeKeys

TABLES, BLOCKS, WIDTH, PROBES, SEED = 8, 2, 2.0, 3, 20240607


def _unit_rows(col: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per dimension: row numbers and unit vectors in double precision."""
    lens = np.diff(col.offsets.to_numpy())
    values = col.values.to_numpy(zero_copy_only=False).astype(np.float64)
    starts = col.offsets.to_numpy()[:-1]
    out = {}
    for d in np.unique(lens):
        rows = np.flatnonzero(lens == d)
        x = values[starts[rows][:, None] + np.arange(d)]
        x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
        out[int(d)] = rows, x / np.linalg.norm(x, axis=1, keepdims=True)
    return out


@functools.lru_cache(maxsize=8)
def _hasher(dim: int, tables: int, blocks: int, width: float, probes: int) -> LatticeKeys:
    return LatticeKeys(dim, tables, blocks, width, probes, SEED)


def _prepare(batches: Iterator[pa.RecordBatch], shape: tuple):
    """(rep, label, embedding, copies) -> (rep, label, copies, unit, cells): keys of every vector,
    salted with label and dimension."""
    for batch in batches:
        rep, label, vec, copies = (batch.column(i) for i in range(4))
        labels = label.to_numpy().astype(np.int64)
        for dim, (rows, unit) in _unit_rows(vec).items():
            for at in range(0, len(rows), 1 << 12):
                r, u = rows[at:at + (1 << 12)], unit[at:at + (1 << 12)]
                keys = _hasher(dim, *shape)(u).reshape(len(r), -1)
                salt = (labels[r].astype(np.uint64) * np.uint64(0x9E3779B1) + np.uint64(dim)) << np.uint64(17)
                keys = np.sort(keys ^ salt[:, None], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [rep.take(pa.array(r)), label.take(pa.array(r)), copies.take(pa.array(r)),
                     flat_binary(u), flat_binary(keys)],
                    names=["rep", "label", "copies", "unit", "cells"])


def _explode_cells(batches: Iterator[pa.RecordBatch]):
    """(rep, cells) -> one row per distinct key."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rep = batch.column(0).to_numpy()
        cells = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.int64).reshape(len(rep), -1)
        new = np.ones(cells.shape, dtype=bool)
        new[:, 1:] = cells[:, 1:] != cells[:, :-1]
        rows, _ = np.nonzero(new)
        yield pa.RecordBatch.from_arrays([pa.array(rep[rows]), pa.array(cells[new])], names=["rep", "key"])


def _first_shared(a: np.ndarray, b: np.ndarray, key: np.uint64) -> np.ndarray:
    """For row pairs of sorted key lists: is ``key``, which both have, the smallest common one?"""
    earlier = np.zeros(len(a), dtype=bool)
    for c in range(a.shape[1]):
        col = a[:, c]
        live = np.flatnonzero((col < key) & ~earlier)
        if len(live):
            earlier[live] = (b[live] == col[live, None]).any(axis=1)
    return ~earlier


def _verify(batches: Iterator[pa.RecordBatch], threshold: float):
    """Sorted rows of block pairs -> (a, b, links): b null for a's number of links found here,
    else a link of the spanning forest."""
    for t in sorted_groups(batches, ["key", "lo", "hi"]):
        bounds = group_bounds(t, ["key", "lo", "hi"])
        rep, label, copies, own, lo, hi, key = (
            t.column(c).to_numpy() for c in ("rep", "label", "copies", "own_block", "lo", "hi", "key"))
        units, cells = t.column("unit").to_pylist(), t.column("cells").to_pylist()
        out_a, out_b, out_n = [], [], []
        for f, e in zip(bounds[:-1], bounds[1:]):
            if e - f < 2 or len({len(u) for u in units[f:e]}) > 1:
                # one row, or (a collision of salted keys) other dimensions: compared elsewhere
                if e - f < 2:
                    continue
            for size in {len(u) for u in units[f:e]}:
                at = np.array([i for i in range(f, e) if len(units[i]) == size])
                _compare(at, rep, label, copies, own, lo[f], hi[f], np.int64(key[f]).view(np.uint64),
                         units, cells, threshold, out_a, out_b, out_n)
        if out_a:
            b = np.concatenate(out_b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out_a)), pa.array(b, mask=b == np.iinfo(np.int64).min),
                 pa.array(np.concatenate(out_n))], names=["a", "b", "links"])


def _compare(at, rep, label, copies, own, lo, hi, key, units, cells, threshold, out_a, out_b, out_n):
    x = np.frombuffer(b"".join(units[i] for i in at), dtype=np.float64).reshape(len(at), -1)
    k = np.frombuffer(b"".join(cells[i] for i in at), dtype=np.uint64).reshape(len(at), -1)
    if lo == hi:
        left = right = np.arange(len(at))
    else:
        left, right = np.flatnonzero(own[at] == lo), np.flatnonzero(own[at] == hi)
    if not len(left) or not len(right):
        return
    near = x[left] @ x[right].T >= threshold
    near &= label[at[left]][:, None] == label[at[right]][None, :]
    near &= rep[at[left]][:, None] != rep[at[right]][None, :]
    if lo == hi:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    if not len(i):
        return
    first = np.empty(len(i), dtype=bool)
    for s in range(0, len(i), 1 << 16):
        part = slice(s, s + (1 << 16))
        first[part] = _first_shared(k[left[i[part]]], k[right[j[part]]], key)
    i, j = left[i[first]], right[j[first]]
    if not len(i):
        return
    links = np.zeros(len(at), dtype=np.int64)
    np.add.at(links, i, copies[at[j]])
    np.add.at(links, j, copies[at[i]])
    some = np.flatnonzero(links)
    none = np.full(len(some), np.iinfo(np.int64).min)
    adjacent = np.zeros((len(at), len(at)), dtype=bool)
    adjacent[i, j] = adjacent[j, i] = True
    tree = np.array(spanning_links(adjacent)).reshape(-1, 2)
    out_a += [rep[at[some]], rep[at[tree[:, 0]]]]
    out_b += [none, rep[at[tree[:, 1]]]]
    out_n += [links[some], np.zeros(len(tree), dtype=np.int64)]


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                    label: str | None = "label", threshold: float = 0.93, tables: int = TABLES,
                    blocks: int = BLOCKS, width: float = WIDTH, probes: int = PROBES,
                    block: int = 1024) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links`` (other vectors linked directly),
    ``component_id`` (smallest id reachable over links, itself included) and ``kept``.

    * Vectors link when labels are equal and not null (``label=None``: always), dimensions are
      equal and their cosine is at least ``threshold``. Null, empty or zero vectors, null or
      non-finite components, null labels and null ids link with nothing; such a row has 0 links
      and its own id as component (null id: null, and ``kept`` true).
    * Repeated rows are vectors like any other: they link with each other.
    * Each row is a vector, whatever its id: rows that share an id have the links of their own vectors, and
      count as several where they are linked. Empty input: empty result. Other columns are not read.
    """
    if label is None:
        group = F.lit(0).cast("long")
    elif vectors.schema[label].dataType.typeName() in ("byte", "short", "integer", "long"):
        group = F.col(label).cast("long")
    else:  # other labels by their 64-bit hash
        group = F.when(F.col(label).isNotNull(), F.xxhash64(label))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), group.alias("label"),
                          F.col(embedding).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()
             & finite & F.exists("vec", lambda x: x != 0))
    # + 0.0: negative zero is zero; two seeds make a 128-bit name of the vector
    clean = F.transform("vec", lambda x: x + F.lit(0.0))
    named = rows.select(
        "id", "label", "vec", F.coalesce(valid, F.lit(False)).alias("valid")).withColumn(
        "h1", F.when(F.col("valid"), F.xxhash64(clean))).withColumn(
        "h2", F.when(F.col("valid"), F.xxhash64(F.lit(7), clean)))
    same = ["label", "h1", "h2"]
    # a number names each distinct vector from here on, as ids may repeat
    reps = stored(named.where("valid").groupBy(*same)
                  .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec"))
                  .withColumn("rep", F.monotonically_increasing_id()), "distinct-vectors")
    shape = (tables, blocks, width, probes)
    prepared = stored(reps.select("rep", "label", "vec", "copies").mapInArrow(
        functools.partial(_prepare, shape=shape),
        "rep long, label long, copies long, unit binary, cells binary"), "lattice")
    keyed = prepared.select("rep", "cells").mapInArrow(_explode_cells, "rep long, key long")
    met = shared_key_blocks(keyed, "rep", block, drop_lonely=True).join(prepared, "rep")
    found = stored(met.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(
        functools.partial(_verify, threshold=threshold), "a long, b long, links long"), "links")
    degree = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("linked"))
    parts = components(found.where("b is not null").select("a", "b"))
    smallest = (parts.join(reps.select(F.col("rep").alias("node"), "first"), "node")
                .groupBy("root").agg(F.min("first").alias("smallest")))
    in_part = parts.join(smallest, "root").select(F.col("node").alias("rep"), "smallest")
    # rows find their vector by its 128-bit name
    names = (reps.select(*same, "rep", "first", "copies").join(degree, "rep", "left").join(in_part, "rep", "left")
             .select(*same, (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("smallest", "first").alias("component_id")))
    out = named.drop("vec", "valid").join(names, same, "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
