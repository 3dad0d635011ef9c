"""SimHash near-dedup by Golay-code fuzzy hashing.

Fingerprint: 64 bits over a text's word shingles. Two fingerprints link when at most ``max_bits``
(4) bits differ. Candidates come from the binary Golay code, whose balls of radius 3 around the
4,096 codewords fill the space of 23-bit words without overlap:

* The 64 bits are cut into three segments of 21, 21 and 22 bits, each read as a 23-bit word.
* Four errors in three segments leave either one segment without an error, or two segments with
  exactly one error each (1+1+2 or less). Both cases get keys:
  - an error-free segment: its codeword and error pattern, i.e. the whole decoded segment;
  - two segments of one error each: for a word at distance 3 from its codeword, flipping one bit
    reaches five further codewords, else none. A fingerprint emits for each pair of segments its
    own codeword of one segment with every reachable codeword of the other, and the other way
    round; two such fingerprints x, y then share (codeword of x, codeword of y).
* Fingerprints that share a key are compared bit by bit in their tasks.

So every link of at most 4 bits is found. Equal fingerprints are collapsed before, groups of a
frequent key are compared in pairs of blocks, and a task emits a spanning forest of the links it
verified, never all pairs.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake.llm.common import (byte_column, components, group_bounds, shared_key_blocks,
                                 sorted_groups, spanning_links, stored)

# Generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1 of the binary Golay code, segment
# bounds of the fingerprint.
GENERATOR = 0b110001110101
SEGMENTS = ((0, 21), (21, 21), (42, 22))

SEED = 42
MAX_CELLS = 1 << 22


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial."""
    rest = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
    return rest


@functools.lru_cache(maxsize=1)
def _error_patterns() -> np.ndarray:
    """For each syndrome the only error of at most three bits that has it."""
    bits = [1 << i for i in range(23)]
    errors = [0] + bits + [a | b for i, a in enumerate(bits) for b in bits[:i]]
    errors += [a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]
    errors = np.array(errors)
    out = np.zeros(2048, dtype=np.int64)
    out[_syndrome(errors)] = errors
    return out


def decode(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest codeword's 12-bit index, and the error pattern's syndrome, of 23-bit words."""
    syndrome = _syndrome(words)
    return (words ^ _error_patterns()[syndrome]) >> 11, syndrome


@functools.lru_cache(maxsize=1)
def _reach_patterns() -> np.ndarray:
    """Per syndrome, for a word at distance 3: a bit flip for each of the codewords that one flip
    reaches (columns; the first is no flip). Words at a smaller distance repeat the first."""
    flips = np.array([0] + [1 << i for i in range(23)])
    patterns = _error_patterns()
    words = patterns.copy()  # a word of each syndrome, its codeword being zero
    out = np.zeros((2048, 6), dtype=np.int64)
    index = np.stack([decode(words ^ f)[0] for f in flips], axis=1)
    for s in range(2048):
        _, first = np.unique(index[s], return_index=True)
        chosen = flips[sorted(first)][:6]
        out[s, :len(chosen)] = chosen
    return out


def reachable(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices within one bit flip, (n, 6); and which of them are not repeats."""
    _, syndrome = decode(words)
    flips = _reach_patterns()[syndrome]
    index = decode((words[:, None] ^ flips).ravel())[0].reshape(flips.shape)
    new = flips != 0
    new[:, 0] = True
    return index, new


def fingerprint_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, keys) of unsigned 64-bit fingerprints."""
    words = [((prints >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64)
             for at, n in SEGMENTS]
    own = [decode(w) for w in words]
    near = [reachable(w) for w in words]
    rows, keys = [], []
    all_rows = np.arange(len(prints))
    for s, (index, syndrome) in enumerate(own):
        rows.append(all_rows)
        keys.append((index << 11 | syndrome) | s << 40)
    for tag, (i, j) in enumerate(((0, 1), (0, 2), (1, 2)), start=3):
        for c in range(6):
            here = np.flatnonzero(near[j][1][:, c])
            rows.append(here)
            keys.append(own[i][0][here] << 12 | near[j][0][here, c] | tag << 40)
            if c:  # own x own is there already
                here = np.flatnonzero(near[i][1][:, c])
                rows.append(here)
                keys.append(near[i][0][here, c] << 12 | own[j][0][here] | tag << 40)
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: bytes, words_each: int) -> int:
    """The 64-bit majority fingerprint of one text's shingles (see ``fingerprints``)."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > words_each:
        ends = ends[words_each - 1:]
        starts = starts[:len(ends)]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())],
                      dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = 2 * ones > len(hashes)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", words_each: int = 4, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all) and ``fp`` (long: the 64 bits) of every row.

    A-Z is lower-cased, words are runs of bytes other than ASCII white space, shingles are
    ``words_each`` space-joined words with repeats (fewer words: the whole sequence). Bit i is 1 if
    it is set in over half of the shingles' XXH64. No words, empty or null text: zero.
    """
    keep = [c for c in docs.columns if c != "fp"] if keep is None else keep
    out = T.StructType([docs.schema[c] for c in keep] + [T.StructField("fp", T.LongType())])
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text")).mapInArrow(
        functools.partial(_fp_batches, words_each=words_each), out)


def _fp_batches(batches: Iterator[pa.RecordBatch], words_each: int):
    for batch in batches:
        fps = np.array([fingerprint(t, words_each) for t in byte_column(batch, "__text")], dtype=np.uint64)
        rest = batch.drop_columns(["__text"])
        yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(fps.view(np.int64))],
                                         names=[*rest.schema.names, "fp"])


def _key_batches(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        fps = batch.column(0).to_numpy()
        for at in range(0, len(fps), 1 << 15):
            part = fps[at:at + (1 << 15)]
            rows, keys = fingerprint_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(part[rows]), pa.array(keys)], names=["fp", "key"])


def _verify_batches(batches: Iterator[pa.RecordBatch], max_bits: int):
    for t in sorted_groups(batches, ["key", "lo", "hi"]):
        bounds = group_bounds(t, ["key", "lo", "hi"])
        fps = t.column("fp").to_numpy().view(np.uint64)
        own, lo, hi = (t.column(c).to_numpy() for c in ("own_block", "lo", "hi"))
        a_out, b_out = [], []
        sizes = np.diff(bounds)
        pairs = bounds[:-1][sizes == 2]  # most groups: two rows, compared all at once
        near = np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= max_bits
        near &= (lo[pairs] == hi[pairs]) | (own[pairs] != own[pairs + 1])
        a_out.append(fps[pairs[near]])
        b_out.append(fps[pairs[near] + 1])
        for g in np.flatnonzero(sizes > 2):
            f, t_ = bounds[g], bounds[g + 1]
            x, blk = fps[f:t_], own[f:t_]
            if lo[f] == hi[f]:
                left = right = np.arange(len(x))
            else:
                left, right = np.flatnonzero(blk == lo[f]), np.flatnonzero(blk == hi[f])
            if not len(left) or not len(right):
                continue
            links = _forest(x, left, right, max_bits)
            if links:
                i, j = np.array(links).T
                a_out.append(x[i])
                b_out.append(x[j])
        a = np.concatenate(a_out).view(np.int64)
        b = np.concatenate(b_out).view(np.int64)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _forest(x: np.ndarray, left: np.ndarray, right: np.ndarray, max_bits: int):
    n = len(x)
    linked = np.zeros((n, n), dtype=bool)
    step = max(1, MAX_CELLS // max(1, len(right)))
    for at in range(0, len(left), step):
        rows = left[at:at + step]
        near = np.bitwise_count(x[rows][:, None] ^ x[right][None, :]) <= max_bits
        linked[np.ix_(rows, right)] |= near
    linked |= linked.T
    np.fill_diagonal(linked, False)
    return spanning_links(linked)


def links_of(distinct: DataFrame, max_bits: int, block: int = 2048) -> DataFrame:
    """(a, b) of fingerprints ``fp``, each given once, at ``max_bits`` or fewer differing bits: of the links of any
    two blocks of a key, a spanning forest."""
    keyed = distinct.mapInArrow(_key_batches, "fp long, key long")
    met = (shared_key_blocks(keyed, "fp", block).repartition("key", "lo", "hi")
           .sortWithinPartitions("key", "lo", "hi"))
    return met.mapInArrow(functools.partial(_verify_batches, max_bits=max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    words_each: int = 4, max_bits: int = 4, block: int = 2048) -> DataFrame:
    """One row per row of ``docs``: the id column, ``fp`` (long) and ``component_id`` (the smallest
    id reachable over links of at most ``max_bits`` differing bits; itself included).

    * null or empty text: fingerprint zero, which links like any other.
    * null id: the row keeps its fingerprint and takes the component of the rows it links with;
      null only if none of these has an id. Repeated ids and rows: one result row each.
    * empty input: empty result. Other columns are not read, whatever their names.
    """
    if max_bits > 4:
        raise ValueError("three Golay segments cover at most 4 differing bits")
    if max_bits < 0 or words_each < 1:
        raise ValueError("max_bits >= 0 and words_each >= 1")
    slim = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("body"))
    prints = stored(fingerprints(slim, "body", words_each, ["id"]), "prints")
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("first_id"),
                                               F.count(F.lit(1)).alias("n")), "distinct")
    parts = components(links_of(distinct.select("fp"), max_bits, block))
    # component id of every fingerprint that is shared or linked; the others are their own
    linked = distinct.join(parts, distinct.fp == parts.node, "left").select(
        "fp", "first_id", "n", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("near"))
    shared = linked.where("near or n > 1")
    first = shared.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = shared.join(first, "root").select("fp", "component_id")
    return prints.join(of_print, "fp", "left").select(
        F.col("id").alias(doc_id), "fp", F.coalesce("component_id", "id").alias("component_id"))


def hex_print(column: str):
    """The 64 bits of a long column as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         words_each: int = 4, max_bits: int = 4) -> DataFrame:
    """Keep one row of each group, that of the smallest id (null ids last; equal ids: any one); all columns of
    ``docs`` stay, whatever their names. A row is a document: rows that share an id are judged by their own
    texts. The rows are stored with a number each, which decides between equal ids."""
    held = "__row"
    while held in map(str.lower, docs.columns):
        held += "_"
    rows = stored(docs.withColumn(held, F.monotonically_increasing_id()), "numbered")
    slim = rows.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("body"), held)
    prints = stored(fingerprints(slim, "body", words_each, ["id", held]), "prints")
    named = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col(held).alias("row"))
    per_print = prints.groupBy("fp").agg(F.min(named).alias("first"))
    per_print = stored(per_print, "distinct")
    linked = per_print.join(components(links_of(per_print.select("fp"), max_bits)), F.col("fp") == F.col("node"), "left")
    kept = (linked.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
            .select(F.col("first.row").alias(held)))
    return rows.join(kept, held, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
