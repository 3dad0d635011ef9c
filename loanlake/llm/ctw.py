"""LM scoring by context-tree weighting over bytes.

Each next byte is eight binary decisions (its bits, high to low); each decision has a context tree
over the preceding bytes down to ``depth``. A node (context of d bytes, bits so far) keeps the counts
(a, b) of zeros and ones; its Krichevsky-Trofimov probability KT(a, b) and its weighted probability

    Pw = KT                        at the deepest level
    Pw = 1/2 KT + 1/2 prod Pw(children)   above it

come from the training documents. A decision is predicted by the mixture over all depths of its path
with the posterior weights that these give; a context that training never saw leaves its weight to
the deepest one it did see. The code length of a text is the sum over its bytes and an end symbol.

At scale: a task sums the byte grams and words of about ``BLOCK_BYTES`` of text; these sums, packed by
bucket, are what is shuffled. A bucket holds all grams whose two most recent context bytes are its
own, so its part of the tree is built there; only the levels of one byte and none (at most 65,535
nodes) are joined over buckets. Every block then gets back the code lengths of its own grams and the
counts of its own words, and scores its texts. Frequent grams or words are one entry a block, so no
key is hot; buckets of many blocks are merged in two rounds.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake.llm.common import byte_column, stored
from loanlake.llm.segtree_bpe import slices

DEPTH = 5
BLOCK_BYTES = 32 << 20
BLOCKS_EACH = 64  # of one bucket in one task, about
MAX_TASKS = 20_000  # that score blocks
END = 0xFF  # no byte of UTF-8: start context and end symbol
WORDS, GRAMS, DOC = 0, 1, 2
LN2 = math.log(2)

ROWS = "block long, kind int, bucket int, id long, held boolean, body binary, counts binary"
_ARROW = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("id", pa.int64()),
                    ("held", pa.bool_()), ("body", pa.binary()), ("counts", pa.binary())])


def grams(texts: list[bytes], depth: int) -> np.ndarray:
    """Keys of all positions of the texts, each with its end: the preceding ``depth`` bytes, most recent
    one highest, then the byte itself lowest."""
    pad = bytes([END]) * depth
    raw = np.frombuffer(b"".join([pad + t.lower() + pad[:1] for t in texts]), dtype=np.uint8)
    n = len(raw) - depth
    key = np.zeros(n, dtype=np.uint64)
    wide = raw.astype(np.uint64)
    for back in range(1, depth + 1):
        key = key << np.uint64(8) | wide[depth - back:depth - back + n]
    key = key << np.uint64(8) | wide[depth:]
    lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    starts = np.concatenate(([0], np.cumsum(lens + depth)[:-1]))
    keep = np.zeros(n + depth + 1, dtype=np.int8)  # positions that are padding of the next text
    ends = starts + lens
    np.add.at(keep, starts, 1)
    np.add.at(keep, ends, -1)
    return key[np.cumsum(keep[:n]).astype(bool)]


def merge_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0: Stirling's series six steps up."""
    y = x + 6.0
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3)
    series += 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    return series - np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - math.log(math.pi)


class Level:
    """Nodes of one depth: sorted keys (context << 8 | bits so far with a leading 1), counts, own weight
    against the children's, ln Pw."""

    def __init__(self, key, a, b, below):
        self.key, self.a, self.b = key, a, b
        own = log_kt(a, b)
        if below is None:
            self.log_pw, self.alpha = own, np.ones(len(key))
        else:
            self.log_pw = np.logaddexp(own, below) - LN2
            self.alpha = np.exp(own - LN2 - self.log_pw)
        self.kt = (b + 0.5) / (a + b + 1.0)

    def parents(self):
        """Keys, counts and summed ln Pw one level up."""
        up = self.key >> np.uint64(16) << np.uint64(8) | self.key & np.uint64(255)
        key, at = np.unique(up, return_inverse=True)
        return key, *(np.bincount(at, x, minlength=len(key)) for x in (self.a, self.b, self.log_pw))


def leaves(keys: np.ndarray, counts: np.ndarray) -> Level:
    """The deepest level, from gram counts."""
    context, nxt = keys >> np.uint64(8), (keys & np.uint64(255)).astype(np.int64)
    node, ones = [], []
    for k in range(8):
        node.append(context << np.uint64(8) | (1 << k | nxt >> (8 - k)).astype(np.uint64))
        ones.append(nxt >> (7 - k) & 1)
    key, at = np.unique(np.concatenate(node), return_inverse=True)
    bit, n = np.concatenate(ones), np.tile(counts.astype(np.float64), 8)
    return Level(key, np.bincount(at, n * (1 - bit), minlength=len(key)),
                 np.bincount(at, n * bit, minlength=len(key)), None)


def levels_up(level: Level, depth: int, down_to: int) -> dict[int, Level]:
    out = {depth: level}
    for d in range(depth - 1, down_to - 1, -1):
        level = Level(*level.parents())
        out[d] = level
    return out


class Mixture:
    """Prediction of ones at every node: the mixture over the path from the root to it."""

    def __init__(self, levels: dict[int, Level]):
        self.nodes = {}
        part = rest = last = None
        for d in sorted(levels):
            lv = levels[d]
            if last is None:
                before, left = np.zeros(len(lv.key)), np.ones(len(lv.key))
            else:
                up = lv.key >> np.uint64(16) << np.uint64(8) | lv.key & np.uint64(255)
                at = np.searchsorted(last, up)
                before, left = part[at], rest[at]
            self.nodes[d] = lv.key, before + left * lv.kt
            part, rest, last = before + left * lv.alpha * lv.kt, left * (1 - lv.alpha), lv.key

    def log10(self, keys: np.ndarray, depth: int) -> np.ndarray:
        """log10 probability of each gram's last byte after its context."""
        context, nxt = keys >> np.uint64(8), (keys & np.uint64(255)).astype(np.int64)
        out = np.zeros(len(keys))
        for k in range(8):
            bits = (1 << k | nxt >> (8 - k)).astype(np.uint64)
            one = np.full(len(keys), 0.5)
            for d, (known, predicted) in sorted(self.nodes.items()):
                if not len(known):
                    continue
                want = context >> np.uint64(8 * (depth - d)) << np.uint64(8) | bits
                at = np.minimum(np.searchsorted(known, want), len(known) - 1)
                one = np.where(known[at] == want, predicted[at], one)
            out += np.log10(np.where(nxt >> (7 - k) & 1, one, 1.0 - one))
        return out


def _gram_bucket(keys: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    recent = keys >> np.uint64(8 * (depth - 1))  # the two most recent bytes
    return ((recent * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets


def _collect_block(block: int, words: Counter, seen: dict, parts: list, depth: int, buckets: int):
    """Rows of a finished block's word and gram counts, by bucket."""
    rows = []
    by: list[list[bytes]] = [[] for _ in range(buckets)]
    for w in seen:
        by[hash_bytes(w) % buckets].append(w)
    for i, ws in enumerate(by):
        if ws:
            n = np.fromiter((words[w] for w in ws), dtype=np.int64, count=len(ws))
            rows.append((block, WORDS, i, None, None, b"\n".join(ws), n.tobytes()))
    if parts:
        keys, counts = merge_counts(*(np.concatenate(x) for x in zip(*parts)))
        home = _gram_bucket(keys, depth, buckets)
        order = np.argsort(home, kind="stable")
        ends = np.searchsorted(home[order], np.arange(buckets + 1))
        for i in range(buckets):
            at = order[ends[i]:ends[i + 1]]
            if len(at):
                rows.append((block, GRAMS, i, None, None, keys[at].tobytes(), counts[at].tobytes()))
    return _batch(rows)


def hash_bytes(word: bytes) -> int:
    import zlib
    return zlib.crc32(word)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)]
                                      if rows else [pa.array([], f.type) for f in _ARROW], schema=_ARROW)


def _gather(batches: Iterator[pa.RecordBatch], depth: int, buckets: int):
    """(id, held, text) -> the documents with their block, and each block's word and gram counts. Words
    and grams of held-out documents are listed with a count of 0."""
    first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 24
    block, size, words, seen, parts = first, 0, Counter(), {}, []
    for batch in batches:
        ids, held = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = byte_column(batch, "text")
        for part in slices(texts, 4 << 20):
            rows = []
            for i in range(part.start, part.stop):
                rows.append((block, DOC, None, ids[i], held[i], texts[i], None))
                tokens = texts[i].lower().split()
                if held[i]:
                    seen.update(dict.fromkeys(tokens))
                else:
                    words.update(tokens)
            yield _batch(rows)
            for flag in (False, True):
                some = [texts[i] for i in range(part.start, part.stop) if bool(held[i]) is flag]
                if some:
                    keys, counts = np.unique(grams(some, depth), return_counts=True)
                    parts.append((keys, counts * (not flag)))
            size += sum(map(len, texts[part]))
            if len(parts) >= 16:
                parts = [merge_counts(*(np.concatenate(x) for x in zip(*parts)))]
            if size >= BLOCK_BYTES:
                seen.update(dict.fromkeys(words))
                yield _collect_block(block, words, seen, parts, depth, buckets)
                block, size, words, seen, parts = block + 1, 0, Counter(), {}, []
    if size or words or seen or parts:
        seen.update(dict.fromkeys(words))
        yield _collect_block(block, words, seen, parts, depth, buckets)


def _sum_rows(rows: list[tuple[bytes, bytes]], kind: int) -> tuple[bytes, bytes]:
    """One row of summed counts; entries without training counts go."""
    if kind == WORDS:
        total: Counter = Counter()
        for body, counts in rows:
            for w, n in zip(body.split(b"\n"), np.frombuffer(counts, dtype=np.int64).tolist()):
                if n:
                    total[w] += n
        return b"\n".join(total), np.fromiter(total.values(), dtype=np.int64, count=len(total)).tobytes()
    keys = np.concatenate([np.frombuffer(b, dtype=np.uint64) for b, _ in rows])
    counts = np.concatenate([np.frombuffer(c, dtype=np.int64) for _, c in rows])
    keys, counts = merge_counts(keys[counts > 0], counts[counts > 0])
    return keys.tobytes(), counts.tobytes()


def _sum_groups(batches: Iterator[pa.RecordBatch]):
    """Rows sorted by (kind, bucket, salt) -> one row of summed counts each."""
    out = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("body", pa.binary()), ("counts", pa.binary())])
    now, rows, held = None, [], 0
    for batch in batches:
        kind, bucket, salt = (batch.column(i).to_pylist() for i in range(3))
        body, counts = byte_column(batch, "body"), byte_column(batch, "counts")
        for i, key in enumerate(zip(kind, bucket, salt)):
            if key != now:
                if rows:
                    yield pa.RecordBatch.from_pylist([_named(now, _sum_rows(rows, now[0]))], schema=out)
                now, rows, held = key, [], 0
            rows.append((body[i], counts[i]))
            held += len(body[i])
            if held > (64 << 20):  # many blocks: fold what is there
                rows, held = [_sum_rows(rows, now[0])], 0
    if rows:
        yield pa.RecordBatch.from_pylist([_named(now, _sum_rows(rows, now[0]))], schema=out)


def _named(key: tuple, row: tuple[bytes, bytes]) -> dict:
    return {"kind": key[0], "bucket": key[1], "body": row[0], "counts": row[1]}


def _summed(rows: DataFrame, salts: int) -> DataFrame:
    """Counts per (kind, bucket), merged within salts first."""
    salt = F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int")

    def merged(df: DataFrame) -> DataFrame:
        return (df.repartition("kind", "bucket", "salt").sortWithinPartitions("kind", "bucket", "salt")
                .select("kind", "bucket", "salt", "body", "counts")
                .mapInArrow(_sum_groups, "kind int, bucket int, body binary, counts binary"))

    once = merged(rows.withColumn("salt", salt))
    return merged(once.withColumn("salt", F.lit(0))) if salts > 1 else once


def _local_levels(body: bytes, counts: bytes, depth: int) -> dict[int, Level]:
    keys, n = np.frombuffer(body, dtype=np.uint64), np.frombuffer(counts, dtype=np.int64)
    return levels_up(leaves(keys, n), depth, 2)


def _top_rows(batches: Iterator[pa.RecordBatch], depth: int):
    """Summed grams of a bucket -> its share of the one-byte level."""
    for batch in batches:
        for body, counts in zip(byte_column(batch, "body"), byte_column(batch, "counts")):
            if body:
                key, a, b, log_pw = _local_levels(body, counts, depth)[2].parents()
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(a), pa.array(b),
                                                  pa.array(log_pw)], names=["node", "a", "b", "log_pw"])


def _answer(batches: Iterator[pa.RecordBatch], depth: int, top: dict[int, Level]):
    """Sorted by (kind, bucket, salt, is a block's row): a bucket's summed counts, then the rows of its
    blocks, which get the totals of their words or log10 probabilities of their grams."""
    now, counts, model = None, {}, None
    for batch in batches:
        kind, bucket, salt, block = (batch.column(i).to_pylist() for i in range(4))
        body, packed = byte_column(batch, "body"), byte_column(batch, "counts")
        rows = []
        for i, key in enumerate(zip(kind, bucket, salt)):
            if key != now:
                now, counts, model = key, {}, Mixture(top) if key[0] == GRAMS else None
            if block[i] is None:
                if key[0] == WORDS:
                    counts = dict(zip(body[i].split(b"\n"), np.frombuffer(packed[i], dtype=np.int64).tolist()))
                elif body[i]:
                    model = Mixture({**top, **_local_levels(body[i], packed[i], depth)})
                continue
            if key[0] == WORDS:
                values = np.array([counts.get(w, 0) for w in body[i].split(b"\n")], dtype=np.int64)
            else:
                values = model.log10(np.frombuffer(body[i], dtype=np.uint64), depth)
            rows.append((block[i], key[0], key[1], None, None, body[i], values.tobytes()))
        if rows:
            yield _batch(rows)


class GramTable:
    """Hash table from gram keys to values, built and read a column at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(4, (2 * len(keys)).bit_length()))
        size = 1 << int(64 - int(self.shift))
        self.keys = np.full(size, ~np.uint64(0))
        self.values = np.zeros(size)
        self.last = size - 1
        left, at = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self.keys[at] == ~np.uint64(0)
            self.keys[at[free]] = keys[left[free]]
            mine = self.keys[at] == keys[left]
            self.values[at[mine]] = values[left[mine]]
            left, at = left[~mine], (at[~mine] + 1) & self.last

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        out = self.values[at]
        miss = np.flatnonzero(self.keys[at] != keys)
        at = at[miss]
        while len(miss):
            at = (at + 1) & self.last
            hit = self.keys[at] == keys[miss]
            out[miss[hit]] = self.values[at[hit]]
            miss, at = miss[~hit], at[~hit]
        return out


def _score_blocks(batches: Iterator[pa.RecordBatch], depth: int, tokens: int, vocabulary: int, ends: int):
    """Sorted by (block, kind): a block's word totals and gram values, then its documents."""
    smooth = math.log10(tokens + vocabulary + 1)
    end_score = math.log10(ends + 1) - smooth
    now, base, known, parts, table = None, {}, set(), [], None
    for batch in batches:
        block, kind = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        ids, held = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        body, packed = byte_column(batch, "body"), byte_column(batch, "counts")
        docs = []
        for i, at in enumerate(block):
            if at != now:
                now, base, known, parts, table = at, {}, set(), [], None
            if kind[i] == WORDS:
                totals = np.frombuffer(packed[i], dtype=np.int64)
                words = body[i].split(b"\n")
                base.update(zip(words, (np.log10(totals + 1.0) - smooth).tolist()))
                known.update(w for w, n in zip(words, totals.tolist()) if not n)
            elif kind[i] == GRAMS:
                parts.append((np.frombuffer(body[i], dtype=np.uint64), np.frombuffer(packed[i], dtype=np.float64)))
            else:
                if table is None:
                    table = GramTable(*(np.concatenate(x) for x in zip(*parts)))
                    parts = []
                tokens_here = body[i].lower().split()
                value = float(table[grams([body[i]], depth)].sum())
                new = sum(map(known.__contains__, tokens_here)) if known else 0
                docs.append((ids[i], held[i], len(tokens_here) + 1, len(tokens_here) - new + (ends > 0),
                             math.fsum(map(base.__getitem__, tokens_here)) + end_score, value, len(body[i])))
        if docs:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*docs), (pa.int64(), pa.bool_(), pa.int64(), pa.int64(),
                                                            pa.float64(), pa.float64(), pa.int64()))],
                names=["id", "held_out", "n_tokens", "n_known", "base_score", "score", "bytes"])


def score_documents(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text",
                    depth: int = DEPTH) -> DataFrame:
    """One row per document: the id column, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens`` (long),
    ``base_score`` (log10, add-one unigrams of words), ``score`` (log10 probability of the lower-cased
    text by context-tree weighting) and ``bits_per_byte`` (code length per byte, end symbol included).

    ``held_out`` is a boolean column; the rows where it is false or null train both models, all rows are
    scored. Words are runs of bytes other than ASCII white space, A-Z lower-cased, and one end a text.
    Null text: empty, scored as its end alone. Repeated rows count each time; null ids are kept. Without
    training rows every bit has probability 1/2. Empty input: empty result. 2 <= ``depth`` <= 7.
    """
    if not 2 <= depth <= 7:
        raise ValueError("depth is 2 to 7")
    spark = docs.sparkSession
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"),
                       F.col(text).alias("text"))
    gathered = stored(rows.mapInArrow(functools.partial(_gather, depth=depth, buckets=buckets), ROWS), "ctw-blocks")
    sums = gathered.where(F.col("kind") != DOC).drop("id", "held")
    sizes = gathered.where(F.col("kind") == DOC).agg(
        F.countDistinct("block"), F.count_if(~F.col("held"))).first()
    salts, ends = max(1, math.ceil(sizes[0] / BLOCKS_EACH)), sizes[1]
    total = stored(_summed(sums, salts), "ctw-sums")
    # words counted in the tasks: the sum and number of the packed counts
    n = total.where(F.col("kind") == WORDS).mapInArrow(_count_words, "n long, v long").agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    tokens, vocabulary = n[0] + ends, n[1] + (ends > 0)
    # levels of one byte and none: at most 256 x 255 nodes
    one = (total.where(F.col("kind") == GRAMS).mapInArrow(
        functools.partial(_top_rows, depth=depth), "node long, a double, b double, log_pw double")
        .groupBy("node").agg(F.sum("a"), F.sum("b"), F.sum("log_pw")).orderBy("node").collect())
    top: dict[int, Level] = {}
    if one:
        key, a, b, below = (np.array(c) for c in zip(*one))
        level = Level(key.astype(np.uint64), a.astype(float), b.astype(float), below.astype(float))
        top = {1: level, 0: Level(*level.parents())}
    salt = F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int")
    ask = sums.select("kind", "bucket", salt.alias("salt"), "block", "body", "counts")
    model = total.select("kind", "bucket", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
                         F.lit(None).cast("long").alias("block"), "body", "counts")
    answers = (model.union(ask).repartition("kind", "bucket", "salt")
               .sortWithinPartitions("kind", "bucket", "salt", F.col("block").asc_nulls_first())
               .mapInArrow(functools.partial(_answer, depth=depth, top=top), ROWS))
    # a task for each block, up to MAX_TASKS: blocks are dealt in turn, so that no task's share grows with the input
    tasks = max(1, min(sizes[0], MAX_TASKS))
    dealt = answers.union(gathered.where(F.col("kind") == DOC)).join(_turns(gathered), "block")
    scored = (dealt.repartitionById(tasks, F.pmod("turn", F.lit(tasks)).cast("int")).select(*answers.columns)
              .sortWithinPartitions("block", "kind")
              .mapInArrow(functools.partial(_score_blocks, depth=depth, tokens=tokens, vocabulary=vocabulary, ends=ends),
                          "id long, held_out boolean, n_tokens long, n_known long, base_score double, "
                          "score double, bytes long"))
    return scored.select(
        F.col("id").alias(doc_id), "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score", "score", (-F.col("score") / math.log10(2) / (F.col("bytes") + 1)).alias("bits_per_byte"))


def _turns(gathered: DataFrame) -> DataFrame:
    """(block, turn): the blocks, one for each ``BLOCK_BYTES`` of text, numbered from 0."""
    blocks = gathered.where(F.col("kind") == DOC).select("block").distinct()
    return stored(blocks.select("block", (F.row_number().over(Window.orderBy("block")) - 1).alias("turn")), "ctw-turns")


def _count_words(batches: Iterator[pa.RecordBatch]):
    n = v = 0
    for batch in batches:
        for packed in byte_column(batch, "counts"):
            counts = np.frombuffer(packed, dtype=np.int64)
            n, v = n + int(counts.sum()), v + len(counts)
    yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "v": pa.array([v], pa.int64())})
