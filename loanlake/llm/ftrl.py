"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, word pairs, and pairs with one and two words
between (A-Z lower-cased, ASCII punctuation is space), in 2^20 buckets, with the values 1, 0.5, 0.3 and
0.3, as single words say most. Training follows the
FTRL-proximal rule: each coordinate has its own learning rate from its sum of squared gradients,
and the L1 term holds rare and useless coordinates at exactly zero. The few weights left are
broadcast (at most 2^20 of them) and every whole text is scored in the tasks.

The model is fitted on at most ``max_rows`` labelled rows, the first by a hash of their id: its
quality does not depend on more, while scoring reads all rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake.llm.common import byte_column, stored

BITS = 20
MAX_ROWS = 16_384
CACHE_ENTRIES = 100_000
BIAS = 0

_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_FOLD = bytes.maketrans(bytes(range(65, 91)) + _PUNCTUATION,
                        bytes(range(97, 123)) + b" " * len(_PUNCTUATION))
_GAPS = ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (3, 0x165667B19E3779F9))
VALUES = np.array([1.0, 0.5, 0.3, 0.3])  # of words and of pairs by gap


@dataclass(frozen=True)
class Settings:
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.0
    epochs: int = 10


class Features:
    """Bucket numbers of texts, with the kind (index of ``VALUES``) above bit 20; hashes of recurring words are kept in a cache of bounded size."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.translate(_FOLD).split()
        if not words:
            return np.zeros(0, dtype=np.uint32)
        known = self.known
        if len(known) > CACHE_ENTRIES:
            known.clear()
        got = list(map(known.get, words))
        if None in got:
            for i, h in enumerate(got):
                if h is None:
                    got[i] = known[words[i]] = xxhash.xxh64_intdigest(words[i])
        h = np.array(got, dtype=np.uint64)
        parts = [h] + [h[:-gap] * np.uint64(c) + h[gap:] * np.uint64(c ^ 0xA5A5A5A4)
                       for gap, c in _GAPS if len(h) > gap]
        return np.concatenate([(p >> np.uint64(64 - BITS)).astype(np.uint32) | np.uint32(kind << BITS)
                               for kind, p in enumerate(parts)])


@functools.lru_cache(maxsize=1)
def features() -> Features:
    return Features()


class Ftrl:
    def __init__(self, settings: Settings):
        self.s = settings
        self.z = np.zeros(1 << BITS)
        self.n = np.zeros(1 << BITS)

    def weights(self, at) -> np.ndarray:
        s, z = self.s, self.z[at]
        rate = (s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2
        return np.where(np.abs(z) <= s.l1, 0.0, (np.sign(z) * s.l1 - z) / rate)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        """One step; ``at`` are distinct buckets."""
        w = self.weights(at)
        g = (_sigmoid((w * value).sum()) - label) * value
        n = self.n[at]
        step = (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha
        self.z[at] += g - step * w
        self.n[at] = n + g * g


def _sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0))))


def distinct(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and the value of each one's first kind."""
    at, first = np.unique(found & np.uint32((1 << BITS) - 1), return_index=True)
    return at, VALUES[found[first] >> np.uint32(BITS)]


def _once(found: np.ndarray) -> np.ndarray:
    _, first = np.unique(found & np.uint32((1 << BITS) - 1), return_index=True)
    return found[first]


def _train(batches: Iterator[pa.RecordBatch], settings: Settings):
    """(turn, label, buckets) in order -> the weights that are not zero. The rows are bounded by
    ``max_rows``; each epoch goes over the kept bucket lists."""
    rows = []
    for batch in batches:
        labels, packed = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        rows += [(y, np.frombuffer(p, dtype=np.uint32)) for y, p in zip(labels, packed)]
    model = Ftrl(settings)
    for _ in range(settings.epochs):
        for y, found in rows:
            model.learn(*distinct(found), y)
    w = model.weights(slice(None))
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(w[at])], names=["bucket", "weight"])


def _featurise(batches: Iterator[pa.RecordBatch]):
    find = features()
    for batch in batches:
        packed = [_once(np.append(np.uint32(BIAS), find(t))).tobytes() for t in byte_column(batch, "text")]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())],
                                         names=["turn", "label", "buckets"])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        max_rows: int = MAX_ROWS, settings: Settings = Settings()) -> DataFrame:
    """Weights (bucket, weight) learned from the texts of the ids in ``labels`` (id, label 0/1).

    Null ids or labels are left out; an id with several labels counts as 1 if any is. At most
    ``max_rows`` labels, the first by hash of the id, are used; this also bounds what is broadcast and
    what the training task holds. No labelled row: no weights, every score is 0.5.
    """
    turn = F.xxhash64(doc_id)
    chosen = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
              .groupBy(F.col(doc_id).alias("labelled")).agg(F.max((F.col(label) > 0).cast("int")).alias("label"))
              .select("labelled", "label").orderBy(F.xxhash64("labelled"), "labelled").limit(max_rows))
    body = docs.select(F.col(doc_id).alias("labelled"), F.col(text).alias("text"), turn.alias("turn"))
    rows = body.join(F.broadcast(chosen), "labelled").select("turn", "label", "text")
    found = rows.mapInArrow(_featurise, "turn long, label int, buckets binary")
    # copies of a labelled id would exceed the bound: one row per id and text content
    one = found.groupBy("turn", "label").agg(F.min("buckets").alias("buckets"))
    ordered = one.repartition(1).sortWithinPartitions("turn", "label")
    return stored(ordered.mapInArrow(functools.partial(_train, settings=settings),
                                     "bucket int, weight double"), "ftrl")


def _score(batches: Iterator[pa.RecordBatch], weights):
    at, values = weights.value
    dense = np.zeros(1 << BITS, dtype=np.float64)
    dense[at] = values
    used = dense != 0
    find, low = features(), np.uint32((1 << BITS) - 1)
    for batch in batches:
        scores = []
        for t in byte_column(batch, "__text"):
            found = find(t)
            hit = found[used[found & low]]
            at, value = distinct(np.append(np.uint32(BIAS), hit))
            scores.append(_sigmoid((dense[at] * value).sum()))
        rest = batch.drop_columns(["__text"])
        yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(scores, pa.float64())],
                                         names=[*rest.schema.names, "score"])


def score(docs: DataFrame, weights: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) with ``score`` (0 to 1) and ``predicted`` (1 at 0.5 or more).

    Null and empty texts score by the bias alone. Columns of ``docs`` called ``score`` or ``predicted``
    are replaced. Empty input: empty result.
    """
    spark: SparkSession = docs.sparkSession
    keep = [c for c in (keep or docs.columns) if c not in ("score", "predicted")]
    rows = weights.collect()  # at most 2^BITS
    sent = spark.sparkContext.broadcast((np.array([r["bucket"] for r in rows], dtype=np.int64),
                                         np.array([r["weight"] for r in rows], dtype=np.float64)))
    out = T.StructType([docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())])
    slim = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    return slim.mapInArrow(functools.partial(_score, weights=sent), out).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def remainder(doc_id: str, n: int):
    """crc32 of the id as text, modulo n; -1, which is no remainder, for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n)), F.lit(-1))
