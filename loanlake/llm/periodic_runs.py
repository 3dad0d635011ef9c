"""Runs of repeated words by string synchronising sets.

A run is a stretch of words with smallest period p, at least four periods and ``min_length`` words long, that no
neighbouring word extends. All runs of a text are found, in O(n log n) steps for n words:

* Periods below ``BASE`` are found directly: words p apart are compared, and stretches of equal ones measured.
* Other periods belong to a dyadic scale t with t <= p < 2t. The synchronising set of t has position i if, of all
  windows of t words that start at i to i + t and are not highly periodic (period of at most t / 3), the
  smallest fingerprint is that of the window at i or at i + t. It is a function of the 2t words from i, so equal
  contexts are selected alike, and a run of scale t, in which no window of 3t - 1 words is highly periodic, has a
  position among its first t. That one and the one a period later have equal contexts of 2t words, and none
  between them has (2t words hold a whole period, which is primitive). So each position and the next one of equal
  context, t to 2t - 1 words on, propose a period, which is then extended word by word in both directions.
* Highly periodic windows are detected apart, by the next occurrence of their first half: it lies one period
  on. The positions they take from the set have smaller periods than the scale's own, and these come from their
  own scale or the direct comparison.

Fingerprints are 64-bit hashes; what they propose is verified on the words. Scales are left out for texts in
which no t words occur twice, since every run of the scale or of larger ones repeats such words.

A task works on some texts side by side, each closed by a word of its own, so no run crosses texts. Its
memory follows the longest text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake.llm.common import byte_column
from loanlake.llm.segtree_bpe import slices

EXPONENT = 4  # periods a run has at least; the scales rest on it
MIN_LENGTH = 6
BASE = 8
SLICE_BYTES = 2 << 20
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
# Odd multipliers of 64-bit mixing.
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _M1
    x ^= x >> np.uint64(32)
    x *= _M2
    x ^= x >> np.uint64(29)
    return x


def fingerprints(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` (a power of two) words from each position that has as many."""
    f = _mixed(words.astype(np.uint64))
    at = 1
    while at < length:
        f = _mixed(f[:-at] + _mixed(f[at:]) * np.uint64(3)) if len(f) > at else f[:0]
        at *= 2
    return f


def _twice(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a value and of its next occurrence."""
    order = np.argsort(f, kind="stable")
    same = f[order[1:]] == f[order[:-1]]
    return order[:-1][same], order[1:][same]


def highly_periodic(f_half: np.ndarray, t: int, n: int) -> np.ndarray:
    """For each window of ``t`` words: has it a period of at most t / 3? ``f_half``: fingerprints of t / 2 words."""
    half, out = t // 2, np.zeros(max(0, n - t + 1), dtype=bool)
    at, after = _twice(f_half)
    period = after - at
    near = (period <= t // 3) & (at < len(out))
    at, period = at[near], period[near]
    # the two halves at either end of the t - p words that have to equal those a period later
    out[at] = f_half[at + half - period] == f_half[at + half]
    return out


def synchronising_set(f: np.ndarray, periodic: np.ndarray, t: int) -> np.ndarray:
    """Positions i whose window of ``t`` words, or that at i + t, has the smallest fingerprint of the windows
    from i to i + t that are not highly periodic."""
    if len(f) <= t:
        return np.zeros(0, dtype=np.int64)
    masked = np.where(periodic, NONE, f)
    least, width = masked, 1
    while width < t:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:len(f) - t], masked[t:])
    return np.flatnonzero((least != NONE) & ((masked[:-t] == least) | (masked[t:] == least)))


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each stretch of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], equal.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def _extent(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The longest stretch [a, b) around ``at`` whose words equal those ``period`` later."""
    a, b, last = at, at, len(words) - period
    step = 64
    while b < last:
        e = min(last, b + step)
        equal = words[b:e] == words[b + period:e + period]
        if not equal.all():
            b += int(equal.argmin())
            break
        b, step = e, step * 2
    step = 64
    while a > 0:
        s = max(0, a - step)
        equal = words[s:a] == words[s + period:a + period]
        if not equal.all():
            a -= int(equal[::-1].argmin())
            break
        a, step = s, step * 2
    return a, b


def find_runs(words: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period), by start and period, of all runs in the texts ``words[bounds[i]:bounds[i + 1]]``, each of which ends
    with a number that occurs nowhere else."""
    found: dict[tuple[int, int], int] = {}

    def add(a: int, b: int, p: int) -> None:
        length = b - a + p
        if length >= max(min_length, EXPONENT * p):
            found[a, length] = min(p, found.get((a, length), p))

    for p in range(1, min(BASE, len(words))):
        starts, ends = _stretches(words[:-p] == words[p:])
        long = ends - starts >= max(min_length, EXPONENT * p) - p
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            add(a, b, p)

    t, sizes = BASE, np.diff(bounds)
    part, origin = words, np.arange(len(words))  # what is left of the texts, and where it comes from
    starts = bounds[:-1]
    while True:
        # texts that are long enough and hold t words twice
        f = fingerprints(part, t)
        first, second = _twice(f)
        owner = np.searchsorted(starts, first, side="right") - 1
        both = owner == np.searchsorted(starts, second, side="right") - 1
        keep = np.zeros(len(starts), dtype=bool)
        keep[owner[both]] = True
        keep &= sizes > EXPONENT * t
        if not keep.any():
            break
        if not keep.all():
            inside = np.repeat(keep, sizes)
            part, origin, sizes = part[inside], origin[inside], sizes[keep]
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        f_half = fingerprints(part, t // 2)
        f = fingerprints(part, t)
        sync = synchronising_set(f, highly_periodic(f_half, t, len(part)), t)
        sync = sync[sync <= len(part) - 2 * t]
        i, j = _twice(_mixed(f[sync] + _mixed(f[sync + t]) * np.uint64(3)))
        at, period = sync[i], sync[j] - sync[i]
        wanted = (period >= t) & (period < 2 * t)
        reached: dict[int, int] = {}
        for s, p in sorted(zip(at[wanted].tolist(), period[wanted].tolist())):
            if s >= reached.get(p, 0):
                a, b = _extent(part, s, p)
                reached[p] = max(b, s + 1)
                add(int(origin[a]), int(origin[a]) + b - a, p)
        t *= 2
    return sorted(((a, length, p) for (a, length), p in found.items()), key=lambda r: (r[0], r[2]))


def _collapse(batches: Iterator[pa.RecordBatch], min_length: int, slice_bytes: int):
    for batch in batches:
        raw = byte_column(batch, "text")
        carried = batch.drop_columns(["text"])
        for part in slices(raw, slice_bytes):
            split = [t.split() for t in raw[part]]
            ids: dict[bytes, int] = {}
            flat: list[int] = []
            for i, words in enumerate(split):
                flat += [ids.setdefault(w, len(ids)) for w in words]
                flat.append(-1 - i)
            bounds = np.concatenate(([0], np.cumsum([len(w) + 1 for w in split])))
            runs: list[list[dict]] = [[] for _ in split]
            found = find_runs(np.array(flat, dtype=np.int64), bounds, min_length)
            owners = np.searchsorted(bounds, [r[0] for r in found], side="right") - 1
            for (start, length, period), i in zip(found, owners.tolist()):
                runs[i].append({"start": start - int(bounds[i]), "length": length, "period": period})
            for words, own in zip(split, runs):
                if own:
                    keep = np.ones(len(words), dtype=bool)
                    for r in own:
                        keep[r["start"] + r["period"]:r["start"] + r["length"]] = False
                    words[:] = [words[k] for k in np.flatnonzero(keep)]
            yield pa.RecordBatch.from_arrays(
                [*carried.slice(part.start, part.stop - part.start).columns,
                 pa.array(np.diff(bounds) - 1, pa.int64()), pa.array(runs, _RUNS),
                 pa.array([b" ".join(w) for w in split], pa.binary())],
                names=[*carried.schema.names, "n_words", "runs", "collapsed"])


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUNS_TYPE = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def collapse_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                  min_length: int = MIN_LENGTH) -> DataFrame:
    """Every row of ``docs`` with the ``keep`` columns (default: all but the text), ``n_words``, ``runs`` (array of
    start, length, period in words, by start and period) and ``collapsed``, the words that are in no run after its first period,
    joined by single spaces.

    Words are separated by ASCII whitespace. Null and empty texts have no words, no runs and an empty
    ``collapsed``. Runs may overlap; a word that any of them repeats goes. Rows are independent: repeated ones and
    null ids are rows like any other. Columns called ``n_words``, ``runs`` or ``collapsed`` are replaced. Empty
    input: empty result.
    """
    new = ("n_words", "runs", "collapsed")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (text, *new)]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)],
                       F.col(f"`{text}`").cast("binary").alias("text"))
    out = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
                       + [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS_TYPE),
                          T.StructField("collapsed", T.BinaryType())])
    found = rows.mapInArrow(functools.partial(_collapse, min_length=min_length, slice_bytes=SLICE_BYTES), out)
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "n_words", "runs",
                        F.col("collapsed").cast("string").alias("collapsed"))
