"""Whitening of embeddings through polarised covariances.

Entries become whole numbers x = floor(64 * c) + 1000000, and a first pass sums them exactly. A second pass
takes the centred values n * x - S, whole numbers again, and sums, exactly, the squares of every dimension and
of the sum of every two dimensions. Half of what the square of a sum has over the two single ones is the
cross product (polarisation), so these variances give every covariance, rounded once, when it becomes a double.
The eigenvectors of the assembled matrix whiten all rows in a third pass, which also measures the covariance of
what it returns.

Exact sums leave a task as limbs of 30 bits, which Spark adds up as longs; the driver sees one row per pair of
dimensions, whatever the number of vectors. Tasks hold 1,024 vectors at a time.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64.0, 1_000_000
BLOCK = 1024  # 2^10 squares below 2^52 add up inside a long
LIMB_BITS, LIMBS = 30, 9
LONG = (-(1 << 63), (1 << 63) - 1)


class Fit(NamedTuple):
    """Of the vectors of one dimension: their number, sums, eigenvalues (falling) and eigenvectors (columns)."""
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def usable(self) -> np.ndarray:
        """Components whose variance is more than the rounding of the matrix."""
        return self.values > len(self.sums) * np.finfo(float).eps * self.trace


def whole(c: np.ndarray) -> np.ndarray:
    """x of finite doubles as longs; beyond the longs, the nearest long."""
    with np.errstate(over="ignore"):
        f = np.floor(c * SCALE)
    big = np.abs(f) >= 2.0 ** 62
    x = np.where(big, 0.0, f).astype(np.int64) + SHIFT
    for at in np.argwhere(big):
        v = f[tuple(at)]
        x[tuple(at)] = min(max(int(v) + SHIFT if np.isfinite(v) else LONG[int(v > 0)], LONG[0]), LONG[1])
    return x


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S as longs or, where those do not hold it, Python integers."""
    far = max((max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0) * n, *(abs(s) for s in sums), 0)
    if far < 1 << 60:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def square_sums(s: np.ndarray) -> list[int]:
    """Exact sum of the squares of each column."""
    out = [0] * s.shape[1]
    for at in range(0, len(s), BLOCK):
        part = s[at:at + BLOCK]
        top = 0 if part.dtype == object else int(np.abs(part).max(initial=0))
        if part.dtype == object or top >= 1 << 52:
            found = (part.astype(object) ** 2).sum(axis=0).tolist()
        elif top < 1 << 26:
            found = np.einsum("ij,ij->j", part, part).tolist()
        else:
            high, low = part >> 26, part & (1 << 26) - 1
            hh, hl, ll = (np.einsum("ij,ij->j", a, b).tolist() for a, b in ((high, high), (high, low), (low, low)))
            found = [(a << 52) + (b << 27) + c for a, b, c in zip(hh, hl, ll)]
        out = [a + b for a, b in zip(out, found)]
    return out


def _limbs(value: int) -> list[int]:
    """Signed limbs; those of several values may be added one by one."""
    mask = (1 << LIMB_BITS) - 1
    return [value >> LIMB_BITS * i & mask for i in range(LIMBS - 1)] + [value >> LIMB_BITS * (LIMBS - 1)]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the batch, their whole numbers) by dimension, some rows at a time."""
    vec = batch.column(batch.schema.get_field_index("vec"))
    flat, offsets = vec.values.to_numpy(zero_copy_only=False), vec.offsets.to_numpy()
    lengths = np.diff(offsets)
    for dim in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == dim)
        for at in range(0, len(rows), BLOCK):
            part = rows[at:at + BLOCK]
            yield part, whole(flat[offsets[part][:, None] + np.arange(dim)])


def _summed(found: dict[tuple[int, int, int], int]) -> pa.RecordBatch:
    keys = list(found)
    limbs = [_limbs(found[k]) for k in keys]
    return pa.RecordBatch.from_arrays(
        [pa.array([k[i] for k in keys], pa.int32()) for i in range(3)]
        + [pa.array([v[i] for v in limbs], pa.int64()) for i in range(LIMBS)],
        names=["dim", "j", "k", *(f"l{i}" for i in range(LIMBS))])


def _sums(batches: Iterator[pa.RecordBatch]):
    """Number of vectors at (dim, -1, -1) and sum of each dimension at (dim, j, j)."""
    found: dict[tuple[int, int, int], int] = {}
    for batch in batches:
        for _, x in _blocks(batch):
            dim = x.shape[1]
            wide = len(x) and max(abs(int(x.min())), abs(int(x.max()))) >= 1 << 52
            sums = x.astype(object).sum(axis=0).tolist() if wide else x.sum(axis=0).tolist()
            for key, value in [((dim, -1, -1), len(x)), *(((dim, j, j), s) for j, s in enumerate(sums))]:
                found[key] = found.get(key, 0) + value
    if found:
        yield _summed(found)


def _squares(batches: Iterator[pa.RecordBatch], centres: dict[int, tuple[int, list[int]]]):
    """Squares of each dimension at (dim, j, j) and of each sum of two at (dim, j, k)."""
    found: dict[tuple[int, int, int], int] = {}
    for batch in batches:
        for _, x in _blocks(batch):
            dim = x.shape[1]
            d = centred(x, *centres[dim])
            for j, value in enumerate(square_sums(d)):
                found[dim, j, j] = found.get((dim, j, j), 0) + value
            for j in range(dim - 1):
                for k, value in enumerate(square_sums(d[:, j + 1:] + d[:, j:j + 1]), j + 1):
                    found[dim, j, k] = found.get((dim, j, k), 0) + value
    if found:
        yield _summed(found)


_SUM_SCHEMA = "dim int, j int, k int, " + ", ".join(f"l{i} long" for i in range(LIMBS))


def _collected(partial: DataFrame) -> dict[tuple[int, int, int], int]:
    """One integer per key of the limbs of all tasks; keys are bounded by the squares of the dimensions."""
    rows = partial.groupBy("dim", "j", "k").agg(*[F.sum(f"l{i}").alias(f"l{i}") for i in range(LIMBS)]).collect()
    return {(r[0], r[1], r[2]): sum(r[3 + i] << LIMB_BITS * i for i in range(LIMBS)) for r in rows}


def covariance(n: int, squares: dict[tuple[int, int], int], dim: int) -> np.ndarray:
    """Covariances (divisor n) from the squares of centred values n * x - S and of their pairwise sums."""
    v = np.empty((dim, dim))
    for j in range(dim):
        v[j, j] = squares[j, j] / n ** 3
        for k in range(j + 1, dim):
            v[j, k] = v[k, j] = (squares[j, k] - squares[j, j] - squares[k, k]) // 2 / n ** 3
    return v


def _vectors(df: DataFrame, embedding: str, *columns: str) -> DataFrame:
    """The carried columns (as c0, c1, ..) and ``vec`` of the rows whose entries are all finite."""
    vec = F.col(f"`{embedding}`").cast("array<double>")
    finite = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return df.where(vec.isNotNull() & finite).select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], vec.alias("vec"))


def fit(df: DataFrame, embedding: str = "embedding") -> dict[int, Fit]:
    """A fit over all usable vectors of each dimension (their number of entries)."""
    vectors = _vectors(df, embedding)
    first = _collected(vectors.mapInArrow(_sums, _SUM_SCHEMA))
    dims = sorted({k[0] for k in first})
    centres = {d: (first[d, -1, -1], [first[d, j, j] for j in range(d)]) for d in dims}
    second = _collected(vectors.mapInArrow(functools.partial(_squares, centres=centres), _SUM_SCHEMA)) if dims else {}
    out = {}
    for d in dims:
        n, sums = centres[d]
        v = covariance(n, {k[1:]: s for k, s in second.items() if k[0] == d}, d)
        values, axes = np.linalg.eigh(v)
        values, axes = values[::-1], axes[:, ::-1]
        # one sign for all rows: the largest entry of a component is positive
        axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(d)])
        out[d] = Fit(n, sums, values, axes, float(np.trace(v)))
    return out


def _projected(x: np.ndarray, model: Fit, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Centred values and whitened rows; NaN in components without variance."""
    d = centred(x, model.n, model.sums)
    k = min(components, x.shape[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(model.usable()[:k], np.sqrt(np.maximum(model.values[:k], 0)), np.nan)
        return d, (d / model.n).astype(float) @ model.vectors[:, :k] / scale


def _moments(batches: Iterator[pa.RecordBatch], fits: dict[int, Fit], components: int):
    """Sums (a, -1) and products (a, b) of whitened values."""
    found: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for _, x in _blocks(batch):
            w = _projected(x, fits[x.shape[1]], components)[1]
            held = found.setdefault(x.shape[1], [np.zeros(w.shape[1]), np.zeros((w.shape[1], w.shape[1]))])
            held[0] += w.sum(axis=0)
            held[1] += w.T @ w
    for dim, (one, two) in found.items():
        k = len(one)
        a, b = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(k + len(a), dim), pa.int32()), pa.array(np.append(np.arange(k), a), pa.int32()),
             pa.array(np.append(np.full(k, -1), b), pa.int32()), pa.array(np.append(one, two[a, b]))],
            names=["dim", "j", "k", "v"])


def identity_error(df: DataFrame, fits: dict[int, Fit], embedding: str = "embedding", components: int = 32) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured on the rows, over the
    components that have variance (0.0 if there are none)."""
    rows = _vectors(df, embedding).mapInArrow(functools.partial(_moments, fits=fits, components=components),
                                              "dim int, j int, k int, v double")
    sums = {(r[0], r[1], r[2]): r[3] for r in rows.groupBy("dim", "j", "k").agg(F.sum("v")).collect()}
    worst = 0.0
    for (dim, a, b), v in sums.items():
        usable = fits[dim].usable()
        if b >= 0 and usable[a] and usable[b]:
            n = fits[dim].n
            worst = max(worst, abs(v / n - sums[dim, a, -1] / n * (sums[dim, b, -1] / n) - (a == b)))
    return worst


def _whitened(batches: Iterator[pa.RecordBatch], fits: dict[int, Fit], components: int):
    for batch in batches:
        carried = batch.columns[:-1]
        for rows, x in _blocks(batch):
            model = fits[x.shape[1]]
            d, w = _projected(x, model, components)
            m, k = w.shape
            deviation = [v if v <= LONG[1] else None for v in square_sums(np.ascontiguousarray(d.T))]
            share = model.values[:k] / model.trace if model.trace else np.full(k, np.nan)
            again = pa.array(np.repeat(rows, k))
            yield pa.RecordBatch.from_arrays(
                [*(c.take(again) for c in carried), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, model.n), pa.int64()),
                 pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                 pa.array(w.ravel(), from_pandas=True), pa.array(np.tile(share, m), from_pandas=True)],
                names=[*batch.schema.names[:-1], "component", "n", "deviation", "whitened", "explained"])


def whiten(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 32,
           fits: dict[int, Fit] | None = None) -> DataFrame:
    """A row per usable vector and component up to ``components``: id, ``component`` (from 1, falling
    eigenvalue), ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    * A null vector and one with null or non-finite entries give no row and are not fitted; so does an empty one.
      Vectors of different dimensions are spaces of their own, each with its own fit.
    * Null and repeated ids are rows like any other, repeated vectors count as often as they occur.
    * ``deviation`` is null where a long does not hold it. Components of no variance (all of them, for one vector
      or equal ones) have null as ``whitened``; ``explained`` is null where the trace is 0.
    * Entries whose x exceeds a long count as the nearest long. Empty input: empty result. Other columns are not read.
    """
    fits = fit(df, embedding) if fits is None else fits
    error = identity_error(df, fits, embedding, components)
    kind = df.schema[vec_id].dataType.simpleString()
    rows = _vectors(df, embedding, vec_id).mapInArrow(
        functools.partial(_whitened, fits=fits, components=components),
        f"c0 {kind}, component int, n long, deviation long, whitened double, explained double")
    return rows.withColumnRenamed("c0", vec_id).withColumn("identity_error", F.lit(error))
