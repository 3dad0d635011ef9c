"""E8 lattice points and hash keys of projected vectors (numpy, runs inside Spark tasks).

The E8 lattice is D8 together with D8 + (1/2,...,1/2), where D8 holds the integer points of even
coordinate sum. A vector is projected to ``blocks`` groups of eight coordinates per table; each
group is decoded to its nearest lattice point and the key is a hash of all points of the table.
"""

from __future__ import annotations

import itertools

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalising permutation (wrapping arithmetic)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer point of even coordinate sum, row by row."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
    if len(odd):
        off = x[odd] - near[odd]
        worst = np.abs(off).argmax(axis=1)
        step = np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
        near[odd, worst] += step
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    whole = nearest_d8(x)
    half = nearest_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def shortest_vectors() -> np.ndarray:
    """The 240 lattice vectors of squared length 2: the steps to neighbouring lattice points."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((-1.0, 1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    for signs in itertools.product((-0.5, 0.5), repeat=8):
        if sum(s < 0 for s in signs) % 2 == 0:
            out.append(np.array(signs))
    return np.array(out)


STEPS = shortest_vectors()


class LatticeKeys:
    """Keys of unit vectors: per table the cell of the vector and ``probes`` neighbouring cells.

    A neighbouring cell moves one block to its next-nearest lattice points; the probes taken are
    the cells nearest to the projected vector.
    """

    def __init__(self, dim: int, tables: int, blocks: int, width: float, probes: int, seed: int):
        rng = np.random.default_rng([seed, dim])
        self.tables, self.blocks, self.probes = tables, blocks, probes
        self.planes = rng.standard_normal((dim, tables * blocks * 8)) / width
        self.salts = rng.integers(1, 2**63, size=(tables, blocks, 8), dtype=np.uint64) | np.uint64(1)

    def _hash(self, points: np.ndarray, table: int, block: int) -> np.ndarray:
        doubled = np.rint(points * 2).astype(np.int64).astype(np.uint64)
        return mix64((doubled * self.salts[table, block]).sum(axis=-1, dtype=np.uint64) + MIX)

    def __call__(self, unit: np.ndarray) -> np.ndarray:
        """(n, tables, 1 + probes) unsigned keys; column 0 is the vector's own cell."""
        n = len(unit)
        flat = unit @ self.planes
        keys = np.empty((n, self.tables, 1 + self.probes), dtype=np.uint64)
        per_block = min(self.probes, 240)
        for t in range(self.tables):
            own, moved, cost = [], [], []
            for b in range(self.blocks):
                at = (t * self.blocks + b) * 8
                x = flat[:, at:at + 8]
                p = nearest_e8(x)
                own.append(self._hash(p, t, b))
                if per_block:
                    gain = (x - p) @ STEPS.T
                    best = np.argpartition(-gain, per_block - 1, axis=1)[:, :per_block]
                    cost.append(-np.take_along_axis(gain, best, axis=1))
                    moved.append(self._hash(p[:, None, :] + STEPS[best], t, b))
            total = np.bitwise_xor.reduce([mix64(h + np.uint64(b)) for b, h in enumerate(own)])
            tag = mix64(np.array([t + 1]) * 2 + 1)[0]
            keys[:, t, 0] = mix64(total ^ tag)
            if per_block:
                alt = np.concatenate(
                    [(total ^ mix64(own[b] + np.uint64(b)))[:, None] ^ mix64(moved[b] + np.uint64(b))
                     for b in range(self.blocks)], axis=1)
                pick = np.argpartition(np.concatenate(cost, axis=1), self.probes - 1, axis=1)
                pick = pick[:, :self.probes]
                keys[:, t, 1:] = mix64(np.take_along_axis(alt, pick, axis=1) ^ tag)
        return keys
