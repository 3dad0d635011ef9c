"""Polarised whitening, source mixing and periodic runs against plain versions."""

import hashlib
import math
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from conftest import SMALL
from loanlake.llm import mixing as M, periodic_runs as P, queries, whitening as W

VEC = "vec_id long, embedding array<float>, n string"
DOC = "doc_id long, text string, source string, copies string"


# ---------------------------------------------------------------- whitening

def exact_covariance(x):
    """Covariances of whole numbers as fractions."""
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    return [[Fraction(sum((n * r[j] - s[j]) * (n * r[k] - s[k]) for r in x), n ** 3) for k in range(d)] for j in range(d)], s


def test_polarised_covariance_is_exact():
    rng = np.random.default_rng(3)
    for scale in (1, 10 ** 6, 10 ** 12, 10 ** 17):
        x = rng.integers(-scale, scale, (40, 5))
        want, sums = exact_covariance([[int(v) for v in r] for r in x])
        d = W.centred(x, 40, sums)
        squares = {(j, j): s for j, s in enumerate(W.square_sums(d))}
        for j in range(4):
            squares |= {(j, k): s for k, s in enumerate(W.square_sums(d[:, j + 1:] + d[:, j:j + 1]), j + 1)}
        assert (W.covariance(40, squares, 5) == np.array([[float(v) for v in r] for r in want])).all()
    for v in (0, 5, -5, 1 << 250, -(1 << 250), (1 << 61) - 1):
        assert sum(x << W.LIMB_BITS * i for i, x in enumerate(W._limbs(v))) == v


def test_whitening_matches_brute_force(spark):
    rng = np.random.default_rng(9)
    base = (rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))).astype(np.float32)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(base)] + [(None, base[0].tolist(), "x"), (7, base[1].tolist(), None)]
    bad = [(900, None, "x"), (901, [1.0, None, 2.0, 3.0, 4.0, 5.0], "x"), (902, [float("nan")] * 6, "x"),
           (903, [float("inf")] + [0.0] * 5, "x"), (904, [], "x")]
    df = spark.createDataFrame(rows + bad, VEC).repartition(5)
    got = W.whiten(df, components=4)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    x = [[math.floor(64 * c) + 1000000 for c in r[1]] for r in rows]
    exact, sums = exact_covariance(x)
    v = np.array([[float(c) for c in r] for r in exact])
    values, axes = np.linalg.eigh(v)
    n = len(x)
    want = (np.array(x) - np.array(sums) / n) @ axes[:, ::-1][:, :4] / np.sqrt(values[::-1][:4])
    out = {}
    for r in got.collect():
        assert r.n == n and r.identity_error < 1e-9
        assert math.isclose(r.explained, values[::-1][r.component - 1] / np.trace(v), rel_tol=1e-9)
        out.setdefault((r.vec_id, r.deviation), {})[r.component] = r.whitened
    deviations = Counter((rows[i][0], sum((n * c - s) ** 2 for c, s in zip(r, sums))) for i, r in enumerate(x))
    assert set(out) == set(deviations) and got.count() == 4 * n
    sign = np.sign([out[0, next(d for i, d in out if i == 0)][c + 1] / want[0, c] for c in range(4)])
    for i in range(300):
        row = out[rows[i][0], sum((n * c - s) ** 2 for c, s in zip(x[i], sums))]
        assert np.allclose([row[c + 1] for c in range(4)], want[i] * sign, atol=1e-8)


def test_whitening_edges(spark):
    empty = spark.createDataFrame([], VEC)
    assert W.whiten(empty).collect() == []
    one = W.whiten(spark.createDataFrame([(1, [1.0, 2.0], "x")], VEC)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [
        (c, 1, 0, None, None, 0.0) for c in (1, 2)]
    # a dimension of its own each; equal entries make a component without variance
    mixed = [(i, [float(i), 1.0], "x") for i in range(4)] + [(10 + i, [float(i * i)], "x") for i in range(3)]
    got = {(r.vec_id, r.component): r for r in W.whiten(spark.createDataFrame(mixed, VEC)).collect()}
    assert len(got) == 11 and got[0, 1].n == 4 and got[11, 1].n == 3
    assert all((got[i, 2].whitened, got[i, 2].explained) == (None, 0.0) for i in range(4))
    assert math.isclose(sum(got[i, 1].whitened ** 2 for i in range(4)) / 4, 1) and got[0, 1].identity_error < 1e-12
    # entries beyond the longs
    far = [(i, [v], "x") for i, v in enumerate([1e300, -1e300, 3e38, 0.0])]
    wide = spark.createDataFrame(far, "vec_id long, embedding array<double>, n string")
    assert all(r.whitened is not None and r.deviation is None for r in W.whiten(wide).collect())
    huge = W.whole(np.array([[1e308, -1e308, 2.0 ** 57, -0.01]]))
    assert huge.tolist() == [[2 ** 63 - 1, -2 ** 63, 2 ** 63 - 1, 999999]]


def test_whitening_query(spark):
    out = queries.op11_polar_whitening(spark, SMALL)
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
    assert out.count() == 32 * rows and out.agg({"identity_error": "max"}).first()[0] < 1e-4


# ---------------------------------------------------------------- mixing

def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    """Water filling, source by source, in fractions."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = sum(sizes.values()), set(order), {}
    while open_:
        share = Fraction(left, sum(w[s] for s in open_))
        over = {s for s in open_ if w[s] * share > cap * sizes[s]}
        if not over:
            return out | {s: w[s] * share for s in open_}
        for s in over:
            out[s] = Fraction(cap * sizes[s])
            left -= cap * sizes[s]
        open_ -= over
    return out


@pytest.mark.parametrize("weights,cap", [((5, 2, 1), 3), ((1,), 1), ((9, 1), 2)])
def test_targets_match_water_filling(spark, weights, cap):
    rng = np.random.default_rng(cap)
    names = [None, "", "a", "Z", "é", "￿", "\U0001F600", *[f"s{i}" for i in range(40)]]
    sizes = {s: int(rng.choice([0, 1, 3, 50, 1000, 10 ** 6, 10 ** 12])) for s in names}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    want = plain_targets(sizes, weights, cap)
    for r in M.source_targets(df, weights, cap).collect():
        assert math.isclose(r.target, float(want[r.source]), rel_tol=1e-12) and r.rate <= cap
        assert r.rate == 0 if not sizes[r.source] else math.isclose(r.rate, r.target / sizes[r.source], rel_tol=1e-12)


def test_mix_draws_every_document(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 40))), f"s{min(i % 9, 4)}", "x") for i in range(4000)]
    rows += [(None, "same words in a group of copies", None, "y")] * 3000 + [(1, None, "none", "x"), (2, "", "none", None)]
    df = spark.createDataFrame(rows, DOC).repartition(7)
    mixed = M.mix(df)
    got = mixed.collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((i, s, len((t or "").split())) for i, t, s, _ in rows)
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r["size"] * r.copies
    want = plain_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, float(want[r.source])) and 0 <= r.copies <= 3
        if sizes[r.source]:
            assert r.copies - r.target / sizes[r.source] < 1 and r.target / sizes[r.source] - r.copies < 1
    assert all(abs(taken[s] - want[s]) <= 0.05 * max(1, want[s]) for s in sizes)
    again = M.mix(df.repartition(3)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert Counter(map(tuple, M.mix(df, seed=1).collect())) != Counter(map(tuple, got))
    out = M.emit(df, mixed)
    total = Counter()
    for r in got:
        total[r.doc_id, r.source] += r.copies
    assert Counter((r.doc_id, r.source) for r in out.collect()) == +total and out.columns == [*df.columns, "copy"]


def test_mix_edges(spark):
    empty = spark.createDataFrame([], DOC)
    assert M.mix(empty).collect() == [] and M.emit(empty, M.mix(empty)).collect() == []
    none = M.mix(spark.createDataFrame([(1, None, None, None), (2, " \n", "a", "x")], DOC)).collect()
    assert {(r["size"], r.target, r.copies) for r in none} == {(0, 0.0, 0)}
    for bad in ({"cap": 0}, {"weights": ()}, {"weights": (1, 0)}):
        with pytest.raises(ValueError):
            M.mix(empty, **bad)


# ---------------------------------------------------------------- runs

def plain_runs(w, min_length=6):
    """Every period, every stretch."""
    found = {}
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - p:
            a = i
            while i < len(w) - p and w[i] == w[i + p]:
                i += 1
            if i - a + p >= max(min_length, 4 * p) and i > a:
                found.setdefault((a, i - a + p), p)
            i += i == a
    return sorted(((a, n, p) for (a, n), p in found.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng):
    """Words with runs inside runs."""
    letters = int(rng.choice([1, 2, 3, 60]))

    def root(n, depth):
        if depth == 0 or n < 4:
            return rng.integers(0, letters, n).tolist()
        r = root(max(1, n // int(rng.integers(2, 6))), depth - 1)
        out = (r * (n // len(r) + 1))[:n]
        if rng.random() < .7:
            out[int(rng.integers(n))] = int(rng.integers(letters + 1))
        return out

    words = []
    for _ in range(int(rng.integers(1, 5))):
        r = root(int(rng.integers(1, rng.choice([3, 10, 40, 150]))), int(rng.integers(0, 4)))
        words += (r * 10)[:int(len(r) * rng.choice([1, 3.9, 4, 4.1, 9])) + 1]
        words += rng.integers(0, letters + 3, int(rng.integers(0, 9))).tolist()
    return words


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("seed", range(40))
def test_runs_match_brute_force(seed):
    rng = np.random.default_rng(seed)
    texts = [repetitive(rng) for _ in range(int(rng.integers(1, 12)))] + [[], fibonacci(10 * seed), ([1, 2, 3, 1, 2] * 20 + [7]) * 6]
    flat = [x for i, t in enumerate(texts) for x in [*t, -1 - i]]
    bounds = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    got = P.find_runs(np.array(flat, dtype=np.int64), bounds)
    want = [(int(b) + a, n, p) for b, t in zip(bounds, texts) for a, n, p in plain_runs(t)]
    assert got == sorted(want, key=lambda r: (r[0], r[2]))


def test_synchronising_set_is_consistent_and_dense():
    rng = np.random.default_rng(1)
    words = np.concatenate([rng.integers(0, 3, 700), np.tile([1, 2], 60), np.tile(rng.integers(0, 9, 50), 5), rng.integers(0, 3, 300)])
    for t in (8, 16, 32):
        n = len(words)
        f = P.fingerprints(words, t)
        periodic = P.highly_periodic(P.fingerprints(words, t // 2), t, n)
        has_period = lambda a, m, p: (words[a:a + m - p] == words[a + p:a + m]).all()
        assert periodic.tolist() == [any(has_period(i, t, p) for p in range(1, t // 3 + 1)) for i in range(n - t + 1)]
        chosen = set(P.synchronising_set(f, periodic, t).tolist())
        contexts = {}
        for i in range(n - 2 * t + 1):
            contexts.setdefault(words[i:i + 2 * t].tobytes(), set()).add(i in chosen)
        assert all(len(v) == 1 for v in contexts.values())
        for i in range(n - 3 * t + 2):
            sparse = any(has_period(i, 3 * t - 1, p) for p in range(1, t // 3 + 1))
            assert sparse == chosen.isdisjoint(range(i, i + t))


def contract_row(doc_id, text):
    """op13's row by its statement."""
    w = (text or "").encode().split()
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for a, m, p in runs for i in range(a + p, a + m)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{a},{m},{p}\n" for a, m, p in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_query(spark, scratch, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{x}" for x in repetitive(rng))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, " \t\n\x0b "), (None, "a b " * 9), (5, "x " * 3000), (6, "é e " * 8), (6, "é e " * 8),
             (403, " ".join(f"v{x}" for x in [*range(5000)] * 5))]
    path = f"{scratch}/documents.parquet"
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'r' AS runs", "1 AS n_words")
    df.repartition(5).write.parquet(path)
    monkeypatch.setattr(P, "SLICE_BYTES", 2000)
    got = [tuple(r) for r in queries.op13_synchronised_runs(spark, scratch).collect()]
    assert Counter(got) == Counter(contract_row(*r) for r in rows)
    assert queries.op13_synchronised_runs(spark, scratch).columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_of_the_test_data(spark):
    want = Counter(contract_row(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    assert Counter(map(tuple, queries.op13_synchronised_runs(spark, SMALL).collect())) == want
    assert sum(r[1] > 0 for r in want) > 5


def test_runs_of_an_empty_table(spark):
    out = P.collapse_runs(spark.createDataFrame([], "doc_id long, text string, collapsed int"))
    assert out.collect() == [] and out.columns == ["doc_id", "n_words", "runs", "collapsed"]
