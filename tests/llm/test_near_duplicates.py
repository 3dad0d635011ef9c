"""Lattice hashing and Golay SimHash against brute force."""

import itertools

import numpy as np
import pytest

import brute
from conftest import SMALL
from loanlake.llm import common, e8, golay_simhash as G, lattice_dedup as L

VEC = "vec_id long, embedding array<float>, label int"


def vectors(seed=1, dim=24):
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            base = rng.standard_normal(dim)
            for _ in range(int(rng.integers(1, 6))):
                rows.append((at, [float(np.float32(x)) for x in base + rng.standard_normal(dim) * rng.choice([0, .1, .3])], label))
                at += 1
    rows += [(at, rows[3][1], rows[3][2]), (at + 1, rows[3][1], 1), (at + 2, None, 0), (at + 3, [], 0),
             (at + 4, [0.0] * dim, 0), (at + 5, [float("nan")] + [1.0] * (dim - 1), 0), (at + 6, [None] + [1.0] * (dim - 1), 0),
             (None, rows[3][1], rows[3][2]), (at + 7, [1.0, 2.0], 0), (at + 8, [2.0, 4.0], 0)]
    return rows


def expect(rows, threshold):
    links = brute.vector_links([(r[0], r[2], r[1]) for r in rows], threshold)
    degree = {}
    for i, j in links:
        degree[i] = degree.get(i, 0) + 1
        degree[j] = degree.get(j, 0) + 1
    parts = brute.components([r[0] for r in rows if r[0] is not None], [(rows[i][0], rows[j][0]) for i, j in links])
    return sorted(((r[0], degree.get(i, 0), parts.get(r[0]), r[0] is None or parts[r[0]] == r[0])
                   for i, r in enumerate(rows)), key=str)


def test_lattice_gives_a_row_per_vector_of_repeated_ids(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.01], 0), (3, [-1.0, 0.0], 0)]
    got = sorted(map(tuple, L.near_duplicates(spark.createDataFrame(rows, VEC)).collect()))
    assert got == [(1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    # three vectors of one id and copies of one of them
    rows = [(5, [1.0, 0.0], 0), (4, [1.0, 0.0], 0), (5, [0.0, 1.0], 0), (7, [0.0, 1.0], 0), (5, [-1.0, 0.0], 0), (5, [1.0, 0.0], 1)]
    got = sorted(map(tuple, L.near_duplicates(spark.createDataFrame(rows, VEC)).collect()))
    assert got == [(4, 1, 4, True), (5, 0, 5, True), (5, 0, 5, True), (5, 1, 4, False), (5, 1, 5, True), (7, 1, 5, False)]


@pytest.mark.parametrize("dim", [16, 64, 256])
def test_lattice_recall_of_pairs_at_the_threshold(dim):
    rng = np.random.default_rng(dim)
    u, v = rng.standard_normal((2, 3000, dim))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    v -= (v * u).sum(axis=1, keepdims=True) * u
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    keys = e8.LatticeKeys(dim, L.TABLES, L.BLOCKS, L.WIDTH, L.PROBES, L.SEED)
    for cosine, least in ((0.93, 0.996), (0.96, 0.9995)):
        w = cosine * u + np.sqrt(1 - cosine ** 2) * v
        assert (keys(u)[:, :, :, None] == keys(w)[:, :, None, :]).any(axis=(1, 2, 3)).mean() >= least


@pytest.mark.parametrize("block", [1024, 3])
def test_lattice_matches_brute_force(spark, block):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x") for r in rows], VEC + ", key string")
    got = sorted(map(tuple, L.near_duplicates(df, block=block).collect()), key=str)
    assert got == expect(rows, 0.93)


def test_lattice_empty_and_test_data(spark):
    assert L.near_duplicates(spark.createDataFrame([], VEC)).collect() == []
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, L.near_duplicates(df).collect()), key=str) == expect(rows, 0.93)


def test_e8_points_and_recall():
    assert len(e8.STEPS) == 240 and np.allclose((e8.STEPS ** 2).sum(axis=1), 2)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 8)) * 2
    p = e8.nearest_e8(x)
    best = ((x - p) ** 2).sum(axis=1)
    assert (best <= 1 + 1e-9).all()  # covering radius
    around = ((x[:, None] - (p[:, None] + e8.STEPS)) ** 2).sum(axis=2)
    assert (around >= best[:, None] - 1e-9).all()
    u = rng.standard_normal((2000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    v = rng.standard_normal((2000, 64))
    v -= (v * u).sum(axis=1, keepdims=True) * u
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    keys = e8.LatticeKeys(64, L.TABLES, L.BLOCKS, L.WIDTH, L.PROBES, L.SEED)

    def met(w):
        return (keys(u)[:, :, :, None] == keys(w)[:, :, None, :]).any(axis=(1, 2, 3)).mean()

    assert met(0.93 * u + np.sqrt(1 - 0.93 ** 2) * v) > 0.99
    assert met(v) < 0.02


def test_golay_code():
    patterns = G._error_patterns()
    assert sorted(set(map(int, np.bitwise_count(patterns)))) == [0, 1, 2, 3] and len(set(patterns.tolist())) == 2048
    words = np.random.default_rng(3).integers(0, 1 << 23, 4000)
    index, new = G.reachable(words)
    for w, row, flags in zip(words[:300].tolist(), index, new):
        near = {int(G.decode(np.array([w ^ f]))[0][0]) for f in [0] + [1 << i for i in range(23)]}
        assert near == set(row[flags].tolist()) and flags.sum() in (1, 6)


def test_golay_keys_meet_within_four_bits():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2 ** 64, 3000, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    sets = []
    for z in (x, y):
        rows, keys = G.fingerprint_keys(z)
        of = [set() for _ in z]
        for r, k in zip(rows.tolist(), keys.tolist()):
            of[r].add(k)
        sets.append(of)
    assert all(a & b for a, b in zip(*sets))
    assert max(map(len, sets[0])) <= 3 + 3 * 11


def test_every_pattern_of_four_errors_in_three_segments_is_covered():
    for errors in itertools.product(range(5), repeat=3):
        if sum(errors) <= 4:
            assert 0 in errors or errors.count(1) >= 2


DOC = "doc_id long, text string"


@pytest.mark.parametrize("block", [2048, 2])
def test_simhash_matches_brute_force(spark, block):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(1001, None), (1002, ""), (1003, " \t\n"), (1004, "One word"), (1005, "one WORD"), (None, "one word"),
             (1006, docs[5][1]), (1006, docs[5][1]), (1007, "word " * 30000), (1008, "É a é A ẞ"), (None, "nothing like it at all")]
    prints = [brute.simhash(t, 4) for _, t in docs]
    links = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    parts = brute.components(range(len(docs)), links)
    first = {}
    for i, p in parts.items():
        if docs[i][0] is not None:
            first[p] = min(first.get(p, docs[i][0]), docs[i][0])
    want = sorted([(docs[i][0], prints[i], first.get(parts[i])) for i in range(len(docs))], key=str)
    got = G.near_duplicates(spark.createDataFrame(docs, DOC), block=block).collect()
    assert sorted([(r[0], r[1] & (2 ** 64 - 1), r[2]) for r in got], key=str) == want
    kept = G.drop_near_duplicates(spark.createDataFrame([(*d, "k") for d in docs], DOC + ", fp string"))
    assert kept.columns == ["doc_id", "text", "fp"]
    ids = [r[0] for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted(
        d[0] for i, d in enumerate(docs) if d[0] is not None and first[parts[i]] == d[0])
    assert ids.count(None) == 1 and [r.text for r in kept.collect() if r.doc_id is None] == ["nothing like it at all"]


def test_one_row_of_each_group_stays(spark):
    same, other = "four equal texts and one id among them", "another text that is shared by rows of one id"
    rows = [(None, same, 1), (None, same, 2), (None, same, 3), (8, same, 4), (9, other, 5), (9, other, 6), (9, "and a text of its own", 7),
            (None, "without id and alone", 8), (None, None, 9), (None, "", 9)]
    df = spark.createDataFrame(rows, DOC + ", __row int").repartition(4)
    kept = G.drop_near_duplicates(df)
    assert kept.columns == df.columns
    got = [tuple(r) for r in kept.collect()]
    assert sorted((i, t) for i, t, _ in got if i) == [(8, same), (9, "and a text of its own"), (9, other)]
    assert sorted(t or "" for i, t, _ in got if i is None) == ["", "without id and alone"]
    assert set(got) <= set(rows) and len(got) == 5
    assert G.drop_near_duplicates(df.limit(0)).collect() == []


def test_simhash_empty(spark):
    assert G.near_duplicates(spark.createDataFrame([], DOC)).collect() == []
    with pytest.raises(ValueError):
        G.near_duplicates(spark.createDataFrame([], DOC), max_bits=5)


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 400)] + [(7, 7), (9, 8), (8, 9)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = brute.components({x for p in links for x in p} - {7}, [p for p in links if p[0] != p[1]])
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []
