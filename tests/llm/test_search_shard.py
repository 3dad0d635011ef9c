"""Multi-index hashing and rendezvous sharding."""

import hashlib
import math

import numpy as np
import pytest

from loanlake.llm import hamming_topk as H, rendezvous as R

CODE = "vec_id long, code long"


def signed(x):
    return int(np.uint64(x).view(np.int64))


@pytest.mark.parametrize("bits,k,segment", [(64, 3, None), (64, 5, 16), (20, 4, 8), (64, 200, None)])
def test_top_k_is_exact(spark, bits, k, segment):
    rng = np.random.default_rng(bits + k)
    base = rng.integers(0, 2 ** bits, 20, dtype=np.uint64)
    codes = []
    for _ in range(120):
        c = int(rng.choice(base))
        for b in rng.choice(bits, rng.integers(0, 9), replace=False):
            c ^= 1 << int(b)
        codes.append(c)
    codes[10:40] = [codes[10]] * 30  # a frequent code
    rows = [(i, signed(c)) for i, c in enumerate(codes)]
    df = spark.createDataFrame(rows + [(500, None), (None, 3), rows[3]], CODE)
    queries = df.where("vec_id % 10 = 0 or vec_id = 500")
    got = sorted(map(tuple, H.top_k(df, queries, k=k, bits=bits, segment_bits=segment).collect()))
    want = []
    for q in range(0, 120, 10):
        near = sorted(((codes[q] ^ c).bit_count(), i) for i, c in enumerate(codes) if i != q)[:k]
        want += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    assert got == sorted(want)


def test_top_k_empty(spark):
    empty = spark.createDataFrame([], CODE)
    one = spark.createDataFrame([(1, 5)], CODE)
    assert H.top_k(empty, empty).collect() == [] and H.top_k(one, one).collect() == []
    assert H.top_k(empty, one).collect() == []


def test_sign_code(spark):
    vec = [1.0 if i % 3 == 0 else -1.0 for i in range(64)]
    df = spark.createDataFrame([(1, vec), (2, None), (3, vec[:5]), (4, [float("nan")] + vec[1:]), (5, [None] + vec[1:])],
                               "vec_id long, embedding array<float>")
    got = {r.vec_id: r.code for r in df.select("vec_id", H.sign_code("embedding").alias("code")).collect()}
    assert got == {1: signed(sum(1 << i for i in range(0, 64, 3))), 2: None, 3: None, 4: None, 5: None}


def test_flips_are_all_words_of_a_weight():
    for n, a in ((8, 0), (8, 3), (11, 5), (5, 5)):
        words = H._flips(n, a).tolist()
        assert len(set(words)) == len(words) == math.comb(n, a) and all(w.bit_count() == a < 9 and w < 1 << n for w in words)


def chosen(key, weights):
    best = []
    for s, w in enumerate(weights):
        if w:
            u = (int(hashlib.md5(f"{key}:{s}".encode()).hexdigest()[:12], 16) + .5) / 16 ** 12
            best.append((-math.log(u) / w, s))
    return min(best)[1]


def test_rendezvous_places_and_numbers(spark):
    rows = [(i % 700, i % 3, None) for i in range(900)] + [(None, 1, "x")] * 40 + [(5, 9, "y")] * 200
    df = spark.createDataFrame(rows, "doc_id long, size int, text string")
    weights = [1.0, 2.0, 0.0, 1.0]
    out = R.shard_records(df, "doc_id", weights, 1.5, ["size"]).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in out) == sorted((a is None, a or 0, b) for a, b, _ in rows)
    slots = {}
    for r in out:
        key = "\\N" if r.doc_id is None else r.doc_id
        assert r.shard == chosen(key, weights) and r.grown_shard == chosen(key, [*weights, 1.5])
        assert r.grown_shard in (r.shard, 4)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and 2 not in slots
    share = {s: sum(chosen(k, weights) == s for k in range(4000)) / 4000 for s in (0, 1, 3)}
    assert abs(share[1] - .5) < .05 and abs(share[0] - .25) < .05


def test_rendezvous_edges(spark):
    empty = spark.createDataFrame([], "doc_id long")
    assert R.shard_records(empty, "doc_id", [1.0]).collect() == []
    assert R.shard_records(spark.range(3).toDF("doc_id"), "doc_id", [1.0]).where("grown_shard is not null").count() == 0
    for bad in ([0.0], [-1.0, 1.0]):
        with pytest.raises(ValueError):
            R.shard_records(empty, "doc_id", bad)
    with pytest.raises(ValueError):
        R.shard_records(spark.range(1).toDF("slot"), "slot", [1.0])
