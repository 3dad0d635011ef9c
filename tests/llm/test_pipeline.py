"""The pipeline stage by stage against plain versions, and the registered queries' contracts."""

import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import brute
import corpus_pipeline as C
from conftest import SMALL
from loanlake.llm import common, queries
from test_text_models import template_brute


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in C.STAGES:
        result = common.stored(stage(spark, docs, SMALL), f"test-{name}")
        out.append((name, docs, result))
        docs = result
    return out


def as_dict(df):
    return {r.doc_id: r for r in df.collect()}


def test_order_and_columns(spark, stages):
    assert [n for n, *_ in stages] == ["toxicity", "line_dedup", "simhash_dedup", "packing"]
    columns = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    for _, _, out in stages[:-1]:
        assert out.schema == columns


def test_toxicity_stage_keeps_what_the_operator_accepts(spark, stages):
    _, docs, out = stages[0]
    rejected = {r.doc_id for r in queries.op8_ftrl_toxicity(spark, SMALL).where("predicted = 1").collect()}
    before, after = as_dict(docs), as_dict(out)
    assert set(after) == set(before) - rejected and all(after[i] == before[i] for i in after)


def test_line_stage_matches_brute_force(stages):
    _, docs, out = stages[1]
    before, after = as_dict(docs), as_dict(out)
    drop = template_brute([(i, r.text) for i, r in before.items()])
    assert set(after) == set(before) and drop
    for i, r in before.items():
        want = "\n".join(x for p, x in enumerate(r.text.split("\n")) if (i, p) not in drop)
        assert after[i].text == want and after[i].lang == r.lang
        assert after[i].n_chars == (r.n_chars if want == r.text else len(want))


def test_near_duplicate_stage_matches_brute_force(stages):
    _, docs, out = stages[2]
    before = as_dict(docs)
    prints = {i: brute.simhash(r.text, 4) for i, r in before.items()}
    ids = sorted(prints)
    parts = brute.components(ids, [(a, b) for a in ids for b in ids if b < a and (prints[a] ^ prints[b]).bit_count() <= 4])
    assert as_dict(out) == {i: before[i] for i in ids if parts[i] == i}


def test_packing_stage_covers_its_input(stages):
    _, docs, out = stages[3]
    seen = {}
    for p in sorted(out.collect(), key=lambda p: (p.doc_id, p.start)):
        assert p.start == seen.get(p.doc_id, 0)
        seen[p.doc_id] = p.start + p.length
    assert set(seen) == set(as_dict(docs))


def test_run_gives_the_last_stage(spark, stages):
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    a = sorted(map(tuple, C.run(spark, SMALL).groupBy("doc_id", "doc_tokens").agg({"length": "sum"}).collect()))
    b = sorted(map(tuple, stages[3][2].groupBy("doc_id", "doc_tokens").agg({"length": "sum"}).collect()))
    assert a == b and all(n == total for _, n, total in a) and set(key) <= set(stages[3][2].columns)


def test_one_query_per_operator():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))


def test_encoding_query(spark):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = as_dict(spark.read.parquet(f"{SMALL}/documents.parquet"))
    for r in queries.op4_segtree_bpe(spark, SMALL).collect():
        text = docs[r.doc_id].text
        ids = np.array(library.encode_ordinary(text), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_sharding_query(spark):
    docs = as_dict(spark.read.parquet(f"{SMALL}/documents.parquet"))
    out = queries.op5_rendezvous(spark, SMALL).collect()
    assert {r.doc_id for r in out} == set(docs) and {r.law for r in out} == {"key"}
    for r in out:
        data = docs[r.doc_id].text.encode()
        assert (r["size"], r.text_crc32) == (len(data) + 1, zlib.crc32(data)) and r.grown_shard in (r.shard, 8)


def test_scoring_query_beats_unigrams_on_held_out_text(spark):
    out = queries.op6_context_tree(spark, "/root/testdata/sf0.1").where("held_out").agg(
        {"score": "sum", "base_score": "sum", "n_tokens": "sum"}).first()
    assert out["sum(score)"] > out["sum(base_score)"]
    small = queries.op6_context_tree(spark, SMALL).collect()
    assert all(r.held_out == (brute.crc_mod(r.doc_id, 7) == 2) for r in small)
    assert all(r.n_known == r.n_tokens for r in small if not r.held_out)


def test_stages_on_an_empty_table_and_null_ids(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "you are a fine reader of these five or more words today"
    rows = [(None, text, "en", None, 55), (None, text, None, "s", 55), (3, None, None, None, None), (4, "", "en", "s", 0), (5, text, "en", "s", 55)]
    for data in ([], rows):
        docs = spark.createDataFrame(data, schema)
        for name, stage in C.STAGES:
            docs = common.stored(stage(spark, docs, SMALL), f"edge-{name}")
        assert docs.count() >= len(data) - 3
    assert docs.where("doc_id = 5").count() == 1


def test_held_out_of_null_ids_is_false(spark, scratch):
    path = f"{scratch}/t"
    spark.createDataFrame([(None, "some text"), (1, "other text"), (2, None)], "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    for query in (queries.op6_context_tree, queries.op8_ftrl_toxicity):
        assert {r.doc_id: r.held_out for r in query(spark, path).collect()} == {
            None: False, 1: brute.crc_mod(1, 7 if "op6" in query.__name__ else 5) == (2 if "op6" in query.__name__ else 0),
            2: brute.crc_mod(2, 7 if "op6" in query.__name__ else 5) == (2 if "op6" in query.__name__ else 0)}
