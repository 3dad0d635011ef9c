"""Segment-tree BPE and packing."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from conftest import SMALL
from loanlake.llm import packing as K, segtree_bpe as B

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = ["", " ", "  ", "a  b", "a \n b", " a", "a ", "it's 'll x's", "\n\n a\t b \r\n", "x." * 40, "ab" * 3000, "é世界 ١٢ 　z",
       "don't <|endoftext|> stop", "\x00\x1c a", "word. word, word.", "a.,b ,. ,", "   lead", "trail   "]


def test_ids_equal_the_library(library):
    encode = B.PieceCache(B.Encoder(B.vocabulary(RANKS), P.PATTERN), entries=50)
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("abcé ,.\n\t '1世") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    for part in (texts[:200], texts[200:], texts):
        assert encode(part) == [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in part]


def test_long_and_short_trees_agree(library):
    vocab = B.vocabulary(RANKS)
    rng = random.Random(3)
    for n in (2, 3, 17, 63, 64, 65, 300):
        word = bytes(rng.choice(b"abcdetion") for _ in range(n))
        want = library._encode_single_piece(word)
        assert B.merge_one(vocab, word) == want
        assert B.merge_rows(vocab, [word], 1 << (n - 1).bit_length()) == [want]


def test_encode_decode_round_trip(spark, library):
    rows = [(i, t, "k") for i, t in enumerate(ODD)] + [(99, None, None), (None, "x", "y"), (3, ODD[3], "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = B.encode(df, RANKS, P.PATTERN, keep=["doc_id"]).withColumn("list", B.unpack("ids"))
    back = B.decode(out, RANKS, keep=["doc_id", "list"]).collect()
    got = sorted(((str(r.doc_id), r.list, bytes(r.decoded)) for r in back), key=str)
    want = sorted(((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows), key=str)
    assert got == want
    assert B.encode(df.limit(0), RANKS, P.PATTERN, keep=["doc_id"]).collect() == []


def check_layout(pieces, limits):
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append(p)
    for seq in by.values():
        seq.sort(key=lambda p: p.offset)
        at = 0
        for p in seq:
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= limits.tokens and len(seq) <= limits.segments and sum(p.loss_tokens for p in seq) <= limits.loss
    return by


def test_documents_are_packed_whole(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(9001, None), (9002, ""), (9003, "tiny"), (9004, "a <|endoftext|> b")], "doc_id long, text string")
    path = P.path("byte_bpe_50k.json")
    pieces = K.pack_documents(docs.union(extra), path).collect()
    check_layout(pieces, K.Limits())
    tokenizer = Tokenizer.from_file(path)
    ids = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.union(extra).collect()}
    seen = {}
    for p in sorted(pieces, key=lambda p: (p.key, p.start)):
        assert p.start == seen.get(p.key, 0) and p.doc_tokens == len(ids[p.key])
        want = np.array(ids[p.key][p.start:p.start + p.length], "<u4").tobytes()
        assert bytes(p.ids) == want and zlib.crc32(bytes(p.ids)) == zlib.crc32(want)
        seen[p.key] = p.start + p.length
    assert seen == {k: len(v) for k, v in ids.items()}
    total = sum(seen.values())
    parts = docs.union(extra).rdd.getNumPartitions()
    assert len({p.sequence_id for p in pieces}) * 1024 <= total + 1024 * parts


def test_limits_on_segments_and_loss(spark):
    rng = random.Random(4)
    rows = [(i, np.arange(rng.randint(1, 60), dtype="<u4").tobytes(), rng.randint(0, 30)) for i in range(400)]
    rows += [(500, None, 0), (501, b"", 3), (None, rows[0][1], None), (502, np.arange(900, dtype="<u4").tobytes(), 100)]
    limits = K.Limits(tokens=128, segments=5, loss=60)
    out = K.pack_examples(spark.createDataFrame(rows, "id long, ids binary, prompt int"), "id", prompt_tokens="prompt",
                          limits=limits).collect()
    check_layout(out, limits)
    for key, ids, prompt in rows:
        mine = sorted((p for p in out if p.key == key), key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in mine) == (ids or b"")
        for p in mine:
            assert p.loss_tokens == max(0, p.start + p.length - max(p.start, prompt or 0))
    assert K.pack_examples(spark.createDataFrame([], "id long, ids binary"), "id").collect() == []


def test_dot_product_picks_what_fits_best():
    packer = K.Packer(K.Limits(tokens=100, segments=3, loss=100), 0)
    for key, n in ((1, 60), (2, 50), (3, 40), (4, 30), (5, 20)):
        packer.add(K.Example(key, bytes(4 * n), 0))
    packer.drain()
    by = {}
    for e, start, n, seq, *_ in packer.out:
        by.setdefault(seq, []).append((e.key, n))
    assert by == {0: [(1, 60), (3, 40)], 1: [(2, 50), (4, 30), (5, 20)]}
