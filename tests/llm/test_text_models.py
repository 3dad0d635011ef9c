"""Context-tree weighting, line templates and toxicity."""

import math

import numpy as np
import pytest

import brute
from conftest import SMALL
from loanlake.llm import ctw, ftrl, queries, template_lines as L

DOC = "doc_id long, text string"


@pytest.mark.parametrize("depth", [2, 5])
def test_context_tree_matches_its_definition(spark, depth, monkeypatch):
    docs = [(i, t[:160]) for i, t in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").limit(25).collect()]
    docs += [(900, None), (901, ""), (902, "É À\x00ß never seen §"), (903, docs[0][1]), (903, docs[0][1]), (None, "the of and")]
    held = [i is not None and brute.crc_mod(i, 7) == 2 or i == 902 for i, _ in docs]
    df = spark.createDataFrame([(*d, h, 1) for d, h in zip(docs, held)], DOC + ", held boolean, score int").repartition(3)
    out = ctw.score_documents(df, "held", depth=depth).collect()
    tree, counts, ends = brute.ContextTree(depth), {}, 0
    for (_, t), h in zip(docs, held):
        if not h:
            tree.learn((t or "").encode())
            ends += 1
            for w in (t or "").encode().lower().split():
                counts[w] = counts.get(w, 0) + 1
    tree.build()
    n, v = sum(counts.values()) + ends, len(counts) + 1
    want = []
    for (i, t), h in zip(docs, held):
        words = (t or "").encode().lower().split()
        base = sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in words) + math.log10((ends + 1) / (n + v + 1))
        want.append((str(i), h, len(words) + 1, 1 + sum(w in counts for w in words), n, round(base, 6),
                     round(tree.log10((t or "").encode()), 6)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in out]
    assert sorted(got) == sorted(want)


def test_context_tree_in_many_blocks_is_the_same(spark, monkeypatch):
    df = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(6)
    held = ftrl.remainder("doc_id", 7) == 2
    one = {r.doc_id: (r.score, r.base_score) for r in ctw.score_documents(df, held).collect()}
    monkeypatch.setattr(ctw, "BLOCKS_EACH", 2)
    many = {r.doc_id: (r.score, r.base_score) for r in ctw.score_documents(df, held).collect()}
    assert one.keys() == many.keys() and all(np.allclose(one[k], many[k]) for k in one)


def test_context_tree_edges(spark):
    assert ctw.score_documents(spark.createDataFrame([], DOC + ", h boolean"), "h").collect() == []
    none = ctw.score_documents(spark.createDataFrame([(1, "ab", True)], DOC + ", h boolean"), "h").collect()[0]
    assert none.train_tokens == 0 and none.n_known == 0 and math.isclose(none.score, 24 * math.log10(.5))


def test_probabilities_of_the_next_byte_sum_to_one():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.choice(list(b"abc "), 60).tolist()) for _ in range(5)]
    keys, counts = np.unique(ctw.grams(texts, 3), return_counts=True)
    levels = ctw.levels_up(ctw.leaves(keys, counts), 3, 0)
    mixture = ctw.Mixture(levels)
    for context in (b"abc", b"zzz", b"c a"):
        every = np.array([int.from_bytes(context[::-1] + bytes([b]), "big") for b in range(256)], dtype=np.uint64)
        assert math.isclose((10 ** mixture.log10(every, 3)).sum(), 1.0, rel_tol=1e-9)


def template_brute(docs):
    """First occurrences stay; (id, pos) of lines whose template is in several documents. The tree line by line: in
    the order of names a line joins the first founder of its leaf that it agrees with in 0.8 of its positions."""
    lines, different = [], {}
    for i, t in docs:
        for p, line in enumerate((t or "").encode().split(b"\n")):
            tokens, template = L.fields(line)
            if len(tokens) >= L.MIN_TOKENS:
                lines.append((L.NO_ID if i is None else i, p, L.line_name(tokens)))
                different[L.line_name(tokens)] = (tokens, template)
    founders, joined = {}, {}
    for name in sorted(different):
        tokens, template = different[name]
        leaf = founders.setdefault((len(tokens), *tokens[:L.LEAD]), []) if template else []
        joined[name] = next((f for f, other in leaf if 5 * sum(x != y for x, y in zip(tokens, other)) <= len(tokens)), name)
        if joined[name] == name:
            leaf.append((name, tokens))
    groups = {}
    for i, p, name in lines:
        groups.setdefault(joined[name], []).append((i, p))
    return {at for g in groups.values() if len({i for i, _ in g}) > 1 for at in set(g) - {min(g)}}


@pytest.mark.parametrize("block", [1024, 2])
def test_recurring_templates(spark, block):
    base = "a known user {} logged in from the host {} at the door of {} today and left again soon after that"
    docs = [(1, "alone here\n" + base.format("ann", "10.0.0.1", "north")), (2, base.format("bob", "10.0.0.9", "north") + "\nkeep this line of text here"),
            (3, base.format("ann", "10.0.0.1", "south") + "\nPage 3 of 17 of the report\nPage 4 of 17 of the report"),
            (4, "Page 9 of 99 of the report\nshort line\nshort line"), (5, "twice in one document only ok\ntwice in one document only ok"),
            (6, None), (7, ""), (8, "\n\n"), (None, "Page 1 of 2 of the report"), (None, "unique to those without any id"),
            (9, "one two three four five six seven eight nine ten"), (10, "one two three four FIVE SIX SEVEN eight nine ten")]
    df = spark.createDataFrame(docs, DOC)
    got = {(r.id, r.pos) for r in L.recurring_lines(df, block=block).collect()}
    assert got == template_brute(docs)
    assert {(2, 0), (3, 0), (3, 2), (4, 0), (L.NO_ID, 0)} == got and (5, 1) not in got


def test_lines_of_the_test_data(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = [tuple(r) for r in df.select("doc_id", "text").collect()]
    drop = template_brute(docs)
    out = {r.doc_id: r for r in L.drop_recurring(df.withColumn("n_lines", df.doc_id)).collect()}
    for i, t in docs:
        lines = t.split("\n")
        assert out[i].text == "\n".join(x for p, x in enumerate(lines) if (i, p) not in drop)
        assert (out[i].n_lines, out[i].n_dropped) == (len(lines), sum((i, p) in drop for p in range(len(lines))))
    assert out[docs[0][0]].lang is not None
    empty = L.drop_recurring(spark.createDataFrame([], DOC))
    assert empty.collect() == [] and empty.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    nulls = {r.doc_id: (r.text, r.n_lines) for r in L.drop_recurring(spark.createDataFrame([(1, None), (2, "")], DOC)).collect()}
    assert nulls == {1: (None, 0), 2: ("", 0)}


@pytest.mark.parametrize("block", [1024, 2, 1])
def test_lines_agree_in_four_fifths_of_their_positions(spark, block):
    rng, docs = np.random.default_rng(11), []
    for n in (5, 9, 10, 14, 20, 60, 101):
        for base in range(3):
            words = [f"{chr(97 + base)}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(n)]
            for changed in (0, 1, n // 5, n // 5 + 1, n // 5 + 2):
                line = list(words)
                for k in rng.choice(np.arange(L.LEAD, n), min(changed, n - L.LEAD), replace=False):
                    line[k] = "other" + "".join(rng.choice(list("xyz"), 8))
                docs.append((len(docs), " ".join(line)))
    docs += [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("doc_id + 1000", "text").collect()]
    got = {(r.id, r.pos) for r in L.recurring_lines(spark.createDataFrame(docs, DOC), block=block).collect()}
    assert got == template_brute(docs)


@pytest.mark.parametrize("block", [1024, 7])
def test_no_line_is_further_from_its_template_than_stated(spark, block):
    """A chain of lines, each one word from the next: compared with templates, not with one another."""
    words = [f"w{chr(97 + k)}" for k in range(20)]
    chain = []
    for k in range(17):
        line = list(words)
        line[3:3 + k] = [f"x{chr(97 + i)}" for i in range(k)]
        chain.append((k, " ".join(line)))
    docs = chain + [(100, " ".join(words[:3] + ["one", "other", "end"])), (101, "user ann of the north logged in at 10:30"),
                    (102, "user ann of the south logged in at 11:45"), (103, "nothing alike in this line at all here")]
    df = spark.createDataFrame(docs, DOC)
    got = {(r.id, r.pos) for r in L.recurring_lines(df, block=block).collect()}
    assert got == template_brute(docs) and len(got) < 16  # single linkage would leave one line of the chain
    kept = {r.template: r for r in L.templates(df, block=block).collect()}
    named = {L.line_name(L.masked_tokens(t.encode())): t for _, t in docs}
    assert {r.n_lines for r in kept.values()} and set(kept) <= set(named)
    for r in kept.values():
        founder = named[r.template].split()
        want = L.masked_tokens(named[r.template].encode())
        assert r.variable and all(r.pattern.split()[p] == "<*>" for p in r.variable)
        assert all(x == y.decode() for p, (x, y) in enumerate(zip(r.pattern.split(), want)) if p not in r.variable) and len(founder) == len(want)
    assert any("logged in at <*>" in r.pattern and r.pattern.startswith("user ann of the <*>") for r in kept.values())


def test_short_lines_recur_by_equality(spark):
    docs = [(1, "All rights reserved.\nShare this article\n\nonly here"), (2, "Share this\nAll rights reserved.\n\n"),
            (3, "Share this story\nAll rights reserved.\nonce more\nonce more"), (4, "Page 4\nShare this article"), (5, "Page 5")]
    got = {(r.id, r.pos) for r in L.recurring_lines(spark.createDataFrame(docs, DOC)).collect()}
    assert got == {(2, 1), (3, 1), (4, 1), (5, 0)} == template_brute(docs)


def test_rows_of_numbers_recur_only_as_they_are(spark):
    docs = [(1, "12 34 56 78 90\n7 7 7 7 7 7\ntotal 1 2 3 4\n3 of 4 pages"), (2, "1 9 8 7 6\n12 34 56 78 91\ntotal 5 6 7 8\n7 of 9 pages"),
            (3, "7 7 7 7 7 7\n12 34 56 78 90"), (4, "5\n2020-01-01"), (5, "6\n2020-01-01")]
    got = {(r.id, r.pos) for r in L.recurring_lines(spark.createDataFrame(docs, DOC)).collect()}
    assert got == {(2, 3), (3, 0), (3, 1), (5, 1)}


def test_rows_without_id_are_documents_of_their_own(spark):
    line, other = "this very line is in all of these rows", "and that one is in two rows without an id"
    rows = [(None, other), (None, other + "\nfirst"), (None, "same text twice without an id"), (None, "same text twice without an id"),
            (None, line), (5, line + "\nkept"), (5, "x\n" + line), (6, "inside one id only and nowhere else"),
            (6, "y\ninside one id only and nowhere else")] + [(7, line)] * 3
    out = [(r.doc_id, r.text) for r in L.drop_recurring(spark.createDataFrame(rows, DOC).repartition(3)).collect()]
    assert len(out) == len(rows)
    nameless = sorted(text for i, text in out if i is None)
    assert nameless in (sorted([other, "first", "same text twice without an id", "", ""]),
                        sorted(["", other + "\nfirst", "same text twice without an id", "", ""]))
    assert sorted(text for i, text in out if i == 5) in (sorted([line + "\nkept", "x"]), sorted(["kept", "x\n" + line]))
    assert [text for i, text in out if i == 7] == ["", "", ""]
    assert sorted(text for i, text in out if i == 6) == [rows[7][1], rows[8][1]]


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    scored = queries.op8_ftrl_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out and toxic is not null").select("score", "predicted", "toxic").collect()
    positive = [r.score for r in rows if r.toxic == 1]
    negative = [r.score for r in rows if r.toxic == 0]
    auc = np.mean([[p > n for n in negative] for p in positive])
    accuracy = np.mean([r.predicted == r.toxic for r in rows])
    assert auc > 0.95 and accuracy > 0.96
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.005 * len(negative)
    assert scored.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(i, "you utter fool" if i % 2 else "good day to you") for i in range(60)]
                                 + [(100, None), (101, ""), (None, "you utter fool"), (3, "you utter fool"), (102, "x " * 50000)], DOC)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 0), (None, 1), (100, None), (777, 1)], "doc_id long, toxic int")
    weights = ftrl.fit(docs, labels)
    got = {r.doc_id: r for r in ftrl.score(docs.withColumn("score", docs.doc_id), weights).collect()}
    assert got[1].predicted == 1 and got[2].predicted == 0 and got[None].predicted == 1
    assert 0 <= got[100].score <= 1 and got[100].score == got[101].score
    nothing = ftrl.fit(docs, labels.limit(0))
    assert {r.score for r in ftrl.score(docs, nothing).collect()} == {0.5}
    assert ftrl.score(docs.limit(0), weights).collect() == []
    assert ftrl.fit(docs, labels, max_rows=7).count() >= 0


def test_ftrl_step_follows_the_rule():
    model = ftrl.Ftrl(ftrl.Settings(alpha=.5, beta=1, l1=.1, l2=.2))
    z = n = 0.0
    for y in (1, 1, 0, 1):
        w = 0.0 if abs(z) <= .1 else -(z - math.copysign(.1, z)) / ((1 + math.sqrt(n)) / .5 + .2)
        g = 1 / (1 + math.exp(-w)) - y
        s = (math.sqrt(n + g * g) - math.sqrt(n)) / .5
        z, n = z + g - s * w, n + g * g
        model.learn(np.array([7]), np.array([1.0]), y)
        assert math.isclose(model.z[7], z) and math.isclose(model.n[7], n)


def plain_sigmoid(x):
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def plain_ftrl(train, s):
    """FTRL-proximal one coordinate at a time, over dictionaries; ``train`` has (features, label) in order."""
    z, n = {}, {}

    def weight(k):
        if abs(z.get(k, 0.0)) <= s.l1:
            return 0.0
        return -(z[k] - math.copysign(s.l1, z[k])) / ((s.beta + math.sqrt(n[k])) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for found, label in train:
            w = {k: weight(k) for k in found}
            p = plain_sigmoid(sum(w[k] * v for k, v in found.items()))
            for k, v in found.items():
                g, before = (p - label) * v, n.get(k, 0.0)
                z[k] = z.get(k, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / s.alpha * w[k]
                n[k] = before + g * g
    return weight


def plain_features(text):
    """Buckets of words, pairs and skip-grams and their values, a bucket by its first kind."""
    raw = (text or "").encode()
    words = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 127 and b > 32 and not chr(b).isalnum() else b for b in raw).split()
    h = [ftrl.xxhash.xxh64_intdigest(w) for w in words]
    out = {0: 1.0}
    for hashed in h:
        out.setdefault(hashed >> 44, 1.0)
    for (gap, c), value in zip(ftrl._GAPS, (0.5, 0.3, 0.3)):
        for a, b in zip(h, h[gap:]):
            out.setdefault((a * c + b * (c ^ 0xA5A5A5A4)) % 2 ** 64 >> 44, value)
    return out


def test_scores_equal_a_plain_retraining(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").where(ftrl.remainder("doc_id", 5) != 0)
    settings = ftrl.Settings(l1=0.5, epochs=3)  # more weights than by default
    got = {r.doc_id: r.score for r in ftrl.score(docs, ftrl.fit(docs, labels, settings=settings), keep=["doc_id"]).collect()}
    found = {r.doc_id: plain_features(r.text) for r in docs.collect()}
    order = labels.where("toxic IS NOT NULL").selectExpr("xxhash64(doc_id) AS turn", "doc_id", "toxic").distinct().collect()
    train = [(found[r.doc_id], r.toxic) for r in sorted(order) if r.doc_id in found]
    assert len(train) > 50 and {y for _, y in train} == {0, 1}
    weight = plain_ftrl(train, settings)
    assert sum(weight(k) != 0 for k in {k for f, _ in train for k in f}) > 100
    for i, f in found.items():
        assert got[i] == pytest.approx(plain_sigmoid(sum(weight(k) * v for k, v in f.items())), rel=1e-6, abs=1e-9)
