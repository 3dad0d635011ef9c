"""Line dedup by a log-template tree.

A line's tokens are its words; tokens with a digit, ``://`` or ``@`` are variable fields (``<*>``). The tree
has a fixed depth: number of tokens, then the first ``LEAD`` tokens. A leaf keeps templates. Each is founded by a
line, and a line joins a template if it agrees with the founder, field by field, in at least 0.8 of its positions:
lines of n tokens may differ in at most n // 5 positions, wherever these are, so that lines of fewer than five words
have to be equal. Lines come in the order of their 64-bit names; one that joins no template of its leaf founds one,
others join the one whose founder has the smallest name. So lines are compared with templates, not with one
another, and none is further from its template than stated. Positions in which a line of the template differs from
its founder are variable fields too (``templates`` lists them).

Variable fields stand for each other only in lines whose tokens are constant to ``MIN_CONSTANT``
or more; other lines, such as rows of numbers, recur by equality of their words as they are. Templates that occur in
two or more documents are dropped, but for their first occurrence (smallest id, then smallest row key, then smallest
line number).

At scale: equal lines are one row before any comparison, and only lines that share their leaf with
another one get a signature, a hash per token, from one row that holds them. A leaf of at most ``BLOCK`` distinct lines
is one group of a task. Larger leaves take rounds: their lines meet by the leaf itself, in pairs of blocks, or, where
a leaf has more blocks than n // 5 + 1, by that many groups of positions, of which one is free of differences. In
a round each undecided line asks for founders and for undecided lines before it; it joins, waits or founds. As names
are hashes, the rounds grow with the logarithm of the leaf. A template's documents are counted by minimum
and maximum, which combine before the shuffle.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake.llm.common import byte_column, group_bounds, shared_key_blocks, sorted_groups, stored
from loanlake.llm.segtree_bpe import slices

MIN_TOKENS = 1  # every line with a word; below five words lines are one template if equal
LEAD = 3
MIN_CONSTANT = 0.5
BLOCK = 1024
MAX_CELLS = 1 << 22  # compared at a time
FIELD = b"<*>"
_VARIABLE = re.compile(rb"[0-9@]|://")
NO_ID = np.iinfo(np.int64).max


def fields(line: bytes) -> tuple[list[bytes], bool]:
    """A line's tokens and whether it may be one template with other lines."""
    tokens = line.split()
    if not _VARIABLE.search(line):
        return tokens, True
    masked = [FIELD if _VARIABLE.search(t) else t for t in tokens]
    if len(tokens) - masked.count(FIELD) < MIN_CONSTANT * len(tokens):
        return tokens, False
    return masked, True


def masked_tokens(line: bytes) -> list[bytes]:
    return fields(line)[0]


def line_name(tokens: list[bytes]) -> int:
    """Signed 64-bit name of a masked line."""
    h = xxhash.xxh64_intdigest(b" ".join(tokens))
    return h - (1 << 64) if h >> 63 else h


def leaf_name(tokens: list[bytes]) -> int:
    """Signed 64-bit name of the leaf: number of tokens and the first ones."""
    h = xxhash.xxh64_intdigest(b"%d " % len(tokens) + b" ".join(tokens[:LEAD]))
    return h - (1 << 64) if h >> 63 else h


def signature(tokens: list[bytes]) -> bytes:
    """A 32-bit hash per token."""
    return np.array([xxhash.xxh32_intdigest(t) for t in tokens], dtype=np.uint32).tobytes()


def _lines(batches: Iterator[pa.RecordBatch], min_tokens: int):
    for batch in batches:
        ids, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = byte_column(batch, "text")
        for part in slices(texts, 4 << 20):
            doc, row, pos, name, leaf, n = [], [], [], [], [], []
            for i in range(part.start, part.stop):
                for p, line in enumerate(texts[i].split(b"\n")):
                    tokens, template = fields(line)
                    if len(tokens) >= min_tokens:
                        doc.append(ids[i])
                        row.append(rows[i])
                        pos.append(p)
                        name.append(line_name(tokens))
                        leaf.append(leaf_name(tokens))
                        n.append(len(tokens) if template else 0)
            if doc:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(row, pa.int64()), pa.array(pos, pa.int32()),
                     pa.array(name, pa.int64()), pa.array(leaf, pa.int64()), pa.array(n, pa.int32())],
                    names=["id", "row", "pos", "line", "leaf", "n"])


def _wanted(batches: Iterator[pa.RecordBatch]):
    """(text, want: [(pos, line, leaf, crowd)]) -> the signatures of these lines of the text."""
    for batch in batches:
        texts, wants = byte_column(batch, "text"), batch.column(batch.schema.get_field_index("want")).to_pylist()
        for part in slices(texts, 4 << 20):
            out = []
            for text, want in zip(texts[part.start:part.stop], wants[part.start:part.stop]):
                lines = text.split(b"\n")
                out += [(w["line"], w["leaf"], w["crowd"], signature(masked_tokens(lines[w["pos"]]))) for w in want]
            if out:
                line, leaf, crowd, sig = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(line, pa.int64()), pa.array(leaf, pa.int64()), pa.array(crowd, pa.int64()),
                     pa.array(sig, pa.binary())], names=["line", "leaf", "crowd", "sig"])


def position_keys(leaf: int, sig: bytes) -> list[int]:
    """Hashes of the n // 5 + 1 groups of the positions after the leading ones: two lines of a leaf that
    differ in at most n // 5 positions share one."""
    tokens = np.frombuffer(sig, dtype=np.uint32)
    groups = len(tokens) // 5 + 1
    return [xxhash.xxh64_intdigest(tokens[LEAD + g::groups].tobytes(), (leaf + g) & (1 << 64) - 1) for g in range(groups)]


def _meeting_keys(batches: Iterator[pa.RecordBatch], block: int):
    """(line, leaf, crowd, sig) -> the line under its leaf or, if that has more blocks, its position groups."""
    for batch in batches:
        line, key = [], []
        for name, leaf, crowd, sig in zip(*(c.to_pylist() for c in batch.columns)):
            keys = [leaf & (1 << 64) - 1] if -(-crowd // block) <= len(sig) // 20 + 1 else position_keys(leaf, sig)
            line += [name] * len(keys)
            key += keys
        if line:
            yield pa.RecordBatch.from_arrays([pa.array(line, pa.int64()), pa.array(np.array(key, dtype=np.uint64).view(np.int64))],
                                             names=["line", "key"])


def same_template(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairwise over rows of two signature arrays of n tokens: at most n // 5 positions differ."""
    n = a.shape[1]
    out = np.zeros((len(a), len(b)), dtype=np.int32)
    step = max(1, MAX_CELLS // max(1, len(a) * len(b)))
    for at in range(0, n, step):
        if step == 1:
            out += a[:, None, at] != b[None, :, at]
        else:
            out += (a[:, None, at:at + step] != b[None, :, at:at + step]).sum(axis=2, dtype=np.int32)
    return out <= n // 5


def _by_length(t: pa.Table, start: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, signatures) of a group: one pair, but for equal hashes of two leaves."""
    sigs = t.column("sig").slice(start, end - start).to_pylist()
    lengths = np.array([len(x) for x in sigs])
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        yield start + at, np.frombuffer(b"".join(sigs[i] for i in at), dtype=np.uint32).reshape(len(at), -1)


def _pairs_out(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["line", "template"])


def _found(batches: Iterator[pa.RecordBatch]):
    """Whole leaves, lines in order -> (line, template)."""
    for t in sorted_groups(batches, ["leaf"]):
        bounds = group_bounds(t, ["leaf"])
        line, out, of = t.column("line").to_numpy(), [], []
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            for rows, sig in _by_length(t, start, end):
                near = same_template(sig, sig)
                template = np.full(len(rows), -1)
                for i in range(len(rows)):  # in the order of names
                    if template[i] < 0:
                        template[np.flatnonzero(near[i] & (template < 0))] = i
                out += line[rows].tolist()
                of += line[rows[template]].tolist()
        if out:
            yield _pairs_out(out, of)


UNDECIDED, FOUNDER, MEMBER = 0, 1, 2


def _meetings(batches: Iterator[pa.RecordBatch]):
    """(table, rows, signatures, sides) of each pair of blocks: a side is (rows that ask, rows that answer), by
    their numbers among ``rows``."""
    for t in sorted_groups(batches, ["key", "lo", "hi"]):
        bounds = group_bounds(t, ["key", "lo", "hi"])
        own, lo, hi = (t.column(c).to_numpy() for c in ("own_block", "lo", "hi"))
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            for rows, sig in _by_length(t, start, end):
                every = np.arange(len(rows))
                if lo[start] == hi[start]:
                    yield t, rows, sig, [(every, every)]
                else:
                    left, right = every[own[rows] == lo[start]], every[own[rows] == hi[start]]
                    yield t, rows, sig, [(left, right), (right, left)]


def _vote(batches: Iterator[pa.RecordBatch]):
    """Of each undecided line: is there a founder, is there an undecided line among those before it that it agrees
    with?"""
    for t, rows, sig, sides in _meetings(batches):
        line, status = t.column("line").to_numpy()[rows], t.column("status").to_numpy()[rows]
        out, founder, waiting = [], [], []
        for ask, answer in sides:
            ask, answer = ask[status[ask] == UNDECIDED], answer[status[answer] != MEMBER]
            if len(ask) and len(answer):
                near = same_template(sig[ask], sig[answer]) & (line[answer][None, :] < line[ask][:, None])
                out.append(line[ask])
                founder.append((near & (status[answer] == FOUNDER)).any(axis=1))
                waiting.append((near & (status[answer] == UNDECIDED)).any(axis=1))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out, founder, waiting)],
                                             names=["line", "founder", "waiting"])


def _join_founders(batches: Iterator[pa.RecordBatch]):
    """(line, template) of the members: the smallest founder before them in this pair of blocks."""
    last = np.iinfo(np.int64).max
    for t, rows, sig, sides in _meetings(batches):
        line, status = t.column("line").to_numpy()[rows], t.column("status").to_numpy()[rows]
        for ask, answer in sides:
            ask, answer = ask[status[ask] == MEMBER], answer[status[answer] == FOUNDER]
            if len(ask) and len(answer):
                near = same_template(sig[ask], sig[answer]) & (line[answer][None, :] < line[ask][:, None])
                least = np.where(near, line[answer][None, :], last).min(axis=1)
                has = near.any(axis=1)
                if has.any():
                    yield _pairs_out(line[ask][has], least[has])


def _in_rounds(signed: DataFrame, block: int) -> DataFrame:
    """(line, template) of leaves that no task holds whole."""
    keyed = signed.select("line", "leaf", "crowd", "sig").mapInArrow(
        functools.partial(_meeting_keys, block=block), "line long, key long")
    met = stored(shared_key_blocks(keyed, "line", block, drop_lonely=True), "template-meetings")
    state = signed.select("line", "sig", F.lit(UNDECIDED).alias("status"))

    def asked(rows: DataFrame, answer, schema: str) -> DataFrame:
        return (met.join(rows, "line").repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
                .mapInArrow(answer, schema))

    while True:
        votes = asked(state.where(F.col("status") != MEMBER), _vote, "line long, founder boolean, waiting boolean")
        heard = votes.groupBy("line").agg(F.bool_or("founder").alias("founder"), F.bool_or("waiting").alias("waiting"))
        status = (F.when(F.col("status") != UNDECIDED, F.col("status")).when(F.col("founder"), F.lit(MEMBER))
                  .when(F.col("waiting"), F.lit(UNDECIDED)).otherwise(F.lit(FOUNDER)))
        state = stored(state.join(heard, "line", "left").select("line", "sig", status.alias("status")), "template-state")
        if state.where(F.col("status") == UNDECIDED).isEmpty():
            break
    joined = asked(state, _join_founders, "line long, template long").groupBy("line").agg(F.min("template").alias("template"))
    return joined.union(state.where(F.col("status") == FOUNDER).select("line", F.col("line").alias("template")))


def _template_of(signed: DataFrame, block: int) -> DataFrame:
    """(line, template) of all lines with a signature."""
    small = (signed.where(F.col("crowd") <= block).select("line", "leaf", "sig").repartition("leaf")
             .sortWithinPartitions("leaf", "line").mapInArrow(_found, "line long, template long"))
    large = signed.where(F.col("crowd") > block)
    return small if large.isEmpty() else small.union(_in_rounds(large, block))


def recurring_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_tokens: int = MIN_TOKENS,
                    block: int = BLOCK) -> DataFrame:
    """(id, row, pos, line) of every line to drop: its template occurs in two or more documents and this is
    not its first occurrence. Rows that share an id are one document; a row without an id (null) is one by
    itself, comes last and has the largest long as id. ``row`` is the hash of the text or, without an id, a number."""
    return _recurring(_keyed(docs, doc_id, text), text, min_tokens, block)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with ``__id`` and ``__row``. Rows of one id and text lose the same lines, so they share a key; rows
    without an id are stored with a number each, since equal ones are several documents."""
    own = F.col(f"`{doc_id}`").cast("long")
    named = docs.where(own.isNotNull()).select("*", own.alias("__id"), F.xxhash64(F.col(f"`{text}`")).alias("__row"))
    nameless = docs.where(own.isNull()).select("*", F.lit(NO_ID).alias("__id"), F.monotonically_increasing_id().alias("__row"))
    return named.union(stored(nameless, "rows-without-id"))


def templates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_tokens: int = MIN_TOKENS,
              block: int = BLOCK) -> DataFrame:
    """The kept templates of two or more different lines: ``template`` (the founder's name), ``n_lines`` (different
    lines), ``pattern`` (the founder with ``<*>`` in every field that varies) and ``variable`` (their numbers)."""
    _, named, signed = _named_lines(_keyed(docs, doc_id, text), text, min_tokens, block)
    members = named.select("line", "template").join(signed.select("line", "sig"), "line")
    founders = members.where("line = template").select("template", F.col("sig").alias("founder"))
    varying = members.join(founders, "template").mapInArrow(_differences, "template long, position int").groupBy(
        "template").agg(F.sort_array(F.collect_set("position")).alias("variable"))  # as many as the line has fields
    kept = members.groupBy("template").agg(F.count(F.lit(1)).alias("n_lines")).where("n_lines > 1").join(varying, "template")
    first = kept.join(named.where("line = template").select("template", "at"), "template")
    rows = _keyed(docs, doc_id, text).select(F.col("__id").alias("id"), F.col("__row").alias("row"), F.col(f"`{text}`").alias("text"))
    one = rows.join(first.select(F.col("at.id").alias("id"), F.col("at.row").alias("row")).distinct(), ["id", "row"], "left_semi")
    shown = one.dropDuplicates(["id", "row"]).join(
        first.select(F.col("at.id").alias("id"), F.col("at.row").alias("row"), F.col("at.pos").alias("pos"), "template", "n_lines", "variable"),
        ["id", "row"])
    return shown.select("template", "n_lines", "variable", "pos", "text").mapInArrow(
        _patterns, "template long, n_lines long, variable array<int>, pattern string")


def _differences(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        of, at = [], []
        for template, sig, founder in zip(get["template"].to_pylist(), get["sig"].to_pylist(), get["founder"].to_pylist()):
            where = np.flatnonzero(np.frombuffer(sig, np.uint32) != np.frombuffer(founder, np.uint32))
            of += [template] * len(where)
            at += where.tolist()
        yield pa.RecordBatch.from_arrays([pa.array(of, pa.int64()), pa.array(at, pa.int32())], names=["template", "position"])


def _patterns(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        rows = batch.select(["template", "n_lines", "variable", "pos"]).to_pylist()
        patterns = []
        for row, text in zip(rows, byte_column(batch, "text")):
            tokens = masked_tokens(text.split(b"\n")[row["pos"]])
            for p in row["variable"]:
                tokens[p] = FIELD
            patterns.append(b" ".join(tokens).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([*batch.select(["template", "n_lines", "variable"]).columns, pa.array(patterns)],
                                         names=["template", "n_lines", "variable", "pattern"])


def _document(at: str = ""):
    own = F.when(F.col(f"{at}id") == NO_ID, F.col(f"{at}row")).otherwise(F.lit(0).cast("long"))
    return F.struct(F.col(f"{at}id").alias("id"), own.alias("own"))


def _named_lines(keyed: DataFrame, text: str, min_tokens: int, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All lines; each different line with its template, first occurrence and last document; the signatures."""
    rows = keyed.select(F.col("__id").alias("id"), F.col("__row").alias("row"), F.col(f"`{text}`").alias("text"))

    lines = stored(rows.mapInArrow(functools.partial(_lines, min_tokens=min_tokens),
                                   "id long, row long, pos int, line long, leaf long, n int"), "lines")
    distinct = stored(lines.groupBy("line").agg(F.min(F.struct("id", "row", "pos")).alias("at"), F.max(_document()).alias("last"),
                                                F.min("leaf").alias("leaf"), F.min("n").alias("n")), "distinct-lines")
    # shorter lines differ in no position; rows of variable tokens have n = 0
    crowded = (distinct.where("n >= 5").groupBy("leaf").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1"))
    want = (distinct.where("n >= 5").join(crowded, "leaf").groupBy("at.id", "at.row")
            .agg(F.collect_list(F.struct("at.pos", "line", "leaf", "crowd")).alias("want")))
    signed = rows.join(want, ["id", "row"]).select("text", "want").mapInArrow(
        _wanted, "line long, leaf long, crowd long, sig binary")
    # equal rows give a line several times
    signed = stored(signed.groupBy("line").agg(F.min("leaf").alias("leaf"), F.min("crowd").alias("crowd"),
                                               F.min("sig").alias("sig")), "signatures")
    parts = _template_of(signed, block)
    named = distinct.join(parts, "line", "left").select(
        "line", F.coalesce("template", "line").alias("template"), "at", "last")
    return lines, named, signed


def _recurring(keyed: DataFrame, text: str, min_tokens: int, block: int) -> DataFrame:
    lines, named, _ = _named_lines(keyed, text, min_tokens, block)
    recurring = (named.groupBy("template").agg(F.min("at").alias("at"), F.max("last").alias("last"))
                 .where(_document("at.") < F.col("last")).select("template", "at"))
    of_line = named.select("line", "template").join(recurring, "template").select("line", "at")
    return (lines.select("id", "row", "pos", "line").join(of_line, "line")
            .where(F.struct("id", "row", "pos") != F.col("at")).select("id", "row", "pos", "line"))


def _rebuild(batches: Iterator[pa.RecordBatch], text: str):
    for batch in batches:
        raw, marks = byte_column(batch, text), batch.column(batch.schema.get_field_index("__drop")).to_pylist()
        nulls = batch.column(batch.schema.get_field_index(text)).is_null().to_pylist()
        texts, total, dropped = [], [], []
        for t, null, mark in zip(raw, nulls, marks):
            lines = t.split(b"\n") if t else []
            gone = 0
            if mark:
                drop = {(m["pos"], m["line"]) for m in mark}
                places = {p for p, _ in drop}
                keep = [x for p, x in enumerate(lines)
                        if p not in places or (p, line_name(masked_tokens(x))) not in drop]
                gone = len(lines) - len(keep)
                t = b"\n".join(keep)
            texts.append(None if null else t)
            total.append(len(lines))
            dropped.append(gone)
        names = batch.schema.names
        cols = [batch.column(i) for i, n in enumerate(names) if n not in (text, "__drop")]
        yield pa.RecordBatch.from_arrays(
            [*cols, pa.array(texts, pa.binary()), pa.array(total, pa.int64()), pa.array(dropped, pa.int64())],
            names=[*(n for n in names if n not in (text, "__drop")), text, "n_lines", "n_dropped"])


def drop_recurring(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                   min_tokens: int = MIN_TOKENS) -> DataFrame:
    """Every row of ``docs`` with the ``keep`` columns (default: all), its text without recurring lines,
    ``n_lines`` and ``n_dropped``.

    Lines are separated by ``\\n``; those of fewer than ``min_tokens`` words stay, by default
    blank lines only. A text that loses all lines
    is empty; null stays null, and both have 0 lines. A line that recurs only inside one document
    stays. Columns called ``n_lines`` or ``n_dropped`` are replaced. Empty input: empty result.
    """
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")] if keep is None else keep
    keep = [c for c in keep if c != text]
    keyed = _keyed(docs, doc_id, text)
    gone = _recurring(keyed, text, min_tokens, BLOCK)
    per_doc = gone.groupBy(F.col("id").alias("__id"), F.col("row").alias("__row")).agg(
        F.collect_set(F.struct("pos", "line")).alias("__drop"))
    body = keyed.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`"), "__id", "__row")
    joined = body.join(per_doc, ["__id", "__row"], "left").drop("__id", "__row")
    out = T.StructType([docs.schema[c] for c in keep] + [T.StructField(text, T.BinaryType()),
                                                         T.StructField("n_lines", T.LongType()),
                                                         T.StructField("n_dropped", T.LongType())])
    return joined.mapInArrow(functools.partial(_rebuild, text=text), out).withColumn(
        text, F.col(f"`{text}`").cast("string"))
