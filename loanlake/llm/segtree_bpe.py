"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A pretoken of n bytes starts as n one-byte tokens. Leaf i of the segment tree holds the merge rank
of the live token at byte i with its right neighbour (no merge: infinite), and inner nodes the
leftmost minimum. The root names the next merge; after it the left token grows, the right one
dies, and three leaves (the merged one, its left neighbour, the dead one) are updated in
logarithmic time, until the root is infinite.

Pretokens of up to 64 bytes of a batch are merged side by side: their trees are rows of one array
and each step does the next merge of every row. Longer ones use the same tree one at a time, so a
run of n bytes costs n log n. A pretoken that is a token itself is that token, as in tiktoken.
"""

from __future__ import annotations

import base64
import functools
import struct
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake.llm.common import byte_column

NEVER = np.int64(1) << np.int64(62)
POSITION_BITS = 32
LONGEST_ROW = 64
CACHE_ENTRIES = 400_000
SLICE_BYTES = 128 << 10  # few enough distinct words for the processor's caches

#: A space inside a run of white space: splitting there could move a token border.
_INNER_SPACE = regex.compile(r"\s (?:\s|$)")
LINE_MARK = "\x00"


class Vocabulary:
    """Ranks of byte strings, read from a tiktoken file."""

    def __init__(self, path: str):
        self.path = path
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = {r: t for t, r in self.rank.items()}
        self.single = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int64)
        # every pair of tokens whose bytes together are a token: sorted keys and the merged ranks
        pairs = {}
        for token, r in self.rank.items():
            for cut in range(1, len(token)):
                a, b = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 24 | b] = r
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.pairs = pairs
        self.pair_keys = keys
        self.pair_ranks = np.array([pairs[k] for k in keys.tolist()], dtype=np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, NEVER where it is no token."""
        want = a << 24 | b
        at = np.minimum(np.searchsorted(self.pair_keys, want), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == want, self.pair_ranks[at], NEVER)


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_one(vocab: Vocabulary, word: bytes) -> list[int]:
    """Ids of one pretoken, whatever its length."""
    n = len(word)
    size = 1 << max(1, (n - 1).bit_length())
    token = [int(vocab.single[b]) for b in word]
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    pairs, never = vocab.pairs, (int(NEVER), 0)
    tree = [never] * (2 * size)
    for i in range(n - 1):
        r = pairs.get(token[i] << 24 | token[i + 1])
        if r is not None:
            tree[size + i] = (r, i)
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, value: tuple[int, int]) -> None:
        node = size + i
        tree[node] = value
        node >>= 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            best = a if a <= b else b
            if tree[node] == best:
                break
            tree[node] = best
            node >>= 1

    def pair_at(i: int) -> tuple[int, int]:
        j = right[i]
        r = pairs.get(token[i] << 24 | token[j]) if j < n else None
        return never if r is None else (r, i)

    while tree[1][0] < NEVER:
        rank, i = tree[1]
        j = right[i]
        token[i] = rank
        right[i] = right[j]
        if right[j] < n:
            left[right[j]] = i
        put(j, never)
        put(i, pair_at(i))
        if left[i] >= 0:
            put(left[i], pair_at(left[i]))
    out, i = [], 0
    while i < n:
        out.append(token[i])
        i = right[i]
    return out


def merge_rows(vocab: Vocabulary, words: list[bytes], size: int) -> list[list[int]]:
    """Ids of pretokens of 2 to ``size`` bytes, ``size`` a power of two: one tree a row."""
    m = len(words)
    lens = np.fromiter(map(len, words), dtype=np.int64, count=m)
    raw = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), dtype=np.uint8).reshape(m, size)
    token = vocab.single[raw]
    where = np.arange(size)
    right = np.broadcast_to(where + 1, (m, size)).copy()
    left = np.broadcast_to(where - 1, (m, size)).copy()
    alive = where < lens[:, None]
    tree = np.full((m, 2 * size), NEVER, dtype=np.int64)
    rank = vocab.merged(token[:, :-1], token[:, 1:])
    rank = np.where(where[1:] < lens[:, None], rank, NEVER)
    tree[:, size:2 * size - 1] = np.where(rank < NEVER, rank << POSITION_BITS | where[:-1], NEVER)
    for node in range(size - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

    def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        node = at + size
        tree[rows, node] = value
        for _ in range(size.bit_length() - 1):
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def pairs_at(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        nxt = right[rows, at]
        inside = nxt < lens[rows]
        r = vocab.merged(token[rows, at], token[rows, np.where(inside, nxt, 0)])
        return np.where(inside & (r < NEVER), r << POSITION_BITS | at, NEVER)

    rows = np.flatnonzero(tree[:, 1] < NEVER)
    while len(rows):
        top = tree[rows, 1]
        i = top & ((1 << POSITION_BITS) - 1)
        j = right[rows, i]
        token[rows, i] = top >> POSITION_BITS
        after = right[rows, j]
        right[rows, i] = after
        inside = after < lens[rows]
        left[rows[inside], after[inside]] = i[inside]
        alive[rows, j] = False
        put(rows, j, np.full(len(rows), NEVER))
        put(rows, i, pairs_at(rows, i))
        before = left[rows, i]
        has = before >= 0
        put(rows[has], before[has], pairs_at(rows[has], before[has]))
        rows = rows[tree[rows, 1] < NEVER]
    counts = alive.sum(axis=1)
    flat = token[alive]
    ends = np.cumsum(counts)
    return [flat[a:b].tolist() for a, b in zip((ends - counts).tolist(), ends.tolist())]


def encode_pretokens(vocab: Vocabulary, words: list[bytes]) -> list[list[int]]:
    out: list[list[int] | None] = [None] * len(words)
    by_size: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        whole = vocab.rank.get(w)
        if whole is not None:
            out[i] = [whole]
        elif not w:
            out[i] = []
        elif len(w) <= LONGEST_ROW:
            by_size.setdefault(1 << (len(w) - 1).bit_length(), []).append(i)
        else:
            out[i] = merge_one(vocab, w)
    for size, rows in by_size.items():
        for at in range(0, len(rows), 8192):
            part = rows[at:at + 8192]
            for i, ids in zip(part, merge_rows(vocab, [words[i] for i in part], size)):
                out[i] = ids
    return out


def _single_breaks(text: str) -> bool:
    """Every line break stands between two characters that are no white space."""
    return all(line and not line[0].isspace() and not line[-1].isspace() for line in text.split("\n"))


class PieceCache:
    """Ids of whole texts from ids of their pieces; pieces that recur are encoded once.

    A text is cut before each space and each single line break, where no token of the pattern can
    cross, unless a space stands inside a run of white space or ``uncut`` says so: then it is encoded
    whole. A key is what follows the space, or ``LINE_MARK`` and what starts with the line break.
    ``encode`` maps a list of strings to packed ids, ``encode_keys`` a list of keys. The cache is emptied
    when it is full, so memory stays bounded.
    """

    def __init__(self, encode, uncut=lambda text: False, encode_keys=None, entries: int = CACHE_ENTRIES):
        self.encode, self.uncut, self.entries = encode, uncut, entries
        self.encode_keys = encode_keys or (
            lambda keys: encode([k[1:] if k[:1] == LINE_MARK else " " + k for k in keys]))
        self.closing = dict(zip(".,", encode([".", ","])))
        self.clear()

    def clear(self) -> None:
        """Keys are numbered; number n has ``length[n]`` ids from ``start[n]`` on in ``ids``."""
        self.number: dict[str, int] = {}
        self.start, self.length = np.zeros(1 << 10, dtype=np.int64), np.zeros(1 << 10, dtype=np.int64)
        self.ids, self.used = np.zeros(1 << 12, dtype="<u4"), 0

    def _put(self, keys: list[str], packed: list[bytes]) -> None:
        ids = np.frombuffer(b"".join(packed), dtype="<u4")
        length = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
        first, last = len(self.number), len(self.number) + len(keys)
        if last > len(self.start):
            self.start, self.length = (np.append(x, np.zeros(last, dtype=np.int64)) for x in (self.start, self.length))
        if self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros(self.used + len(ids), dtype="<u4"))
        self.start[first:last] = self.used + np.cumsum(length) - length
        self.length[first:last] = length
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.number.update(zip(keys, range(first, last)))

    def _learn(self, words: set[str]) -> None:
        """Number new words. A letter and a closing "." or "," never share a token, so "word," takes the ids
        of "word" and of ","."""
        ended = [w for w in words if w[-1:] in self.closing and w[-2:-1].isalpha()]
        new = words.difference(ended)
        new.update(w[:-1] for w in ended if w[:-1] not in self.number)
        if new:
            keys = list(new)
            self._put(keys, self.encode_keys(keys))
        if ended:
            stems = [self.number[w[:-1]] for w in ended]
            self._put(ended, [self.ids[self.start[n]:self.start[n] + self.length[n]].tobytes() + self.closing[w[-1]]
                              for w, n in zip(ended, stems)])

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text: its words' numbers are looked up and their ids gathered in one array."""
        if len(self.number) > self.entries:
            self.clear()
        heads: list[str] = []
        words: list[str] = []
        sizes = np.zeros(len(texts) + 1, dtype=np.int64)
        for i, t in enumerate(texts):
            if "  " in t or LINE_MARK in t or self.uncut(t) or _INNER_SPACE.search(t):
                heads.append(t)
            else:
                if "\n" in t and _single_breaks(t):
                    t = t.replace("\n", " " + LINE_MARK + "\n")
                cut = t.split(" ")
                heads.append(cut[0])
                words += cut[1:]
                sizes[i + 1] = len(cut) - 1
        at = np.fromiter(map(self.number.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missed = np.flatnonzero(at < 0).tolist()
        if missed:
            self._learn({words[i] for i in missed})
            at[missed] = [self.number[words[i]] for i in missed]
        n = self.length[at]
        ends = np.cumsum(n)
        source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[at] - ends + n, n)
        gathered = self.ids[source]
        bounds = np.append(0, ends)[np.cumsum(sizes)].tolist()
        return [head + gathered[a:b].tobytes()
                for head, a, b in zip(self.encode(heads), bounds, bounds[1:])]


class Encoder:
    """The segment-tree encoder for lists of strings: packed ids, four little-endian bytes each."""

    def __init__(self, vocab: Vocabulary, pattern: str):
        self.vocab, self.pattern = vocab, regex.compile(pattern)

    def __call__(self, texts: list[str]) -> list[bytes]:
        words = [self.pattern.findall(t) for t in texts]
        distinct = list({w for ws in words for w in ws})
        ids = encode_pretokens(self.vocab, [w.encode() for w in distinct])
        packed = {w: struct.pack(f"<{len(i)}I", *i) for w, i in zip(distinct, ids)}
        return [packed[ws[0]] if len(ws) == 1 else b"".join([packed[w] for w in ws]) for ws in words]


@functools.lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> PieceCache:
    return PieceCache(Encoder(vocabulary(path), pattern))


def slices(values: list, limit: int = SLICE_BYTES) -> Iterator[slice]:
    """Consecutive slices of about ``limit`` bytes."""
    start = held = 0
    for i, v in enumerate(values):
        held += len(v)
        if held >= limit:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(values):
        yield slice(start, len(values))


def _encode_batches(batches: Iterator[pa.RecordBatch], text: str, path: str, pattern: str):
    encode = encoder(path, pattern)
    for batch in batches:
        raw = byte_column(batch, text)
        rest = batch.drop_columns([text])
        for part in slices(raw):
            ids = encode([t.decode("utf-8", "replace") for t in raw[part]])
            yield pa.RecordBatch.from_arrays(
                [*rest.slice(part.start, part.stop - part.start).columns, pa.array(ids, pa.binary())],
                names=[*rest.schema.names, "ids"])


def _decode_batches(batches: Iterator[pa.RecordBatch], ids: str, path: str, keep: list[str]):
    vocab = vocabulary(path)
    for batch in batches:
        raw = byte_column(batch, ids)
        kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
        for part in slices(raw):
            get = vocab.bytes_of.__getitem__
            texts = [b"".join(map(get, np.frombuffer(r, dtype="<u4").tolist())) for r in raw[part]]
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(part.start, part.stop - part.start) for c in kept), pa.array(texts, pa.binary())],
                names=[*keep, "decoded"])


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but the text) and ``ids``: the text's token ids as binary, four
    little-endian bytes each (``unpack`` makes an array).

    Null or empty text: empty ids. Bytes that are no UTF-8 count as U+FFFD. ``path`` is a tiktoken
    rank file that every executor can open. Each match of ``pattern`` is encoded by itself; there are
    no special tokens. Empty input: empty result. A kept column must not be called ``ids``.
    """
    keep = [c for c in docs.columns if c not in (text, "ids")] if keep is None else keep
    out = T.StructType([docs.schema[c] for c in keep] + [T.StructField("ids", T.BinaryType())])
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text")).mapInArrow(
        functools.partial(_encode_batches, text="__text", path=path, pattern=pattern), out)


def decode(tokens: DataFrame, path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) and ``decoded``: the bytes of the ids. Null ids: empty."""
    keep = [c for c in tokens.columns if c != "decoded"] if keep is None else keep
    out = T.StructType([tokens.schema[c] for c in keep] + [T.StructField("decoded", T.BinaryType())])
    cols = list(dict.fromkeys([*keep, ids]))
    return tokens.select(*cols).mapInArrow(
        functools.partial(_decode_batches, ids=ids, path=path, keep=keep), out)


def unpack(ids: str = "ids"):
    """Array of longs of a packed id column."""
    n = F.octet_length(ids) / 4
    hexed = F.hex(F.col(ids))

    def one(i):
        at = i * 8
        parts = [F.substring(hexed, at + k, F.lit(2)) for k in (7, 5, 3, 1)]
        return F.conv(F.concat(*parts), 16, 10).cast("long")

    return F.when(F.col(ids).isNull() | (n == 0), F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), one))
