"""Packing by vector bin packing under limits on tokens, segments and loss-bearing tokens.

Every input partition packs its own examples as they stream by, so there is no shuffle, no hot key
and no group in memory beyond a pool of ``POOL`` rests:

* An example is cut at the capacity: each full piece is a sequence of its own, the rest goes to the
  pool.
* Sequences are filled one at a time. Of the rests that fit, the one whose demand vector (tokens, one
  segment, loss tokens, each by its limit) has the largest dot product with what the sequence has
  left is placed. If none fits and there is room, a rest is cut to fill it.
* Only the last sequence of a partition can stay short.

Sequence ids are the partition's number times 2^33 plus a count, so a recomputed partition gives the
same ids.
"""

from __future__ import annotations

import functools
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.llm.common import byte_column
from loanlake.llm.segtree_bpe import CACHE_ENTRIES, LINE_MARK, PieceCache, slices

POOL = 256
EMIT_PIECES = 2000  # a few megabytes of ids
WORDS_A_CALL = 4096
SPACE = "\u0120"  # how byte-level vocabularies write a space


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 128
    loss: int = 1024


@dataclass
class Example:
    """Token ids (packed, four bytes each) of one example; loss counts from token ``loss_from``."""
    key: object
    ids: bytes
    loss_from: int

    @property
    def tokens(self) -> int:
        return len(self.ids) // 4

    def loss_between(self, start: int, end: int) -> int:
        return max(0, end - max(start, self.loss_from))


class Packer:
    """Packs examples in the order they come; ``out`` gets (example, start, length, sequence,
    offset, loss) of each piece."""

    def __init__(self, limits: Limits, first_sequence: int, pool: int = POOL):
        self.limits, self.next, self.pool_size = limits, first_sequence, pool
        self.waiting: list[tuple[Example, int]] = []  # rests: example and first token
        self.demand = np.zeros((0, 3))
        self.out: list[tuple] = []

    def _longest(self, e: Example, start: int, tokens: int, loss: int) -> int:
        """Most tokens from ``start`` within the given room."""
        free = max(0, e.loss_from - start)  # without loss
        return min(e.tokens - start, tokens, free + loss)

    def add(self, e: Example) -> None:
        start, lim = 0, self.limits
        while True:
            n = self._longest(e, start, lim.tokens, lim.loss)
            if n <= 0 or (start + n == e.tokens and n < lim.tokens):
                break
            self.out.append((e, start, n, self.next, 0, e.loss_between(start, start + n)))
            self.next += 1
            start += n
        if start < e.tokens:
            self.waiting.append((e, start))
        if len(self.waiting) >= self.pool_size:
            self.drain(self.pool_size // 2)

    def drain(self, keep: int = 0) -> None:
        """Fill sequences until at most ``keep`` rests wait."""
        lim = self.limits
        cap = np.array([lim.tokens, lim.segments, lim.loss], dtype=np.float64)
        items = self.waiting
        need = np.array([(e.tokens - s, 1, e.loss_between(s, e.tokens)) for e, s in items],
                        dtype=np.float64).reshape(-1, 3)
        share = need / cap
        left = len(items)
        here = np.ones(left, dtype=bool)
        while left > keep:
            room, offset = cap.copy(), 0
            while left and room[0] > 0 and room[1] > 0:
                fits = here & (need <= room).all(axis=1)
                if fits.any():
                    gain = share @ (room / cap)
                    i = int(np.where(fits, gain, -1.0).argmax())
                    n = int(need[i, 0])
                else:  # cut the rest that fills most of the room
                    free = need[:, 0] - need[:, 2]  # tokens without loss come first
                    can = np.minimum(np.minimum(need[:, 0], room[0]), free + room[2])
                    can = np.where(here, can, 0.0)
                    i = int(can.argmax())
                    n = int(can[i])
                    if n <= 0:
                        break
                e, s = items[i]
                loss = e.loss_between(s, s + n)
                self.out.append((e, s, n, self.next, offset, loss))
                offset += n
                room -= (n, 1, loss)
                if s + n < e.tokens:
                    items[i] = (e, s + n)
                    need[i] = (e.tokens - s - n, 1, e.loss_between(s + n, e.tokens))
                    share[i] = need[i] / cap
                else:
                    here[i] = False
                    left -= 1
            self.next += 1
        self.waiting = [items[i] for i in np.flatnonzero(here)]


def _pack(batches: Iterator[pa.RecordBatch], read: Callable, limits: Limits):
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    packer = Packer(limits, part << 33)
    for batch in batches:
        for examples in read(batch):
            for e in examples:
                packer.add(e)
            if len(packer.out) > EMIT_PIECES:
                yield from _emit(packer)
    packer.drain()
    yield from _emit(packer)


def _emit(packer: Packer):
    out, packer.out = packer.out, []
    if out:
        yield pa.RecordBatch.from_pydict({
            "key": pa.array([p[0].key for p in out], pa.int64()),
            "start": pa.array([p[1] for p in out], pa.int64()),
            "length": pa.array([p[2] for p in out], pa.int64()),
            "ids": pa.array([p[0].ids[4 * p[1]:4 * (p[1] + p[2])] for p in out], pa.binary()),
            "doc_tokens": pa.array([p[0].tokens for p in out], pa.int64()),
            "sequence_id": pa.array([p[3] for p in out], pa.int64()),
            "offset": pa.array([p[4] for p in out], pa.int64()),
            "loss_tokens": pa.array([p[5] for p in out], pa.int64())})


PIECES = ("key long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long, loss_tokens long")


def _read_ids(batch: pa.RecordBatch):
    keys, prompts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
    ids = byte_column(batch, "ids")
    for part in slices(ids, 4 << 20):
        yield [Example(k, i, p or 0) for k, i, p in zip(keys[part], ids[part], prompts[part])]


def pack_examples(examples: DataFrame, key: str, ids: str = "ids", prompt_tokens: str | None = None,
                  limits: Limits = Limits()) -> DataFrame:
    """Pack tokenised examples (``ids``: packed token ids; the first ``prompt_tokens`` of them bear no
    loss) into sequences: a row per piece, see ``PIECES``.

    Null or empty ids: no piece. Null keys are kept as null; repeated rows are packed each. Empty
    input: empty result.
    """
    prompt = F.col(prompt_tokens).cast("int") if prompt_tokens else F.lit(0)
    rows = examples.select(F.col(key).cast("long").alias("key"), F.col(ids).alias("ids"), prompt.alias("prompt"))
    return rows.mapInArrow(functools.partial(_pack, read=_read_ids, limits=limits), PIECES)


@functools.lru_cache(maxsize=2)
def document_tokens(path: str, entries: int = CACHE_ENTRIES) -> PieceCache:
    """Ids of texts by a tokenizer file of the ``tokenizers`` library, without adding special tokens. A
    text that holds a special token's string goes to the tokenizer whole."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    spaced = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
    spaced[[i for t, i in tokenizer.get_vocab().items() if t.startswith(SPACE)]] = True

    def encode(texts: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in (e.ids for e in found)]

    def encode_keys(keys: list[str]) -> list[bytes]:
        """Many keys are one call: they hold no space, so a token that starts with one is the first of
        its key. Before a line break that token is the space alone, which the text does not have."""
        out: list[bytes] = []
        for at in range(0, len(keys), WORDS_A_CALL):
            part = keys[at:at + WORDS_A_CALL]
            joined = " " + " ".join(part).replace(LINE_MARK, "")
            ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            starts = np.flatnonzero(spaced[ids])
            if len(starts) != len(part):  # a key that is white space in part: each by itself
                out += encode([k[1:] if k[:1] == LINE_MARK else " " + k for k in part])
                continue
            data, bounds = ids.tobytes(), (4 * np.append(starts, len(ids))).tolist()
            out += [data[a + 4 * (k[:1] == LINE_MARK):b] for k, a, b in zip(part, bounds, bounds[1:])]
        return out

    return PieceCache(encode, lambda text: any(s in text for s in special), encode_keys, entries)


def _read_texts(batch: pa.RecordBatch, path: str, end_id: int, entries: int = CACHE_ENTRIES):
    tokens, end = document_tokens(path, entries), struct.pack("<I", end_id)
    keys, texts = batch.column(0).to_pylist(), byte_column(batch, "text")
    for part in slices(texts):
        ids = tokens([t.decode("utf-8", "replace") for t in texts[part]])
        yield [Example(k, i + end, 0) for k, i in zip(keys[part], ids)]


def pack_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end_id: int = 0,
                   limits: Limits = Limits(), cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """Tokenise and pack whole documents, every token bearing loss; rows as ``pack_examples``.

    A document is its text's ids and then ``end_id``, so a null or empty text is one token. ``path`` is
    a tokenizers file that every executor can open. A worker keeps ids of at most ``cache_entries`` words
    (some 200 bytes each).
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    read = functools.partial(_read_texts, path=path, end_id=end_id, entries=cache_entries)
    return rows.mapInArrow(functools.partial(_pack, read=read, limits=limits), PIECES)
