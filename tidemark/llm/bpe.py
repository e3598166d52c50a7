"""Byte-level BPE encoding and decoding with length-bucketed, padded numpy matrices.

A text is cut by the vocabulary's pattern. Pieces not met before are put into matrices of similar length, one
row of token ids each, padded at the right. In a round every row merges its leftmost pair of least rank; the
matrices lose one column, rows without a known pair leave. Ranks of pairs come from an open-addressing hash
table in two numpy arrays; a merge looks up only the two pairs it creates. A piece above ``LONG`` bytes would
cost its square there and is merged with a heap instead, in the same order.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bare

LONG = 2048            # bytes of a piece; longer ones take the heap
CELLS = 1 << 20        # cells of a matrix
GROUP_CHARS = 1 << 20  # characters of the texts cut at once
KNOWN = 300_000        # pieces remembered by a worker
NONE = np.int64(1 << 40)
ODD = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """(left id, right id) -> id of their concatenation, by open addressing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        keys = (left << 32) | right
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int64)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while todo.size:
            free = todo[self.keys[slot[todo]] == -1]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], merged[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * ODD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged ids, ``NONE`` where there is none; padding (negative) has none."""
        shape, found = left.shape, np.full(left.size, NONE, np.int64)
        left, right = left.ravel(), right.ravel()
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left[todo] << 32) | right[todo]
        slot = self._slot(keys)
        while todo.size:
            held = self.keys[slot]
            hit = held == keys
            found[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (held != -1)
            todo, keys, slot = todo[on], keys[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return found.reshape(shape)


def parse_ranks(ranks: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(r) for t, r in map(bytes.split, ranks.splitlines()) if t}


@lru_cache(maxsize=2)
def late_letters(ranks: bytes, pattern: str) -> str:
    """Characters that Python's regex module counts as letters or numbers and the tiktoken library does not.

    The two follow different versions of Unicode. Only characters unknown to Python's own tables can differ;
    the library is asked whether ``'s`` stands alone behind them, as it does behind a letter or a number.
    """
    word = regex.compile(r"[\p{L}\p{N}]")
    unsure = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn" and word.match(c)]
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=parse_ranks(ranks), special_tokens={})
    end = own.encode_ordinary("'s")
    found = own.encode_ordinary_batch([c + "'s" for c in unsure], num_threads=1)
    return "".join(c for c, ids in zip(unsure, found) if ids[-len(end):] != end)


class Codec:
    def __init__(self, ranks: bytes, pattern: str, late: str = ""):
        self.id_of = parse_ranks(ranks)
        self.bytes_of = dict((i, t) for t, i in self.id_of.items())
        self.pattern = regex.compile(pattern)
        self.late = frozenset(late)
        self.masks = dict.fromkeys(map(ord, late), "\u0378")     # unassigned: neither letter, number nor space
        self.of_byte = np.array([self.id_of[bytes([b])] for b in range(256)], np.int64)
        self.known: dict[str, bytes] = {}

    @cached_property
    def pairs(self) -> PairTable:
        """Made by who encodes only."""
        triples = [(self.id_of[t[:k]], self.id_of[t[k:]], i) for t, i in self.id_of.items()
                   for k in range(1, len(t)) if t[:k] in self.id_of and t[k:] in self.id_of]
        return PairTable(*np.array(triples, np.int64).reshape(-1, 3).T)

    def merge(self, ids: np.ndarray) -> list[np.ndarray]:
        """The final ids of each row of a padded matrix."""
        done: list = [None] * len(ids)
        rows, rank = np.arange(len(ids)), self.pairs.find(ids[:, :-1], ids[:, 1:])
        while rank.shape[1]:
            at = rank.argmin(axis=1)
            low = rank[np.arange(len(at)), at]
            live = low != NONE
            for k in np.flatnonzero(~live):
                done[rows[k]] = ids[k][ids[k] >= 0]
            if not live.any():
                return done
            ids, rank, rows, at, low = ids[live], rank[live], rows[live], at[live], low[live]
            r, cols = np.arange(len(at)), np.arange(ids.shape[1] - 1)
            ids[r, at] = low
            ids = np.take_along_axis(ids, cols + (cols > at[:, None]), axis=1)
            rank = np.take_along_axis(rank, cols[:-1] + (cols[:-1] >= at[:, None]), axis=1)
            for near, k in ((at > 0, at - 1), (at < rank.shape[1], at)):
                q, c = r[near], k[near]
                rank[q, c] = self.pairs.find(ids[q, c], ids[q, c + 1])
        for k, row in zip(rows, ids):
            done[k] = row[row >= 0]
        return done

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece, with a heap of (rank, place)."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)]
        ranks = self.pairs.find(ids[:-1], ids[1:])
        ids, n = ids.tolist(), len(piece)
        heap = [(int(ranks[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(ranks != NONE).tolist()]
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        id_of, text = self.id_of, self.bytes_of

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (merged := id_of.get(text[ids[i]] + text[ids[j]])) is not None:
                heapq.heappush(heap, (merged, i, ids[i], ids[j]))

        while heap:
            merged, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = merged, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return np.array([i for i in ids if i >= 0], np.int64)

    def pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian 32-bit integers."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            if (whole := self.id_of.get(p)) is not None:
                out[k] = whole.to_bytes(4, "little")
            elif len(p) > LONG:
                out[k] = self.merge_long(p).astype("<u4").tobytes()
            else:
                buckets.setdefault((len(p) + 3) // 4 if len(p) <= 32 else 1000 + len(p).bit_length(), []).append(k)
        for members in buckets.values():
            width = max(len(pieces[k]) for k in members)
            step = max(1, CELLS // width)
            for at in range(0, len(members), step):
                part = members[at:at + step]
                flat = np.frombuffer(b"".join(pieces[k].ljust(width, b"\0") for k in part), np.uint8)
                sizes = np.array([len(pieces[k]) for k in part])
                ids = np.where(np.arange(width) < sizes[:, None], self.of_byte[flat].reshape(-1, width), -1)
                for k, row in zip(part, self.merge(ids)):
                    out[k] = row.astype("<u4").tobytes()
        return out

    def cut(self, text: str) -> list[str]:
        """The pattern's matches, with late letters taken for symbols."""
        return [text[m.start():m.end()] for m in self.pattern.finditer(text.translate(self.masks))]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cut = [self.pattern.findall(t or "") for t in texts]
        new = list({p for c in cut for p in c}.difference(self.known))
        if not self.late.isdisjoint("".join(new)):
            cut = [c if self.late.isdisjoint(t or "") else self.cut(t) for t, c in zip(texts, cut)]
            new = list({p for c in cut for p in c}.difference(self.known))
        if len(self.known) + len(new) > KNOWN:
            new = list({p for c in cut for p in c})
            self.known = {}
        self.known.update(zip(new, self.pieces([p.encode() for p in new])))
        out = [b"".join(map(self.known.__getitem__, c)) for c in cut]
        for p in new:           # met again, they show that their text has to be cut anew
            if not self.late.isdisjoint(p):
                del self.known[p]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(ranks: bytes, pattern: str, late: str) -> Codec:
    return Codec(ranks, pattern, late)


def _groups(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    held, chars = [], 0
    for t in texts:
        held.append(t)
        chars += len(t or "")
        if chars >= GROUP_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def _vocabulary(docs: DataFrame, path: str, pattern: str):
    """What a codec is made of, as a broadcast; its size is that of the rank file, whatever the data."""
    with open(path, "rb") as f:
        ranks = f.read()
    return docs.sparkSession.sparkContext.broadcast((ranks, pattern, late_letters(ranks, pattern)))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids binary) of every row: the whole text's ids as little-endian unsigned 32-bit integers.

    Null counts as the empty text, which has no ids. Repeated rows and null doc_ids come out as they came;
    other columns are ignored.
    """
    made_of = _vocabulary(docs, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(*made_of.value)
        for batch in batches:
            at = 0
            for texts in _groups(t.as_py() for t in batch.column(1)):
                ids = own.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(ids)), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
                at += len(ids)
        # A worker that waits, or goes on with another operator's tasks, keeps nothing of this one.
        codec.cache_clear()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bare(docs, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded binary): the bytes that the ids stand for; null ids are empty."""
    made_of = _vocabulary(tokens, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(*made_of.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [own.decode(i.as_py() or b"") for i in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.binary())], names=["doc_id", "ids", "decoded"])
        codec.cache_clear()

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return bare(tokens, "doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    return decoded.select(
        "doc_id", F.expr("cast(octet_length(ids) / 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), *more)
