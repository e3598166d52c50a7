"""Suffix-array dedup: bytes covered by long strings that start anywhere else are removed.

A window (400 bytes, unless asked otherwise) is filed under its anchor, the gram in it of least hash (the leftmost
of equals): equal windows have equal anchors, wherever they lie. Neighbouring windows with one anchor form a segment,
so all windows are cut into segments once and every window is in exactly one.

1. Anchors are counted over the corpus; only texts with an anchor met twice go on.
2. Segments of such anchors are counted by content, without their bytes. Copies are repeats throughout and need no
   index; one row of each content goes on, found by its number, so a content with many copies is no hot key.
3. Anchors left with several different segments go, a few megabytes at a time, through a run-length index
   (``run_index``), whose matching statistics mark the windows that start elsewhere too.
4. An anchor with very many different segments, or very long ones, is filed anew: its windows by their distance from
   the anchor, in eight ranges, and by the bytes that all windows of the range share. Each round divides the range
   by eight until a group is small or its windows are equal. No group grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rows import loose
from tidemark.llm.common import stash, store, text_key
from tidemark.llm.run_index import repeated_windows

LENGTH = 400               # bytes of a string that counts as repeated
SHORTEST = 48              # bytes of the shortest string that can be asked for
CROWD = 2000               # different segments of an anchor that one task takes
CROWD_BYTES = 1 << 22      # and their bytes
WAYS = 8                   # ranges an overfull anchor is split into
GROUP_BYTES = 1 << 20      # bytes hashed at once
INDEX_BYTES = 1 << 21      # bytes indexed at once
BASE = 0x9E3779B97F4A7C15
CODES = np.random.default_rng(42).integers(1, 1 << 63, 256, np.uint64)
SPOT = np.uint64((1 << 28) - 1)

SEGMENTS = ("tid binary, start bigint, last bigint, h bigint, copies bigint, turns bigint, low bigint, high bigint, "
            "spot bigint, digest binary, seg binary")


def gram_of(length: int) -> int:
    """Bytes of an anchor: the largest power of two of at most a sixth of ``length``."""
    return 1 << (length // 6).bit_length() - 1


def gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` bytes, by doubling."""
    h, width, power = CODES[text], 1, BASE
    while width < gram:
        h = h[:-width] * np.uint64(power) + h[width:]
        width, power = width * 2, power * power % (1 << 64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x, size = np.minimum(x[:-size], x[size:]), 2 * size
    return np.minimum(x[:len(x) - (width - size)], x[width - size:])


def anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``length`` bytes its anchor's place and hash."""
    gram = gram_of(length)
    h = gram_hashes(np.frombuffer(text, np.uint8), gram)
    least = sliding_min((h & ~SPOT) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    spot = (least & SPOT).astype(np.int64)
    return spot, h[spot].view(np.int64)


def segments(text: bytes, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first window, last window, anchor hash, anchors met) of the text's segments."""
    for at in range(0, max(0, len(text) - length + 1), GROUP_BYTES):
        spot, h = anchors(text[at:at + GROUP_BYTES + length - 1], length)
        cut = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        moved = np.concatenate(([1], spot[1:] != spot[:-1])).astype(np.int64)
        ends = np.concatenate((cut[1:], [len(h)])) - 1
        yield from zip((cut + at).tolist(), (ends + at).tolist(), h[cut].tolist(), np.add.reduceat(moved, cut).tolist())


def _digest(*parts: bytes) -> bytes:
    d = blake2b(digest_size=16)
    for p in parts:
        d.update(p)
    return d.digest()


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(names), types)], names=names)


def _emit(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], most: int = 4000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield _table(held, names, types)
            held = []
    if held:
        yield _table(held, names, types)


def _anchor_counts(texts: DataFrame, length: int) -> DataFrame:
    """(key, h, n): the anchors of every text (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for _, _, h, n in segments(text.as_py(), length):
                        yield key, h, n
        yield from _emit(rows(), ["key", "h", "n"], [pa.int64()] * 3, 50_000)

    return texts.mapInArrow(run, "key bigint, h bigint, n bigint")


NAMES = [c.split()[0] for c in SEGMENTS.split(", ")]
TYPES = [pa.binary(), *[pa.int64()] * 8, pa.binary(), pa.binary()]


def _segments_of(wanted: DataFrame, length: int) -> DataFrame:
    """The segments of each text (tid, text, hs) whose anchors are listed in ``hs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for tid, text, hs in zip(batch.column(0), batch.column(1), batch.column(2)):
                    key, whole, shared = tid.as_py(), text.as_py(), set(hs.as_py())
                    for first, last, h, n in segments(whole, length):
                        if h in shared:
                            seg = whole[first:last + length]
                            yield key, first, last, h, 1, n, 0, length - gram_of(length), -1, _digest(seg), seg
        yield from _emit(rows(), NAMES, TYPES)

    return wanted.mapInArrow(run, SEGMENTS)


def finer(seg: bytes, h: int, spot: int, low: int, high: int, length: int) -> Iterator[tuple]:
    """(first, last, group, low, high, place of the anchor) of a segment's parts, by distance from the anchor.

    Equal windows of one group get equal new groups: the distance is a window's own, and the bytes that all
    windows of a range share belong to each of them.
    """
    windows = len(seg) - length + 1
    at = anchors(seg, length)[0] if spot < 0 else np.full(windows, spot)
    width = -(-(high - low + 1) // WAYS)
    part = (at - np.arange(windows) - low) // width
    cut = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (part[1:] != part[:-1]))))
    ends = np.concatenate((cut[1:], [windows])) - 1
    for i, j in zip(cut.tolist(), ends.tolist()):
        a = low + int(part[i]) * width
        b, place = min(high, a + width - 1), int(at[i])
        group = _digest(f"{h},{a},{b},".encode(), seg[place - a:place - b + length])[:8]
        yield i, j, int.from_bytes(group, "little", signed=True), a, b, place - i


def _refile(crowded: DataFrame, length: int) -> DataFrame:
    """File the windows of overfull anchors anew. What a segment repeats is folded; a null ``seg`` is a mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for r in batch.to_pylist():
                    seg, parts = r["seg"], {}
                    for i, j, *filed in finer(seg, r["h"], r["spot"], r["low"], r["high"], length):
                        parts.setdefault((seg[i:j + length], *filed), []).append(i)
                    for (part, group, a, b, place), firsts in parts.items():
                        more, copies = len(part) - length, r["copies"] * len(firsts)
                        if copies > 1 and r["tid"] is not None:
                            for i in firsts:
                                yield r["tid"], r["start"] + i, r["start"] + i + more, *[0] * 6, None, None
                        start = r["start"] + firsts[0]
                        yield (r["tid"] if copies == 1 else None, start, start + more, group, copies, 1, a, b, place,
                               _digest(part), part)
        yield from _emit(rows(), NAMES, TYPES)

    return crowded.mapInArrow(run, SEGMENTS)


def _indexed(few: DataFrame, length: int) -> DataFrame:
    """(tid, first, last): windows of segments that occur once, which start elsewhere in their group too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held):
            marks = repeated_windows([r["seg"] for r in held], length)
            for r, mark in zip(held, marks):
                if r["tid"] is not None and mark.any():
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], mark.astype(np.int8), [0]))))
                    for i, j in zip(edge[::2].tolist(), edge[1::2].tolist()):
                        yield r["tid"], r["start"] + i, r["start"] + j - 1

        def rows():
            held, size = [], 0
            for batch in batches:
                for r in batch.to_pylist():
                    if size >= INDEX_BYTES and held[-1]["h"] != r["h"]:
                        yield from found(held)
                        held, size = [], 0
                    held.append(r)
                    size += len(r["seg"])
            if held:
                yield from found(held)
        yield from _emit(rows(), ["tid", "first", "last"], [pa.binary(), pa.int64(), pa.int64()])

    together = few.select("h", "tid", "start", "seg").repartition("h").sortWithinPartitions("h")
    return together.mapInArrow(run, "tid binary, first bigint, last bigint")


def _marks(rows: DataFrame, length: int) -> DataFrame:
    """(tid, first, last): ranges of repeated windows among segments filed by anchor."""
    marks = []
    while True:
        rows = store(rows.withColumn("row", F.monotonically_increasing_id()), "suffix-segments")
        kinds = rows.filter("digest is not null").groupBy("h", "digest").agg(
            F.sum("copies").alias("n"), F.max("turns").alias("most_turns"), F.min("row").alias("row"),
            F.max(F.col("last") - F.col("start") + length).alias("bytes"))
        groups = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.sum("bytes").alias("all_bytes"))
        crowded = (F.col("kinds") > CROWD) | (F.col("all_bytes") > CROWD_BYTES)
        labels = store(kinds.join(loose(groups), "h").filter("n > 1 or kinds > 1 or most_turns > 1").select(
            "h", "digest", "n", "kinds", "most_turns", "row", crowded.alias("crowded")), "suffix-kinds")
        marks.append(rows.filter("seg is null").select("tid", F.col("start").alias("first"), "last"))
        copied = labels.filter("n > 1").select("h", "digest")
        marks.append(rows.filter("tid is not null").select("h", "digest", "tid", F.col("start").alias("first"), "last").join(
            loose(copied), ["h", "digest"]).select("tid", "first", "last"))
        # One row of each content; of a copied one the windows need no marks, they are there for the others.
        picked = labels.filter("n = 1 or kinds > 1 or most_turns > 1").select("row", "n", "crowded")
        whole = rows.join(loose(picked), "row").withColumns({
            "tid": F.when(F.col("n") == 1, F.col("tid")), "copies": F.col("n")})
        marks.append(_indexed(whole.filter("not crowded"), length))
        if picked.filter("crowded").isEmpty():
            break
        rows = _refile(whole.filter("crowded").select(*NAMES), length)
    out = marks[0]
    for m in marks[1:]:
        out = out.union(m)
    return out


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(tid, spans): for each text (tid, text binary) the ranges of its windows that start elsewhere too."""
    keyed = texts.withColumn("key", F.xxhash64("tid"))
    counted = store(_anchor_counts(keyed.select("key", "text"), length), "suffix-anchors")
    shared = counted.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h")
    wanted = counted.select("key", "h").join(loose(shared), "h").groupBy("key").agg(F.collect_set("h").alias("hs"))
    rows = _segments_of(keyed.join(loose(wanted), "key").select("tid", "text", "hs"), length)
    return _marks(rows, length).groupBy("tid").agg(
        F.sort_array(F.collect_set(F.struct("first", "last"))).alias("spans"))


def _covered(spans: list[dict] | None, length: int, text: bytes, words: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by ranges of windows, given in order, that hold ``words`` words or more."""
    out: list[tuple[int, int]] = []
    for s in spans or []:
        if out and s["first"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["last"] + length))
        else:
            out.append((s["first"], s["last"] + length))
    return [(a, b) for a, b in out if len(text[a:b].split()) >= words] if words else out


def remove_repeats(docs: DataFrame, length: int = LENGTH, as_text: bool = False, words: int = 0) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and ``kept`` (the bytes that are left), all rows.

    With ``as_text``, ``kept`` is a string; of a character that a removed span cuts through nothing is left.
    With ``words``, a removed span holds at least so many words; shorter ones stay.

    A byte goes if a ``length``-byte string over it starts anywhere else, in the same text or another one,
    as judged on the input. Null texts count as empty; texts shorter than ``length`` stay whole. A repeated
    row repeats its text. Other columns pass through, whatever they are called but the four above.
    """
    if length < SHORTEST:
        raise ValueError(f"length must be {SHORTEST} or more")
    keyed = stash(docs, tid=text_key(F.col("text")), text=F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    spans = repeated_spans(keyed.select("tid", "text").filter(F.octet_length("text") >= length), length)
    held = keyed.join(loose(spans), "tid", "left").drop("tid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                made = []
                for text, spans in zip(batch.column("text"), batch.column("spans")):
                    full = text.as_py()
                    gone = _covered(spans.as_py(), length, full, words)
                    edges = [0, *[e for span in gone for e in span], len(full)]
                    kept = b"".join(full[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    made.append((len(full), len(full) - len(kept), len(gone),
                                 kept.decode("utf-8", "ignore") if as_text else kept))
                own = [batch.column(i) for i in range(n_own)]
                new = [pa.array(c, t) for c, t in zip(zip(*made), [pa.int64()] * 3 + [pa.string() if as_text else pa.binary()])]
                yield pa.RecordBatch.from_arrays(own + new, names=names)

    added = ["n_bytes", "n_removed", "n_spans", "kept"]
    n_own = len(docs.columns)
    names = [f"c{i}" for i in range(n_own)] + added
    kinds = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema)]
    kinds.append("n_bytes bigint, n_removed bigint, n_spans bigint, kept " + ("string" if as_text else "binary"))
    out = held.mapInArrow(run, ", ".join(kinds))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)], *added)
