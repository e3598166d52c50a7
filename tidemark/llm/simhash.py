"""SimHash near-dedup: segment-popcount embedding, grid range join, exact verification.

A fingerprint is mapped to the bit counts (0 to 2) of its 32 two-bit segments, written in unary so that the
Manhattan distance of two embeddings is the number of bits in which they differ. It never exceeds the
Hamming distance of the fingerprints. The embedding is cut in two halves of 16 segments: of a pair within
``bits``, one half differs in ``bits // 2`` bits at most. Each half is a grid, refined by the patterns of its
segments. Halves one bit apart differ by one step of one count and agree in all other patterns: the higher one
is in the cell of its counts, the lower one is put one step *up* in each segment in turn. So a pair that meets
agrees in 30 bits or more, once for each half, and of 10^9 unlike fingerprints each meets a few others. Further
apart (4 bits and more) the segments that may differ are left open instead. Pairs that meet are tested by the whole
embeddings' Manhattan distance and then by the differing bits, inside the join.

Only different fingerprints are joined (copies are folded first), so a fingerprint has at most
``C(64,1) + .. + C(64,bits)`` partners however many rows there are, and the links stay linear in the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rows import loose
from tidemark.llm.common import bare, stash, store, text_key, unstash
from tidemark.llm.components import components

SHINGLE = 3          # words per shingle
BITS = 3             # differing bits at most
CHUNK = 1 << 16      # shingles hashed at once
LOW, HIGH = 0x5555555555555555, -0x5555555555555556      # lower and upper bit of every segment
OCTETS = np.unpackbits(np.arange(256, dtype=np.uint8).reshape(-1, 1), axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text's lower-cased (A-Z) words; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    n = len(words) - width + 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros((8, 8), np.int64)
    for at in range(0, n, CHUNK):
        part = words[at:at + CHUNK + width - 1]
        hashes = [digest(b" ".join(s), 42) for s in zip(*[part[k:] for k in range(width)])]
        octets = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[k] += np.bincount(octets[:, k], minlength=256) @ OCTETS
    return int(np.packbits((2 * ones > n).ravel(), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_id, fp bigint) of every row; the whole text counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=["doc_id", "text_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    whole = bare(docs, "doc_id", "text").select(
        "doc_id", text_key(F.col("text")).alias("text_id"), F.col("text").cast("binary"))
    return whole.mapInArrow(run, f"doc_id {kind}, text_id binary, fp bigint")


def embedding(fp: Column) -> Column:
    """Unary bit counts of the segments: lower bit for one or more, upper bit for two."""
    return ((fp.bitwiseOR(F.shiftrightunsigned(fp, 1))).bitwiseAND(F.lit(LOW))).bitwiseOR(
        fp.bitwiseAND(F.shiftleft(fp, 1)).bitwiseAND(F.lit(HIGH)))


def apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _halves() -> list[tuple[int, Column]]:
    return [(0, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))), (1, F.shiftrightunsigned("fp", 32))]


def _without(half: Column, *segments: int) -> Column:
    return half.bitwiseAND(F.lit(0xFFFFFFFF & ~sum(3 << (2 * s) for s in segments)))


def _tag(kind: int, side: int, count: Column | None = None) -> Column:
    named = F.lit((2 * kind + side) << 34)
    return named if count is None else named.bitwiseOR(F.shiftleft(count.cast("bigint"), 32))


def _open_cells(open_segments: int) -> list[Column]:
    """The half's patterns but for each choice of open segments."""
    return [_without(half, *chosen).bitwiseOR(_tag(k, side))
            for k, chosen in enumerate(combinations(range(16), open_segments)) for side, half in _halves()]


def _count_cells(steps: int) -> list[Column]:
    """For each segment the patterns of the others and its own count, ``steps`` up (null beyond two)."""
    out = []
    for side, half in _halves():
        for s in range(16):
            count = F.bit_count(half.bitwiseAND(F.lit(3 << (2 * s)))) + steps
            cell = _without(half, s).bitwiseOR(_tag(1 + s, side, count))
            out.append(F.when(count <= 2, cell) if steps else cell)
    return out


def _cells(prints: DataFrame, cells: list[Column], name: str) -> DataFrame:
    return prints.select(F.col("fp").alias(name), F.explode(F.array_compact(F.array(*cells))).alias("cell"))


def links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """(a, b) with a < b: all pairs of different fingerprints at ``bits`` or fewer differing bits, once each."""
    radius = bits // 2
    here = _open_cells(0 if radius < 2 else radius)
    left = _cells(prints, here + (_count_cells(0) if radius == 1 else []), "a")
    right = _cells(prints, here + (_count_cells(1) if radius == 1 else []), "b")
    a, b = F.col("a"), F.col("b")
    # Cells that both sides fill alike bring a pair twice, one order is enough; raised ones bring each pair once.
    once = (a < b) | (F.shiftright(left["cell"], 35) > 0) if radius == 1 else a < b
    near = once & (apart(embedding(a), embedding(b)) <= bits) & (apart(a, b) <= bits)
    met = left.hint("merge").join(right, (left["cell"] == right["cell"]) & near)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _rooted(docs: DataFrame, shingle: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and for each fingerprint (fp, least doc_id, root of its component)."""
    prints = store(fingerprints(docs, shingle), "simhash")
    groups = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(groups.select("fp"), bits))
    rooted = groups.join(found, groups["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root"))
    return prints, store(rooted, "simhash-roots")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text; other columns are ignored).

    component_id is the smallest doc_id that links reach, the row's own included. Null, empty and blank
    texts have fingerprint 0 and link like any other. Repeated rows come out as often as they come in. A
    null doc_id is never the smallest; a component of nulls only has a null id. No rows give no rows.
    """
    prints, rooted = _rooted(docs, shingle, bits)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(loose(least), "root").select("fp", "component_id")
    return prints.join(loose(labels), "fp").select("doc_id", "fp", "component_id")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The rows of ``docs``, one of each group: the smallest doc_id (null last), then the smallest text key.

    All columns are kept as they are. Of rows equal in doc_id and text any one stays.
    """
    prints, rooted = _rooted(docs, shingle, bits)
    held = prints.join(loose(rooted.select("fp", "root")), "fp")
    first = held.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_id")).alias("k"))
    winners = store(first.select(F.col("k.doc_id").alias("id"), F.col("k.text_id").alias("text_id")), "simhash-kept")
    own = stash(docs, id=F.col("doc_id"), text_id=text_key(F.col("text")))
    same = own["id"].eqNullSafe(winners["id"]) & (own["text_id"] == winners["text_id"])
    return unstash(own.join(winners, same, "left_semi").dropDuplicates(["id", "text_id"]), docs)
