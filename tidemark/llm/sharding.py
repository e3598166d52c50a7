"""Sharding by Karmarkar-Karp differencing: near-equal bytes, and no group is ever divided.

A part is a way to deal some groups over all shards: one sum of bytes per shard. A single group is a part with
one sum. The two parts of largest spread (largest sum minus smallest) are combined, oppositely ordered: the
largest sum of one meets the smallest of the other. The last part left deals out everything.

1. Rows are folded to one per group before the shuffle, so a group of copies is one small row.
2. The few groups that weigh a ``LARGE``-th of all bytes or more are combined first, on the driver: ``LARGE`` rows at most.
3. All others follow in classes of like size, the larger ones first. A class falls by hash into blocks of about ``FAN``
   groups, and each block is combined in a task of its own. As many blocks as it takes to even out what is there
   start with a share of it and so fill its gaps; their parts add up shard by shard.
4. The other blocks' parts are combined in turn with that one, ``FAN`` at a time, in rounds until one is left.
5. Slots are counted per range of rows and shifted by the counts before it, so no task sees a whole shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rows import loose
from tidemark.llm.common import stash, store, text_key

SHARDS = 16
FAN = 4096          # groups or parts that one task combines, many times the number of shards
LARGE = 4096        # a group of this share of all bytes is combined ahead of the blocks
STEP = 4            # sizes of one class differ by a factor of 2 ** STEP at most


def difference(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine the rows of ``parts`` (part x shard) to one: (where each part's every sum goes, the sums)."""
    count, width = parts.shape
    order = np.argsort(-parts, axis=1, kind="stable")
    sums = list(np.take_along_axis(parts, order, 1))
    heap = [(int(s[-1] - s[0]), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    joins, moves = [], np.empty((max(0, count - 1), width), np.intp)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = sums[a] + sums[b][::-1]
        by = np.argsort(-both, kind="stable")
        both = both[by]
        moves[len(joins)][by] = np.arange(width)
        joins.append((a, b))
        sums[a] = sums[b] = None
        sums.append(both)
        heapq.heappush(heap, (int(both[-1] - both[0]), len(sums) - 1))
    goes = np.empty((len(sums), width), np.intp)
    goes[-1] = np.arange(width)
    for node in range(len(joins) - 1, -1, -1):
        a, b = joins[node]
        goes[a] = goes[count + node][moves[node]]
        goes[b] = goes[a][::-1]
    placed = np.empty((count, width), np.intp)
    np.put_along_axis(placed, order, goes[:count], 1)
    return placed, sums[-1]


def _singles(sizes: np.ndarray, shards: int) -> np.ndarray:
    parts = np.zeros((len(sizes), shards), np.int64)
    parts[:, 0] = sizes
    return parts


def _blocks(small: DataFrame, shares: np.ndarray, filling: int) -> DataFrame:
    """(block, gid, place) of every group, and one row (block, null, null, sums) per block.

    ``small`` has (block, gid, bytes). Blocks below ``filling`` start with the part ``shares`` divided among them.
    """
    shards = len(shares)

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        rows = sorted(zip(table.column("bytes").to_pylist(), table.column("gid").to_pylist()), key=lambda r: (-r[0], r[1]))
        sizes = np.array([r[0] for r in rows], np.int64)
        parts = _singles(sizes, shards)
        if block < filling:
            own = [int(s) * (block + 1) // filling - int(s) * block // filling for s in shares]
            placed, _ = difference(np.vstack([np.array(own, np.int64), parts]))
            names = np.empty(shards, np.intp)
            names[placed[0]] = np.arange(shards)
            place = names[placed[1:, 0]]
        else:
            place = difference(parts)[0][:, 0]
        sums = np.zeros(shards, np.int64)
        np.add.at(sums, place, sizes)
        return pa.table({
            "block": pa.array([block] * (len(rows) + 1), pa.int64()),
            "gid": pa.array([*[r[1] for r in rows], None], pa.binary()),
            "place": pa.array([*place.tolist(), None], pa.int32()),
            "sums": pa.array([*[None] * len(rows), sums.tolist()], pa.list_(pa.int64()))})

    return small.groupBy("block").applyInArrow(run, "block bigint, gid binary, place int, sums array<bigint>")


def _combined(parts: DataFrame, count: int) -> tuple[DataFrame, list[int]]:
    """(part, goes), which shard each place of a part becomes, and the shards' sums.

    ``parts`` has (part, sums), part from 0 to count - 1.
    """
    ups = -(-count // FAN)

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("part").to_pylist(), table.column("sums").to_pylist()))
        placed, sums = difference(np.array([r[1] for r in rows], np.int64))
        return pa.table({
            "part": pa.array([*[r[0] for r in rows], None], pa.int64()),
            "up": pa.array([table.column("up")[0].as_py()] * (len(rows) + 1), pa.int64()),
            "goes": pa.array([*placed.tolist(), None], pa.list_(pa.int32())),
            "sums": pa.array([*[None] * len(rows), sums.tolist()], pa.list_(pa.int64()))})

    dealt = store(parts.withColumn("up", F.col("part") % ups).groupBy("up").applyInArrow(
        run, "part bigint, up bigint, goes array<int>, sums array<bigint>"), "shard-parts")
    own = dealt.filter("part is not null").select("part", "up", "goes")
    if ups == 1:
        return own.select("part", "goes"), dealt.filter("part is null").first()["sums"]
    above, sums = _combined(dealt.filter("part is null").select(F.col("up").alias("part"), "sums"), ups)
    above = above.select(F.col("part").alias("up"), F.col("goes").alias("on"))
    return own.join(loose(above), "up").select("part", F.transform("goes", lambda i: F.get("on", i)).alias("goes")), sums


def _tier(small: DataFrame, count: int, weight: int, held: np.ndarray) -> tuple[DataFrame, list[int], list[int]]:
    """Combine the groups of one size class with the part ``held``: (gid, place), where ``held`` goes, the new sums."""
    spark, shards = small.sparkSession, len(held)
    blocks = -(-count // FAN)
    gaps = int((held.max() - held).sum())
    filling = min(blocks, -(-3 * gaps * blocks // (2 * weight)))
    free = blocks - filling
    cut = store(_blocks(small.withColumn("block", F.pmod(F.xxhash64("gid"), F.lit(blocks))), held, filling), "shard-blocks")
    # The filling blocks are one part with ``held``, numbered behind the free blocks.
    part = F.when(F.col("block") < filling, free).otherwise(F.col("block") - filling).cast("bigint")
    given = spark.createDataFrame([(free, held.tolist())], "part bigint, sums array<bigint>")
    empty = spark.range(free).select(F.col("id").alias("part"), F.array_repeat(F.lit(0).cast("bigint"), shards).alias("sums"))
    sums = cut.filter("gid is null").select(part.alias("part"), "sums").unionByName(given).unionByName(empty)
    sums = sums.groupBy("part").agg(F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(shards)]).alias("sums"))
    goes, total = _combined(sums, free + 1)
    items = cut.filter("gid is not null").select("gid", "place", part.alias("part"))
    placed = items.join(loose(goes), "part").select("gid", F.get("goes", "place").alias("place"))
    return placed, goes.filter(F.col("part") == free).first()["goes"], total


def places(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(gid, shard) for ``groups`` (gid binary, bytes bigint above 0; every gid once)."""
    spark = groups.sparkSession
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    heavy = F.col("bytes") * LARGE >= total
    large = sorted(((r["bytes"], bytes(r["gid"])) for r in groups.filter(heavy).collect()), key=lambda r: (-r[0], r[1]))
    dealt, held = (difference(_singles(np.array([r[0] for r in large], np.int64), shards)) if large
                   else (np.empty((0, shards), int), np.zeros(shards, np.int64)))
    first = [(g, int(p)) for (_, g), p in zip(large, dealt[:, 0])]
    out, moves = [spark.createDataFrame(first, "gid binary, place int")], []
    small = groups.filter(~heavy).withColumn("tier", F.floor(F.log2("bytes") / STEP))
    tiers = small.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("weight")).collect()
    for tier, n, weight in sorted(map(tuple, tiers), reverse=True):
        placed, goes, sums = _tier(small.filter(F.col("tier") == tier), n, weight, held - held.min())
        out.append(placed)
        moves.append(goes)
        held = np.array(sums, np.int64)
    # What an earlier tier placed has been moved by every later one.
    final = np.arange(shards)
    for i in range(len(out) - 1, -1, -1):
        shard = F.get(F.array(*[F.lit(int(x)) for x in final]), F.col("place"))
        out[i] = out[i].select("gid", shard.alias("shard"))
        if i:
            final = final[np.array(moves[i - 1])]
    return reduce(DataFrame.union, out)


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``slot``: gapless from 0 within each shard, in the order of the columns ``order``."""
    names = rows.columns
    # Rows that agree in all of ``order`` are told apart, so that a repeated one can be spread over ranges.
    apart = rows.withColumn("_salt", F.monotonically_increasing_id())
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = apart.repartitionByRange(parts, "shard", *order, "_salt").sortWithinPartitions("shard", *order, "_salt")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))).tolist() + [len(shard)]
            at = np.empty(len(shard), np.int64)
            for i, j in zip(edges, edges[1:]):
                start = seen.get(int(shard[i]), 0) if j > i else 0
                at[i:j] = np.arange(start, start + j - i)
                if j > i:
                    seen[int(shard[i])] = start + j - i
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=[*names, "_piece", "_at"])

    piece = ranged.select(*names, F.spark_partition_id().alias("_piece"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in piece.schema)
    cut = store(piece.mapInArrow(run, f"{kinds}, _at bigint"), "shard-slots")
    counts = cut.groupBy("shard", "_piece").agg(F.count(F.lit(1)).alias("n"))
    # One row per range and shard in it: ranges plus shards at most.
    before = counts.alias("l").join(counts.alias("r"), (F.col("l.shard") == F.col("r.shard")) & (F.col("r._piece") < F.col("l._piece")), "left")
    before = before.groupBy("l.shard", "l._piece").agg(F.coalesce(F.sum("r.n"), F.lit(0)).alias("_before"))
    return cut.join(F.broadcast(before), ["shard", "_piece"]).select(*names, (F.col("_at") + F.col("_before")).alias("slot"))


def assign(rows: DataFrame, group: Column, size: Column, order: list[Column], shards: int = SHARDS) -> DataFrame:
    """``rows`` with shard (int, 0 to shards - 1) and slot (bigint, gapless from 0 in each shard).

    ``group`` (binary) names the rows that stay together, ``size`` is a row's weight (above 0), ``order`` the
    order of slots in a shard. Shards' sums of sizes are near equal; a group heavier than a shard's share has
    its shard to itself as far as the others allow. The outcome depends on the rows alone, not on their layout.
    No rows give no rows; extra columns pass through under any name but ``shard`` and ``slot``.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    own = [f"o{i}" for i in range(len(order))]
    held = stash(rows, gid=group, size=size.cast("bigint"), **dict(zip(own, order)))
    groups = store(held.groupBy("gid").agg(F.sum("size").alias("bytes")), "shard-groups")
    placed = store(places(groups, shards), "shard-places")
    out = _numbered(held.join(loose(placed), "gid").drop("size"), [*own, "gid"])
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rows.columns)], "shard", "slot")


def text_size(text: Column) -> Column:
    """UTF-8 bytes (a null text has none) plus one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` (doc_id, text and anything else) with shard and slot: equal texts stay together, null ones with empty ones.

    A row counts its bytes plus one. Slots go by doc_id (null first); repeated rows each have a slot.
    """
    return assign(docs, text_key(F.col("text")), text_size(F.col("text")), [F.col("doc_id")], shards)


def placements(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) as ``shard_documents`` places the rows; texts are read once and not shuffled."""
    text = F.col("text")
    slim = store(docs.select(
        "doc_id", text_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), text_key(text).alias("key")), "shard-sizes")
    return assign(slim, F.col("key"), F.col("size"), [F.col("doc_id")], shards).drop("key")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> str:
    """Write ``shard_documents`` as one folder per shard; every file holds one range of slots, in order."""
    out = shard_documents(docs, shards)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out.repartitionByRange(max(parts, shards), "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path


def read_shard(spark: SparkSession, path: str, shard: int, start: int = 0) -> DataFrame:
    """The rows of one shard from slot ``start`` on; other shards' files are not opened."""
    return spark.read.parquet(path).filter((F.col("shard") == shard) & (F.col("slot") >= start))
