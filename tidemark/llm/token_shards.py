"""Training-order materialisation: token sequences in fixed-stride shards at keyed pseudo-random slots.

Every text is given as many numbers as it can have sequences (an id stands for a byte at least, so its bytes
bound them); this needs lengths only, and texts are encoded once. A balanced Feistel network, walked until it
lands in the numbers' range, permutes them under a key without a sort, a random column or any state. The
permuted numbers are cut into equal ranges. A range is one task, which writes its records, all of one length,
in order to one file. A sequence's global slot is its rank: the records of the files before plus its place.
Where slot s lies follows from s and the files' counts, so a reader starts anywhere and goes on where it stopped.
The counts are written beside the shards as the last step: shards without them are not whole, and any process can
read by the path alone.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import parse_ranks
from tidemark.llm.common import bare

CONTEXT = 256            # ids of a sequence
SHARD_BYTES = 16 << 20   # bytes of a shard at most, about
MOST_TASKS = 20_000      # tasks that write shards at most
ROUNDS = 8
HEAD = "<qiH"            # a record's doc_id, part and ids; part -1 - k: part k of a text without doc_id
HEAD_BYTES = struct.calcsize(HEAD)


def round_keys(key: str) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"{key}/{r}", 42) for r in range(ROUNDS)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _network(x: np.ndarray, keys: np.ndarray, half: np.uint64, back: bool) -> np.ndarray:
    mask = (np.uint64(1) << half) - np.uint64(1)
    left, right = x >> half, x & mask
    for k in keys[::-1] if back else keys:
        if back:
            left, right = right ^ (_mix(left ^ k) & mask), left
        else:
            left, right = right, left ^ (_mix(right ^ k) & mask)
    return (left << half) | right


def permute(numbers: np.ndarray, n: int, key: str, back: bool = False) -> np.ndarray:
    """The slots of ``numbers`` below ``n``; with ``back`` the numbers of slots."""
    out, keys = numbers.astype(np.uint64), round_keys(key)
    half = np.uint64(max(1, (max(2, n) - 1).bit_length() + 1) // 2)
    todo = np.arange(len(out))
    while todo.size:
        out[todo] = _network(out[todo], keys, half, back)
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


@dataclass(frozen=True)
class Layout:
    """Where slots lie: records of ``stride`` bytes, ``starts[k]`` of them before shard k; the last entry is all."""

    path: str
    context: int
    id_bytes: int
    starts: tuple[int, ...]

    @property
    def n(self) -> int:
        return self.starts[-1]

    @property
    def stride(self) -> int:
        return HEAD_BYTES + self.context * self.id_bytes

    def place(self, slot: int) -> tuple[int, int]:
        """(shard, byte offset) of a slot."""
        shard = bisect_right(self.starts, slot) - 1
        return shard, (slot - self.starts[shard]) * self.stride


LAYOUT = "layout.json"


def save(layout: Layout) -> None:
    """Put the layout beside its shards, under its name only when it is whole."""
    fs, root = pafs.FileSystem.from_uri(layout.path)
    hidden = f"{root}/_{uuid.uuid4().hex}"
    with fs.open_output_stream(hidden, compression=None) as file:
        file.write(json.dumps({"context": layout.context, "id_bytes": layout.id_bytes, "starts": layout.starts}).encode())
    fs.move(hidden, f"{root}/{LAYOUT}")


def load(path: str) -> Layout:
    """The layout of shards that were written whole."""
    fs, root = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(f"{root}/{LAYOUT}") as file:
        held = json.loads(file.read())
    return Layout(path, held["context"], held["id_bytes"], tuple(held["starts"]))


def shard_file(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


@lru_cache(maxsize=2)
def _library(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=parse_ranks(ranks), special_tokens={})


def _encode(ranks: bytes, pattern: str, texts: list) -> list:
    own = _library(ranks, pattern)
    return [np.array(own.encode_ordinary(t or ""), np.uint32) for t in texts]


def library_encoder(ranks: bytes, pattern: str) -> Callable[[list], list]:
    """Texts to arrays of ids with the tiktoken library, without special tokens."""
    return partial(_encode, ranks, pattern)


def _numbered(docs: DataFrame, encode: Callable[[list], list], context: int, id_bytes: int, base: dict, n: int, key: str,
              per_shard: int) -> DataFrame:
    """(shard, number, doc_id, part, n_tokens, ids) of every sequence; ``base``: first number of each partition."""
    shared = docs.sparkSession.sparkContext.broadcast(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, end = shared.value.get(TaskContext.get().partitionId(), (0, 0))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                own, rows, numbers = batch.slice(at, 500), [], []
                texts = own.column(1).to_pylist()
                for doc, text, ids in zip(own.column(0).to_pylist(), texts, encode(texts)):
                    if len(ids) and int(ids.max()) >> (8 * id_bytes):
                        raise ValueError(f"an id does not fit {id_bytes} bytes")
                    for k in range(0, len(ids), context):
                        part = ids[k:k + context].astype(f"<u{id_bytes}")
                        rows.append((doc, k // context, len(part), zlib.compress(part.tobytes(), 1)))
                        numbers.append(first + k // context)
                    first += -(-len((text or "").encode()) // context)
                if first > end:
                    raise RuntimeError("a partition holds more than was counted; its rows must be the same in every run")
                if rows:
                    numbers = permute(np.array(numbers), n, key)
                    cols, types = [numbers // per_shard, numbers, *zip(*rows)], [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    names = ["shard", "number", "doc_id", "part", "n_tokens", "ids"]
    return bare(docs, "doc_id", "text").mapInArrow(
        run, "shard bigint, number bigint, doc_id bigint, part int, n_tokens int, ids binary")


def write(docs: DataFrame, path: str, encode: Callable[[list], list], key: str, id_bytes: int = 2,
          context: int = CONTEXT, shard_bytes: int = SHARD_BYTES) -> Layout:
    """Write the ids of every text of ``docs`` (doc_id integer or null, text) under ``path``.

    ``encode`` maps texts (null: no ids) to arrays of ids below 256 ** id_bytes, at most one per UTF-8 byte.
    ``docs`` must give the same rows in the same partitions whenever it is run: a scan of files does, a shuffled
    frame has to be stored before. A text gives all its ids in sequences of ``context``, the last one shorter;
    texts without ids give none, repeated rows theirs as often as they come, an empty table an empty layout.
    A file gets its name when it is whole, and a task that is run again writes the same bytes to that name.
    """
    room = F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / context)
    per = bare(docs, "text").select(F.spark_partition_id().alias("pid"), room.alias("n")).groupBy("pid").agg(F.sum("n").alias("n"))
    base, n = {}, 0
    for r in sorted(per.collect()):          # one row per partition
        base[r["pid"]] = (n, n + r["n"])
        n += r["n"]
    stride = HEAD_BYTES + context * id_bytes
    per_shard = max(1, shard_bytes // stride)
    shards = -(-n // per_shard)
    fs, root = pafs.FileSystem.from_uri(path)
    fs.create_dir(root, recursive=True)
    rows = _numbered(docs, encode, context, id_bytes, base, n, key, per_shard)

    def put(group: pa.Table) -> pa.Table:
        shard, numbers = group["shard"][0].as_py(), group["number"].to_numpy()
        order = np.argsort(numbers)
        if len(numbers) > 1 and np.diff(numbers[order]).min() < 1:
            raise RuntimeError(f"two sequences of shard {shard} have one number")
        out, width = bytearray(stride * len(order)), context * id_bytes
        docs, parts, sizes, ids = (group[c].to_pylist() for c in ("doc_id", "part", "n_tokens", "ids"))
        for k, i in enumerate(order.tolist()):
            at = k * stride
            struct.pack_into(HEAD, out, at, docs[i] or 0, -1 - parts[i] if docs[i] is None else parts[i], sizes[i])
            out[at + HEAD_BYTES:at + stride] = zlib.decompress(ids[i]).ljust(width, b"\0")
        fs, root = pafs.FileSystem.from_uri(path)
        hidden = f"{root}/_{shard}-{uuid.uuid4().hex}"
        with fs.open_output_stream(hidden, compression=None) as file:
            file.write(out)
        fs.move(hidden, f"{root}/{shard_file(shard)}")
        return pa.table({"shard": pa.array([shard], pa.int64()), "records": pa.array([len(order)], pa.int64())})

    counts = np.zeros(shards + 1, np.int64)
    # As many tasks as files, so that few files share a task.
    dealt = rows.repartition(min(max(1, shards), MOST_TASKS), "shard")
    for r in dealt.groupBy("shard").applyInArrow(put, "shard bigint, records bigint").collect():      # one row per file
        counts[r["shard"] + 1] = r["records"]
    layout = Layout(path, context, id_bytes, tuple(np.cumsum(counts).tolist()))
    save(layout)
    return layout


def read(spark: SparkSession, layout: Layout | str, first: int = 0, end: int | None = None, block: int = 4096) -> DataFrame:
    """(slot, doc_id, part, n_tokens, ids binary, shard, offset) of slots ``first`` to ``end`` (not included).

    ``layout`` is what ``write`` returned or the path it wrote to. Each file's part is read in order, ``block``
    records at a time; to resume, pass the first slot still wanted.
    """
    layout = load(layout) if isinstance(layout, str) else layout
    end = layout.n if end is None else min(end, layout.n)
    names = ["slot", "doc_id", "part", "n_tokens", "ids", "shard", "offset"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    shared = spark.sparkContext.broadcast(layout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = shared.value
        fs, root = pafs.FileSystem.from_uri(layout.path)
        for shard in (s for batch in batches for s in batch.column(0).to_pylist()):
            start = layout.starts[shard]
            at, stop = max(first, start), min(end, layout.starts[shard + 1])
            if at >= stop:
                continue
            with fs.open_input_file(f"{root}/{shard_file(shard)}") as file:
                file.seek((at - start) * layout.stride)
                while at < stop:
                    many = min(block, stop - at)
                    data, rows = file.read(many * layout.stride), []
                    for k in range(many):
                        where = k * layout.stride
                        doc, part, size = struct.unpack_from(HEAD, data, where)
                        body = where + HEAD_BYTES
                        rows.append((at + k, None if part < 0 else doc, -1 - part if part < 0 else part, size,
                                     data[body:body + size * layout.id_bytes], shard, (at + k - start) * layout.stride))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    at += many

    low, high = (layout.place(first)[0], layout.place(end - 1)[0] + 1) if first < end else (0, 0)
    shards = spark.range(low, high, 1, max(1, min(high - low, 10_000)))
    return shards.mapInArrow(run, "slot bigint, doc_id bigint, part int, n_tokens int, ids binary, shard bigint, offset bigint")
