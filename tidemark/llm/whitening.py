"""Embedding whitening with a covariance by polarisation.

Entries become integers, so every sum is exact. The first pass adds up the entries; the second adds up, for every
dimension i and every pair i < j, the squares of the centred values of x_i and of x_i + x_j. With those,

    cov(x_i, x_j) = (var(x_i + x_j) - var(x_i) - var(x_j)) / 2

holds without rounding, and the matrix goes to ``eigh``. Values are centred on the integer next to the mean before
they are squared; what the centre is off (less than one) is known exactly and taken out of the sums at the end.

A task holds one sum per dimension and pair; those are added up by Spark, so the driver gets dim * (dim + 1) / 2
numbers however many rows there are. The rows themselves are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stash, store

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
FAR = 1 << 45        # |floor(SCALE * c)| is cut to this
FLAT = 1e-12         # a variance of at most this share of the largest one is no direction
LOW = 30             # bits of the lower part of a sum


def grid(entries: np.ndarray) -> np.ndarray:
    """Doubles as integers."""
    return np.clip(np.floor(entries * float(SCALE)), -FAR, FAR).astype(np.int64) + SHIFT


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, entries) of the vectors without null or non-finite entries, a matrix for every length there is."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    for size in np.unique(lengths[lengths >= 0]).tolist():
        rows = np.flatnonzero(lengths == size)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
        entries = flat.reshape(len(rows), size)
        fine = np.isfinite(entries).all(axis=1)
        if fine.any():
            yield rows[fine], entries[fine]


def _vectors(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(f"`{column}`").cast("array<double>").alias("v"))


def _sums(vectors: DataFrame) -> DataFrame:
    """(size, dim, total): sums of the integers by vector length; dim -1 has the number of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high: dict[int, np.ndarray] = {}
        low: dict[int, np.ndarray] = {}
        count: dict[int, int] = {}
        for batch in batches:
            for rows, entries in matrices(batch.column(0)):
                x, size = grid(entries), entries.shape[1]
                high[size] = high.get(size, 0) + (x >> LOW).sum(axis=0)
                low[size] = low.get(size, 0) + (x & ((1 << LOW) - 1)).sum(axis=0)
                count[size] = count.get(size, 0) + len(rows)
        for size, n in count.items():
            totals = [n] + [(int(h) << LOW) + int(s) for h, s in zip(high[size], low[size])]
            yield pa.RecordBatch.from_arrays([
                pa.array([size] * (size + 1), pa.int32()), pa.array(range(-1, size), pa.int32()),
                pa.array([Decimal(t) for t in totals], pa.decimal128(38, 0))], names=["size", "dim", "total"])

    return vectors.mapInArrow(run, "size int, dim int, total decimal(38,0)").groupBy("size", "dim").agg(F.sum("total").alias("total"))


def square_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums of squares of centred columns: of x_i at [i, i], of x_i + x_j at [i, j] for i < j."""
    n, d = x.shape
    out = np.zeros((d, d), object)
    most = 2 * int(np.abs(x).max(initial=0)) + 1
    block = min(4096, (1 << 62) // (most * most))
    if not block:       # a square alone may exceed a long
        x, block = x.astype(object), 4096
    for at in range(0, n, block):
        part = x[at:at + block]
        for i in range(d):
            pair = part[:, i:i + 1] + part[:, i:]
            pair[:, 0] = part[:, i]
            out[i, i:] += (pair * pair).sum(axis=0).astype(object)
    return out


def _squares(vectors: DataFrame, centre: np.ndarray) -> DataFrame:
    """(i, j, total): sums of squares over all vectors of the centre's length."""
    d = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((d, d), object)
        for batch in batches:
            for _, entries in matrices(batch.column(0)):
                if entries.shape[1] == d:
                    held += square_sums(grid(entries) - centre)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([
            pa.array(i, pa.int32()), pa.array(j, pa.int32()),
            pa.array([Decimal(int(v)) for v in held[i, j]], pa.decimal128(38, 0))], names=["i", "j", "total"])

    return vectors.mapInArrow(run, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total"))


@dataclass
class Whitening:
    """A fitted transform: ``n`` vectors with column sums ``sums``; covariance ``cov``; components by falling variance."""

    n: int
    sums: list[int]
    cov: np.ndarray
    axes: np.ndarray            # dim x component, unit length
    variances: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        return np.array([round_half(s, self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """n * (mean - centre), exactly."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.variances]


def round_half(total: int, n: int) -> int:
    """total / n to the next integer, for whole numbers of any size."""
    return (2 * total + n) // (2 * n)


def covariance(squares: dict[tuple[int, int], int], rest: list[int], n: int) -> np.ndarray:
    """The covariance matrix, divisor n, each entry the exact fraction rounded once.

    ``squares`` sums squares about the integer centre; n * square - rest ** 2 is n * n times the variance.
    """
    d = len(rest)
    spread = {(i, j): n * v - (rest[i] + (rest[j] if i != j else 0)) ** 2 for (i, j), v in squares.items()}
    out = np.zeros((d, d))
    for (i, j), v in spread.items():
        if i == j:
            out[i, i] = v / (n * n)
        else:
            out[i, j] = out[j, i] = (v - spread[i, i] - spread[j, j]) / (2 * n * n)
    return out


def fit(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Fit on all vectors of ``column`` without null or non-finite entries.

    The vectors are those of the commonest length (of ties the longest); others count as having missing entries.
    Directions without variance are left out, so there may be fewer components than asked for, or none: no rows,
    one row and equal rows give none. An entry beyond ``FAR`` / ``SCALE`` counts as that.
    """
    vectors = _vectors(df, column)
    sums = store(_sums(vectors), "whitening-sums")
    most = sums.filter("dim = -1").orderBy(F.desc("total"), F.desc("size")).first()
    if most is None or most["size"] == 0:
        return Whitening(int(most["total"]) if most else 0, [], np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0), 0.0)
    n, d = int(most["total"]), most["size"]
    found = {r["dim"]: int(r["total"]) for r in sums.filter((F.col("size") == d) & (F.col("dim") >= 0)).collect()}
    model = Whitening(n, [found[i] for i in range(d)], np.zeros((d, d)), np.zeros((d, 0)), np.zeros(0), 0.0)
    squares = {(r["i"], r["j"]): int(r["total"]) for r in _squares(vectors, model.centre).collect()}
    model.cov = covariance(squares, model.rest, n)
    values, axes = np.linalg.eigh(model.cov)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(components, int((values > max(0.0, FLAT * values[0])).sum()))
    top = np.abs(axes[:, :kept]).argmax(axis=0)
    model.axes = axes[:, :kept] * np.where(axes[top, range(kept)] < 0, -1.0, 1.0)     # the largest entry is positive
    model.variances, model.trace = values[:kept].copy(), float(np.trace(model.cov))
    return model


def _project(x: np.ndarray, rest: np.ndarray, turn: np.ndarray) -> np.ndarray:
    return (x - rest) @ turn


def _deviations(x: np.ndarray, rest: list[int], n: int) -> list[int]:
    """Exact sums over dimensions of (n * x - S) ** 2, of centred integers."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, rest), default=0)
    off = (x if most * most * max(1, len(rest)) < 1 << 62 else x.astype(object)) * n - np.array(rest, object if most >= 1 << 31 else np.int64)
    return [int(v) for v in (off * off).sum(axis=1)]


def whiten(df: DataFrame, model: Whitening, column: str = "embedding") -> DataFrame:
    """The rows of ``df`` whose vector is usable, with ``deviation`` (decimal) and ``whitened`` (one double per component).

    deviation is the exact sum over dimensions of (n * x - sum) ** 2. Other columns pass through, whatever they
    are called but those two; repeated rows come out as often as they come in.
    """
    d, n = len(model.sums), model.n
    centre, rest = (model.centre, model.rest) if d else (np.zeros(0, np.int64), [])
    shift = np.array([r / n for r in rest])
    turn = model.axes / np.sqrt(model.variances) if d else np.zeros((0, 0))
    width = turn.shape[1]
    held = stash(df, v=F.col(f"`{column}`").cast("array<double>"))
    kinds = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(df.schema)]
    names = [f"c{i}" for i in range(len(df.columns))] + ["deviation", "whitened"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, entries in matrices(batch.column("v")):
                if entries.shape[1] != d:
                    continue
                x = grid(entries) - centre
                white = _project(x, shift, turn)
                kept = batch.select(names[:-2]).take(pa.array(rows))
                ends = pa.array(np.arange(len(rows) + 1) * width, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    *kept.columns, pa.array([Decimal(v) for v in _deviations(x, rest, n)], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(ends, pa.array(white.ravel(), pa.float64()))], names=names)

    out = held.mapInArrow(run, ", ".join([*kinds, "deviation decimal(38,0), whitened array<double>"]))
    return out.select(*[F.col(f"c{i}").alias(f"{c}") for i, c in enumerate(df.columns)], "deviation", "whitened")


def identity_error(df: DataFrame, model: Whitening, column: str = "embedding") -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, measured on all of them."""
    width, d = len(model.variances), len(model.sums)
    if not width:
        return 0.0
    centre, shift = model.centre, np.array([r / model.n for r in model.rest])
    turn = model.axes / np.sqrt(model.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            for _, entries in matrices(batch.column(0)):
                if entries.shape[1] == d:
                    white = _project(grid(entries) - centre, shift, turn)
                    total += white.sum(axis=0)
                    products += white.T @ white
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate((np.full(width, -1), i)), pa.int32()), pa.array(np.concatenate((np.arange(width), j)), pa.int32()),
            pa.array(np.concatenate((total, products[i, j])))], names=["i", "j", "total"])

    found = _vectors(df, column).mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    sums = {(r["i"], r["j"]): r["total"] / model.n for r in found.collect()}
    return max(abs(v - sums[-1, i] * sums[-1, j] - (i == j)) for (i, j), v in sums.items() if i >= 0)


def components(df: DataFrame, model: Whitening, *keys: str, column: str = "embedding") -> DataFrame:
    """(keys, component, n, deviation, whitened, explained, identity_error): a row for each usable row and component from 1."""
    shares = F.array(*[F.lit(v) for v in model.explained]).cast("array<double>")
    rows = whiten(df.select(*keys, column), model, column)
    out = rows.select(*keys, "deviation", F.posexplode("whitened").alias("component", "white"))
    return out.select(
        *keys, (F.col("component") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
        F.col("white").alias("whitened"), F.get(shares, F.col("component")).alias("explained"),
        F.lit(identity_error(df, model, column)).alias("identity_error"))
