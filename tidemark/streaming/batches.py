"""Ingestion in micro-batches that look at their own files.

The stream is one of file names; its checkpoint is the ledger of the files taken, whatever their modification time.
Each batch, of a bounded number of files, infers the schema of exactly the files it is about to read, lets the table
grow, and writes its rows under a partition of its own (``ingest_batch``). A batch that is run again after a crash
has the same files and number, so it replaces what it had written: every row is in the table once.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, NumericType, StringType, StructField, StructType

from tidemark.sources import readers, sinks
from tidemark.streaming import ingest

BATCH = "ingest_batch"
# Columns that ingestion itself adds to a table.
OWN = (*ingest.LINEAGE, BATCH)
FILES_PER_BATCH = 1000
# Spark's file source forgets files this much older than the newest one it has seen, and its default is a week.
LATE = "36500d"


def file_names(spark: SparkSession, path: str, max_files: int = FILES_PER_BATCH, pattern: str = "*",
               late: str = LATE) -> DataFrame:
    """Stream of the files below ``path`` whose names match: names, lengths and times, not their contents.

    ``max_files`` bounds a batch; a file older than the newest one seen by more than ``late`` is never taken.
    """
    return (
        spark.readStream.format("binaryFile").schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).option("maxFileAge", late)
        .option("pathGlobFilter", pattern).load(path).select("path", "length", "modificationTime")
    )


def batch_mark(spark: SparkSession, checkpoint: str, batch: int) -> str:
    """Name of a batch: the stream's id, which lives in its checkpoint, and the batch's number."""
    found = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()
    return f"{found[0]}-{batch:09d}"


def each_batch(spark: SparkSession, source: str, checkpoint: str, take: Callable[[SparkSession, list[str], str], None],
               max_files: int = FILES_PER_BATCH, name: str | None = None, after_write: Callable[[int], None] | None = None,
               pattern: str = "*") -> None:
    """Give the new files below ``source`` to ``take(session, paths, mark)``, ``max_files`` at a time, and stop.

    A batch counts once ``take`` and ``after_write`` (told its number) are through; else it comes again, as it was.
    """
    def run(batch: DataFrame, number: int) -> None:
        paths = sorted(r["path"] for r in batch.select("path").collect())       # at most max_files names
        if paths:
            take(batch.sparkSession, paths, batch_mark(batch.sparkSession, checkpoint, number))
            if after_write:
                after_write(number)

    writer = file_names(spark, source, max_files, pattern).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    ingest.run_once((writer.queryName(name) if name else writer).trigger(availableNow=True).start())


def literal_path(path: str) -> str:
    """A file's name as a path that means just this file."""
    return re.sub(r"([\\{}\[\]*?,])", r"\\\1", path)


def same_schema_groups(spark: SparkSession, paths: list[str], base: str) -> list[DataFrame]:
    """The files as read with their own types: in one go, or by schema where types differ between files."""
    reader = spark.read.option("basePath", base)
    try:
        return [reader.option("mergeSchema", "true").parquet(*map(literal_path, paths))]
    except (PySparkException, Py4JJavaError) as problem:
        if "CANNOT_MERGE_SCHEMAS" not in str(problem):
            raise
    kinds: dict[str, list[str]] = {}
    for path in paths:
        kinds.setdefault(reader.parquet(literal_path(path)).schema.json(), []).append(path)
    return [reader.parquet(*map(literal_path, same)) for same in kinds.values()]


def conform(table: DataFrame, known: StructType) -> DataFrame:
    """Give ``table`` the columns and types of ``known``; what does not fit is kept as JSON in ``_rescued_data``.

    Rescued are columns that ``known`` lacks and values that another type than the known one cannot take over
    as they are. A column that the table lacks is NULL. Ingestion's own columns pass through.
    """
    present = {f.name.lower(): f for f in table.schema.fields}
    columns, left = [], []
    for field in known.fields:
        own = present.pop(field.name.lower(), None)
        if own is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        raw = F.col(f"`{own.name}`")
        value, fits = _typed(raw, own, field)
        columns.append(value.alias(field.name))
        if fits is not None:
            left.append(F.when(~fits, raw).alias(own.name))
    passed = [f.name for f in present.values() if f.name in OWN]
    left += [F.col(f"`{f.name}`") for f in present.values() if f.name not in OWN]
    if left:
        rescued = F.to_json(F.struct(*left))
        rescued = F.when(rescued != "{}", rescued)
    else:
        rescued = F.lit(None).cast("string")
    return table.select(*columns, *passed, rescued.alias(ingest.RESCUED))


def _typed(raw: Column, own: StructField, field: StructField) -> tuple[Column, Column | None]:
    """The value under the known type, and whether it says the same (None: always)."""
    if own.dataType == field.dataType:
        return raw, None
    if not (isinstance(own.dataType, AtomicType) and isinstance(field.dataType, AtomicType)):
        return F.lit(None).cast(field.dataType), raw.isNull()
    if isinstance(field.dataType, StringType):
        return raw.cast("string"), None
    try:
        value = raw.try_cast(field.dataType)
        SparkSession.active().range(0).select(F.lit(None).cast(own.dataType).try_cast(field.dataType)).schema
    except AnalysisException:       # no cast between these types
        return F.lit(None).cast(field.dataType), raw.isNull()
    if isinstance(own.dataType, NumericType) and isinstance(field.dataType, NumericType):
        # A number that another type cuts or rounds does not fit it.
        fits = raw.isNull() | F.coalesce(value.try_cast(own.dataType) == raw, F.lit(False))
        return F.when(fits, value), fits
    return value, raw.isNull() | value.isNotNull()


def wider(known: StructType, groups: list[DataFrame], mode: str) -> StructType:
    """The known schema grown by the groups' columns, as ``mode`` allows."""
    for table in groups:
        known = ingest.evolve(known, ingest.without(table.schema, OWN), mode)
    return known


def ingest_files(spark: SparkSession, source: str, table: str, checkpoint: str, partition_by: list[str],
                 prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows, derived: tuple[str, ...] = (),
                 mode: str = ingest.ADD_NEW_COLUMNS, name: str | None = None, max_files: int = FILES_PER_BATCH,
                 after_write: Callable[[int], None] | None = None) -> None:
    """Take the new Parquet files below ``source`` into a catalog table and stop.

    ``prepare`` may set types and add the columns named in ``derived`` where the files do not give them. New columns
    are added to the table (``addNewColumns``), kept in ``_rescued_data`` (``rescue``) or refused with
    ``NewColumnsError`` (``failOnNewColumns``), in which case the batch stays to be taken. ``after_write`` is told each
    batch's number before it is committed.
    """
    refused: list[ingest.NewColumnsError] = []

    def take(session: SparkSession, paths: list[str], mark: str) -> None:
        groups = [readers.with_lineage(g) for g in same_schema_groups(session, paths, source)]
        exists = session.catalog.tableExists(table)
        known = ingest.without(session.table(table).schema if exists else prepare(groups[0]).schema, OWN)
        try:
            known = wider(known, groups, mode if exists else ingest.ADD_NEW_COLUMNS)
        except ingest.NewColumnsError as problem:
            refused.append(problem)
            raise
        rows = [_prepared(g, known, prepare, derived) for g in groups]
        out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
        out = out.withColumn(BATCH, F.lit(mark))
        sinks.ensure_table(session, table, out.schema, [*partition_by, BATCH])
        sinks.add_columns(session, table, out.schema)
        sinks.replace_partitions(out, table, [*partition_by, BATCH])

    try:
        each_batch(spark, source, checkpoint, take, max_files, name, after_write)
    except PySparkException as failure:
        if refused:
            raise refused[0] from failure
        raise
    finally:
        # The batches ran in a session of their own; this one may hold the table as it was.
        if spark.catalog.tableExists(table):
            spark.catalog.refreshTable(table)


def _prepared(group: DataFrame, known: StructType, prepare: Callable[[DataFrame], DataFrame], derived: tuple[str, ...]) -> DataFrame:
    given = {c.lower() for c in group.columns}
    return prepare(conform(group, ingest.without(known, [d for d in derived if d not in given])))
