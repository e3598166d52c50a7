"""JSON lines in two tables: typed rows, and the lines that the schema does not hold, to be replayed when it grows.

Below one root are ``schemas`` (one version each), ``typed`` and ``rescued``. A line that fits the current schema
becomes a typed row; any other is kept as it came, beside what of it did not fit. Growing the schema replays the
rescued lines: those that fit now become typed rows, the rest is rescued under the new version. A version counts
once its schema is written, which is a replay's last step. Batches and replays write partitions of their own, so
one that is run again replaces what it had written.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from tidemark.sources import sinks
from tidemark.streaming import batches, ingest

LINE, FILE, VERSION = "_line", "_file", "_version"


class NotGrownError(ValueError):
    """A new schema lacks a field of the old one, or gives it another type."""


def current_schema(spark: SparkSession, root: str) -> tuple[int, StructType] | None:
    """The newest version and its schema; None before the first run."""
    try:
        found = spark.read.parquet(f"{root}/schemas")
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    newest = found.orderBy(F.desc("version")).first()
    return newest["version"], StructType.fromJson(json.loads(newest["schema"]))


def _register(spark: SparkSession, root: str, version: int, schema: StructType) -> None:
    row = spark.createDataFrame([(schema.json(), version)], "schema string, version int").coalesce(1)
    sinks.replace_path_partitions(row, f"{root}/schemas", ["version"])


def require_grown(old: DataType, new: DataType, path: str = "") -> None:
    """Raise unless ``new`` has every field of ``old`` with its type, at any depth."""
    if isinstance(old, StructType) and isinstance(new, StructType):
        fields = {f.name: f.dataType for f in new.fields}
        for f in old.fields:
            if f.name not in fields:
                raise NotGrownError(f"field {path}{f.name} is missing")
            require_grown(f.dataType, fields[f.name], f"{path}{f.name}.")
    elif isinstance(old, ArrayType) and isinstance(new, ArrayType):
        require_grown(old.elementType, new.elementType, path)
    elif old != new:
        raise NotGrownError(f"field {path.rstrip('.')} was {old.simpleString()}, not {new.simpleString()}")


def _split(lines: DataFrame, schema: StructType, root: str, version: int, mark: str) -> None:
    """Write the lines (``_line``, ``_file``) that fit as typed rows, the others as rescued ones."""
    parsed = ingest.rescue_json(lines, schema, LINE, (LINE, FILE)).persist()
    try:
        typed = parsed.filter(F.col(ingest.RESCUED).isNull()).drop(LINE, ingest.RESCUED)
        rescued = parsed.filter(F.col(ingest.RESCUED).isNotNull()).select(LINE, FILE, ingest.RESCUED)
        sinks.replace_path_partitions(typed.withColumn(batches.BATCH, F.lit(mark)), f"{root}/typed", [batches.BATCH])
        sinks.replace_path_partitions(
            rescued.withColumn(VERSION, F.lit(version)).withColumn(batches.BATCH, F.lit(mark)), f"{root}/rescued", [VERSION, batches.BATCH])
    finally:
        parsed.unpersist()


def ingest_json(spark: SparkSession, source: str, root: str, checkpoint: str, schema: StructType | None = None,
                max_files: int = batches.FILES_PER_BATCH, after_write: Callable[[int], None] | None = None) -> None:
    """Take the new files of JSON lines below ``source`` and stop.

    ``schema`` opens a root without versions and is ignored later; ``grow`` changes it. Blank lines are left out.
    Not to be run while ``grow`` runs.
    """
    known = current_schema(spark, root)
    if known is None:
        if schema is None:
            raise ValueError("the first run needs a schema")
        _register(spark, root, 0, schema)
        known = (0, schema)
    version, kept = known

    def take(batch: DataFrame, number: int) -> None:
        _split(batch, kept, root, version, batches.batch_mark(batch.sparkSession, checkpoint, number))
        if after_write:
            after_write(number)

    lines = (
        spark.readStream.format("text").option("maxFilesPerTrigger", max_files).option("maxFileAge", batches.LATE)
        .load(source).filter(F.trim("value") != "").select(F.col("value").alias(LINE), F.col("_metadata.file_path").alias(FILE))
    )
    ingest.run_once(lines.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def grow(spark: SparkSession, root: str, schema: StructType) -> None:
    """Make ``schema`` the current one and replay the rescued lines under it. Existing fields keep their types."""
    version, known = current_schema(spark, root)
    require_grown(known, schema)
    lines = _rescued(spark, root, version).select(LINE, FILE)
    _split(lines, schema, root, version + 1, f"replay-{version + 1:09d}")
    _register(spark, root, version + 1, schema)


def _rescued(spark: SparkSession, root: str, version: int) -> DataFrame:
    kinds = StructType.fromDDL(f"{LINE} STRING, {FILE} STRING, {ingest.RESCUED} STRING, {VERSION} INT, {batches.BATCH} STRING")
    return _table(spark, f"{root}/rescued", kinds).filter(F.col(VERSION) == version)


def _table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def rescued_lines(spark: SparkSession, root: str) -> DataFrame:
    """(_line, _file, _rescued_data, ..): what the current schema does not hold."""
    version, _ = current_schema(spark, root)
    return _rescued(spark, root, version)


def typed_rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows that fit, under the current schema (fields are NULL in rows from before they were known)."""
    version, schema = current_schema(spark, root)
    whole = StructType(schema.fields).add(FILE, "string").add(batches.BATCH, "string")
    done = F.coalesce(F.regexp_extract(batches.BATCH, r"^replay-(\d+)$", 1).try_cast("int"), F.lit(0))
    return _table(spark, f"{root}/typed", whole).filter(done <= version)
