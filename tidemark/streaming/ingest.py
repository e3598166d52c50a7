"""Incremental file ingestion with Structured Streaming.

The checkpoint remembers which files were taken, so a scheduled run handles the
new ones and stops. Files present before the first run are included.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StructType

ADD_NEW_COLUMNS = "addNewColumns"
RESCUE = "rescue"
FAIL_ON_NEW_COLUMNS = "failOnNewColumns"
RESCUED = "_rescued_data"
# What ingestion itself adds to a table.
LINEAGE = ("source_file", "source_file_mod_time", "ingest_ts", RESCUED)


class NewColumnsError(ValueError):
    """The source grew columns and the caller asked to be told."""


def observed_schema(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> StructType | None:
    """Schema of the files present now, with the columns of all of them; None if there is no file."""
    reader = spark.read.format(fmt).options(**options)
    if fmt in ("parquet", "orc"):
        reader = reader.option("mergeSchema", "true")
    elif fmt == "csv":
        reader = reader.option("inferSchema", "true")
    try:
        return reader.load(path).schema
    except AnalysisException as problem:
        if problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def without(schema: StructType, names: Iterable[str]) -> StructType:
    """A schema less some columns."""
    gone = {n.lower() for n in names}
    return StructType([f for f in schema.fields if f.name.lower() not in gone])


def evolve(known: StructType, observed: StructType, mode: str = ADD_NEW_COLUMNS) -> StructType:
    """Schema for the next run. Known columns keep their type and place."""
    names = {f.name.lower() for f in known.fields}
    new = [f for f in observed.fields if f.name.lower() not in names]
    if not new or mode == RESCUE:
        return known
    if mode == FAIL_ON_NEW_COLUMNS:
        raise NewColumnsError("new columns in source: " + ", ".join(f.name for f in new))
    if mode != ADD_NEW_COLUMNS:
        raise ValueError(f"unknown evolution mode: {mode}")
    return StructType(known.fields + new)


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Stream of new files under ``path`` with where each row came from and when it was taken."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_file_mod_time"),
        F.current_timestamp().alias("ingest_ts"),
    )


def rescuing_json_stream(spark: SparkSession, path: str, schema: StructType, **options: str) -> DataFrame:
    """JSON-lines stream that keeps what does not fit the schema in ``_rescued_data``."""
    lines = spark.readStream.format("text").options(**options).load(path)
    return rescue_json(lines, schema)


def rescue_json(lines: DataFrame, schema: StructType, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse JSON text; what the schema does not hold is kept as a JSON object of path and raw value.

    A path names a field unknown to the schema or of another type, at any depth:
    ``order.coupon``, ``order.items[2].gift``. A line that is no JSON object at
    all is kept whole. ``keep`` names columns of ``lines`` to pass along.
    """
    raw = F.from_json(F.col(text), "map<string,string>")
    typed = F.from_json(F.col(text), schema)
    parsed = lines.withColumns({"_raw": raw, "_typed": typed})
    left = _misfits(F.col("_raw"), F.col("_typed"), schema, F.lit(""))
    rescued = F.when(F.col("_raw").isNull(), F.col(text)).when(F.size("_left") > 0, F.to_json("_left"))
    return parsed.withColumn("_left", left).select("_typed.*", *keep, rescued.alias(RESCUED))


def _misfits(raw: Column, typed: Column, schema: StructType, prefix: Column) -> Column:
    """Path -> raw value of what ``typed`` does not hold of an object given as ``raw`` name -> value."""
    nothing = F.from_json(F.lit("{}"), "map<string,string>")
    held = F.array_compact(F.array(*[F.when(typed[f.name].isNotNull(), F.lit(f.name)) for f in schema.fields]))
    here = F.map_filter(raw, lambda k, v: v.isNotNull() & ~F.array_contains(held, k))
    found = [F.transform_keys(here, lambda k, v: F.concat(prefix, k))]
    for field in schema.fields:
        kind, value, path = field.dataType, raw[field.name], F.concat(prefix, F.lit(field.name))
        if isinstance(kind, StructType):
            inner = _misfits(F.from_json(value, "map<string,string>"), typed[field.name], kind, F.concat(path, F.lit(".")))
            found.append(F.when(typed[field.name].isNotNull(), inner))
        elif isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
            found.append(F.when(typed[field.name].isNotNull(), _list_misfits(value, typed[field.name], kind.elementType, path)))
    return F.map_concat(*[F.coalesce(f, nothing) for f in found])


def _list_misfits(value: Column, typed: Column, schema: StructType, path: Column) -> Column:
    nothing = F.from_json(F.lit("{}"), "map<string,string>")

    def of_element(raw: Column, place: Column) -> Column:
        prefix = F.concat(path, F.lit("["), place.cast("string"), F.lit("]."))
        return F.coalesce(_misfits(raw, F.get(typed, place), schema, prefix), nothing)

    each = F.transform(F.from_json(value, "array<map<string,string>>"), of_element)
    return F.aggregate(each, nothing, lambda whole, one: F.map_concat(whole, one))


def rescue_columns(table: DataFrame, schema: StructType) -> DataFrame:
    """Keep only the known columns; move the others of a wider file into ``_rescued_data``."""
    known = {f.name.lower() for f in schema.fields}
    extra = [c for c in table.columns if c.lower() not in known]
    if not extra:
        return table.withColumn(RESCUED, F.lit(None).cast("string"))
    surplus = reduce(or_, [F.col(c).isNotNull() for c in extra])
    return table.select(
        *[f.name for f in schema.fields], F.when(surplus, F.to_json(F.struct(*extra))).alias(RESCUED)
    )


def trip_bronze(stream: DataFrame) -> DataFrame:
    """Type the pickup time and derive the partition columns the landing folder does not give."""
    typed = stream.withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").try_cast("timestamp"))
    missing = {
        name: part("tpep_pickup_datetime")
        for name, part in (("year", F.year), ("month", F.month))
        if name not in stream.columns
    }
    return typed.withColumns(missing) if missing else typed


def _writer(stream: DataFrame, checkpoint: str, partition_by: list[str], name: str | None,
            fmt: str, trigger: dict | None):
    writer = (
        stream.writeStream.format(fmt).outputMode("append")
        .option("checkpointLocation", checkpoint).option("mergeSchema", "true")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    # An empty trigger means: start the next batch as soon as the last one is done.
    return writer.trigger(**trigger) if trigger else writer


def start_to_path(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
                  name: str | None = None, fmt: str = "parquet", trigger: dict | None = None) -> StreamingQuery:
    """Start writing a stream to files. ``trigger`` is e.g. ``{"processingTime": "5 minutes"}``."""
    return _writer(stream, checkpoint, partition_by or [], name, fmt, trigger).start(path)


def start_to_table(stream: DataFrame, table: str, checkpoint: str, partition_by: list[str] | None = None,
                   name: str | None = None, fmt: str = "parquet", trigger: dict | None = None) -> StreamingQuery:
    """Start writing a stream to a catalog table, created on first use."""
    return _writer(stream, checkpoint, partition_by or [], name, fmt, trigger).toTable(table)


def run_once(query: StreamingQuery) -> None:
    """Wait for a query to finish and surface its failure, if any."""
    query.awaitTermination()
    failure = query.exception()
    if failure is not None:
        raise failure


def ingest_available(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
                     name: str | None = None) -> None:
    """Take everything that is new, write it, stop. Running it again writes nothing."""
    run_once(start_to_path(stream, path, checkpoint, partition_by, name, trigger={"availableNow": True}))
