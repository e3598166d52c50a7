"""Batch sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import schemas

SUFFIX = "event_suffix"
NO_LINE = "\0\0\0\0"    # in no JSON document of any encoding


def web_events(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Event export partitioned by ``event_suffix=YYYYMMDD``, both bounds included.

    The bounds compare as strings against the partition value, so days outside
    the range are never listed for reading.
    """
    schema = schemas.parse(f"{schemas.WEB_EVENT_DDL}, {SUFFIX} STRING")
    return suffix_range(spark.read.schema(schema).parquet(path), start, end)


def suffix_range(events: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    if start is not None:
        events = events.filter(F.col(SUFFIX) >= start)
    if end is not None:
        events = events.filter(F.col(SUFFIX) <= end)
    return events


def commerce_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON lines in the commerce event layout; unknown fields are ignored."""
    return spark.read.schema(schemas.parse(schemas.COMMERCE_EVENT_DDL)).json(path)


def station_status(spark: SparkSession, root: str | list[str], ddl: str = schemas.STATION_STATUS_DDL,
                   pattern: str = "*.json") -> DataFrame:
    """Every status snapshot below ``root``, one row per document, with its file."""
    return _documents(spark, root, ddl, pattern)


def station_info(spark: SparkSession, root: str | list[str], ddl: str = schemas.STATION_INFO_DDL,
                 pattern: str = "*.json") -> DataFrame:
    """Every metadata snapshot below ``root``, one row per document, with its file; ``ddl`` names the fields to keep."""
    return _documents(spark, root, ddl, pattern)


def document_ddl(spark: SparkSession, root: str | list[str], pattern: str = "*.json") -> str:
    """The fields that the documents below ``root`` hold, to be kept and passed to later reads.

    Each file is taken as one line, so that files are dealt over tasks by their size. Inference of multi-line files
    would open all small ones in one task, each with the paths of all others beside it.
    """
    found = spark.read.option("lineSep", NO_LINE).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).json(root)
    return found.select("data").schema.toDDL()


def _documents(spark: SparkSession, root: str | list[str], ddl: str, pattern: str) -> DataFrame:
    # One read for all files under one schema: no per-file inference, no chain of unions.
    return (
        spark.read.schema(schemas.parse(ddl))
        .option("multiLine", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .json(root)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def partitioned_trips(spark: SparkSession, root: str) -> DataFrame:
    """Trips laid out as ``year=*/month=*``; the folder values arrive as ``year`` and ``month``."""
    schema = schemas.parse(f"{schemas.TRIP_DDL}, year INT, month INT")
    return spark.read.schema(schema).option("basePath", root).parquet(f"{root}/year=*/month=*")


def partitioned_weather(spark: SparkSession, root: str) -> DataFrame:
    """Headed weather CSV laid out as ``year=*/month=*``."""
    schema = schemas.parse(f"{schemas.WEATHER_DDL}, year INT, month INT")
    return (
        spark.read.schema(schema).option("header", "true").option("basePath", root).csv(f"{root}/year=*/month=*")
    )


def zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Headed zone lookup CSV."""
    return spark.read.schema(schemas.parse(schemas.ZONE_DDL)).option("header", "true").csv(path)


def with_lineage(table: DataFrame) -> DataFrame:
    """Add where and when each row was read. Only valid directly on a file read."""
    return table.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_file_mod_time"),
        F.current_timestamp().alias("ingest_ts"),
    )
