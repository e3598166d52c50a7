"""Bike-station feed: snapshot documents to dated station readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_stations(documents: DataFrame, *keep: str) -> DataFrame:
    """One row per station of every snapshot; empty snapshots disappear."""
    return documents.select(*keep, F.inline("data.stations"))


def status_readings(documents: DataFrame, missing_as_zero: bool = False, *keep: str) -> DataFrame:
    """Station readings with bike types as columns and a proper reading time.

    A bike type a station does not report stays NULL, or becomes 0 on request.
    """
    def bikes(kind: str) -> Column:
        value = F.col(f"num_bikes_available_types.{kind}")
        return (F.coalesce(value, F.lit(0)) if missing_as_zero else value).alias(kind)

    readings = explode_stations(documents, *keep)
    others = [c for c in readings.columns if c not in ("num_bikes_available_types", "last_reported")]
    return readings.select(
        *others, bikes("electric"), bikes("classic"), F.timestamp_seconds("last_reported").alias("timestamp")
    )


def station_curated(status: DataFrame, info: DataFrame, missing_as_zero: bool = False) -> DataFrame:
    """Readings of known stations with station metadata and date partition columns.

    The partitions follow the reading, not the file it came in. Columns both
    sides share get a suffix. The join is left to Spark, which broadcasts the
    metadata when its measured size allows and splits a busy station otherwise.
    """
    readings = status_readings(status, missing_as_zero)
    stations = explode_stations(info)
    shared = [c for c in stations.columns if c in readings.columns and c != "station_id"]
    stations = stations.withColumnsRenamed({c: f"{c}_info" for c in shared})
    return readings.join(stations, "station_id").withColumns(
        {"year": F.year("timestamp"), "month": F.month("timestamp"), "day": F.dayofmonth("timestamp")}
    )


def once_per_reading(curated: DataFrame) -> DataFrame:
    """Drop readings that overlapping incremental runs delivered more than once.

    Which of several stays is settled by their content, so a rerun keeps the same.
    """
    key = ["station_id", "timestamp"]
    rest = [c for c in curated.columns if c not in key]
    kept = curated.groupBy(*key).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_kept"))
    return kept.select(*key, "_kept.*").select(*[F.col(f"`{c}`") for c in curated.columns])
