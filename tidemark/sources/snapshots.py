"""Choosing snapshot files by the time in their path: ``.../YYYY/MM/DD/HHMMSS.json``.

The path is an ordinary column, so choosing files is a filter over the listing,
not a loop on the driver.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PATH = "source_file"
_TIMED = r"/(\d{4})/(\d{1,2})/(\d{1,2})/(\d{2})(\d{2})(\d{0,2})\d*\.[^/]*$"
# Root, source folder, three date folders and a file name.
_DATED_FOLDERS = r"(^|/)[^/]+/[^/]+/[^/]+/[^/]+$"


def path_time(path: Column | str = PATH, seconds: bool = True) -> Column:
    """Time named by a path, or NULL when it names none (also for impossible dates)."""
    path = F.col(path) if isinstance(path, str) else path
    part = [F.regexp_extract(path, _TIMED, i) for i in range(1, 7)]
    second = F.when(part[5] == "", F.lit("00")).otherwise(F.lpad(part[5], 2, "0")) if seconds else F.lit("00")
    text = F.concat(
        part[0], F.lit("-"), F.lpad(part[1], 2, "0"), F.lit("-"), F.lpad(part[2], 2, "0"),
        F.lit(" "), part[3], F.lit(":"), part[4], F.lit(":"), second,
    )
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def list_files(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """Files below ``root`` as rows of one path column; their contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        .load(root).select(F.col("path").alias(PATH))
    )


def _newest(path: str) -> Column:
    return F.max(F.struct(path_time(path).alias("at"), F.col(path).alias("path")))


def latest_snapshot(files: DataFrame, path: str = PATH) -> DataFrame:
    """Rows of the newest file by its full path time; ties go to the greater path."""
    newest = files.agg(_newest(path).alias("n")).select("n.path").scalar()
    return files.filter(F.col(path) == newest)


def in_window(as_of: datetime | str, hours_back: int = 4, path: Column | str = PATH) -> Column:
    """Whether a file is at most ``hours_back`` old at ``as_of``, to the minute, or dated without a readable time.

    It depends on the path alone: as a filter on a read it decides which files are opened.
    """
    path = F.col(path) if isinstance(path, str) else path
    cutoff = F.lit(str(as_of)).cast("timestamp") - F.expr(f"INTERVAL {int(hours_back)} HOURS")
    return F.coalesce(path_time(path, seconds=False) >= cutoff, path.rlike(_DATED_FOLDERS))


def recent_snapshots(files: DataFrame, as_of: datetime | str, hours_back: int = 4, path: str = PATH) -> DataFrame:
    """Rows of files at most ``hours_back`` old at ``as_of``, to the minute.

    Dated paths whose time cannot be read are taken along; if that leaves
    nothing, only the newest file is taken. Both facts are scalar subqueries over
    the paths.
    """
    wanted = in_window(as_of, hours_back, path)
    anything = files.agg(F.bool_or(wanted)).scalar()
    newest = files.agg(_newest(path).alias("n")).select("n.path").scalar()
    return files.filter(wanted | (~anything & (F.col(path) == newest)))
