"""Session settings every job in this package relies on.

Nothing is sized by hand: adaptive execution chooses partition counts, join
strategies and skew splits from the sizes it measures at run time.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or fetch) a session; ``master`` is only for local runs and tests."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the clock of a session somebody else created."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_private: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a session whose tasks all run in this process may leave it unset and
    gets a private temporary folder. On a cluster each executor would write to
    its own disk and readers would miss files, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not one_process(spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _private:
        _private[application] = tempfile.mkdtemp(prefix="tidemark-")
    return _private[application]


def one_process(master: str) -> bool:
    return master == "local" or master.startswith("local[")
