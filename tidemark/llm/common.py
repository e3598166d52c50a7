"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a session on a local master may go without one; it gets a temporary folder, which all its
    tasks see because they run in one process. On a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = getattr(spark, "_llm_shared_dir", None)
    if made is None:
        made = spark._llm_shared_dir = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    return made


def fresh_path(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint: what follows survives the loss of any executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def store(df: DataFrame, what: str) -> DataFrame:
    """Write the rows to a Parquet table in the shared folder and read them back (for wide rows)."""
    path = fresh_path(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """128 bits that stand for a text (null counts as empty); equal for equal texts."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def crc_fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def share_of_hashes(rows: int, among: int) -> Column:
    """The largest 64-bit hash to take so that of ``among`` rows about ``rows`` are taken (all, if there are fewer)."""
    return F.lit(min(2 ** 63 - 1, -2 ** 63 + 2 ** 64 * rows // max(1, among)))


def bare(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns named: extra columns of the input cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def stash(docs: DataFrame, **own: Column) -> DataFrame:
    """``docs`` with its columns renamed to c0, c1, .. beside an operator's ``own``, so that no names clash."""
    held = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    return docs.select(*held, *[c.alias(n) for n, c in own.items()])


def unstash(held: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their names again, nothing else."""
    return held.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
