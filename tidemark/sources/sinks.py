"""Batch sinks and the naming of layers.

Partitioned writes use the REBALANCE hint: rows of one partition value are
brought together so few files are written, while adaptive execution splits a
value that holds a large share of the rows over several tasks.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# How each layer is kept and the schema it lives in.
LAYERS = {
    "staging": ("view", "staging"),
    "intermediate": ("view", "staging"),
    "marts": ("table", "marts"),
}


def balanced(table: DataFrame, *columns: str) -> DataFrame:
    return table.hint("rebalance", *[F.col(c) for c in columns])


def append_partitioned(table: DataFrame, path: str, by: list[str]) -> None:
    balanced(table, *by).write.mode("append").partitionBy(*by).parquet(path)


def overwrite_partitioned(table: DataFrame, path: str, by: list[str], max_records_per_file: int | None = 100_000,
                          dynamic: bool = False) -> None:
    """Replace the whole target, or with ``dynamic`` only the partitions present in ``table``."""
    writer = balanced(table, *by).write.mode("overwrite").partitionBy(*by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(path)


def replace_path_partitions(table: DataFrame, path: str, by: list[str]) -> None:
    """Write into a folder; partitions that ``table`` has rows for are replaced, the others stay."""
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_csv(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    table.write.mode(mode).option("header", "true").csv(path)


def land_json(table: DataFrame, path: str, mode: str = "append", compression: str = "none") -> None:
    """JSON lines; every record ends with a newline. Readers know compressed files by their names."""
    table.write.mode(mode).option("compression", compression).json(path)


def schema_name(custom: str | None, default: str = "default") -> str:
    """A layer's own schema is used as it stands; otherwise the target's default."""
    return custom.strip() if custom else default


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def add_columns(spark: SparkSession, name: str, schema: StructType) -> None:
    """Give a table the columns of ``schema`` that it lacks, so that readers see them."""
    held = {f.name.lower() for f in spark.table(name).schema.fields}
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name.lower() not in held]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")


def ensure_table(spark: SparkSession, name: str, schema: StructType, partition_by: list[str]) -> None:
    """Create a Parquet table with these columns if there is none."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(f"`{c}`" for c in partition_by)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({by})")


@contextmanager
def overwriting(spark: SparkSession, mode: str):
    """Overwrites within replace the whole target ("static") or the partitions at hand ("dynamic").

    The session's setting is used, because an option would become the table's own and bind later writes.
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    held = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, held)


def replace_partitions(table: DataFrame, name: str, by: list[str]) -> None:
    """Write into a catalog table; partitions that ``table`` has rows for are replaced, the others stay."""
    spark = table.sparkSession
    with overwriting(spark, "dynamic"):
        balanced(table, *by).select(*[f"`{c}`" for c in spark.table(name).columns]).write.insertInto(name, overwrite=True)


def replace_table(table: DataFrame, name: str, partition_by: list[str] | None = None,
                  options: dict[str, str] | None = None) -> DataFrame:
    """Create or replace a managed Parquet table and return it as read back."""
    by = partition_by or []
    writer = (balanced(table, *by) if by else table).write.format("parquet").mode("overwrite")
    writer = writer.options(**(options or {}))
    if by:
        writer = writer.partitionBy(*by)
    # A full refresh drops partitions that no longer occur, whatever the session default is.
    with overwriting(table.sparkSession, "static"):
        writer.saveAsTable(name)
    return table.sparkSession.table(name)


def is_table(layer: str, kind: str | None = None) -> bool:
    """Whether a model of this layer is written, rather than kept as a view."""
    return (kind or LAYERS.get(layer, ("view", None))[0]) == "table"


def materialize(table: DataFrame, name: str, layer: str, kind: str | None = None,
                partition_by: list[str] | None = None, default_schema: str = "default", window: bool = False) -> DataFrame:
    """Publish a model as its layer prescribes: a view for early layers, a table for marts.

    With ``window``, the rows are those of some partitions: an existing partitioned table keeps its others.
    """
    layer_kind, layer_schema = LAYERS.get(layer, ("view", None))
    if (kind or layer_kind) == "view":
        table.createOrReplaceTempView(name)
        return table.sparkSession.table(name)
    schema = schema_name(layer_schema, default_schema)
    create_schema(table.sparkSession, schema)
    full = f"`{schema}`.`{name}`"
    if window and partition_by and table.sparkSession.catalog.tableExists(full):
        replace_partitions(table, full, partition_by)
        return table.sparkSession.table(full)
    return replace_table(table, full, partition_by)
