"""Data-quality checks. Each check is one aggregate over its table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Columns declared never NULL, per table.
NOT_NULL = {
    "stg_events": ["event_date", "event_ts", "event_name", "user_pseudo_id"],
    "stg_event_params": ["event_date", "event_ts", "event_name", "user_pseudo_id"],
    "stg_items": ["event_date", "event_ts", "event_name", "user_pseudo_id"],
    "stg_event_param_pivot": ["event_id", "event_date", "event_ts", "user_pseudo_id"],
    "int_purchase_items": ["transaction_id", "purchase_ts"],
    "int_sessions": ["session_key"],
    "dim_views": ["event_date", "total_page_views", "unique_users"],
    "fct_purchases": ["transaction_id", "user_pseudo_id", "purchase_ts"],
    "dim_products": ["product_key"],
    "agg_daily_product_revenue": ["event_date", "product_key"],
    "agg_daily_funnel_long": ["session_date", "stage_order", "stage", "sessions"],
    "agg_daily_sessions": ["session_date", "platform", "operating_system"],
}

# Columns declared unique, per table.
UNIQUE = {"stg_event_param_pivot": "event_id", "dim_views": "event_date"}


class EmptySourceError(ValueError):
    """Raised when a source that must hold data holds none."""


def null_counts(table: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
    """NULLs per checked column as (table_name, column_name, failures), from a single scan."""
    columns = columns or NOT_NULL[name]
    counted = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counted.selectExpr(f"'{name}' AS table_name", f"stack({len(columns)}, {rows}) AS (column_name, failures)")


class Checks:
    """NULL counts taken while tables are written: a watched table counts its rows' NULLs as they flow past.

    ``rows`` holds a count for every watched table once each has been written in full, exactly once.
    """

    def __init__(self) -> None:
        self._held: list[tuple[str, list[str], Observation]] = []

    def watch(self, table: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
        """The same table; to be written instead of it."""
        columns = columns or NOT_NULL[name]
        observation = Observation()
        self._held.append((name, columns, observation))
        return table.observe(observation, *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])

    def rows(self, spark: SparkSession) -> DataFrame:
        """(table_name, column_name, failures); one row per checked column."""
        found = [(name, c, o.get[c]) for name, columns, o in self._held for c in columns]
        return spark.createDataFrame(found, "table_name string, column_name string, failures bigint")


def unique_violations(table: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with how often."""
    return (
        table.filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count("*").alias("occurrences"))
        .filter("occurrences > 1")
    )


def unique_failures(table: DataFrame, name: str, column: str | None = None) -> DataFrame:
    """Number of repeated values as (table_name, column_name, failures)."""
    column = column or UNIQUE[name]
    return unique_violations(table, column).agg(F.count("*").alias("failures")).select(
        F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "failures"
    )


def split_by_rules(table: DataFrame, rules: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the rest with the first broken rule as ``failure_reason``.

    ``rules`` lists (reason, condition that marks a row as broken).
    """
    reason = F.coalesce(*[F.when(F.expr(condition), name) for name, condition in rules])
    judged = table.withColumn("failure_reason", reason)
    return judged.filter("failure_reason IS NULL").drop("failure_reason"), judged.filter("failure_reason IS NOT NULL")


def order_arithmetic(bronze: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Orders whose subtotal, tax or total does not follow from their items."""
    amount = F.aggregate(
        F.coalesce("order.items", F.array()),
        F.lit(0.0),
        lambda total, i: total + F.coalesce(i["product"]["price"] * i["quantity"], F.lit(0.0)),
    )
    orders = bronze.filter(F.col("event_id").isNotNull() & F.col("order").isNotNull()).select(
        "event_id", "order.order_id", "order.subtotal", "order.tax", "order.tax_rate", "order.shipping",
        "order.total_amount", amount.alias("item_amount"),
    )

    def differs(stated: str, expected: Column) -> Column:
        # The extra tenth of a cent absorbs binary fractions.
        return F.coalesce(F.abs(F.col(stated) - F.round(expected, 2)) > tolerance + 0.001, F.lit(True))

    checked = orders.select(
        "event_id", "order_id", "subtotal", "tax", "total_amount",
        differs("subtotal", F.col("item_amount")).alias("bad_subtotal"),
        differs("tax", F.col("subtotal") * F.col("tax_rate")).alias("bad_tax"),
        differs("total_amount", F.col("subtotal") + F.col("tax") + F.col("shipping")).alias("bad_total"),
    )
    return checked.filter("bad_subtotal OR bad_tax OR bad_total")


def require_rows(table: DataFrame, source: str) -> DataFrame:
    """Fail early when a source is empty; looks at one row only."""
    if table.isEmpty():
        raise EmptySourceError(f"no data found in {source}")
    return table
