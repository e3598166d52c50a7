"""Web events, purchase layer.

A purchase line is a purchase event beside one of its items. An event recorded
``n`` times matches the items of all its copies, so its lines come out ``n``
times each. Lines are therefore a bag: kept once with a ``copies`` weight.
Aggregates multiply by the weight, tables made from lines carry it on, and all
stay linear in the input. ``functions.unrolled`` gives the rows of such a table
to whoever asks for each of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    array_fields,
    event_key,
    item_count,
    param_max,
    parse_day,
    repeat_rows,
    safe_divide,
    steady_sum,
    sunday_of,
)
from tidemark.operators.web_sessions import distinct_events

LINE_COLUMNS = [
    "transaction_id", "user_pseudo_id", "event_date", "purchase_ts", "total_revenue", "currency",
    "product_key", "item_id", "item_name", "item_brand", "item_category",
    "quantity", "unit_price", "item_revenue",
    "is_valid_transaction", "has_items", "is_complete",
]


def int_purchase(events: DataFrame) -> DataFrame:
    """Purchases that carry a transaction id, one row per recorded event."""
    bought = distinct_events(events.filter(F.col("event_name") == "purchase"))
    return repeat_rows(
        bought.filter(F.col("transaction_id").isNotNull()).select(
            "transaction_id", "user_pseudo_id", "ga_session_id",
            F.col("event_ts").alias("purchase_ts"), F.col("value").alias("revenue"), "currency", "copies",
        ),
        "copies",
    )


LINE_FIELDS = ["item_id", "item_name", "item_brand", "item_category", "price", "quantity"]


def _purchase_key() -> Column:
    """One key that is never NULL: the event, or the anonymous row, on its day."""
    anonymous = F.concat_ws(
        "|", F.lit("no-id"), F.coalesce("user_pseudo_id", F.lit("")), F.col("event_timestamp").cast("string")
    )
    return F.concat_ws("|", F.coalesce(event_key(), anonymous), "event_date")


def purchase_lines(events: DataFrame, unique_ids: bool = False, items: DataFrame | None = None) -> DataFrame:
    """Weighted purchase lines: the published columns plus event_id, ga_session_id and copies.

    Both sides of the join come from purchase events only. The fold combines on
    the map side; grouping it by event and day, while the join uses the event,
    puts an exchange on both sides of the join, which is what lets adaptive
    execution split an event that holds a large share of all rows. With item
    rows (``items``) no event's items ever meet in one array.
    """
    bought = events.filter(F.col("event_name") == "purchase")
    identified = F.col("event_id").isNotNull()

    # Everything that reads a nested column sits directly above the scan, so it can prune fields.
    base = bought.select(
        event_key().alias("event_id"),
        "event_date",
        "event_timestamp",
        "user_pseudo_id",
        _purchase_key().alias("_key"),
        param_max("transaction_id", "string_value").alias("transaction"),
        param_max("value", "double_value", "float_value").alias("amount"),
        param_max("currency", "string_value").alias("currency"),
        param_max("ga_session_id", "int_value").alias("session"),
        *([array_fields("items", *LINE_FIELDS).alias("items")] if items is None else []),
        item_count(events).alias("_n"),
    )
    rows = base.select(
        "_key",
        "event_id",
        parse_day("event_date").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("purchase_ts"),
        "user_pseudo_id",
        F.when(identified, F.col("transaction")).alias("_transaction"),
        F.when(identified, F.col("amount")).alias("total_revenue"),
        F.when(identified, F.col("currency")).alias("currency"),
        F.when(identified, F.col("session")).alias("ga_session_id"),
        *(["items"] if items is None else []),
        "_n",
    )
    header = ["event_id", "purchase_ts", "user_pseudo_id", "_transaction", "total_revenue", "currency", "ga_session_id"]
    exploded = ["_key", F.posexplode_outer("items").alias("_pos", "i")]
    matched = identified & F.col("_pos").isNotNull()
    alone = ~identified & F.coalesce(F.col("_pos") == 0, F.lit(True))
    if unique_ids and items is None:
        weight = F.when(matched | alone | F.col("_pos").isNull(), F.lit(1))
        lines = rows.select(*exploded, "event_date", *header)
    else:
        purchases = rows.groupBy("_key", "event_date").agg(
            *[F.max(name).alias(name) for name in header],
            F.sum("_n").alias("_items"),
            F.count("*").alias("_copies"),
        )
        if items is None:
            # A copy without items only counts when no copy has any.
            weight = F.when(matched, F.col("_copies")).when(alone | (identified & (F.col("_items") == 0)), F.lit(1))
            lines = rows.select(*exploded).join(purchases, "_key")
        else:
            weight = F.col("_copies")
            item = F.struct(*[F.col(f"item.{f}").alias(f) for f in LINE_FIELDS]).alias("i")
            known = items.filter((F.col("event_name") == "purchase") & event_key().isNotNull()).select(_purchase_key().alias("_key"), item)
            bare = purchases.filter(~identified | (F.col("_items") == 0))
            lines = known.join(purchases, "_key").unionByName(bare, allowMissingColumns=True)
    lines = lines.withColumn("copies", weight.cast("bigint")).filter(F.col("copies") > 0)

    def item(field):
        return F.when(identified, F.col(f"i.{field}"))

    product_key = F.coalesce(item("item_id"), item("item_name"))
    valid = F.col("_transaction").isNotNull()
    return lines.select(
        F.coalesce("_transaction", F.concat(F.lit("MISSING_"), F.col("event_id"))).alias("transaction_id"),
        "user_pseudo_id",
        "event_date",
        "purchase_ts",
        "total_revenue",
        "currency",
        product_key.alias("product_key"),
        item("item_id").alias("item_id"),
        item("item_name").alias("item_name"),
        item("item_brand").alias("item_brand"),
        item("item_category").alias("item_category"),
        F.coalesce(item("quantity"), F.lit(0)).alias("quantity"),
        item("price").alias("unit_price"),
        F.coalesce(item("price") * item("quantity"), F.lit(0.0)).alias("item_revenue"),
        valid.alias("is_valid_transaction"),
        product_key.isNotNull().alias("has_items"),
        (valid & product_key.isNotNull()).alias("is_complete"),
        "event_id",
        "ga_session_id",
        "copies",
    )


def int_purchase_items(lines: DataFrame) -> DataFrame:
    """The published line columns; ``copies`` says how often a line stands in the table."""
    return lines.select(*LINE_COLUMNS, "copies")


def dim_items(lines: DataFrame) -> DataFrame:
    """Item attributes of every complete line, weighted by ``copies``."""
    return lines.filter("is_valid_transaction AND has_items").select(
        "transaction_id", "item_id", "item_name", "item_brand", "item_category",
        F.col("unit_price").alias("price"), "copies",
    )


def dim_products(lines: DataFrame) -> DataFrame:
    """Distinct product attributes; one product key may appear with several."""
    return (
        lines.filter("has_items")
        .select("product_key", "item_id", "item_name", "item_brand", "item_category")
        .distinct()
    )


def _purchase_grain(lines: DataFrame, *extra: str) -> DataFrame:
    return lines.filter("is_complete").groupBy(
        "transaction_id", "user_pseudo_id", "event_date", "purchase_ts", "currency", "total_revenue", *extra
    )


def fct_purchases(lines: DataFrame) -> DataFrame:
    """One row per complete purchase."""
    return _purchase_grain(lines).agg(
        F.sum("copies").alias("items_count"),
        F.sum(F.col("quantity") * F.col("copies")).alias("total_quantity"),
    )


def session_commerce(lines: DataFrame, user_scoped: bool = False) -> DataFrame:
    """Transactions and revenue per client session id (and user, on request), from complete purchases."""
    keys = ["session_id", "user_pseudo_id"] if user_scoped else ["session_id"]
    return (
        _purchase_grain(lines.withColumnRenamed("ga_session_id", "session_id"), "session_id").agg(F.lit(1).alias("_one"))
        .groupBy(*keys)
        .agg(
            F.count_distinct("transaction_id").alias("total_transactions"),
            steady_sum("total_revenue").alias("total_revenue"),
        )
    )


def agg_daily_product_revenue(lines: DataFrame) -> DataFrame:
    """Transactions, units, revenue and mean price per day and product."""
    copies = F.col("copies")
    priced = F.when(F.col("unit_price").isNotNull(), copies)
    return (
        lines.filter("is_complete")
        .groupBy("event_date", "product_key", "item_name", "item_brand", "item_category")
        .agg(
            F.count_distinct("transaction_id").alias("transactions"),
            F.sum(F.col("quantity") * copies).alias("units_sold"),
            steady_sum(F.col("item_revenue") * copies).alias("total_revenue"),
            safe_divide(steady_sum(F.col("unit_price") * copies), F.sum(priced)).alias("avg_unit_price"),
        )
    )


def analysis_incomplete_purchases(lines: DataFrame) -> DataFrame:
    """Incomplete lines, weighted by ``copies``, beside the totals of their day.

    The day totals are broadcast: they hold at most one row per calendar day.
    """
    incomplete = lines.filter("NOT is_complete").select(
        "transaction_id", "user_pseudo_id", "event_date", "purchase_ts", "total_revenue", "currency",
        "product_key", "item_name", "quantity", "item_revenue",
        "is_valid_transaction", "has_items", "is_complete", "copies",
    )
    per_day = incomplete.groupBy("event_date").agg(
        F.sum("copies").alias("daily_incomplete_count"),
        steady_sum(F.coalesce("total_revenue", F.lit(0.0)) * F.col("copies")).alias("daily_potential_revenue"),
    )
    return incomplete.join(F.broadcast(per_day), "event_date", "left").select(
        *[c for c in incomplete.columns if c != "copies"], "daily_incomplete_count", "daily_potential_revenue", "copies"
    )


def rpt_purchase_dq(lines: DataFrame) -> DataFrame:
    """Lines that cannot be used for analytics, weighted by ``copies``, with the reason."""
    reason = (
        F.when(~F.col("is_valid_transaction") & ~F.col("has_items"), "MISSING_BOTH")
        .when(~F.col("is_valid_transaction"), "MISSING_TRANSACTION_ID")
        .otherwise("MISSING_ITEMS")
    )
    return lines.filter("NOT is_complete").select(
        "transaction_id", "user_pseudo_id", "event_date", "event_id",
        reason.alias("invalid_reason"), "item_name",
        F.col("item_revenue").alias("estimated_revenue"), "quantity", "copies",
    )


def dim_product_daily(events: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Views, cart additions, checkouts, purchases and revenue per day and item; ``items`` are item rows."""
    # The event names that concern an item.
    actions = {
        "item_views": "view_item",
        "item_add_to_carts": "add_to_cart",
        "item_checkouts": "begin_checkout",
        "item_purchases": "purchase",
    }
    earned = F.coalesce("i.item_revenue", F.col("i.price") * F.col("i.quantity"), F.lit(0.0))
    day = parse_day("event_date").alias("event_date")
    if items is None:
        nested = events.filter(F.col("event_name").isin(*actions.values())).select(
            day, "event_name", array_fields("items", *LINE_FIELDS, "item_revenue").alias("items"))
        rows = nested.select("event_date", "event_name", F.explode("items").alias("i"))
    else:
        rows = items.filter(F.col("event_name").isin(*actions.values())).select(day, "event_name", F.col("item").alias("i"))
    shown = rows.select(
        "event_date", "event_name", "i.item_id", "i.item_name", "i.item_brand", "i.item_category",
        F.when(F.col("event_name") == "purchase", earned).otherwise(F.lit(0.0)).alias("amount"),
    )
    return shown.groupBy("event_date", "item_id", "item_name", "item_brand", "item_category").agg(
        *[F.count_if(F.col("event_name") == name).alias(column) for column, name in actions.items()],
        steady_sum("amount").alias("item_revenue"),
    )


def filter_loss_audit(events: DataFrame) -> DataFrame:
    """How many events each filtering step keeps, as a small report.

    All counts come from one pass over the folded events and are then turned
    into report rows.
    """
    folded = distinct_events(events, keep_unidentified=True)
    identified = F.col("event_id").isNotNull()
    bought = F.col("event_name") == "purchase"
    copies = F.col("copies")
    counts = folded.agg(
        F.sum(F.when(bought, copies).otherwise(0)).alias("purchases"),
        F.count_if(bought & identified & F.col("transaction_id").isNotNull()).alias("with_transaction"),
        F.count_if(bought & identified & (F.col("items") > 0)).alias("with_items"),
        F.sum(F.when(bought, copies * F.greatest("items", F.lit(1))).otherwise(0)).alias("line_rows"),
        F.sum(copies).alias("events"),
        F.sum(F.when(F.col("ga_session_id").isNull(), copies).otherwise(0)).alias("without_session"),
    )
    # The report's labels, in report order.
    return counts.selectExpr(
        """stack(8,
          1, 'Total Purchase Events (stg_events)', purchases,
          2, 'Purchase Events with Transaction ID', with_transaction,
          3, 'Purchase Events with Items', with_items,
          4, 'Final Purchase Item Rows (int_purchase_items)', line_rows,
          5, '------- SESSION ANALYSIS -------', CAST(NULL AS BIGINT),
          6, 'Total Events (stg_events)', events,
          7, 'Events Missing ga_session_id (filtered out)', without_session,
          8, 'Events with Session ID (included in int_sessions)', events - without_session
        ) AS (position, metric, count)"""
    )


def incomplete_by_os(events: DataFrame) -> DataFrame:
    """Purchase events without a transaction id or items, per operating system."""
    folded = _completeness(distinct_events(events.filter(F.col("event_name") == "purchase"),
                                           touch=("operating_system",), keep_unidentified=True))
    return (
        folded.filter("NOT is_complete")
        .groupBy(F.col("touch.operating_system").alias("operating_system"))
        .agg(F.sum("copies").alias("incomplete_purchases"))
    )


def incomplete_by_week(events: DataFrame) -> DataFrame:
    """Incomplete purchase events and the revenue they carry, per week starting on Sunday."""
    folded = _completeness(distinct_events(events.filter(F.col("event_name") == "purchase"), keep_unidentified=True))
    return (
        folded.filter("NOT is_complete")
        .groupBy(sunday_of("event_date").alias("week_start"))
        .agg(
            F.sum("copies").alias("incomplete_purchases"),
            F.coalesce(steady_sum(F.col("value") * F.col("copies")), F.lit(0.0)).alias("revenue_lost"),
        )
    )


def purchase_completeness(events: DataFrame) -> DataFrame:
    """Headline figures: how many purchases are usable and what the rest is worth."""
    folded = _completeness(distinct_events(events.filter(F.col("event_name") == "purchase"), keep_unidentified=True))
    copies, incomplete = F.col("copies"), ~F.col("is_complete")

    def weigh(condition):
        return F.coalesce(F.sum(F.when(condition, copies)), F.lit(0))

    return folded.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("purchase_events"),
        weigh(F.col("is_complete")).alias("complete_events"),
        weigh(F.col("transaction_id").isNull()).alias("missing_transaction_id"),
        weigh(F.col("items") == 0).alias("missing_items"),
        F.coalesce(steady_sum(F.when(incomplete, F.col("value") * copies)), F.lit(0.0)).alias("revenue_at_risk"),
        F.count_distinct(F.when(incomplete, F.col("user_pseudo_id"))).alias("users_affected"),
    ).withColumn(
        "complete_pct",
        F.round(F.try_divide(F.col("complete_events"), F.col("purchase_events")) * 100, 2),
    )


def _completeness(purchases: DataFrame) -> DataFrame:
    return purchases.withColumn("is_complete", F.col("transaction_id").isNotNull() & (F.col("items") > 0))
