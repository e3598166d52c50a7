"""Commerce events: nested bronze events to a flat, de-duplicated silver table and its dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import parse_iso_timestamp, steady_avg, steady_sum

# Published silver column -> path in the nested event, in published order.
SILVER_COLUMNS = {
    "customer_id": "customer.customer_id",
    "customer_first_name": "customer.first_name",
    "customer_last_name": "customer.last_name",
    "customer_email": "customer.email",
    "customer_country": "customer.country",
    "customer_tax_rate": "customer.tax_rate",
    "channel": "session.channel",
    "device": "session.device",
    "cart_id": "cart.cart_id",
    "abandon_stage": "abandon_stage",
    "order_id": "order.order_id",
    "order_subtotal": "order.subtotal",
    "order_tax": "order.tax",
    "order_tax_rate": "order.tax_rate",
    "order_shipping": "order.shipping",
    "order_total_amount": "order.total_amount",
    "order_status": "order.status",
    "order_created_at_raw": "order.created_at",
    "order_paid_at_raw": "order.paid_at",
    "order_fulfilled_at_raw": "order.fulfilled_at",
    "order_cancelled_at_raw": "order.cancelled_at",
    "order_cancel_reason": "order.cancel_reason",
    "product_id": "item.product.id",
    "product_name": "item.product.name",
    "product_category": "item.product.category",
    "product_price": "item.product.price",
    "quantity": "item.quantity",
}
SILVER_KEY = ["event_id", "product_id", "order_id"]


def item_rows(bronze: DataFrame) -> DataFrame:
    """One row per event and item; an event without items keeps one row with a NULL item.

    The order's list wins over the cart's even when it is empty; a lone product
    counts as a list of one. Events that come as such rows (a column ``item``)
    are taken as they are.
    """
    single = F.when(
        F.col("product").isNotNull(), F.array(F.struct("product", F.lit(1).alias("quantity")))
    )
    typed = bronze.filter(F.col("event_id").isNotNull()).withColumn(
        "event_timestamp", parse_iso_timestamp("event_timestamp")
    )
    if "item" in bronze.columns:
        return typed
    return typed.withColumn("item", F.explode_outer(F.coalesce("order.items", "cart.items", single)))


def commerce_silver(bronze: DataFrame, processed_at: bool = True) -> DataFrame:
    """Flat item rows, one per (event, product, order).

    Which of several rows with one key survives is settled by their content, so
    a recomputed partition always keeps the same one. The fold combines on the
    map side, so a flood of redelivered events collapses before the exchange.
    """
    flat = item_rows(bronze).select(
        "event_id", "event_type", "session_id", "event_timestamp",
        F.to_date("event_timestamp").alias("event_date"),
        *[F.col(path).alias(name) for name, path in SILVER_COLUMNS.items()],
    )
    rest = [name for name in flat.columns if name not in SILVER_KEY]
    kept = flat.groupBy(*SILVER_KEY).agg(F.min(F.struct(*rest)).alias("kept"))
    head = ["event_id", "event_type", "session_id", "event_timestamp", "event_date"]
    silver = kept.select(*SILVER_KEY, "kept.*").select(*head, *SILVER_COLUMNS)
    if not processed_at:
        return silver
    return silver.select(*head, F.current_timestamp().alias("processed_at"), *SILVER_COLUMNS)


def orders_by_country(silver: DataFrame) -> DataFrame:
    """Distinct orders per customer country."""
    return (
        silver.filter(F.col("order_id").isNotNull())
        .groupBy(F.col("customer_country").alias("country"))
        .agg(F.count_distinct("order_id").alias("total_orders"))
    )


def hourly_category_revenue(silver: DataFrame) -> DataFrame:
    """Paid revenue per hour and product category."""
    return (
        silver.filter((F.col("event_type") == "order_paid") & F.col("product_id").isNotNull())
        .groupBy(F.date_trunc("hour", "event_timestamp").alias("hour"), "product_category")
        .agg(
            steady_sum(F.col("product_price") * F.col("quantity")).alias("revenue"),
            F.sum("quantity").alias("units"),
        )
    )


def _paid_orders(silver: DataFrame, *by: str) -> DataFrame:
    # An order's total is repeated on each of its items, and an item on each payment
    # event of the order: take the units once per product and the total once per order.
    per_product = (
        silver.filter((F.col("event_type") == "order_paid") & F.col("order_id").isNotNull())
        .groupBy(*by, "order_id", "product_id")
        .agg(F.max("order_total_amount").alias("order_total"), F.max("quantity").alias("units"))
    )
    return per_product.groupBy(*by, "order_id").agg(
        F.max("order_total").alias("order_total"), F.sum("units").alias("units"))


def customer_ltv(silver: DataFrame) -> DataFrame:
    """Lifetime value per customer: paid order totals and units bought."""
    return (
        _paid_orders(silver, "customer_id")
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("orders"),
            steady_sum("order_total").alias("lifetime_value"),
            F.sum("units").alias("total_quantity"),
        )
    )


def event_funnel_counts(silver: DataFrame) -> DataFrame:
    """Distinct events per event type."""
    return silver.groupBy("event_type").agg(F.count_distinct("event_id").alias("events"))


def channel_performance(silver: DataFrame) -> DataFrame:
    """Paid orders and revenue per acquisition channel."""
    return (
        _paid_orders(silver, "channel")
        .groupBy("channel")
        .agg(F.count("*").alias("orders"), steady_sum("order_total").alias("revenue"))
    )


def average_order_value(silver: DataFrame) -> DataFrame:
    """Mean paid order total per customer country."""
    return (
        _paid_orders(silver, "customer_country")
        .groupBy(F.col("customer_country").alias("country"))
        .agg(F.count("*").alias("orders"), steady_avg("order_total").alias("avg_order_value"))
    )
