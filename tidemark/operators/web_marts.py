"""Web events, marts and reports built on session rows and purchase lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import event_key, first_param, loose, safe_divide, steady_avg, steady_sum
from tidemark.operators.web_purchases import session_commerce


def agg_daily_sessions(sessions: DataFrame) -> DataFrame:
    """Daily session metrics per platform, system, browser and device category."""
    total, converted = F.count("*"), F.count_if("is_converted")
    viewed, carted = F.count_if(F.col("product_views") > 0), F.count_if(F.col("add_to_carts") > 0)
    started = F.count_if(F.col("checkouts_started") > 0)
    bounced, revenue = F.count_if("is_bounce"), steady_sum("session_revenue")
    new, returning = F.count_if("is_first_session"), F.count_if(~F.col("is_first_session"))
    return sessions.groupBy("session_date", "platform", "operating_system", "browser", "device_category").agg(
        total.alias("total_sessions"),
        F.count_distinct("user_pseudo_id").alias("unique_users"),
        new.alias("new_user_sessions"),
        returning.alias("returning_user_sessions"),
        F.avg("session_duration_seconds").alias("avg_session_duration_seconds"),
        F.avg("page_views").alias("avg_pages_per_session"),
        F.sum("page_views").alias("total_page_views"),
        bounced.alias("bounced_sessions"),
        safe_divide(bounced, total).alias("bounce_rate"),
        viewed.alias("sessions_with_product_views"),
        carted.alias("sessions_with_add_to_cart"),
        started.alias("sessions_with_checkout"),
        converted.alias("converted_sessions"),
        safe_divide(converted, total).alias("session_conversion_rate"),
        safe_divide(carted, viewed).alias("add_to_cart_rate"),
        safe_divide(converted, started).alias("checkout_completion_rate"),
        revenue.alias("total_revenue"),
        steady_avg(F.when(F.col("is_converted"), F.col("session_revenue"))).alias("avg_order_value"),
        safe_divide(revenue, total).alias("revenue_per_session"),
        safe_divide(returning, new).alias("returning_to_new_ratio"),
    )


def agg_daily_funnel_long(daily_sessions: DataFrame) -> DataFrame:
    """The four funnel counts of every daily row as rows, from one pass over it."""
    # Stage order and label.
    return daily_sessions.selectExpr(
        "session_date",
        """stack(4,
             1, 'Product views', sessions_with_product_views,
             2, 'Add to cart', sessions_with_add_to_cart,
             3, 'Checkout', sessions_with_checkout,
             4, 'Purchase', converted_sessions
           ) AS (stage_order, stage, sessions)""",
    )


def agg_weekly_dropoff_rates(daily_sessions: DataFrame) -> DataFrame:
    """Share of sessions lost between funnel steps, per week starting on Monday."""
    steps = ["sessions_with_product_views", "sessions_with_add_to_cart", "sessions_with_checkout", "converted_sessions"]
    losses = ["dropoff_view_to_cart", "dropoff_cart_to_checkout", "dropoff_checkout_to_purchase"]
    weekly = daily_sessions.groupBy(F.trunc("session_date", "week").alias("week_start")).agg(
        *[F.sum(step).alias(step) for step in steps]
    )
    return weekly.select(
        "*",
        *[(1 - safe_divide(after, before)).alias(name) for name, before, after in zip(losses, steps, steps[1:])],
    )


def agg_daily_geo(sessions: DataFrame) -> DataFrame:
    """Daily session metrics per place. Rates are percentages rounded to two digits."""
    places = ["country", "region", "city", "continent", "sub_continent"]
    total, revenue = F.count("*"), steady_sum("session_revenue")
    converted, bounced = F.count_if("is_converted"), F.count_if("is_bounce")
    return sessions.groupBy("session_date", *[F.col(f"geo.{p}").alias(p) for p in places]).agg(
        total.alias("total_sessions"),
        F.count_if("is_first_session").alias("new_user_sessions"),
        converted.alias("converted_sessions"),
        bounced.alias("bounced_sessions"),
        F.round(safe_divide(converted, total) * 100, 2).alias("conversion_rate"),
        F.round(safe_divide(bounced, total) * 100, 2).alias("bounce_rate"),
        F.round(F.avg("session_duration_seconds"), 2).alias("avg_session_duration_seconds"),
        F.round(F.avg("page_views"), 2).alias("avg_pages_per_session"),
        F.sum("product_views").alias("total_product_views"),
        F.sum("add_to_carts").alias("total_add_to_carts"),
        F.sum("purchases").alias("total_purchases"),
        revenue.alias("total_revenue"),
        F.round(safe_divide(revenue, converted), 2).alias("avg_order_value"),
    )


def dim_views(page_views: DataFrame) -> DataFrame:
    """Page views and distinct viewers per day."""
    return page_views.groupBy("event_date").agg(
        F.count("*").alias("total_page_views"),
        F.count_distinct("user_pseudo_id").alias("unique_users"),
    )


def dim_funnel_daily(sessions: DataFrame, user_scoped: bool = False) -> DataFrame:
    """Distinct sessions reaching each funnel step per day, country, platform and device.

    Client session ids are counted as they are, so two users sharing an id count
    once; ``user_scoped=True`` tells them apart. Each id is first reduced to one
    row of flags, which replaces five distinct counts by one exchange of ids.
    """
    cut = ["session_date", "country", "platform", "device_category"]
    identity = ["ga_session_id", "user_pseudo_id"] if user_scoped else ["ga_session_id"]
    # Published step and the session counter behind it.
    steps = {
        "sessions_view_item": "product_views",
        "sessions_add_to_cart": "add_to_carts",
        "sessions_begin_checkout": "checkouts_started",
        "sessions_purchase": "purchases",
    }
    per_id = (
        sessions.withColumn("country", F.col("geo.country"))
        .groupBy(*cut, *identity)
        .agg(
            *[F.max(F.when(F.col(counter) > 0, 1).otherwise(0)).alias(step) for step, counter in steps.items()],
            steady_sum("session_revenue").alias("revenue"),
        )
    )
    return per_id.groupBy(*cut).agg(
        F.count("*").alias("total_sessions"),
        *[F.sum(step).alias(step) for step in steps],
        steady_sum("revenue").alias("total_revenue"),
        safe_divide(F.sum("sessions_purchase"), F.count("*")).alias("session_conversion_rate"),
    )


def fct_daily_web_metrics(session_facts: DataFrame, purchases: DataFrame, user_scoped: bool = False) -> DataFrame:
    """Daily traffic beside daily sales; both inputs are already facts of their own grain."""
    session = F.struct("user_pseudo_id", "session_id") if user_scoped else F.col("session_id")
    traffic = session_facts.groupBy("event_date").agg(
        F.count_distinct(session).alias("total_sessions"),
        F.count_distinct("user_pseudo_id").alias("total_users"),
        F.avg("session_length").alias("average_session_duration"),
    )
    sales = purchases.groupBy("event_date").agg(
        F.count_distinct("transaction_id").alias("total_transactions"),
        steady_sum("total_revenue").alias("total_revenue"),
        F.sum("total_quantity").alias("total_quantity"),
    )
    rate = safe_divide("total_transactions", "total_sessions")
    return traffic.join(sales, "event_date", "left").select(
        "event_date",
        "total_sessions",
        "total_users",
        "average_session_duration",
        F.coalesce("total_transactions", F.lit(0)).alias("total_transactions"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        F.coalesce("total_quantity", F.lit(0)).alias("total_quantity"),
        F.coalesce(rate, F.lit(0.0)).alias("conversion_rate"),
    )


# Funnel steps from the last to the first. Flag, counter, stage number, stage label.
FUNNEL = [
    ("reached_purchase", "purchases", 4, "Purchase"),
    ("reached_checkout", "checkouts_started", 3, "Checkout"),
    ("reached_add_to_cart", "add_to_carts", 2, "Add to Cart"),
    ("reached_product_view", "product_views", 1, "Product View"),
]


def rpt_funnel_sessions(sessions: DataFrame) -> DataFrame:
    """One row per session: how far it came, where it stopped, and its context; with the list of its transactions
    where the session rows have it."""
    listed = ["transaction_ids"] if "transaction_ids" in sessions.columns else []
    reached = {flag: F.col(counter) > 0 for flag, counter, _, _ in FUNNEL}
    stage = F.coalesce(*[F.when(reached[flag], number) for flag, _, number, _ in FUNNEL], F.lit(0))
    stage_name = F.coalesce(*[F.when(reached[flag], label) for flag, _, _, label in FUNNEL])

    def dropped(step, following):
        return reached[step] & (F.col(following) == 0)

    return sessions.select(
        "user_pseudo_id",
        F.col("ga_session_id").alias("session_id"),
        "session_key", "session_date", "session_start_ts", "session_end_ts",
        "session_duration_seconds", "session_number",
        "is_first_session", "is_bounce", "is_converted",
        "operating_system", "browser", "device_category", "platform", "device",
        "geo.country", "geo.region", "geo.city",
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        F.col("traffic_source.name").alias("traffic_campaign"),
        "landing_page", "exit_page", "referrer",
        "product_views", "add_to_carts", "checkouts_started", "purchases",
        *[reached[flag].alias(flag) for flag, *_ in reversed(FUNNEL)],
        stage.alias("furthest_funnel_stage"),
        F.coalesce(stage_name, F.lit("No Funnel Activity")).alias("furthest_funnel_stage_name"),
        # A finished funnel and an untouched one both have no drop-off.
        F.when(~reached["reached_purchase"], stage_name).alias("drop_off_stage"),
        dropped("reached_product_view", "add_to_carts").alias("dropped_at_product_view"),
        dropped("reached_add_to_cart", "checkouts_started").alias("dropped_at_add_to_cart"),
        dropped("reached_checkout", "purchases").alias("dropped_at_checkout"),
        "session_revenue", "currency", *listed, "transaction_count",
    )


def session_places(events: DataFrame, user_scoped: bool = False) -> DataFrame:
    """Place of the earliest event of every client session id."""
    keys = ["session_id", "user_pseudo_id"] if user_scoped else ["session_id"]
    found = events.select(
        first_param("ga_session_id", "int_value").alias("session_id"),
        "user_pseudo_id",
        F.timestamp_micros("event_timestamp").alias("event_ts"),
        event_key().alias("event_id"),
        F.struct("geo.country", "geo.region", "geo.city").alias("place"),
    ).filter(F.col("session_id").isNotNull())
    # Ties in time go to the smaller id, then to the smaller place.
    earliest = F.min(F.struct("event_ts", "event_id", "place")).alias("first")
    return found.groupBy(*keys).agg(earliest).select(*keys, "first.place.*")


def rpt_sessions_wide(events: DataFrame, session_facts: DataFrame, lines: DataFrame,
                      user_scoped: bool = False) -> DataFrame:
    """Session facts with the place and the sales of their client session id.

    Place and sales are looked up by the client session id alone, as published;
    ``user_scoped=True`` keeps users who share an id apart. Place and sales are
    grouped by the same key, so they are put together in place into a lookup of
    one row per key; a popular id never multiplies rows.
    """
    keys = ["session_id", "user_pseudo_id"] if user_scoped else ["session_id"]
    sales = session_commerce(lines, user_scoped)
    transactions = F.coalesce("total_transactions", F.lit(0))
    lookup = session_places(events, user_scoped).join(sales, keys, "full")
    return (
        session_facts.join(loose(lookup), keys, "left")
        .select(
            "session_id", "user_pseudo_id", "event_date", "session_start", "session_end",
            "session_length", "session_number", "country", "region", "city",
            transactions.alias("total_transactions"),
            F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
            F.when(transactions > 0, 1).otherwise(0).alias("has_transaction"),
        )
    )


def rpt_product_sales(lines: DataFrame, events: DataFrame, session_facts: DataFrame) -> DataFrame:
    """Purchase lines, weighted by ``copies``, with the place of their session.

    The place depends on the session id only, so it is looked up once per id:
    a line appears once however many session rows share its id. Ids without a
    published session have no place.
    """
    published = session_facts.select("session_id").distinct()
    places = session_places(events).join(published, "session_id", "left_semi")
    return lines.withColumnRenamed("ga_session_id", "session_id").join(loose(places), "session_id", "left").select(
        "event_id", "user_pseudo_id", "event_date", "purchase_ts", "transaction_id", "session_id",
        "item_id", "item_name", "item_brand", "item_category",
        F.col("unit_price").alias("price"), "quantity", "item_revenue",
        "country", "region", "city", "copies",
    )
