"""Web events, staging layer.

Input everywhere is the raw nested export: one row per event, with its
parameters and items as arrays (see ``sources.schemas.WEB_EVENT_DDL``).

Operators on items also take *item rows*: an event's columns beside one of its
items, a struct ``item``. Where items arrive as rows they need not be nested
first; events then state their ``item_count`` instead of an array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import event_key, has_elements, param_max, parse_day, try_parse_day

# The parameter keys the models read and the typed slots that may hold them.
PIVOT_KEYS = {
    "ga_session_id": ("ga_session_id", ("int_value",)),
    "ga_session_number": ("ga_session_number", ("int_value",)),
    "page_location": ("page_location", ("string_value",)),
    "page_referrer": ("page_referrer", ("string_value",)),
    "transaction_id": ("transaction_id", ("string_value",)),
    "value": ("value", ("double_value", "float_value")),
    "currency": ("currency", ("string_value",)),
}

# The wider pivot also reads the title, and its amount only accepts the double slot.
WIDE_PIVOT_KEYS = {
    "ga_session_id": ("ga_session_id", ("int_value",)),
    "ga_session_number": ("ga_session_number", ("int_value",)),
    "page_location": ("page_location", ("string_value",)),
    "page_referrer": ("page_referrer", ("string_value",)),
    "transaction_id": ("transaction_id", ("string_value",)),
    "page_title": ("page_title", ("string_value",)),
    "currency": ("currency", ("string_value",)),
    "value_param": ("value", ("double_value",)),
}

# The item attributes published by the staging layer.
ITEM_FIELDS = [
    "item_id", "item_name", "item_brand", "item_variant",
    "item_category", "item_category2", "item_category3", "item_category4", "item_category5",
    "price", "quantity",
]


IDENTITY = ["event_id", "event_date", "event_ts", "user_pseudo_id", "event_name"]


def in_row_params(keys: dict[str, tuple[str, tuple[str, ...]]]) -> dict[str, Column]:
    return {name: param_max(key, *fields) for name, (key, fields) in keys.items()}


def stg_events(events: DataFrame) -> DataFrame:
    """One row per event: hashed id, typed time, flattened device; arrays kept as they are.

    The day is parsed strictly, so a malformed date stops the load.
    """
    return events.select(
        event_key().alias("event_id"),
        parse_day("event_date").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_ts"),
        "user_pseudo_id",
        "event_name",
        "platform",
        F.col("device.operating_system").alias("operating_system"),
        F.col("device.web_info.browser").alias("browser"),
        F.col("device.category").alias("device_category"),
        F.col("device.mobile_brand_name").alias("mobile_brand"),
        "device",
        "geo",
        "traffic_source",
        "event_params",
        "items",
    )


def with_event_id(folded: DataFrame) -> DataFrame:
    """Hash the id of rows that hold what it is made of: a fold by those need not carry and compare 64 characters."""
    return folded.withColumn("event_id", event_key("user_pseudo_id", F.unix_micros("event_ts"), "event_name"))


def _timed(events: DataFrame, *extra: Column | str) -> DataFrame:
    return events.select(
        try_parse_day("event_date").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_ts"),
        "user_pseudo_id",
        "event_name",
        *extra,
    )


def _identified(events: DataFrame, *extra: Column | str) -> DataFrame:
    return events.select(
        event_key().alias("event_id"),
        try_parse_day("event_date").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_ts"),
        "user_pseudo_id",
        "event_name",
        *extra,
    )


def stg_event_params(events: DataFrame) -> DataFrame:
    """One row per event and parameter; events without parameters disappear."""
    # The id is hashed in the row that owns the array, not once per element.
    exploded = _identified(events, "event_params").select(*IDENTITY, F.explode("event_params").alias("p"))
    return exploded.select(
        *IDENTITY,
        F.col("p.key").alias("param_key"),
        "p.value.string_value", "p.value.int_value", "p.value.float_value", "p.value.double_value",
    )


def stg_items(events: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """One row per event and item; events without items disappear. ``items`` are item rows, if there are such."""
    if items is None:
        exploded = _identified(events, "items").select(*IDENTITY, F.explode("items").alias("i"))
    else:
        exploded = _identified(items, F.col("item").alias("i"))
    return exploded.select(*IDENTITY, *[f"i.{name}" for name in ITEM_FIELDS])


def _pivot(events: DataFrame, keys, grain: list[str]) -> DataFrame:
    # Each event folds its own array first, so the exchange carries one narrow
    # row per event and repeated events are combined before it. Where the name is
    # part of the grain, the id follows from the rest and is hashed behind it.
    columns = in_row_params(keys)
    if set(IDENTITY) <= set(grain):
        known = _timed(events.filter(has_elements("event_params")), *[c.alias(name) for name, c in columns.items()])
        return with_event_id(known.groupBy(*[c for c in grain if c != "event_id"]).agg(
            *[F.max(name).alias(name) for name in columns])).select(*grain, *columns)
    folded = _identified(
        events.filter(has_elements("event_params")),
        *[c.alias(name) for name, c in columns.items()],
    )
    return folded.groupBy(*grain).agg(*[F.max(name).alias(name) for name in columns])


def stg_event_param_pivot(events: DataFrame) -> DataFrame:
    """Known parameters as columns, one row per distinct event."""
    return _pivot(events, PIVOT_KEYS, ["event_id", "user_pseudo_id", "event_name", "event_date", "event_ts"])


def int_event_param_pivot(events: DataFrame) -> DataFrame:
    """Pivot with the page title; an amount not stored as a double is lost."""
    return _pivot(events, WIDE_PIVOT_KEYS, ["event_id", "event_date", "event_ts", "user_pseudo_id"])


def int_geo(events: DataFrame) -> DataFrame:
    """Where each event came from; one row per event, repeated events included."""
    return stg_events(events).select("event_id", "geo.country", "geo.region", "geo.city")


def int_platform(events: DataFrame) -> DataFrame:
    """What each event was sent from; one row per event, repeated events included."""
    return stg_events(events).select("event_id", "platform", "device_category", "operating_system", "browser")


def int_page_views(events: DataFrame) -> DataFrame:
    """Page views with a known user and day."""
    return (
        stg_events(events.filter(F.col("event_name") == "page_view"))
        .select("event_id", "event_date", "event_ts", "user_pseudo_id", "platform", "device", "geo", "traffic_source")
        .filter(F.col("user_pseudo_id").isNotNull() & F.col("event_date").isNotNull())
    )


def int_users(events: DataFrame) -> DataFrame:
    """Activity span of each user."""
    return (
        events.select("user_pseudo_id", parse_day("event_date").alias("event_date"))
        # Folding to (user, day) first keeps the distinct count cheap and a very
        # active user spread over as many tasks as there are days.
        .groupBy("user_pseudo_id", "event_date").agg(F.count("*").alias("n"))
        .groupBy("user_pseudo_id")
        .agg(
            F.min("event_date").alias("first_seen_date"),
            F.max("event_date").alias("last_seen_date"),
            F.count("event_date").alias("days_active"),
            F.sum("n").alias("total_events"),
        )
    )


def source_profile(events: DataFrame, top: int = 20) -> DataFrame:
    """Most frequent event names with the span of days they were seen on."""
    return (
        events.groupBy("event_name")
        .agg(
            F.count("*").alias("event_count"),
            F.min("event_date").alias("min_date"),
            F.max("event_date").alias("max_date"),
        )
        .orderBy(F.col("event_count").desc(), F.col("event_name"))
        .limit(top)
    )
