"""Web events, session layer.

A session row is keyed by (user, session number sent by the client, day).

Session attributes need the parameters of an event, and two copies of one event
share the union of their parameters. Instead of exploding the parameters,
pivoting them and joining them back, copies are folded into one row with a
``copies`` weight: one exchange on the event, one on the session, both with
map-side combination, so neither a flood of copies nor one giant session lands
on a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import item_count, parse_day, steady_sum
from tidemark.operators.web_staging import IDENTITY, PIVOT_KEYS, in_row_params, int_event_param_pivot, stg_events, with_event_id

# First-touch attributes a session can carry, in published order.
FIRST_TOUCH = {
    "operating_system": "device.operating_system",
    "browser": "device.web_info.browser",
    "device_category": "device.category",
    "platform": "platform",
    "device": "device",
    "geo": "geo",
    "traffic_source": "traffic_source",
}
PAGE_TOUCH = ("landing_page", "exit_page", "referrer")
ALL_TOUCH = (*FIRST_TOUCH, *PAGE_TOUCH)


# Session counters and the event name each one counts.
COUNTERS = {
    "page_views": "page_view",
    "scrolls": "scroll",
    "clicks": "click",
    "product_views": "view_item",
    "add_to_carts": "add_to_cart",
    "checkouts_started": "begin_checkout",
    "purchases": "purchase",
}


def distinct_events(events: DataFrame, touch: tuple[str, ...] = (), unique_ids: bool = False,
                    keep_unidentified: bool = False) -> DataFrame:
    """One row per distinct event with its known parameters and a ``copies`` weight.

    ``touch`` names the first-touch attributes to carry along; anything not
    named never reaches the exchange. ``unique_ids=True`` is for inputs known to
    hold every event once (``quality.unique_violations`` checks it): the fold,
    and its exchange, are skipped. Rows whose id is NULL match no parameters.
    """
    attributes = [F.col(path).alias(name) for name, path in FIRST_TOUCH.items() if name in touch]
    flat = events.select(
        parse_day("event_date").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_ts"),
        "user_pseudo_id",
        "event_name",
        *[c.alias(name) for name, c in in_row_params(PIVOT_KEYS).items()],
        item_count(events).alias("items"),
        *([F.struct(*attributes).alias("touch")] if attributes else []),
    )
    # The id follows from user, time and name, so it is hashed behind the fold and is NULL if one of them is.
    identified = F.col("user_pseudo_id").isNotNull() & F.col("event_ts").isNotNull() & F.col("event_name").isNotNull()
    if keep_unidentified:
        params = {name: F.when(identified, F.col(name)) for name in PIVOT_KEYS}
        flat = flat.withColumns({**params, "items": F.when(identified, F.col("items")).otherwise(F.lit(0))})
    else:
        flat = flat.filter(identified)
    if unique_ids:
        return with_event_id(flat).select("event_id", *flat.columns, F.lit(1).cast("bigint").alias("copies"))
    folded = flat.groupBy(*[c for c in IDENTITY if c != "event_id"]).agg(
        *[F.max(name).alias(name) for name in PIVOT_KEYS],
        F.sum("items").alias("items"),
        *([F.min("touch").alias("touch")] if attributes else []),
        F.count("*").alias("copies"),
    )
    return with_event_id(folded).select("event_id", *folded.columns)


def _in_sessions(events: DataFrame, touch: tuple[str, ...], unique_ids: bool) -> DataFrame:
    return distinct_events(events, touch=touch, unique_ids=unique_ids).filter(F.col("ga_session_id").isNotNull())


def _session_key() -> Column:
    return F.concat("user_pseudo_id", F.lit("-"), F.col("ga_session_id").cast("string")).alias("session_key")


def session_transactions(events: DataFrame, unique_ids: bool = False) -> DataFrame:
    """The transactions of every session, one row each: a session row itself never holds a list of them."""
    return (
        _in_sessions(events, (), unique_ids).filter(F.col("transaction_id").isNotNull())
        .select("user_pseudo_id", "ga_session_id", _session_key(), F.col("event_date").alias("session_date"), "transaction_id")
        .distinct()
    )


def with_transaction_ids(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Session rows with their ids as one sorted list, for exports that nest them; a session's ids meet in its row."""
    key = ["user_pseudo_id", "ga_session_id", "session_date"]
    lists = transactions.groupBy(*key).agg(F.sort_array(F.collect_list("transaction_id")).alias("transaction_ids"))
    same = [sessions[k].eqNullSafe(lists[k]) for k in key]
    return sessions.join(lists, same, "left").select(*[sessions[c] for c in sessions.columns], "transaction_ids")


def int_sessions(events: DataFrame, touch: tuple[str, ...] = ALL_TOUCH,
                 transaction_count: bool = True, unique_ids: bool = False, transaction_ids: bool = False) -> DataFrame:
    """Session aggregates. Ties in time are settled by the event id.

    ``touch`` and ``transaction_count`` let a mart ask only for what it reads. The ids that are counted lie in
    ``session_transactions``; counting spreads a session over tasks by id before it is put together. With
    ``transaction_ids`` the row has them as a sorted list as well (NULL without any), each once: copies are
    dropped in the same spread, so what meets in one place is the list that the row holds.
    """
    base = _in_sessions(events, touch, unique_ids)
    order = F.struct("event_ts", "event_id")
    first_fields = [name for name in FIRST_TOUCH if name in touch]
    first: list[Column] = [F.col(f"touch.{name}").alias(name) for name in first_fields]
    if "landing_page" in touch:
        first.append(F.col("page_location").alias("landing_page"))
    if "referrer" in touch:
        first.append(F.col("page_referrer").alias("referrer"))

    is_purchase = F.col("event_name") == "purchase"
    aggregates = [
        F.min("event_ts").alias("session_start_ts"),
        F.max("event_ts").alias("session_end_ts"),
        F.max("ga_session_number").alias("session_number"),
        F.sum("copies").alias("total_events"),
        *[
            F.sum(F.when(F.col("event_name") == name, F.col("copies")).otherwise(F.lit(0))).alias(counter)
            for counter, name in COUNTERS.items()
        ],
        steady_sum(F.when(is_purchase, F.col("value") * F.col("copies")).otherwise(F.lit(0.0))).alias("session_revenue"),
        F.max("currency").alias("currency"),
    ]
    if first:
        aggregates.append(F.min_by(F.struct(*first), order).alias("first"))
    if "exit_page" in touch:
        # Wrapped in a struct: the latest event decides even when it names no page.
        aggregates.append(F.max_by(F.struct("page_location"), order).alias("last"))
    if transaction_count:
        aggregates.append(F.count_distinct("transaction_id").alias("ids"))
    if transaction_ids:
        aggregates.append(F.expr("collect_list(DISTINCT transaction_id)").alias("listed"))

    grouped = base.groupBy("user_pseudo_id", "ga_session_id", "event_date").agg(*aggregates)

    touched = [F.col(f"first.{name}").alias(name) for name in first_fields]
    if "landing_page" in touch:
        touched.append(F.col("first.landing_page").alias("landing_page"))
    if "exit_page" in touch:
        touched.append(F.col("last.page_location").alias("exit_page"))
    if "referrer" in touch:
        touched.append(F.col("first.referrer").alias("referrer"))
    counted = [F.when(F.col("ids") > 0, F.col("ids").cast("int")).alias("transaction_count")] if transaction_count else []
    listed = [F.when(F.size("listed") > 0, F.sort_array("listed")).alias("transaction_ids")] if transaction_ids else []

    return grouped.select(
        "user_pseudo_id",
        "ga_session_id",
        _session_key(),
        F.col("event_date").alias("session_date"),
        "session_start_ts",
        "session_end_ts",
        F.timestamp_diff("SECOND", F.col("session_start_ts"), F.col("session_end_ts"))
        .alias("session_duration_seconds"),
        "session_number",
        *touched,
        "total_events",
        *COUNTERS,
        "session_revenue",
        "currency",
        *listed,
        *counted,
        (F.col("purchases") > 0).alias("is_converted"),
        (F.col("session_number") == 1).alias("is_first_session"),
        (F.col("page_views") == 1).alias("is_bounce"),
    )


def fct_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions that lasted: a session with a single event has no length and is left out."""
    return sessions.select(
        "user_pseudo_id",
        F.col("session_date").alias("event_date"),
        F.col("session_start_ts").alias("session_start"),
        F.col("session_end_ts").alias("session_end"),
        F.col("session_duration_seconds").alias("session_length"),
        "session_number",
        F.col("ga_session_id").alias("session_id"),
    ).filter("session_length > 0 AND session_number > 0 AND session_start IS NOT NULL AND session_end IS NOT NULL")


def fct_events(events: DataFrame) -> DataFrame:
    """Every event with its parameters beside it; an event is known by its id and its day.

    Events without an id find no parameters. They get a private join key, so a
    large share of anonymous rows does not gather in the partition of NULL.
    """
    wanted = ["ga_session_id", "transaction_id", F.col("value_param").alias("event_value"),
              "currency", "page_location", "page_title"]
    anonymous = F.concat(F.lit("-"), F.xxhash64("event_ts", "event_date", "event_name", "user_pseudo_id").cast("string"))
    base = stg_events(events).select("event_id", "event_date", "event_ts", "user_pseudo_id", "event_name")
    params = int_event_param_pivot(events).filter(F.col("event_id").isNotNull()).select(
        F.col("event_id").alias("_key"), F.col("event_date").alias("_day"), *wanted)
    keyed = base.withColumn("_key", F.coalesce("event_id", anonymous)).withColumn("_day", F.col("event_date"))
    return keyed.join(params, ["_key", "_day"], "left").drop("_key", "_day")
