"""Hand-made rows for the places where web models are easy to get wrong."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import event_key, unrolled
from tidemark.operators import quality
from tidemark.operators import web_marts as marts
from tidemark.operators import web_purchases as purchases
from tidemark.operators import web_sessions as sessions
from tidemark.operators import web_staging as staging
from tidemark.plans.catalog import QUERIES
from tidemark.sources import schemas

DAY = 86_400_000_000
START = 1_704_067_200_000_000  # 2024-01-01 00:00:00 UTC


def param(key, **value):
    return {"key": key, "value": value}


def event(at=0, user="u1", name="page_view", day="20240101", session=1, number=1, params=(), items=(), **rest):
    given = list(params)
    if session is not None:
        given.append(param("ga_session_id", int_value=session))
    if number is not None:
        given.append(param("ga_session_number", int_value=number))
    return {
        "event_date": day, "event_timestamp": START + at, "event_name": name, "user_pseudo_id": user,
        "platform": "WEB", "event_params": given, "items": list(items), **rest,
    }


@pytest.fixture
def frame(spark):
    schema = schemas.parse(schemas.WEB_EVENT_DDL)

    def make(*events):
        text = spark.createDataFrame([(json.dumps(e),) for e in events], "line string")
        return text.select(F.from_json("line", schema).alias("e")).select("e.*")

    return make


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_params_and_items_drop_events_without_any(frame):
    events = frame(event(), {**event(at=1), "event_params": None}, {**event(at=2), "event_params": []},
                   {**event(at=3), "items": None})
    assert staging.stg_event_params(events).count() == 4
    assert staging.stg_items(events).count() == 0
    assert staging.stg_event_param_pivot(events).count() == 2


def test_days_are_strict_only_in_the_event_table(frame):
    events = frame(event(day="2024-13-99", items=[{"item_id": "a"}]))
    assert one(staging.stg_items(events)).event_date is None
    assert staging.stg_event_params(events).filter("event_date IS NULL").count() == 2
    with pytest.raises(Exception, match="(?i)parse|date"):
        staging.stg_events(events).collect()


def test_amount_kept_by_slot(frame):
    events = frame(
        event(params=[param("value", int_value=5)]),
        event(at=1, params=[param("value", float_value=6.5)]),
        event(at=2, params=[param("value", double_value=7.5)]),
    )
    narrow = {r.event_ts.microsecond: r.value for r in staging.stg_event_param_pivot(events).collect()}
    wide = {r.event_ts.microsecond: r.value_param for r in staging.int_event_param_pivot(events).collect()}
    assert narrow == {0: None, 1: 6.5, 2: 7.5}
    assert wide == {0: None, 1: None, 2: 7.5}


def test_first_touch_keeps_missing_values(frame):
    events = frame(
        event(at=0), event(at=5_000_000, params=[param("page_location", string_value="/b")]), event(at=9_000_000)
    )
    row = one(sessions.int_sessions(events))
    assert (row.landing_page, row.exit_page) == (None, None)
    assert (row.session_duration_seconds, row.page_views, row.is_bounce) == (9, 3, False)


def test_equal_times_are_settled_by_id(frame):
    events = frame(
        event(name="scroll", params=[param("page_location", string_value="/scroll")]),
        event(name="click", params=[param("page_location", string_value="/click")]),
    )
    ids = staging.stg_events(events).select("event_id", "event_name").collect()
    first = min(ids).event_name
    assert one(sessions.int_sessions(events)).landing_page == f"/{first}"


def test_whole_seconds_only(frame):
    events = frame(event(at=900_000), event(at=2_100_000))
    assert one(sessions.int_sessions(events)).session_duration_seconds == 1


def test_session_over_midnight_is_two_rows(frame):
    events = frame(event(at=DAY - 1, day="20240101"), event(at=DAY, day="20240102"))
    assert sessions.int_sessions(events).count() == 2


def test_transactions_absent_is_null_not_empty(frame):
    events = frame(event(), event(at=1, user="u2", name="purchase",
                                  params=[param("transaction_id", string_value="T1")]))
    report = marts.rpt_funnel_sessions(sessions.int_sessions(events))
    assert {r.user_pseudo_id: r.transaction_count for r in report.collect()} == {"u1": None, "u2": 1}


def test_unknown_session_number_is_neither_new_nor_returning(frame):
    rows = sessions.int_sessions(frame(event(number=None)))
    daily = one(marts.agg_daily_sessions(rows))
    assert (daily.new_user_sessions, daily.returning_user_sessions) == (0, 0)
    assert daily.returning_to_new_ratio is None and daily.add_to_cart_rate is None
    assert one(marts.agg_daily_geo(rows)).new_user_sessions == 0


def test_single_event_sessions_are_not_published(frame):
    rows = sessions.int_sessions(frame(event(), event(at=1, user="u2"), event(at=5_000_000, user="u2")))
    assert [r.user_pseudo_id for r in sessions.fct_sessions(rows).collect()] == ["u2"]


def literal_sessions(events):
    """Sessions as defined: explode, pivot, join back, group."""
    pivot = staging.stg_event_param_pivot(events).select("event_id", "ga_session_id", "value")
    joined = staging.stg_events(events).join(pivot, "event_id").filter("ga_session_id IS NOT NULL")
    return joined.groupBy("user_pseudo_id", "ga_session_id", F.col("event_date").alias("session_date")).agg(
        F.count("*").alias("total_events"),
        F.sum(F.when(F.col("event_name") == "purchase", F.col("value")).otherwise(0.0)).alias("session_revenue"),
    )


def literal_lines(events):
    """Purchase lines as defined: three tables joined on the event id."""
    bought = staging.stg_events(events.filter("event_name = 'purchase'")).select("event_id", "user_pseudo_id", "event_ts")
    pivot = staging.stg_event_param_pivot(events).select("event_id", "transaction_id", F.col("value").alias("total_revenue"))
    items = staging.stg_items(events).select("event_id", "item_id", "quantity")
    return bought.join(pivot, "event_id", "left").join(items, "event_id", "left").select(
        F.coalesce("transaction_id", F.concat(F.lit("MISSING_"), "event_id")).alias("transaction_id"),
        "user_pseudo_id", "total_revenue", "item_id", F.coalesce("quantity", F.lit(0)).alias("quantity"),
    )


def bag(df, columns):
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


@pytest.fixture
def copies(frame):
    """Repeated events that disagree about their parameters and items, and anonymous ones."""
    buy = [param("transaction_id", string_value="T1"), param("value", double_value=10.0)]
    return frame(
        event(name="purchase", params=buy, items=[{"item_id": "a", "quantity": 2, "price": 3.0}]),
        event(name="purchase", session=None, number=None, items=[{"item_id": "b", "quantity": 1, "price": 1.0}]),
        event(name="purchase", session=None, number=None),
        event(name="page_view"), event(name="page_view"),
        event(at=1, name="purchase", params=buy), event(at=1, name="purchase"),
        event(at=2, user=None, name="purchase", params=buy, items=[{"item_id": "c"}, {"item_id": "d"}]),
        event(at=2, user=None, name="purchase", params=buy, items=[{"item_id": "c"}]),
        event(at=3, name="purchase", session=None, number=None),
    )


def test_copies_share_parameters_and_multiply_lines(copies):
    columns = ["user_pseudo_id", "ga_session_id", "session_date", "total_events", "session_revenue"]
    assert bag(sessions.int_sessions(copies), columns) == bag(literal_sessions(copies), columns)
    columns = ["transaction_id", "user_pseudo_id", "total_revenue", "item_id", "quantity"]
    lines = purchases.purchase_lines(copies)
    assert bag(unrolled(purchases.int_purchase_items(lines)), columns) == bag(literal_lines(copies), columns)


def test_weighted_aggregates_equal_unrolled_ones(copies):
    lines = purchases.purchase_lines(copies)
    rows = unrolled(purchases.int_purchase_items(lines))
    expected = rows.filter("is_complete").agg(F.count("*").alias("n"), F.sum("quantity").alias("q")).first()
    got = purchases.fct_purchases(lines).agg(F.sum("items_count").alias("n"), F.sum("total_quantity").alias("q")).first()
    assert got == expected
    audit = {r.position: r["count"] for r in purchases.filter_loss_audit(copies).collect()}
    assert audit[4] == rows.count()


def test_a_much_repeated_event_stays_linear(frame):
    """Sixty records of one event: its tables have sixty lines of weight sixty, and as many rows as published on request."""
    buy = [param("transaction_id", string_value="T1"), param("value", double_value=10.0)]
    events = frame(*[event(name="purchase", params=buy, items=[{"item_id": f"i{k}", "quantity": 1, "price": 2.0}]) for k in range(60)],
                   event(at=1, name="purchase", session=None, number=None))
    lines = purchases.purchase_lines(events)
    facts = sessions.fct_sessions(sessions.int_sessions(events))
    for table, rows, weight in (
        (purchases.int_purchase_items(lines), 61, 3601), (purchases.dim_items(lines), 60, 3600),
        (purchases.rpt_purchase_dq(lines), 1, 1), (purchases.analysis_incomplete_purchases(lines), 1, 1),
        (marts.rpt_product_sales(lines, events, facts), 61, 3601),
    ):
        assert table.count() == rows and table.agg(F.sum("copies")).first()[0] == weight
        assert unrolled(table).count() == weight and "copies" not in unrolled(table).columns
    assert one(purchases.fct_purchases(lines)).items_count == 3600


def test_item_rows_give_what_arrays_give(copies):
    rows = copies.select(*[c for c in copies.columns if c != "items"], F.explode("items").alias("item"))
    counted = copies.withColumn("item_count", F.coalesce(F.size("items"), F.lit(0)).cast("bigint")).withColumn(
        "item_count", F.greatest("item_count", F.lit(0))).drop("items")
    same = staging.stg_items(copies)
    assert bag(same, same.columns) == bag(staging.stg_items(counted, rows), same.columns)
    daily = purchases.dim_product_daily(copies)
    assert bag(daily, daily.columns) == bag(purchases.dim_product_daily(counted, rows), daily.columns)
    lines = unrolled(purchases.purchase_lines(copies))
    assert bag(lines, lines.columns) == bag(unrolled(purchases.purchase_lines(counted, items=rows)), lines.columns)
    assert bag(purchases.filter_loss_audit(copies), ["position", "count"]) == bag(purchases.filter_loss_audit(counted), ["position", "count"])


def test_lists_of_transactions_on_request(frame):
    def buy(t):
        return [param("transaction_id", string_value=t)]
    events = frame(event(), event(at=1, name="purchase", params=buy("T2")), event(at=2, name="purchase", params=buy("T1")),
                   event(at=3, name="purchase", params=buy("T1")), event(at=4, user="u2"))
    rows, bridge = sessions.int_sessions(events), sessions.session_transactions(events)
    assert bag(bridge, ["user_pseudo_id", "transaction_id"]) == ["('u1', 'T1')", "('u1', 'T2')"]
    found = {r.user_pseudo_id: (r.transaction_ids, r.transaction_count) for r in sessions.with_transaction_ids(rows, bridge).collect()}
    assert found == {"u1": (["T1", "T2"], 2), "u2": (None, None)}


def test_session_rows_and_their_report_hold_the_ids(frame):
    """Sorted, each once, and NULL without any: the same lists as from the relation of transactions."""
    def buy(t):
        return [param("transaction_id", string_value=t)]
    events = frame(event(), event(at=1, name="purchase", params=buy("T2")), event(at=2, name="purchase", params=buy("T1")),
                   event(at=3, name="purchase", params=buy("T1")), event(at=3, name="purchase", params=buy("T1")), event(at=4, user="u2"))
    rows = sessions.int_sessions(events, transaction_ids=True)
    for table in (rows, marts.rpt_funnel_sessions(rows)):
        found = {r.user_pseudo_id: (r.transaction_ids, r.transaction_count) for r in table.collect()}
        assert found == {"u1": (["T1", "T2"], 2), "u2": (None, None)}
    plain = sessions.int_sessions(events)
    assert bag(rows, plain.columns) == bag(plain, plain.columns)


@pytest.mark.parametrize("name", ["int_sessions", "rpt_funnel_sessions"])
def test_queries_give_the_ids(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir)
    bridge = QUERIES["int_session_transactions"](spark, sf_dir)
    ids = rows.select("session_key", "session_date", F.explode(F.split("transaction_ids", ",")).alias("transaction_id"))
    keys = ["session_key", "session_date", "transaction_id"]
    assert bag(ids, keys) == bag(bridge, keys) != []


def test_audit_counts_the_sources(copies):
    audit = {r.position: r["count"] for r in purchases.filter_loss_audit(copies).collect()}
    assert audit[6] == copies.count() and audit[5] is None


def test_unique_ids_shortcut_gives_the_same_rows(frame):
    events = frame(
        event(name="purchase", params=[param("transaction_id", string_value="T1")], items=[{"item_id": "a", "quantity": 2}]),
        event(at=1), event(at=2, user="u2", name="purchase"),
    )
    slow, fast = sessions.int_sessions(events), sessions.int_sessions(events, unique_ids=True)
    assert bag(slow, slow.columns) == bag(fast, slow.columns)
    slow, fast = purchases.purchase_lines(events), purchases.purchase_lines(events, unique_ids=True)
    assert bag(slow, slow.columns) == bag(fast, slow.columns)


def test_popular_session_id_does_not_multiply_rows(frame):
    buy = [param("transaction_id", string_value="T1"), param("value", double_value=10.0)]
    events = frame(*[
        e for u in range(6) for e in (
            event(at=u, user=f"u{u}"), event(at=5_000_000 + u, user=f"u{u}", name="purchase", params=buy,
                                             items=[{"item_id": "a", "quantity": 1, "price": 2.0}]),
        )
    ])
    lines = purchases.purchase_lines(events)
    facts = sessions.fct_sessions(sessions.int_sessions(events))
    assert marts.rpt_sessions_wide(events, facts, lines).count() == 6
    assert marts.rpt_product_sales(lines, events, facts).count() == 6
    assert one(marts.fct_daily_web_metrics(facts, purchases.fct_purchases(lines))).total_sessions == 1
    assert one(marts.fct_daily_web_metrics(facts, purchases.fct_purchases(lines), True)).total_sessions == 6


def test_declared_checks(frame):
    events = frame(event(user=None), event())
    failures = {r.column_name: r.failures for r in quality.null_counts(staging.stg_events(events), "stg_events").collect()}
    assert failures == {"event_date": 0, "event_ts": 0, "event_name": 0, "user_pseudo_id": 1}
    twice = staging.stg_events(frame(event(), event())).select("event_id")
    assert one(quality.unique_failures(twice, "stg_events", "event_id")).failures == 1


def test_key_needs_all_parts(frame):
    assert one(frame(event(user=None)).select(event_key().alias("id"))).id is None


def test_the_id_is_hashed_behind_the_fold(frame):
    """Events with the same user, time and name are one event: the fold's exchange carries those and no hash of them."""
    buy = [param("transaction_id", string_value="T1"), param("transaction_id", string_value="T0"), param("transaction_id"), param("page_title", string_value="Z")]
    events = frame(event(params=buy), event(params=buy), event(at=7, user="u2"), event(name=None, params=buy), event(name="scroll", user=None, params=buy))
    for table in (staging.stg_event_param_pivot(events), sessions.distinct_events(events)):
        text = table._jdf.queryExecution().executedPlan().toString()
        exchanged = text[text.index("Exchange hashpartitioning("):].split(")", 1)[0]
        assert "event_name" in exchanged and "event_id" not in exchanged
    rows = staging.stg_event_param_pivot(events).collect()
    known = {(r.event_id, r.user_pseudo_id, r.event_name) for r in events.select(event_key().alias("event_id"), "user_pseudo_id", "event_name").collect()}
    assert {(r.event_id, r.user_pseudo_id, r.event_name) for r in rows} <= known and len(rows) == 4
    assert {r.transaction_id for r in rows if r.user_pseudo_id is None or r.event_name is None} == {"T1"}
    assert sorted((r.user_pseudo_id, r.copies) for r in sessions.distinct_events(events).collect()) == [("u1", 2), ("u2", 1)]
