"""Named queries over the benchmark tables, one per operator.

Each entry wires operators to the inputs they need and asks those inputs only
for what is read downstream.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import round_doubles, unrolled
from tidemark.operators import commerce, quality, stations, trips
from tidemark.operators import web_marts as marts
from tidemark.operators import web_purchases as purchases
from tidemark.operators import web_sessions as sessions
from tidemark.operators import web_staging as staging
from tidemark.plans import inputs, jobs
from tidemark.session import shared_folder, use_utc
from tidemark.sources import readers, sinks, snapshots
from tidemark.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAILY_TOUCH = ("platform", "operating_system", "browser", "device_category")
# Fixed parameters of the incremental station run.
STATION_AS_OF = "2024-01-31 00:00:00"
STATION_HOURS = 72


def query(name: str):
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return round_doubles(build(spark, sf_dir))

        QUERIES[name] = run
        return build

    return register


def bag(name: str):
    """Register a weighted table twice: its rows one by one, and each different row with how often it stands there."""
    def register(build: Query) -> Query:
        query(name)(lambda spark, sf: unrolled(build(spark, sf)))

        @query(f"{name}_weighted")
        def _(spark, sf):
            rows = round_doubles(build(spark, sf))
            return rows.groupBy(*[c for c in rows.columns if c != "copies"]).agg(F.sum("copies").alias("copies"))

        return build

    return register


def _web(spark, sf, **parts):
    return inputs.web_events(spark, sf, **parts)


# --- web: staging -----------------------------------------------------------


@query("stg_events")
def _(spark, sf):
    e = staging.stg_events(_web(spark, sf, items=True, geo=True))
    return e.select(
        "event_id", "event_date", "event_ts", "user_pseudo_id", "event_name", "platform",
        "operating_system", "browser", "device_category", "mobile_brand",
        "geo.continent", "geo.country", "geo.region", "geo.city",
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        F.col("traffic_source.name").alias("traffic_campaign"),
        F.array_size("event_params").alias("param_count"),
        F.array_size("items").alias("item_count"),
    )


@query("stg_event_params")
def _(spark, sf):
    return staging.stg_event_params(_web(spark, sf))


@query("stg_items")
def _(spark, sf):
    return staging.stg_items(_web(spark, sf), inputs.web_item_rows(spark, sf))


@query("stg_event_param_pivot")
def _(spark, sf):
    return staging.stg_event_param_pivot(_web(spark, sf))


# --- web: intermediate ------------------------------------------------------

@query("int_event_param_pivot")
def _(spark, sf):
    return staging.int_event_param_pivot(_web(spark, sf))


@query("int_geo")
def _(spark, sf):
    return staging.int_geo(_web(spark, sf, geo=True))


@query("int_platform")
def _(spark, sf):
    return staging.int_platform(_web(spark, sf))


@query("int_page_views")
def _(spark, sf):
    views = staging.int_page_views(_web(spark, sf, geo=True))
    return views.select(
        "event_id", "event_date", "event_ts", "user_pseudo_id", "platform",
        F.col("device.category").alias("device_category"), "geo.country",
        F.col("traffic_source.source").alias("traffic_source"),
    )


@query("int_purchase")
def _(spark, sf):
    return purchases.int_purchase(_web(spark, sf))


@bag("int_purchase_items")
def _(spark, sf):
    return purchases.int_purchase_items(_lines(spark, sf))


@query("int_sessions")
def _(spark, sf):
    rows = sessions.int_sessions(_web(spark, sf, geo=True), transaction_ids=True)
    return rows.select(
        *[c for c in rows.columns if c not in ("device", "geo", "traffic_source", "transaction_ids")],
        F.col("device.mobile_brand_name").alias("mobile_brand"),
        "geo.continent", "geo.country", "geo.region", "geo.city",
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        F.col("traffic_source.name").alias("traffic_campaign"),
        F.array_join("transaction_ids", ",").alias("transaction_ids"),
    )


@query("int_session_transactions")
def _(spark, sf):
    return sessions.session_transactions(_web(spark, sf))


@query("int_users")
def _(spark, sf):
    return staging.int_users(_web(spark, sf))


# --- web: marts -------------------------------------------------------------

def _lines(spark, sf):
    return purchases.purchase_lines(_web(spark, sf, items="count"), items=inputs.web_item_rows(spark, sf))


def _daily(spark, sf):
    return marts.agg_daily_sessions(
        sessions.int_sessions(_web(spark, sf), touch=DAILY_TOUCH, transaction_count=False)
    )


def _session_facts(spark, sf):
    return sessions.fct_sessions(sessions.int_sessions(_web(spark, sf), touch=(), transaction_count=False))


@query("agg_daily_sessions")
def _(spark, sf):
    return _daily(spark, sf)


@query("agg_daily_funnel_long")
def _(spark, sf):
    return marts.agg_daily_funnel_long(_daily(spark, sf))


@query("agg_weekly_dropoff_rates")
def _(spark, sf):
    return marts.agg_weekly_dropoff_rates(_daily(spark, sf))


@query("agg_daily_geo")
def _(spark, sf):
    return marts.agg_daily_geo(
        sessions.int_sessions(_web(spark, sf, geo=True), touch=("geo",), transaction_count=False)
    )


@query("agg_daily_product_revenue")
def _(spark, sf):
    return purchases.agg_daily_product_revenue(_lines(spark, sf))


@bag("analysis_incomplete_purchases")
def _(spark, sf):
    return purchases.analysis_incomplete_purchases(_lines(spark, sf))


@query("dim_geo")
def _(spark, sf):
    return staging.int_geo(_web(spark, sf, geo=True))


@query("dim_platform")
def _(spark, sf):
    return staging.int_platform(_web(spark, sf))


@query("dim_users")
def _(spark, sf):
    return staging.int_users(_web(spark, sf))


@bag("dim_items")
def _(spark, sf):
    return purchases.dim_items(_lines(spark, sf))


@query("dim_products")
def _(spark, sf):
    return purchases.dim_products(_lines(spark, sf))


@query("dim_views")
def _(spark, sf):
    return marts.dim_views(staging.int_page_views(_web(spark, sf)))


@query("fct_events")
def _(spark, sf):
    return sessions.fct_events(_web(spark, sf))


@query("fct_purchases")
def _(spark, sf):
    return purchases.fct_purchases(_lines(spark, sf))


@query("fct_sessions")
def _(spark, sf):
    return _session_facts(spark, sf)


def _daily_metrics(spark, sf, user_scoped):
    return marts.fct_daily_web_metrics(
        _session_facts(spark, sf), purchases.fct_purchases(_lines(spark, sf)), user_scoped
    )


@query("fct_daily_web_metrics")
def _(spark, sf):
    return _daily_metrics(spark, sf, False)


@query("fct_daily_web_metrics_user_scoped")
def _(spark, sf):
    return _daily_metrics(spark, sf, True)


# --- web: analysis and reporting --------------------------------------------

def _funnel(spark, sf, user_scoped):
    rows = sessions.int_sessions(
        _web(spark, sf, geo=True), touch=("geo", "platform", "device_category"), transaction_count=False
    )
    return marts.dim_funnel_daily(rows, user_scoped)


@query("dim_funnel_daily")
def _(spark, sf):
    return _funnel(spark, sf, False)


@query("dim_funnel_daily_user_scoped")
def _(spark, sf):
    return _funnel(spark, sf, True)


@query("dim_product_daily")
def _(spark, sf):
    return purchases.dim_product_daily(_web(spark, sf), inputs.web_item_rows(spark, sf))


def funnel_sessions(spark: SparkSession, sf: str) -> DataFrame:
    report = marts.rpt_funnel_sessions(sessions.int_sessions(_web(spark, sf, geo=True), transaction_ids=True))
    return report.select(
        *[c for c in report.columns if c not in ("device", "transaction_ids")],
        F.col("device.mobile_brand_name").alias("mobile_brand"),
        F.array_join("transaction_ids", ",").alias("transaction_ids"),
    )


query("rpt_funnel_sessions")(funnel_sessions)


def _wide(spark, sf, user_scoped):
    return marts.rpt_sessions_wide(
        _web(spark, sf, geo=True), _session_facts(spark, sf), _lines(spark, sf), user_scoped
    )


@query("rpt_sessions_wide")
def _(spark, sf):
    return _wide(spark, sf, False)


@query("rpt_sessions_wide_user_scoped")
def _(spark, sf):
    return _wide(spark, sf, True)


@bag("rpt_product_sales")
def _(spark, sf):
    return marts.rpt_product_sales(_lines(spark, sf), _web(spark, sf, geo=True), _session_facts(spark, sf))


@bag("rpt_purchase_dq")
def _(spark, sf):
    return purchases.rpt_purchase_dq(_lines(spark, sf))


@query("source_profile")
def _(spark, sf):
    return staging.source_profile(_web(spark, sf))


@query("filter_loss_audit")
def _(spark, sf):
    return purchases.filter_loss_audit(_web(spark, sf, items="count"))


@query("incomplete_by_os")
def _(spark, sf):
    return purchases.incomplete_by_os(_web(spark, sf, items="count"))


@query("incomplete_by_week")
def _(spark, sf):
    return purchases.incomplete_by_week(_web(spark, sf, items="count"))


@query("purchase_completeness")
def _(spark, sf):
    return purchases.purchase_completeness(_web(spark, sf, items="count"))


# --- commerce ---------------------------------------------------------------

def _silver(spark, sf):
    return commerce.commerce_silver(inputs.commerce_item_rows(spark, sf), processed_at=False)


@query("commerce_silver")
def _(spark, sf):
    return _silver(spark, sf)


def _dashboard(name):
    @query(name)
    def _(spark, sf):
        return getattr(commerce, name)(_silver(spark, sf))


for _name in ("orders_by_country", "hourly_category_revenue", "customer_ltv", "event_funnel_counts",
              "channel_performance", "average_order_value"):
    _dashboard(_name)


@query("commerce_landing_roundtrip")
def _(spark, sf):
    # Land the events as JSON lines in the shared folder, then read them back under the fixed schema.
    path = f"{shared_folder(spark)}/commerce-landing-{uuid.uuid4().hex}"
    sinks.land_json(inputs.commerce_events(spark, sf), path)
    return commerce.commerce_silver(readers.commerce_events(spark, path), processed_at=False)


# --- stations ---------------------------------------------------------------

@query("station_curated")
def _(spark, sf):
    return stations.station_curated(inputs.station_status(spark, sf), inputs.station_info(spark, sf))


@query("station_curated_zero_filled")
def _(spark, sf):
    return stations.station_curated(inputs.station_status(spark, sf), inputs.station_info(spark, sf), True)


def _recent(spark, sf):
    return snapshots.recent_snapshots(inputs.station_status(spark, sf), STATION_AS_OF, STATION_HOURS)


@query("station_incremental")
def _(spark, sf):
    return stations.station_curated(_recent(spark, sf), inputs.station_info(spark, sf))


@query("station_latest_snapshot")
def _(spark, sf):
    return stations.status_readings(snapshots.latest_snapshot(inputs.station_status(spark, sf)), False, "source_file")


# --- trips ------------------------------------------------------------------

def _trips(spark, sf):
    return trips.trips_silver(inputs.trips_bronze(spark, sf))


def _weather(spark, sf):
    return trips.weather_daily(trips.weather_bronze(inputs.weather_raw(spark, sf)))


def _zones(spark, sf):
    return trips.dim_zone(inputs.zone_lookup(spark, sf))


@query("weather_daily")
def _(spark, sf):
    return _weather(spark, sf).drop("ingest_ts")


@query("partition_counts")
def _(spark, sf):
    return trips.partition_counts(trips.weather_bronze(inputs.weather_raw(spark, sf)))


@query("dim_zone")
def _(spark, sf):
    return _zones(spark, sf)


@query("trips_silver")
def _(spark, sf):
    return _trips(spark, sf)


@query("trips_quarantine")
def _(spark, sf):
    return trips.trips_quarantine(inputs.trips_bronze(spark, sf), detected_at=False)


@query("quarantine_summary")
def _(spark, sf):
    return trips.quarantine_summary(trips.trips_quarantine(inputs.trips_bronze(spark, sf)))


@query("dq_split_counts")
def _(spark, sf):
    return trips.trip_reconciliation(inputs.trips_bronze(spark, sf))


@query("city_daily_kpis")
def _(spark, sf):
    return trips.city_daily_kpis(_trips(spark, sf), _weather(spark, sf))


@query("zone_daily_kpis")
def _(spark, sf):
    return trips.zone_daily_kpis(_trips(spark, sf), _zones(spark, sf), _weather(spark, sf))


@query("city_daily_simple")
def _(spark, sf):
    return trips.city_daily_simple(_trips(spark, sf))


@query("zone_daily_simple")
def _(spark, sf):
    return trips.zone_daily_simple(_trips(spark, sf))


# --- quality ----------------------------------------------------------------

@query("dq_not_null")
def _(spark, sf):
    """The events are read once; models that jobs write are checked while they are written, the others from those."""
    checks = quality.Checks()

    def written(table, name, watched=True):
        path = jobs.fresh(spark, f"checked-{name}")
        (checks.watch(table, name) if watched else table).write.parquet(path)
        return spark.read.schema(table.schema).parquet(path)

    events = written(_web(spark, sf, items=True), "events", watched=False)
    written(staging.stg_event_param_pivot(events), "stg_event_param_pivot")
    lines = written(purchases.purchase_lines(events), "int_purchase_items")
    rows = written(sessions.int_sessions(events, touch=DAILY_TOUCH, transaction_count=False), "int_sessions")
    daily = written(marts.agg_daily_sessions(rows), "agg_daily_sessions")
    views = {
        "stg_events": staging.stg_events(events),
        "stg_event_params": staging.stg_event_params(events),
        "stg_items": staging.stg_items(events),
        "dim_views": marts.dim_views(staging.int_page_views(events)),
        "fct_purchases": purchases.fct_purchases(lines),
        "dim_products": purchases.dim_products(lines),
        "agg_daily_product_revenue": purchases.agg_daily_product_revenue(lines),
        "agg_daily_funnel_long": marts.agg_daily_funnel_long(daily),
    }
    return _union([checks.rows(spark), *[quality.null_counts(t, name) for name, t in views.items()]])


def _union(frames):
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


@query("dq_unique")
def _(spark, sf):
    events = _web(spark, sf)
    tables = {"stg_event_param_pivot": staging.stg_event_param_pivot(events), "dim_views": marts.dim_views(staging.int_page_views(events))}
    return _union([quality.unique_failures(tables[name], name) for name in quality.UNIQUE])


@query("dq_commerce_silver")
def _(spark, sf):
    return quality.null_counts(
        _silver(spark, sf), "commerce_silver", ["event_id", "event_type", "session_id", "event_timestamp", "product_id"]
    )


@query("dq_order_arithmetic")
def _(spark, sf):
    return quality.order_arithmetic(inputs.commerce_events(spark, sf))


# --- streaming --------------------------------------------------------------

@query("bronze_stream_counts")
def _(spark, sf):
    # Stream the event file into a partitioned bronze table, twice; the second run finds nothing new.
    root = f"{shared_folder(spark)}/bronze-{uuid.uuid4().hex}"
    schema = inputs.table(spark, sf, "events").schema
    for _run in range(2):
        # As a pattern the source may be one file or a folder of files.
        stream = ingest.file_stream(spark, f"{sf}/events.{{parquet}}", schema)
        dated = stream.withColumns({"year": F.year("ts"), "month": F.month("ts")})
        ingest.ingest_available(dated, f"{root}/table", f"{root}/checkpoint", ["year", "month"])
    return trips.partition_counts(spark.read.parquet(f"{root}/table"), rows="events")


# --- whole jobs through files -------------------------------------------------

for _job in (jobs.trip_ingestion, jobs.json_rescue_replay, jobs.delivery_stream_recovery, jobs.export_suffix_range,
             jobs.station_history_job, jobs.weather_csv_job, jobs.zone_csv_job, jobs.trip_folders_job,
             jobs.commerce_append_job, jobs.trip_lakehouse_job):
    query(_job.__name__)(_job)
