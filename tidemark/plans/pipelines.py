"""The four pipelines end to end: read, transform, write.

Every job is a handful of lazy reads and one action per output. Row counts are
taken by ``Observation`` while the output is written, not by extra jobs.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import unrolled
from tidemark.operators import commerce, quality, stations, trips
from tidemark.operators import web_marts as marts
from tidemark.operators import web_purchases as purchases
from tidemark.operators import web_sessions as sessions
from tidemark.operators import web_staging as staging
from tidemark.session import use_utc
from tidemark.sources import readers, schemas, sinks, snapshots
from tidemark.streaming import batches, ingest

# Partition columns of bronze trips.
PARTITIONS = ["year", "month"]


def counted(table: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that flow past; read ``observation.get["rows"]`` after the write."""
    observation = Observation(name)
    return table.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def build_web(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
              default_schema: str = "default", checks: quality.Checks | None = None,
              window: bool = False) -> dict[str, DataFrame]:
    """Build every web model from the event export.

    With ``window``, only the days from ``start`` to ``end`` are read: tables by day keep their other days, what is
    made from those tables is made anew from all of them, and models that need every event are left as they are.
    A day that no longer gives a table any row keeps the rows it had there.

    With ``checks``, declared NOT NULL columns of the tables are counted while those are written.

    Early layers are views. Session rows, purchase lines and the parameter pivot
    feed several marts each, so they are written once and read back; marts are
    tables.
    """
    use_utc(spark)
    events = readers.web_events(spark, path, start, end)
    built: dict[str, DataFrame] = {}

    def publish(name: str, table: DataFrame, layer: str, kind: str | None = None, by: list[str] | None = None,
                every: bool = False):
        """``every``: the model is made from all events, whichever day they are of."""
        if every and window:
            return table
        if checks and name in quality.NOT_NULL and sinks.is_table(layer, kind):
            table = checks.watch(table, name)
        built[name] = sinks.materialize(table, name, layer, kind, by, default_schema, window)
        return built[name]

    def publish_bag(name: str, weighted: DataFrame, layer: str, by: list[str] | None = None):
        """The weighted table is what is written; its rows one by one are a view of it."""
        held = publish(f"{name}_weighted", weighted, layer, by=by)
        return publish(name, unrolled(held), layer, "view")

    publish("stg_events", staging.stg_events(events), "staging", every=True)
    publish("stg_event_params", staging.stg_event_params(events), "staging", every=True)
    publish("stg_items", staging.stg_items(events), "staging", every=True)
    publish("stg_event_param_pivot", staging.stg_event_param_pivot(events), "staging", "table", ["event_date"])

    publish("int_event_param_pivot", staging.int_event_param_pivot(events), "intermediate", every=True)
    publish("int_geo", staging.int_geo(events), "intermediate", every=True)
    publish("int_platform", staging.int_platform(events), "intermediate", every=True)
    views = publish("int_page_views", staging.int_page_views(events), "intermediate", every=True)
    publish("int_users", staging.int_users(events), "intermediate", every=True)
    publish("int_purchase", purchases.int_purchase(events), "intermediate", every=True)
    lines = publish("purchase_lines", purchases.purchase_lines(events), "intermediate", "table", ["event_date"])
    publish_bag("int_purchase_items", purchases.int_purchase_items(lines), "intermediate")
    rows = publish("int_sessions", sessions.int_sessions(events, transaction_ids=True), "intermediate", "table", ["session_date"])

    publish("int_session_transactions", sessions.session_transactions(events), "intermediate", "table", ["session_date"])

    daily = publish("agg_daily_sessions", marts.agg_daily_sessions(rows), "marts")
    publish("agg_daily_funnel_long", marts.agg_daily_funnel_long(daily), "marts")
    publish("agg_weekly_dropoff_rates", marts.agg_weekly_dropoff_rates(daily), "marts")
    publish("agg_daily_geo", marts.agg_daily_geo(rows), "marts")
    publish("agg_daily_product_revenue", purchases.agg_daily_product_revenue(lines), "marts")
    publish_bag("analysis_incomplete_purchases", purchases.analysis_incomplete_purchases(lines), "marts")
    publish("dim_geo", staging.int_geo(events), "marts", every=True)
    publish("dim_platform", staging.int_platform(events), "marts", every=True)
    publish("dim_users", staging.int_users(events), "marts", every=True)
    publish_bag("dim_items", purchases.dim_items(lines), "marts")
    publish("dim_products", purchases.dim_products(lines), "marts")
    publish("dim_views", marts.dim_views(views), "marts", by=["event_date"])
    publish("fct_events", sessions.fct_events(events), "marts", by=["event_date"])
    bought = publish("fct_purchases", purchases.fct_purchases(lines), "marts")
    facts = publish("fct_sessions", sessions.fct_sessions(rows), "marts", "view")
    publish("fct_daily_web_metrics", marts.fct_daily_web_metrics(facts, bought), "marts")
    publish("dim_funnel_daily", marts.dim_funnel_daily(rows), "marts")
    publish("dim_product_daily", purchases.dim_product_daily(events), "marts", by=["event_date"])
    publish("rpt_funnel_sessions", marts.rpt_funnel_sessions(rows), "marts")
    publish("rpt_sessions_wide", marts.rpt_sessions_wide(events, facts, lines), "marts", every=True)
    if not window:
        publish_bag("rpt_product_sales", marts.rpt_product_sales(lines, events, facts), "marts")
    publish_bag("rpt_purchase_dq_analysis", purchases.rpt_purchase_dq(lines), "marts")
    return built


def run_commerce(spark: SparkSession, input_path: str, output_path: str) -> dict[str, int]:
    """Bronze JSON to partitioned silver Parquet. Returns the rows read and written."""
    use_utc(spark)
    bronze, read = counted(readers.commerce_events(spark, input_path), "bronze")
    silver, written = counted(commerce.commerce_silver(bronze), "silver")
    sinks.append_partitioned(silver, output_path, ["event_type", "event_date"])
    return {"bronze": read.get["rows"], "silver": written.get["rows"]}


def run_stations_incremental(spark: SparkSession, info_root: str, status_root: str, output_path: str,
                             as_of: datetime | str, hours_back: int = 4, idempotent: bool = False,
                             status_ddl: str = schemas.STATION_STATUS_DDL,
                             info_ddl: str = schemas.STATION_INFO_DDL) -> None:
    """Append the readings of recent snapshots.

    The DDLs name the fields of the documents that are kept; ``readers.document_ddl``
    finds all of them once.

    Overlapping look-backs append a reading again; ``idempotent=True`` drops the
    readings the touched days already hold. Without a snapshot in the window the
    newest one is taken. ``run_stations_stream`` needs no window.
    """
    use_utc(spark)
    every = readers.station_status(spark, status_root, status_ddl)
    recent = every.filter(snapshots.in_window(as_of, hours_back))
    if recent.isEmpty():
        recent = readers.station_status(spark, _newest(spark, status_root), status_ddl)
    curated = stations.station_curated(recent, _latest_info(spark, info_root, info_ddl))
    if idempotent:
        curated = _not_held(spark, stations.once_per_reading(curated), output_path)
    sinks.append_partitioned(curated, output_path, ["year", "month", "day"])


def run_stations_stream(spark: SparkSession, info_root: str, status_root: str, output_path: str, checkpoint: str,
                        max_files: int = batches.FILES_PER_BATCH, status_ddl: str = schemas.STATION_STATUS_DDL,
                        info_ddl: str = schemas.STATION_INFO_DDL, after_write: Callable[[int], None] | None = None) -> None:
    """Take the status snapshots that no run has taken yet, whenever they are from, into dated partitions.

    The checkpoint is the look-back: every snapshot is read once, and a batch that is run again replaces what it had
    written (partition ``ingest_batch``).
    """
    use_utc(spark)
    info = _newest(spark, info_root)

    def take(session: SparkSession, paths: list[str], mark: str) -> None:
        status = readers.station_status(session, [batches.literal_path(p) for p in paths], status_ddl)
        curated = stations.station_curated(status, readers.station_info(session, info, info_ddl))
        by = ["year", "month", "day", batches.BATCH]
        sinks.replace_path_partitions(sinks.balanced(curated.withColumn(batches.BATCH, F.lit(mark)), *by), output_path, by)

    batches.each_batch(spark, status_root, checkpoint, take, max_files, "stations", after_write, "*.json")


def run_stations_backfill(spark: SparkSession, info_root: str, status_root: str, output_path: str,
                          max_records_per_file: int = 100_000, status_ddl: str = schemas.STATION_STATUS_DDL,
                          info_ddl: str = schemas.STATION_INFO_DDL) -> None:
    """Rebuild all readings from every snapshot; the DDLs as for the incremental run."""
    use_utc(spark)
    quality.require_rows(_listing(spark, status_root), status_root)
    status = readers.station_status(spark, status_root, status_ddl)
    curated = stations.station_curated(status, _latest_info(spark, info_root, info_ddl))
    sinks.overwrite_partitioned(curated, output_path, ["year", "month", "day"], max_records_per_file)


def _listing(spark: SparkSession, root: str) -> DataFrame:
    return snapshots.list_files(spark, root)


def _newest(spark: SparkSession, root: str) -> str:
    """The newest snapshot below ``root``, as a path that means just this file."""
    newest = snapshots.latest_snapshot(_listing(spark, root)).select(snapshots.PATH).first()
    if newest is None:
        raise quality.EmptySourceError("no snapshot files found")
    return batches.literal_path(newest[0])


def _latest_info(spark: SparkSession, root: str, ddl: str) -> DataFrame:
    return readers.station_info(spark, _newest(spark, root), ddl)


def _not_held(spark: SparkSession, curated: DataFrame, path: str) -> DataFrame:
    """Readings the target does not hold yet; only partitions of the days at hand are read."""
    by = ["year", "month", "day"]
    try:
        held = spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return curated
    # At most one row per calendar day; joined on the partition columns it prunes the target when it runs.
    # Spark prunes only by a side that is filtered by more than a test for NULL.
    days = F.broadcast(curated.select(*by).filter("year > 0").distinct())
    touched = held.join(days, by, "left_semi").unionByName(held.filter("year IS NULL OR year <= 0")).select(
        F.col("station_id").alias("held_id"), F.col("timestamp").alias("held_at"))
    # A reading without a time is the same reading when it comes again.
    same = F.col("station_id").eqNullSafe(F.col("held_id")) & F.col("timestamp").eqNullSafe(F.col("held_at"))
    return curated.join(touched, same, "left_anti")


def ingest_trips(spark: SparkSession, source: str, table: str, checkpoint: str,
                 mode: str = ingest.ADD_NEW_COLUMNS, max_files: int = batches.FILES_PER_BATCH,
                 after_write: Callable[[int], None] | None = None) -> None:
    """Take new trip files, old or new by their time, into the bronze table and stop.

    Every batch opens the footers of its own files. New columns are added to the table, kept as JSON in
    ``_rescued_data`` or refused, as ``mode`` says; a value that does not fit its column's type is kept there in any
    mode. Year and month come from the folders or, where those do not give them, from the pickup time.
    """
    use_utc(spark)
    if "." in table:
        sinks.create_schema(spark, table.rpartition(".")[0])
    if not spark.catalog.tableExists(table):
        quality.require_rows(snapshots.list_files(spark, source, "*"), source)
    batches.ingest_files(spark, source, table, checkpoint, PARTITIONS, ingest.trip_bronze, tuple(PARTITIONS), mode,
                         "trips_bronze", max_files, after_write)


def build_trips(spark: SparkSession, bronze: DataFrame, weather_root: str, zone_path: str,
                schemas: tuple[str, str, str] = ("taxi_bronze", "taxi_silver", "taxi_gold")) -> dict[str, DataFrame]:
    """Silver, quarantine, dimensions and daily KPIs from bronze trips."""
    use_utc(spark)
    bronze_db, silver_db, gold_db = schemas
    for name in schemas:
        sinks.create_schema(spark, name)
    replace = sinks.replace_table
    weather_raw = trips.weather_bronze(readers.partitioned_weather(spark, weather_root))
    weather_raw = replace(weather_raw, f"{bronze_db}.weather_raw", ["year", "month"])
    weather = replace(trips.weather_daily(weather_raw), f"{silver_db}.weather_daily")
    zones = replace(trips.dim_zone(readers.zone_lookup(spark, zone_path)), f"{silver_db}.dim_zone")
    silver = replace(trips.trips_silver(bronze), f"{silver_db}.trips", ["pickup_date"])
    held = replace(trips.trips_quarantine(bronze), f"{silver_db}.trips_quarantine", ["dq_reason"])
    by_month = ["year", "month"]
    return {
        "weather_raw": weather_raw,
        "weather_daily": weather,
        "dim_zone": zones,
        "trips": silver,
        "trips_quarantine": held,
        "city_daily_kpis": replace(trips.city_daily_kpis(silver, weather), f"{gold_db}.city_daily_kpis", by_month),
        "zone_daily_kpis": replace(
            trips.zone_daily_kpis(silver, zones, weather), f"{gold_db}.zone_daily_kpis", by_month
        ),
        "kpi_city_daily": replace(trips.city_daily_simple(silver), f"{gold_db}.kpi_city_daily"),
        "kpi_zone_daily": replace(trips.zone_daily_simple(silver), f"{gold_db}.kpi_zone_daily", ["pickup_date"]),
    }
