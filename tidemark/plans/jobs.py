"""Whole jobs over the benchmark tables, through files: land, ingest or read back, and report.

Each lands what it needs below a fresh folder of the shared one, runs the library's own readers, sinks and jobs on
it, and returns what a user would look at. The drops, faults and restarts are this module's own; they only have to
be the same in ``oracle.py``.
"""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import stations, trips
from tidemark.plans import inputs, pipelines
from tidemark.session import shared_folder
from tidemark.sources import readers, schemas, sinks
from tidemark.streaming import batches, ingest, rescue

DROPS = 3           # landings of a job, told apart by a number modulo this
DOCUMENTS = 1000    # documents of a landed file


def fresh(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def fresh_name(what: str) -> str:
    return f"{what}_{uuid.uuid4().hex}"


class Lost(RuntimeError):
    """The driver went away between a batch's write and its commit."""


def lose(batch: int):
    """Lose the driver once the batch of this number is written."""
    def after_write(number: int) -> None:
        if number == batch:
            raise Lost(f"after batch {number}")
    return after_write


def _report(*parts: DataFrame) -> DataFrame:
    """Rows of (layer, key, rows)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _counts(table: DataFrame, layer: str, key) -> DataFrame:
    return table.groupBy(key.cast("string").alias("key")).agg(F.count("*").alias("rows")).select(F.lit(layer).alias("layer"), "key", "rows")


# --- trips: several drops, a new column, misfits, a restart -------------------

def trip_drops(spark: SparkSession, sf_dir: str, folder: str):
    """Land the trips in a flat folder, one drop after the other; yields the drop's number.

    The second drop has a column of its own, the third gives distances as text, some of which are no number.
    """
    every = inputs.trips_bronze(spark, sf_dir).drop("year", "month")
    distance = "IF(payment_type = 3, 'unknown', CAST(trip_distance AS STRING))"
    shapes = [every, every.withColumn("airport_fee", F.lit(1.75)), every.withColumn("trip_distance", F.expr(distance))]
    for drop, rows in enumerate(shapes):
        rows.filter(F.col("DOLocationID") % DROPS == drop).repartition(4).write.mode("append").parquet(folder)
        yield drop


def trip_ingestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per bronze month, silver, quarantine reason and rescued field after three runs, the second one restarted."""
    root, db = fresh(spark, "trip-ingestion"), fresh_name("trips")
    table = f"{db}.trips_raw"
    for drop in trip_drops(spark, sf_dir, f"{root}/landing"):
        if drop == 1:
            try:
                pipelines.ingest_trips(spark, f"{root}/landing", table, f"{root}/checkpoint", max_files=3, after_write=lose(2))
            except PySparkException as failure:
                if "Lost" not in str(failure):
                    raise
        pipelines.ingest_trips(spark, f"{root}/landing", table, f"{root}/checkpoint", max_files=3)
    bronze = spark.table(table)
    traced = bronze.filter("source_file IS NOT NULL AND source_file_mod_time IS NOT NULL AND ingest_ts IS NOT NULL")
    rescued = bronze.select(F.explode(F.json_object_keys(ingest.RESCUED)).alias("field"))
    return _report(
        _counts(bronze, "bronze", F.concat_ws("-", "year", "month")),
        _counts(traced, "traced", F.lit("all")),
        _counts(bronze, "airport_fee", F.col("airport_fee")),
        _counts(trips.trips_silver(bronze), "silver", F.concat_ws("-", "year", "month")),
        _counts(trips.trips_quarantine(bronze), "quarantine", F.col("dq_reason")),
        _counts(rescued, "rescued", F.col("field")),
    )


# --- JSON: rescued lines and their replay --------------------------------------

JSON_FIRST = """
  event_id BIGINT, kind STRING, amount DOUBLE, customer STRUCT<customer_id: BIGINT, segment: STRING>,
  items ARRAY<STRUCT<slot: INT, part: BIGINT>>
"""
JSON_GROWN = """
  event_id BIGINT, kind STRING, amount DOUBLE,
  customer STRUCT<customer_id: BIGINT, segment: STRING, loyalty: STRUCT<tier: INT, since: STRING>>,
  items ARRAY<STRUCT<slot: INT, part: BIGINT, gift: BOOLEAN>>
"""


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line of JSON per event: unknown fields inside objects and lists, customer ids that are no number, broken lines."""
    e = inputs.numbered_events(spark, sf_dir)
    return e.selectExpr(
        "event_id",
        """CASE WHEN k = 13 THEN '{"event_id": ' || event_id ELSE to_json(named_struct(
             'event_id', event_id, 'kind', event_type, 'amount', value,
             'customer', named_struct(
               'customer_id', IF(k % 10 = 3, 'guest-' || user_id, NULL), 'segment', 'S' || user_id % 3,
               'loyalty', IF(k % 10 IN (1, 4), named_struct('tier', k % 4, 'since', '2024'), NULL)),
             'items', array(
               named_struct('slot', 0, 'part', event_id % 7, 'gift', CAST(NULL AS BOOLEAN)),
               named_struct('slot', 1, 'part', event_id % 5, 'gift', IF(k % 10 IN (2, 4), k % 20 = 2, NULL)))))
           END AS value""",
    )


def json_rescue_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed and rescued rows before the schema grows, after it, and after another drop."""
    root = fresh(spark, "json-rescue")
    every, mark = json_lines(spark, sf_dir), f"{root}/checkpoint"
    reports = []

    def land(drop: int) -> None:
        every.filter(F.col("event_id") % DROPS == drop).select("value").write.mode("append").text(f"{root}/landing")
        rescue.ingest_json(spark, f"{root}/landing", f"{root}/tables", mark, schemas.parse(JSON_FIRST), max_files=2)

    def note(state: str) -> None:
        typed, left = rescue.typed_rows(spark, f"{root}/tables"), rescue.rescued_lines(spark, f"{root}/tables")
        replayed = F.when(F.col(batches.BATCH).startswith("replay"), "replayed").otherwise("streamed")
        fields = F.coalesce(F.array_join(F.array_sort(F.json_object_keys(ingest.RESCUED)), ","), F.lit("no object"))
        parts = [_counts(typed, f"{state}: typed", replayed), _counts(left, f"{state}: rescued", fields)]
        if "loyalty" in typed.schema["customer"].dataType.names:
            parts.append(_counts(typed, f"{state}: tier", F.col("customer.loyalty.tier")))
            parts.append(_counts(typed, f"{state}: gift", F.get("items", F.lit(1))["gift"]))
        # What later steps change is counted now.
        report, path = _report(*parts), fresh(spark, "json-rescue-report")
        report.write.parquet(path)
        reports.append(spark.read.schema(report.schema).parquet(path))

    land(0)
    land(1)
    note("1 first")
    rescue.grow(spark, f"{root}/tables", schemas.parse(JSON_GROWN))
    note("2 grown")
    land(2)
    note("3 more")
    return _report(*reports)


# --- delivery: bounded batches, a lost driver ------------------------------------

def delivery_stream_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and state after every run: one batch then a loss, the rest, nothing new."""
    root, table = fresh(spark, "delivery"), fresh_name("delivered")
    events = inputs.table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))
    for drop in range(DROPS):
        events.filter(F.col("event_id") % DROPS == drop).repartition(2).write.mode("append").parquet(f"{root}/landing")
    reports = []
    for state, fault in (("1 lost", lose(0)), ("2 whole", None), ("3 nothing new", None)):
        try:
            batches.ingest_files(spark, f"{root}/landing", table, f"{root}/checkpoint", ["event_type"], max_files=1, after_write=fault)
        except PySparkException as failure:
            if "Lost" not in str(failure):
                raise
        if state != "1 lost":
            held, path = spark.table(table), fresh(spark, "delivery-report")
            one = held.groupBy("event_type").agg(
                F.count("*").alias("rows"), F.count_distinct("event_id").alias("events"),
                F.max("ts").alias("newest")).withColumn("state", F.lit(state))
            one.write.parquet(path)
            reports.append(spark.read.schema(one.schema).parquet(path).withColumn("batches", held.select(F.count_distinct(batches.BATCH)).scalar()))
    return reports[0].unionByName(reports[1])


# --- sources and sinks, written and read back --------------------------------------

SUFFIXES = ("20240105", "20240120")


def export_suffix_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day and name of a suffix range, read back from the partitioned export."""
    path = fresh(spark, "web-export")
    inputs.web_events(spark, sf_dir).write.partitionBy(readers.SUFFIX).parquet(path)
    return readers.web_events(spark, path, *SUFFIXES).groupBy("event_suffix", "event_name").agg(
        F.count("*").alias("events"), F.count_distinct("user_pseudo_id").alias("users"))


def _several(rows: int) -> int:
    """Files for so many documents; they hold half of ``DOCUMENTS`` on the average."""
    return max(1, -(-rows // DOCUMENTS) * 2)


def _land_documents(documents: DataFrame, path: str) -> None:
    """Write (file, data) as files of one folder that each hold a list of documents: those with one number ``file``."""
    lists = documents.groupBy("file").agg(F.to_json(F.collect_list(F.struct("data"))).alias("value"))
    # A file per list, named by Spark; a folder for each would have to be made, renamed and listed by itself.
    lists.repartition("file").select("value").write.option("maxRecordsPerFile", 1).text(path)


def station_history_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings rebuilt from landed documents into dated partitions, and read back."""
    root = fresh(spark, "stations")
    numbered = inputs.station_status(spark, sf_dir).select("data", F.xxhash64("source_file", "data").alias("h"))
    several = _several(inputs.table(spark, sf_dir, "events").count())
    _land_documents(numbered.select("data", F.pmod("h", F.lit(several)).alias("file")), f"{root}/status")
    several = _several(inputs.table(spark, sf_dir, "supplier").count())
    info = inputs.station_info(spark, sf_dir).select("data", F.pmod(F.xxhash64("data"), F.lit(several)).alias("file"))
    _land_documents(info, f"{root}/info")
    found = readers.document_ddl(spark, f"{root}/info", "*")
    curated = stations.station_curated(
        readers.station_status(spark, f"{root}/status", pattern="*"), readers.station_info(spark, f"{root}/info", found, "*"))
    sinks.overwrite_partitioned(curated, f"{root}/curated", ["year", "month", "day"])
    return spark.read.parquet(f"{root}/curated").select(*curated.columns)


def weather_csv_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather landed as headed CSV in dated folders, read by folder pattern."""
    root = fresh(spark, "weather")
    inputs.weather_raw(spark, sf_dir).write.partitionBy("year", "month").option("header", "true").csv(root)
    return trips.weather_daily(trips.weather_bronze(readers.partitioned_weather(spark, root))).drop("ingest_ts")


def zone_csv_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup written by the CSV sink and read back."""
    root = fresh(spark, "zones")
    sinks.write_csv(inputs.zone_lookup(spark, sf_dir), root)
    return trips.dim_zone(readers.zone_lookup(spark, root))


def trip_folders_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per folder and how many of them have their lineage, read from dated folders."""
    root = fresh(spark, "trip-folders")
    sinks.overwrite_partitioned(inputs.trips_bronze(spark, sf_dir), root, ["year", "month"])
    found = readers.with_lineage(readers.partitioned_trips(spark, root))
    traced = F.col("source_file").isNotNull() & F.col("source_file_mod_time").isNotNull() & F.col("ingest_ts").isNotNull()
    return found.groupBy("year", "month").agg(F.count("*").alias("trips"), F.count_if(traced).alias("traced"))


def commerce_append_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each run of the commerce job reports, and rows of the silver table that the runs append to."""
    root = fresh(spark, "commerce")
    every = inputs.commerce_events(spark, sf_dir)
    runs = []
    for drop in range(DROPS):
        # Events without an id go with the first drop.
        number = F.coalesce(F.substring("event_id", 2, 20).cast("bigint") % DROPS, F.lit(0))
        # Nested JSON repeats its names in every row: packed it is a tenth of the bytes.
        sinks.land_json(every.filter(number == drop), f"{root}/landing-{drop}", compression="gzip")
        counts = pipelines.run_commerce(spark, f"{root}/landing-{drop}", f"{root}/silver")
        runs += [(f"run {drop}", layer, rows) for layer, rows in sorted(counts.items())]
    silver = spark.read.parquet(f"{root}/silver")
    return _report(spark.createDataFrame(runs, "layer string, key string, rows bigint"),
                   _counts(silver, "silver", F.col("event_type")), _counts(silver, "processed", F.col("processed_at").isNotNull()))


def trip_lakehouse_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table that the trip job publishes, built twice over the same sources and read from the catalog."""
    root, names = fresh(spark, "lakehouse"), tuple(fresh_name(n) for n in ("bronze", "silver", "gold"))
    inputs.weather_raw(spark, sf_dir).write.partitionBy("year", "month").option("header", "true").csv(f"{root}/weather")
    sinks.write_csv(inputs.zone_lookup(spark, sf_dir), f"{root}/zones")
    for _ in range(2):
        built = pipelines.build_trips(spark, inputs.trips_bronze(spark, sf_dir), f"{root}/weather", f"{root}/zones", names)
    return _report(*[_counts(table, name, F.lit("all")) for name, table in built.items()])
