"""A third of all rows on one key: joins must split it and results must stay whole."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import loose, repeat_rows
from tidemark.operators import web_marts, web_purchases, web_sessions
from tidemark.plans.catalog import QUERIES
from tidemark.sources import schemas, sinks

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def flood(spark, tmp_path_factory):
    """6000 purchases: 2001 records of one event with different items, half of all events in one client session."""
    path = str(tmp_path_factory.mktemp("flood"))
    rows = spark.range(0, 6000, numPartitions=6).select("id", F.greatest(F.col("id") - 2000, F.lit(0)).alias("n"))
    events = rows.selectExpr(
        "'20240101' AS event_date", "1704067200000000 + n * 1000000 AS event_timestamp", "'purchase' AS event_name",
        "'user' || n DIV 2 AS user_pseudo_id", "'WEB' AS platform",
        "CAST(NULL AS STRUCT<operating_system: STRING, category: STRING, mobile_brand_name: STRING, web_info: STRUCT<browser: STRING>>) AS device",
        "named_struct('continent', 'c', 'sub_continent', 's', 'country', 'country', 'region', 'r', 'city', 'c') AS geo",
        "CAST(NULL AS STRUCT<source: STRING, medium: STRING, name: STRING>) AS traffic_source",
        """array(
             named_struct('key', 'ga_session_id', 'value', named_struct('string_value', CAST(NULL AS STRING),
               'int_value', IF(n < 3000, 1L, n), 'float_value', CAST(NULL AS DOUBLE), 'double_value', CAST(NULL AS DOUBLE))),
             named_struct('key', 'ga_session_number', 'value', named_struct('string_value', CAST(NULL AS STRING),
               'int_value', 1L, 'float_value', CAST(NULL AS DOUBLE), 'double_value', CAST(NULL AS DOUBLE))),
             named_struct('key', 'transaction_id', 'value', named_struct('string_value', 'T' || n,
               'int_value', CAST(NULL AS BIGINT), 'float_value', CAST(NULL AS DOUBLE), 'double_value', CAST(NULL AS DOUBLE)))
           ) AS event_params""",
        """array(named_struct('item_id', 'i' || sha2(CAST(id AS STRING), 512), 'item_name', 'x', 'item_brand', 'b', 'item_variant', 'v',
             'item_category', 'c', 'item_category2', '', 'item_category3', '', 'item_category4', '', 'item_category5', '',
             'price', 2D, 'quantity', 3L, 'item_revenue', CAST(NULL AS DOUBLE))) AS items""",
    )
    events.write.mode("overwrite").parquet(path)
    return spark.read.schema(schemas.parse(schemas.WEB_EVENT_DDL)).parquet(path)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    frame = df.toDF(*df.columns)
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_hot_event_is_split_and_counted_whole(spark, flood, small_splits):
    lines = web_purchases.purchase_lines(flood)
    assert "skew=true" in final_plan(lines.select("event_id", "item_id", "copies"))
    totals = web_purchases.fct_purchases(lines).agg(F.count("*"), F.sum("items_count"), F.sum("total_quantity")).first()
    hot = 2001
    assert tuple(totals) == (4000, hot * hot + 3999, 3 * (hot * hot + 3999))


def test_hot_session_id_is_split(spark, flood, small_splits):
    sessions = web_sessions.int_sessions(flood, touch=(), transaction_count=False)
    facts = web_sessions.fct_sessions(sessions)
    wide = web_marts.rpt_sessions_wide(flood, facts, web_purchases.purchase_lines(flood))
    rows = wide.groupBy("session_id").agg(F.count("*").alias("n")).orderBy(F.col("n").desc()).collect()
    assert (rows[0].session_id, rows[0].n) == (1, 1500)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Exchange RoundRobin" in plan


def test_hot_session_holds_no_list(spark, small_splits):
    """Half of all events and 3,000 transactions in one session: counted by id first, so no row or task holds them."""
    def param(key, **value):
        kinds = {"string_value": "STRING", "int_value": "BIGINT", "float_value": "DOUBLE", "double_value": "DOUBLE"}
        slots = ", ".join(f"'{k}', CAST({value.get(k, 'NULL')} AS {t})" for k, t in kinds.items())
        return f"named_struct('key', '{key}', 'value', named_struct({slots}))"

    empty = {f.name: f.dataType.simpleString() for f in schemas.parse(schemas.WEB_EVENT_DDL).fields}
    made = {
        "event_date": "'20240101'", "event_timestamp": "1704067200000000 + id * 1000000", "event_name": "'purchase'",
        "user_pseudo_id": "IF(id < 3000, 'hot', 'u' || id)",
        "event_params": "array(" + ", ".join([param("ga_session_id", int_value="1"), param("ga_session_number", int_value="1"),
                                               param("transaction_id", string_value="'T' || id")]) + ")"}
    events = spark.range(0, 6000, numPartitions=6).selectExpr(*[f"{made.get(n, f'CAST(NULL AS {t})')} AS {n}" for n, t in empty.items()])
    rows = web_sessions.int_sessions(events)
    text = final_plan(rows.select("user_pseudo_id", "transaction_count"))
    assert "collect_" not in text and "transaction_id" in text.split("Exchange hashpartitioning", 1)[1]
    assert {(r.user_pseudo_id, r.transaction_count) for r in rows.filter("transaction_count > 1").collect()} == {("hot", 3000)}
    bridge = web_sessions.session_transactions(events)
    assert bridge.count() == 6000 and "collect_" not in final_plan(bridge)


def test_an_order_with_a_third_of_all_lines_is_split(spark, sf_dir, tmp_path, small_splits):
    """Item-level queries never nest an order's lines, so one order may have any number of them."""
    hot = spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_type = 'purchase' AND event_id % 10 <> 9").filter(
        F.get_json_object("props", "$.k").cast("int").isin(3, 14, 25, 36, 63, 74, 85)).agg(F.min("event_id")).first()[0]
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    n = 30_000
    more = lines.limit(1).crossJoin(spark.range(n)).withColumns({
        "l_orderkey": F.lit(hot).cast(lines.schema["l_orderkey"].dataType), "l_partkey": F.pmod(F.xxhash64("id"), F.lit(10 ** 9)).cast(lines.schema["l_partkey"].dataType)}).drop("id")
    lines.filter(F.col("l_orderkey") != hot).unionByName(more).repartition(6).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(6).write.parquet(str(tmp_path / "events.parquet"))
    for other in ("customer", "nation", "region"):
        spark.read.parquet(f"{sf_dir}/{other}.parquet").write.parquet(str(tmp_path / f"{other}.parquet"))
    for name in ("stg_items", "int_purchase_items", "dim_items", "dim_product_daily", "agg_daily_product_revenue", "filter_loss_audit",
                 "hourly_category_revenue", "customer_ltv"):
        text = QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert "collect_list" not in text and "collect_set" not in text, name
    items = QUERIES["stg_items"](spark, str(tmp_path))
    assert "skew=true" in final_plan(items.select("event_id", "item_id", "price"))
    hot_rows = items.groupBy("event_id").count().agg(F.max("count")).first()[0]
    assert hot_rows == n
    bought = QUERIES["int_purchase_items"](spark, str(tmp_path))
    assert bought.groupBy("user_pseudo_id", "purchase_ts").count().agg(F.max("count")).first()[0] == n
    units = lines.agg(F.sum("l_quantity")).first()[0]
    assert QUERIES["commerce_silver"](spark, str(tmp_path)).groupBy("event_id").count().agg(F.max("count")).first()[0] > 20_000 and units > 0


def test_loose_lookup_lets_the_join_split(spark, small_splits):
    left = spark.range(0, 60000, numPartitions=6).selectExpr("IF(id % 3 = 0, id, 1L) AS k", "sha2(CAST(id AS STRING), 256) AS v")
    lookup = spark.range(0, 60000).selectExpr("id AS k", "id AS w").repartition(6).groupBy("k").agg(F.max("w").alias("w"))
    assert "skew=true" not in final_plan(left.join(lookup, "k", "left"))
    split = left.join(loose(lookup), "k", "left")
    assert "skew=true" in final_plan(split)
    assert split.filter("w IS NULL").count() == 0 and split.count() == 60000


def test_hot_partition_value_is_written_by_several_tasks(spark, tmp_path, small_splits):
    rows = spark.range(0, 30000, numPartitions=6).selectExpr("sha2(CAST(id AS STRING), 256) AS v", "IF(id % 3 = 0, 'cold', 'hot') AS p")
    sinks.overwrite_partitioned(rows, str(tmp_path / "t"), ["p"], max_records_per_file=None)
    files = spark.read.parquet(str(tmp_path / "t")).filter("p = 'hot'").select("_metadata.file_name").distinct().count()
    assert files > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 30000


def test_repeat_rows_crosses_block_boundaries(spark):
    df = spark.createDataFrame([("a", 1), ("b", 4096), ("c", 4097), ("d", 10000), ("e", 0)], "k string, n bigint")
    counts = {r.k: r["count"] for r in repeat_rows(df, "n").groupBy("k").count().collect()}
    assert counts == {"a": 1, "b": 4096, "c": 4097, "d": 10000}
