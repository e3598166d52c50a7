import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality, web_marts, web_purchases, web_sessions
from tidemark.plans import inputs, pipelines
from tidemark.plans.catalog import QUERIES
from tidemark.sources import readers, schemas, sinks
from tidemark.streaming import ingest


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def exported(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("web") / "events")
    inputs.web_events(spark, sf_dir, items=True, geo=True).write.partitionBy("event_suffix").parquet(path)
    return path


def test_suffix_range_prunes_partitions(spark, exported):
    days = readers.web_events(spark, exported, "20240103", "20240105")
    text = plan(days.select("user_pseudo_id"))
    assert "PartitionFilters: [isnotnull(event_suffix" in text and "20240105" in text
    assert [r[0] for r in days.select("event_suffix").distinct().orderBy("event_suffix").collect()] == [
        "20240103", "20240104", "20240105"]


def test_scans_read_only_what_is_used(spark, exported):
    events = readers.web_events(spark, exported)
    rows = web_sessions.int_sessions(events, touch=("platform",), transaction_count=False)
    text = plan(rows.groupBy("platform").agg(F.sum("purchases")))
    assert "geo" not in text and "items:" not in text and "traffic_source" not in text
    lines = plan(web_purchases.purchase_lines(events).select("product_key", "copies"))
    assert "PushedFilters: [IsNotNull(event_name), EqualTo(event_name,purchase)" in lines
    assert "item_variant" not in lines and "item_category5" not in lines


def test_unpivot_scans_once(spark, exported):
    daily = web_marts.agg_daily_sessions(web_sessions.int_sessions(readers.web_events(spark, exported)))
    long = plan(web_marts.agg_daily_funnel_long(daily))
    assert long.count("Scan parquet") // 2 == plan(daily).count("Scan parquet") // 2 == 1


def test_no_python_and_no_nested_loops_in_plans(spark, sf_dir):
    for name in ("rpt_sessions_wide", "rpt_product_sales", "commerce_silver", "zone_daily_kpis", "station_incremental"):
        text = plan(QUERIES[name](spark, sf_dir), "simple")
        assert "Python" not in text and "NestedLoop" not in text and "Cartesian" not in text, name


def test_whole_web_build(spark, exported):
    checks = quality.Checks()
    built = pipelines.build_web(spark, exported, default_schema="default", checks=checks)
    counted = {(r.table_name, r.column_name): r.failures for r in checks.rows(spark).collect()}
    names = {n for n, _ in counted}
    assert {"stg_event_param_pivot", "int_sessions", "fct_purchases", "dim_products", "agg_daily_sessions"} <= names
    for name in names:
        again = quality.null_counts(built[name], name).collect()
        assert {r.column_name: r.failures for r in again} == {c: n for (t, c), n in counted.items() if t == name}
    assert len(built) == 41
    for name in ("int_purchase_items", "dim_items", "rpt_product_sales", "rpt_purchase_dq_analysis", "analysis_incomplete_purchases"):
        assert built[name].count() == built[f"{name}_weighted"].agg(F.sum("copies")).first()[0]
    names = {t.name for t in spark.catalog.listTables("marts")}
    assert {"agg_daily_sessions", "rpt_sessions_wide", "dim_products"} <= names and "int_geo" not in {
        t.name for t in spark.catalog.listTables("marts") if not t.isTemporary}
    assert built["fct_events"].count() == spark.read.parquet(exported).count()


def test_a_window_leaves_other_days_as_they_are(spark, exported, tmp_path):
    pipelines.build_web(spark, exported)

    def state():
        return {name: sorted(map(str, spark.table(f"marts.{name}").collect())) for name in (
            "dim_product_daily", "agg_daily_sessions", "agg_daily_geo", "fct_purchases", "dim_funnel_daily", "dim_views")}

    whole, sessions_before = state(), spark.table("staging.int_sessions").count()
    # An export that has only two days: the others must come from the tables.
    part = str(tmp_path / "part")
    readers.web_events(spark, exported, "20240105", "20240106").write.partitionBy("event_suffix").parquet(part)
    built = pipelines.build_web(spark, part, "20240105", "20240106", window=True)
    assert "rpt_sessions_wide" not in built and "int_sessions" in built
    assert state() == whole and spark.table("staging.int_sessions").count() == sessions_before
    # One of the days loses half of its events: its rows change, those of other days do not.
    less = str(tmp_path / "less")
    readers.web_events(spark, part, "20240105", "20240105").filter("event_name <> 'purchase'").write.partitionBy("event_suffix").parquet(less)
    pipelines.build_web(spark, less, "20240105", "20240105", window=True)
    rows = spark.table("marts.agg_daily_sessions")
    assert sorted(map(str, rows.collect())) != whole["agg_daily_sessions"]
    other = [r for r in whole["agg_daily_sessions"] if "2024, 1, 5)" not in r]
    assert [r for r in sorted(map(str, rows.collect())) if "2024, 1, 5)" not in r] == other


def test_null_checks_read_each_raw_table_once(spark, sf_dir, monkeypatch):
    """The check's raw scans: the job that stores the events; what it returns reads stored models only."""
    stored = []
    real = inputs.table
    monkeypatch.setattr(inputs, "table", lambda s, d, name: stored.append(name) or real(s, d, name))
    text = plan(QUERIES["dq_not_null"](spark, sf_dir))
    assert sorted(stored) == ["events", "lineitem"] and f"{sf_dir}/" not in text


def test_schema_names():
    assert sinks.schema_name("  marts ") == "marts" and sinks.schema_name(None, "dev") == "dev"


def test_dynamic_overwrite_replaces_only_touched_days(spark, tmp_path):
    out = str(tmp_path / "t")
    sinks.overwrite_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), out, ["p"])
    sinks.overwrite_partitioned(spark.createDataFrame([(9, "b")], "v int, p string"), out, ["p"], dynamic=True)
    assert sorted(tuple(r) for r in spark.read.parquet(out).select("v", "p").collect()) == [(1, "a"), (9, "b")]


def test_commerce_job_counts_without_extra_jobs(spark, sf_dir, tmp_path):
    sinks.land_json(inputs.commerce_events(spark, sf_dir), str(tmp_path / "in"))
    counts = pipelines.run_commerce(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert counts == {"bronze": 1000, "silver": written.count()}
    assert {"event_type", "event_date"} <= set(written.columns)


def test_stream_takes_each_file_once(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def run():
        stream = ingest.file_stream(spark, source, spark.read.parquet(source).schema)
        ingest.ingest_available(stream, out, mark, ["p"], name="bronze")
        return spark.read.parquet(out).count()

    spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string").write.parquet(source)
    assert (run(), run()) == (2, 2)
    spark.createDataFrame([(3, "c")], "v int, p string").write.mode("append").parquet(source)
    assert run() == 3
    assert spark.read.parquet(out).filter("source_file IS NULL OR ingest_ts IS NULL").count() == 0


def test_processing_time_trigger(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(3).write.parquet(source)
    query = ingest.start_to_path(ingest.file_stream(spark, source, spark.read.parquet(source).schema), str(tmp_path / "out"),
                                 str(tmp_path / "mark"), trigger={"processingTime": "1 second"})
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_schema_evolution_modes(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1,)], "a int").write.parquet(source)
    known = ingest.observed_schema(spark, source)
    spark.createDataFrame([(2, "x")], "a int, b string").write.mode("append").parquet(source)
    seen = ingest.observed_schema(spark, source)
    assert ingest.evolve(known, seen).names == ["a", "b"]
    assert ingest.evolve(known, seen, ingest.RESCUE).names == ["a"]
    with pytest.raises(ingest.NewColumnsError, match="b"):
        ingest.evolve(known, seen, ingest.FAIL_ON_NEW_COLUMNS)
    wide = spark.read.schema(seen).parquet(source)
    rescued = {r.a: r._rescued_data for r in ingest.rescue_columns(wide, known).collect()}
    assert rescued == {1: None, 2: '{"b":"x"}'}


def test_rescued_json(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ['{"a": 1, "b": "x"}', '{"a": "many", "b": "y"}', '{"a": 2, "c": {"d": 1}}', "not json", '{"a": 3}']
    (tmp_path / "in" / "f.json").write_text("\n".join(lines) + "\n")
    schema = ingest.evolve(spark.createDataFrame([], "a int, b string").schema, spark.createDataFrame([], "a int").schema)
    stream = ingest.rescuing_json_stream(spark, str(tmp_path / "in"), schema)
    ingest.ingest_available(stream, str(tmp_path / "out"), str(tmp_path / "mark"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    found = sorted(((r.a, r.b, r._rescued_data) for r in rows), key=str)
    kept = {(a, b): json.loads(x) if x and x.startswith("{") else x for a, b, x in found}
    assert kept == {(1, "x"): None, (None, "y"): {"a": "many"}, (2, None): {"c": '{"d":1}'},
                    (None, None): "not json", (3, None): None}


def test_lineage_columns(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t"))
    rows = readers.with_lineage(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert all(r.source_file.endswith(".parquet") and r.source_file_mod_time and r.ingest_ts for r in rows)


def test_a_cluster_has_to_name_its_shared_folder():
    from tidemark import session

    class Context:
        applicationId = "a"

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    for master in ("spark://host:7077", "local-cluster[3,2,1024]", "yarn"):
        Context.master = master
        with pytest.raises(RuntimeError):
            session.shared_folder(Session())
    Context.master = "local[4]"
    assert session.shared_folder(Session())


def test_misfits_are_kept_at_any_depth(spark):
    from tidemark.streaming import ingest
    schema = schemas.parse("a STRING, customer STRUCT<customer_id: INT, name: STRING>, "
                           "order STRUCT<items: ARRAY<STRUCT<id: INT, product: STRUCT<price: DOUBLE>>>, total: DOUBLE>")
    lines = [
        {"a": "x", "customer": {"customer_id": 1, "name": "n"}, "order": {"items": [{"id": 1, "product": {"price": 2.5}}], "total": 3}},
        {"a": "y", "customer": {"customer_id": "abc", "name": "n", "loyalty": {"tier": 2}}, "new": [1, 2]},
        {"order": {"items": [{"id": 1}, {"id": "two", "gift": True, "product": {"price": 1.0, "tax": 0.5}}], "coupon": "C"}, "customer": 7},
    ]
    rows = spark.createDataFrame([(json.dumps(x),) for x in lines] + [("no json",), ("{}",)], "value string")
    found = [(r.a, json.loads(r._rescued_data) if (r._rescued_data or "").startswith("{") else r._rescued_data)
             for r in ingest.rescue_json(rows, schema).collect()]
    assert found[0] == ("x", None) and found[3] == (None, "no json") and found[4] == (None, None)
    assert found[1] == ("y", {"customer.customer_id": "abc", "customer.loyalty": '{"tier":2}', "new": "[1,2]"})
    assert found[2] == (None, {"order.items[1].id": "two", "order.items[1].gift": "true", "order.items[1].product.tax": "0.5",
                               "order.coupon": "C", "customer": "7"})
