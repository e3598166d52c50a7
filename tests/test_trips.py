import pytest

from tidemark.operators import trips
from tidemark.plans import pipelines
from tidemark.sources import readers, schemas, sinks


@pytest.fixture
def bronze(spark):
    schema = schemas.parse(f"{schemas.TRIP_DDL}, year INT, month INT")

    def make(*rows):
        def row(pickup="2022-03-09T04:48:40.000", dropoff="2022-03-09T04:58:27.000", distance=2.88, total=15.0,
                zone=164, year=2022, month=3):
            return (2, pickup, dropoff, 4.0, distance, 1.0, "N", zone, 140, 1, 10.0, 2.0, total, year, month)

        return spark.createDataFrame([row(**r) for r in rows], schema)

    return make


def test_worked_record(bronze):
    row = trips.trips_silver(bronze({})).first()
    assert (round(row.trip_minutes, 2), row.pickup_hour, str(row.pickup_date)) == (9.78, 4, "2022-03-09")
    assert (row.pickup_location_id, row.dropoff_location_id, row.passenger_count) == (164, 140, 4)
    assert len(row) == 14


@pytest.mark.parametrize("broken, reason", [
    ({"dropoff": None, "distance": -1.0}, "NULL_TIMESTAMP"),
    ({"dropoff": "2022-03-09T04:48:40.000"}, "NEGATIVE_OR_ZERO_DURATION"),
    ({"dropoff": "2022-03-09T08:48:41.000"}, "DURATION_TOO_LONG"),
    ({"distance": 0.0, "total": 0.0}, "NONPOSITIVE_DISTANCE"),
    ({"total": 0.0}, "NONPOSITIVE_TOTAL_AMOUNT"),
    ({"month": 4}, "EVENT_TIME_OUTSIDE_SOURCE_PARTITION"),
])
def test_first_broken_rule_is_reported(bronze, broken, reason):
    assert [r.dq_reason for r in trips.trips_quarantine(bronze(broken)).collect()] == [reason]
    assert trips.trips_silver(bronze(broken)).count() == 0


def test_rows_in_neither_output_are_counted(bronze):
    data = bronze({}, {"dropoff": "2022-03-09T04:49:10.000"}, {"distance": None}, {"total": -1.0})
    assert tuple(trips.trip_reconciliation(data).first()) == (4, 1, 1, 2)
    edges = bronze({"dropoff": "2022-03-09T04:49:40.000"}, {"dropoff": "2022-03-09T08:48:40.000"})
    assert trips.trips_silver(edges).count() == 2


def weather(spark, *rows):
    return spark.createDataFrame(rows, "date string, tmin_c string, tmax_c string, prcp_mm string, snow_mm string")


def test_weather_validity(spark):
    days = trips.weather_daily(weather(
        spark, ("2022-03-09", "1", "5", "0.2", "0"), ("2022-03-10", "-51", "5", "0", "0"),
        ("2022-03-11", "1", "61", "0", "0"), ("2022-03-12", "1", "5", None, "0"), ("soon", "1", "5", "0", "0"),
        ("2022-03-13", "1", "5", "0", "-1"), ("2022-03-14", "x", "5", "0", "0"),
    )).collect()
    assert [(str(d.date), d.is_rain, d.is_snow) for d in days] == [("2022-03-09", True, False)]


def test_daily_kpis(spark, bronze):
    zones = trips.dim_zone(spark.createDataFrame([("164", "Manhattan", "Midtown", "Yellow Zone")], schemas.ZONE_DDL))
    sky = trips.weather_daily(weather(spark, ("2022-03-09", "1", "5", "0.2", "0")))
    silver = trips.trips_silver(bronze({}, {"total": 25.0}, {"zone": 999, "distance": 8.0}))
    found = {r.zone: (r.trips, r.revenue, r.avg_distance, r.rain_mm) for r in
             trips.zone_daily_kpis(silver, zones, sky).collect()}
    assert found == {"Midtown": (2, 40.0, 2.88, 0.2), None: (1, 15.0, 8.0, 0.2)}
    city = trips.city_daily_kpis(silver, sky).first()
    assert (city.trips, city.revenue, city.is_rain) == (3, 55.0, True)


def test_lakehouse_end_to_end(spark, bronze, tmp_path):
    root = str(tmp_path)
    bronze({}, {"total": 0.0}).write.partitionBy("year", "month").parquet(f"{root}/trips")
    weather(spark, ("2022-03-09", "1", "5", "0.2", "0")).selectExpr("*", "2022 AS year", "3 AS month").write.partitionBy(
        "year", "month").option("header", "true").csv(f"{root}/weather")
    sinks.write_csv(spark.createDataFrame([("164", "Manhattan", "Midtown", "Yellow Zone")], schemas.ZONE_DDL), f"{root}/zones")
    pipelines.ingest_trips(spark, f"{root}/trips", "trips_raw", f"{root}/checkpoint")
    pipelines.ingest_trips(spark, f"{root}/trips", "trips_raw", f"{root}/checkpoint")
    raw = spark.table("trips_raw")
    assert raw.count() == 2 and {"source_file", "source_file_mod_time", "ingest_ts"} <= set(raw.columns)
    for _ in range(2):
        built = pipelines.build_trips(spark, readers.partitioned_trips(spark, f"{root}/trips"), f"{root}/weather", f"{root}/zones")
    assert built["trips"].count() == 1 and built["trips_quarantine"].first().dq_reason == "NONPOSITIVE_TOTAL_AMOUNT"
    assert built["zone_daily_kpis"].first().borough == "Manhattan" and built["city_daily_kpis"].count() == 1
    assert spark.table("taxi_gold.kpi_city_daily").first().total_trips == 1
    assert trips.preview(built["weather_raw"]).count() == 1


def land(spark, folder, name, *rows, extra=None):
    """One file of trips in a flat folder: (pickup, distance), written under a name of its own."""
    out = spark.createDataFrame(
        [(2, f"2022-{m:02d}-09T04:48:40.000", f"2022-{m:02d}-09T04:58:27.000", 4.0, d, 1.0, "N", 164, 140, 1, 10.0, 2.0, 15.0)
         for m, d in rows], schemas.parse(schemas.TRIP_DDL))
    if extra:
        out = out.selectExpr("*", f"'{extra}' AS extra_fee")
    out.coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def bronze_table(spark):
    spark.sql("DROP TABLE IF EXISTS taxi_runs.trips_raw")
    yield "taxi_runs.trips_raw"
    spark.sql("DROP SCHEMA IF EXISTS taxi_runs CASCADE")


@pytest.mark.parametrize("mode", ["addNewColumns", "rescue"])
def test_every_run_lands_in_its_month(spark, tmp_path, bronze_table, mode):
    folder, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    for name, rows, extra in (("a", [(3, 1.0), (3, 2.0)], None), ("b", [(4, 3.0)], None), ("c", [(5, 4.0), (5, -1.0)], "7")):
        land(spark, folder, name, *rows, extra=extra)
        pipelines.ingest_trips(spark, folder, bronze_table, checkpoint, mode)
    pipelines.ingest_trips(spark, folder, bronze_table, checkpoint, mode)      # nothing new
    bronze = spark.table(bronze_table)
    assert sorted((r.year, r.month, r["count"]) for r in bronze.groupBy("year", "month").count().collect()) == [
        (2022, 3, 2), (2022, 4, 1), (2022, 5, 2)]
    assert trips.trips_silver(bronze).count() == 4
    assert [r.dq_reason for r in trips.trips_quarantine(bronze).collect()] == ["NONPOSITIVE_DISTANCE"]
    if mode == "rescue":
        assert "extra_fee" not in bronze.columns
        assert sorted(r._rescued_data or "" for r in bronze.collect()) == ["", "", "", '{"extra_fee":"7"}', '{"extra_fee":"7"}']
    else:
        assert sorted(r.extra_fee or "" for r in bronze.collect()) == ["", "", "", "7", "7"]
