"""Micro-batch ingestion: schema evolution by the files taken, whole and single delivery."""

import json
import os
from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from tidemark.operators import quality
from tidemark.plans import pipelines
from tidemark.sources import schemas
from tidemark.streaming import batches, ingest


@pytest.fixture
def landing(spark, tmp_path):
    spark.sql("DROP SCHEMA IF EXISTS batch_runs CASCADE")

    class Landing:
        folder, checkpoint, table = str(tmp_path / "landing"), str(tmp_path / "checkpoint"), "batch_runs.trips"
        n = 0

        def land(self, month, distances, days_old=0, **extra):
            """One file of trips; ``extra`` are further columns as SQL."""
            Landing.n += 1
            staged = str(tmp_path / f"staged-{self.n}")
            rows = [(2, f"2022-{month:02d}-09T04:48:40.000", f"2022-{month:02d}-09T04:58:27.000", 4.0, d, 1.0, "N", 164, 140, 1, 10.0, 2.0, 15.0)
                    for d in distances]
            out = spark.createDataFrame(rows, schemas.parse(schemas.TRIP_DDL)).selectExpr("*", *[f"{v} AS {k}" for k, v in extra.items() if k not in REPLACED])
            out = out.withColumns({k: extra[k] for k in REPLACED if k in extra})
            out.coalesce(1).write.parquet(staged)
            os.makedirs(self.folder, exist_ok=True)
            part = next(f for f in os.listdir(staged) if f.endswith(".parquet"))
            target = f"{self.folder}/drop {self.n} {{a,b}} é.parquet"
            os.rename(f"{staged}/{part}", target)
            then = os.path.getmtime(target) - 86_400 * days_old
            os.utime(target, (then, then))

        def run(self, mode=ingest.ADD_NEW_COLUMNS, **options):
            pipelines.ingest_trips(spark, self.folder, self.table, self.checkpoint, mode, **options)
            return spark.table(self.table)

    REPLACED = ("trip_distance",)
    yield Landing()
    spark.sql("DROP SCHEMA IF EXISTS batch_runs CASCADE")


@pytest.mark.parametrize("days_old", [0, 1, 30])
def test_a_file_of_any_age_adds_its_column(landing, days_old):
    landing.land(3, [1.0, 2.0])
    assert landing.run().count() == 2
    landing.land(4, [3.0], days_old, airport_fee="1.25D")
    landing.land(4, [4.0])
    landing.run()
    landing.land(5, [5.0], days_old, extra="'x'")
    found = landing.run()
    assert {(r.trip_distance, r.airport_fee, r.extra) for r in found.collect()} == {
        (1.0, None, None), (2.0, None, None), (3.0, 1.25, None), (4.0, None, None), (5.0, None, "x")}
    assert sorted((r.year, r.month, r["count"]) for r in found.groupBy("year", "month").count().collect()) == [
        (2022, 3, 2), (2022, 4, 2), (2022, 5, 1)]
    assert landing.run().count() == 5       # nothing new


def test_refused_columns_leave_the_files_to_be_taken(landing):
    landing.land(3, [1.0])
    landing.run(ingest.FAIL_ON_NEW_COLUMNS)
    landing.land(4, [2.0], days_old=1, airport_fee="1.25D")
    for _ in range(2):
        with pytest.raises(ingest.NewColumnsError, match="airport_fee"):
            landing.run(ingest.FAIL_ON_NEW_COLUMNS)
    found = landing.run(ingest.ADD_NEW_COLUMNS)
    assert sorted((r.trip_distance, r.airport_fee) for r in found.select("trip_distance", "airport_fee").na.fill(0).collect()) == [(1.0, 0.0), (2.0, 1.25)]


def test_rescue_keeps_unknown_columns_and_misfits(spark, landing):
    from pyspark.sql import functions as F
    landing.land(3, [1.0])
    landing.run(ingest.RESCUE)
    landing.land(4, [2.0, 3.0], days_old=2, airport_fee="1.25D")
    landing.land(4, [7.0], trip_distance=F.lit("far"))
    landing.land(4, [8.0], trip_distance=F.lit("8.5"))
    found = landing.run(ingest.RESCUE)
    assert "airport_fee" not in found.columns
    got = sorted((r.trip_distance or 0.0, json.loads(r._rescued_data or "{}")) for r in found.collect())
    assert got == [(0.0, {"trip_distance": "far"}), (1.0, {}), (2.0, {"airport_fee": 1.25}), (3.0, {"airport_fee": 1.25}), (8.5, {})]


def test_a_killed_batch_is_delivered_once(spark, landing):
    for month in (3, 4, 5):
        landing.land(month, [float(month), month + 0.5])

    def crash(number):
        if number == 1:
            raise RuntimeError("lost")

    with pytest.raises(PySparkException):
        landing.run(max_files=1, after_write=crash)
    # The second batch is written but not committed.
    assert spark.table(landing.table).count() == 4
    found = landing.run(max_files=1)
    assert sorted(r.trip_distance for r in found.collect()) == [3.0, 3.5, 4.0, 4.5, 5.0, 5.5]
    assert found.select(batches.BATCH).distinct().count() == 3


def test_folders_give_the_partition_columns(spark, landing, tmp_path):
    rows = [(2, "2022-03-09T04:48:40.000", "2022-03-09T04:58:27.000", 4.0, 1.0, 1.0, "N", 164, 140, 1, 10.0, 2.0, 15.0)]
    spark.createDataFrame(rows, schemas.parse(schemas.TRIP_DDL)).selectExpr("*", "2022 AS year", "4 AS month").write.partitionBy("year", "month").parquet(landing.folder)
    assert [(r.year, r.month) for r in landing.run().collect()] == [(2022, 4)]


def test_an_empty_folder_is_an_error(landing):
    os.makedirs(landing.folder)
    with pytest.raises(quality.EmptySourceError):
        landing.run()


def test_values_that_change_under_the_known_type_are_kept(spark):
    own = spark.createDataFrame([(1.5, 2.0, "7", "x", datetime(2024, 1, 1)), (None, None, None, None, None)],
                                "a double, b double, c string, d string, e timestamp")
    known = schemas.parse("a BIGINT, b BIGINT, c INT, d ARRAY<INT>, e DOUBLE, f DATE")
    first, second = batches.conform(own, known).collect()
    assert tuple(first)[:-1] == (None, 2, 7, None, first.e, None) and tuple(second) == (None,) * 7
    rescued = json.loads(first._rescued_data)
    assert rescued["a"] == 1.5 and rescued["d"] == "x" and "b" not in rescued and "c" not in rescued
