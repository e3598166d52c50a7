import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import quality, stations
from tidemark.plans import jobs, pipelines
from tidemark.sources import readers, snapshots

NOON = 1_764_849_600  # 2025-12-04 12:00:00 UTC


def write(root, folder, name, station_list):
    path = root / folder
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(json.dumps({"last_updated": 1, "data": {"stations": station_list}}, indent=1))


def status(station, at=NOON, **types):
    return {"station_id": station, "num_bikes_available_types": types, "last_reported": at}


@pytest.fixture
def feed(tmp_path):
    info, live = tmp_path / "raw" / "info", tmp_path / "raw" / "status"
    write(info, "2025/12/03", "230000.json", [{"station_id": "a", "name": "Old"}])
    write(info, "2025/12/04", "010000.json", [{"station_id": "a", "name": "New"}, {"station_id": "b", "name": "B"}])
    write(live, "2025/12/04", "115959.json", [status("a", NOON - 1, electric=1, classic=2), status("zz", NOON)])
    write(live, "2025/12/04", "073000.json", [status("a", NOON - 16_200, classic=5)])
    write(live, "2025/12/04", "120000.json", [])
    write(live, "2025/13/99", "120000.json", [status("b", NOON, electric=7)])
    return str(info), str(live), str(tmp_path / "out")


def test_latest_goes_by_date_then_time(spark, feed):
    newest = snapshots.latest_snapshot(snapshots.list_files(spark, feed[0])).first()[0]
    assert newest.endswith("2025/12/04/010000.json")


def names(df):
    return sorted("/".join(r[0].split("/")[-4:]) for r in df.collect())


def test_look_back_keeps_unreadable_dates(spark, feed):
    files = snapshots.list_files(spark, feed[1])
    assert names(snapshots.recent_snapshots(files, "2025-12-04 12:00:00", 4)) == [
        "2025/12/04/115959.json", "2025/12/04/120000.json", "2025/13/99/120000.json"]
    assert len(names(snapshots.recent_snapshots(files, "2025-12-04 11:30:00", 4))) == 4
    readable = files.filter("source_file NOT LIKE '%/13/%'")
    assert names(snapshots.recent_snapshots(readable, "2026-01-01 00:00:00", 4)) == ["2025/12/04/120000.json"]


def test_incremental_run_appends_and_can_be_idempotent(spark, feed):
    info, live, out = feed
    pipelines.run_stations_incremental(spark, info, live, out, "2025-12-04 12:00:00")
    rows = spark.read.parquet(out).orderBy("station_id").collect()
    assert [(r.station_id, r.name, r.electric, r.classic, r.day) for r in rows] == [
        ("a", "New", 1, 2, 4), ("b", "B", 7, None, 4)]
    pipelines.run_stations_incremental(spark, info, live, out, "2025-12-04 12:00:00", idempotent=True)
    assert spark.read.parquet(out).count() == 2
    pipelines.run_stations_incremental(spark, info, live, out, "2025-12-04 12:00:00")
    assert spark.read.parquet(out).count() == 4
    assert stations.once_per_reading(spark.read.parquet(out)).count() == 2


def test_backfill_replaces_everything(spark, feed):
    info, live, out = feed
    for _ in range(2):
        pipelines.run_stations_backfill(spark, info, live, out, max_records_per_file=1)
    assert spark.read.parquet(out).count() == 3


def test_missing_bike_type_is_null_or_zero(spark, feed):
    documents = readers.station_status(spark, feed[1])
    kept = stations.status_readings(documents).filter("station_id = 'b'").first()
    zeroed = stations.status_readings(documents, missing_as_zero=True).filter("station_id = 'b'").first()
    assert (kept.classic, zeroed.classic) == (None, 0)


def test_shared_columns_are_told_apart(spark):
    station = "data STRUCT<stations: ARRAY<STRUCT<station_id: STRING, name: STRING{}>>>"
    live = spark.createDataFrame([(([("a", "seen", (1, 2), NOON)],),)], station.format(
        ", num_bikes_available_types: STRUCT<electric: INT, classic: INT>, last_reported: BIGINT"))
    info = spark.createDataFrame([(([("a", "official")],),)], station.format(""))
    row = stations.station_curated(live, info).first()
    assert (row.name, row.name_info) == ("seen", "official")


def test_empty_feed_is_an_error(spark, feed, tmp_path):
    (tmp_path / "nothing").mkdir()
    with pytest.raises(quality.EmptySourceError):
        pipelines.run_stations_backfill(spark, feed[0], str(tmp_path / "nothing"), feed[2])
    with pytest.raises(quality.EmptySourceError):
        pipelines.run_stations_incremental(spark, feed[0], str(tmp_path / "nothing"), feed[2], "2025-12-04 12:00:00")


def test_all_fields_and_readings_without_a_time(spark, tmp_path):
    info, live, out = tmp_path / "info", tmp_path / "live" / "2025" / "12" / "04", str(tmp_path / "out")
    (info / "2025" / "12" / "04").mkdir(parents=True)
    live.mkdir(parents=True)
    bikes = {"electric": 1, "classic": 2}
    (info / "2025" / "12" / "04" / "100000.json").write_text(json.dumps(
        {"data": {"stations": [{"station_id": "a", "name": "A", "capacity": 9}]}}))
    (live / "113000.json").write_text(json.dumps({"data": {"stations": [
        {"station_id": "a", "num_bikes_available_types": bikes, "is_renting": 1, "last_reported": None},
        {"station_id": "a", "num_bikes_available_types": bikes, "is_renting": 1, "last_reported": NOON}]}}))
    ddl = {"status_ddl": readers.document_ddl(spark, str(tmp_path / "live")), "info_ddl": readers.document_ddl(spark, str(info))}
    for _ in range(2):
        pipelines.run_stations_incremental(spark, str(info), str(tmp_path / "live"), out, "2025-12-04 12:00:00", idempotent=True, **ddl)
    rows = spark.read.parquet(out).collect()
    assert sorted((r.is_renting, r.capacity, r.timestamp is None) for r in rows) == [(1, 9, False), (1, 9, True)]


def files_read(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numFiles").value()


def test_the_window_decides_which_files_are_opened(spark, feed):
    every = readers.station_status(spark, feed[1])
    assert files_read(every) == 4
    assert files_read(every.filter(snapshots.in_window("2025-12-04 12:00:00", 4))) == 3
    assert files_read(every.filter(snapshots.in_window("2026-01-01 00:00:00", 4))) == 1      # the one without a readable date


def test_only_the_days_at_hand_are_compared(spark, feed, tmp_path):
    info, live, out = feed
    pipelines.run_stations_backfill(spark, info, live, out)
    other = spark.read.parquet(out).withColumn("day", F.lit(9))
    other.write.mode("append").partitionBy("year", "month", "day").parquet(out)
    recent = stations.station_curated(readers.station_status(spark, live), readers.station_info(spark, info))
    left = pipelines._not_held(spark, recent, out)
    assert left.count() == 0
    text = left._sc._jvm.PythonSQLUtils.explainString(left._jdf.queryExecution(), "formatted")
    assert "dynamicpruning" in text.lower()


def test_the_checkpoint_is_the_look_back(spark, feed, tmp_path):
    info, live, out = feed
    mark = str(tmp_path / "mark")

    def lost(number):
        raise RuntimeError("lost")
    with pytest.raises(PySparkException):
        pipelines.run_stations_stream(spark, info, live, out, mark, max_files=2, after_write=lost)
    for _ in range(2):
        pipelines.run_stations_stream(spark, info, live, out, mark, max_files=2)
        assert spark.read.parquet(out).count() == 3
    late = os.path.join(live, "2025", "11", "30")
    os.makedirs(late)
    path = os.path.join(late, "080000.json")
    with open(path, "w") as f:
        json.dump({"data": {"stations": [{"station_id": "a", "num_bikes_available_types": {"electric": 5}, "last_reported": None}]}}, f)
    os.utime(path, (NOON - 90 * 86_400,) * 2)
    pipelines.run_stations_stream(spark, info, live, out, mark)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 4 and sum(r.timestamp is None and r.electric == 5 for r in rows) == 1


def test_fields_of_many_files_are_found_in_several_tasks(spark, tmp_path):
    """Pretty-printed documents, lists of them, a byte order mark and UTF-16; one of 60 files has a field of its own."""
    for i in range(60):
        more = {"capacity": 9} if i == 41 else {}
        write(tmp_path, f"d{i % 3}", f"{i}.json", [{"station_id": "a", "lat": i / 2, **more}])
    (tmp_path / "list.json").write_text(json.dumps([{"data": {"stations": [{"region": {"id": 1}}]}}, {"data": None}], indent=1))
    (tmp_path / "mark.json").write_text(json.dumps({"data": {"stations": [{"marked": "\u4100A"}]}}), encoding="utf-8-sig")
    (tmp_path / "wide.json").write_text(json.dumps({"data": {"stations": [{"wide": "\u4100A"}]}}, ensure_ascii=False), encoding="utf-16")
    tracker, tasks = spark.sparkContext.statusTracker(), []
    spark.sparkContext.setJobGroup("fields", "fields")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(16 << 20))
    try:
        ddl = readers.document_ddl(spark, str(tmp_path))
        for job in tracker.getJobIdsForGroup("fields"):
            tasks += [tracker.getStageInfo(s).numTasks for s in tracker.getJobInfo(job).stageIds]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    found = spark.read.option("multiLine", "true").option("recursiveFileLookup", "true").json(str(tmp_path))
    assert ddl == found.select("data").schema.toDDL() and {"capacity", "marked", "wide", "region"} <= set(ddl.replace(":", " ").replace("<", " ").split())
    assert max(tasks) > 1


def test_landed_documents_are_as_many_files_as_their_number_asks_for(spark, tmp_path):
    rows = spark.range(3000).selectExpr("named_struct('stations', array(named_struct('station_id', CAST(id AS STRING)))) AS data", "id % 6 AS file")
    jobs._land_documents(rows, str(tmp_path / "landed"))
    files = [p for p in (tmp_path / "landed").iterdir() if p.name.startswith("part-")]
    assert len(files) == 6 and readers.station_status(spark, str(tmp_path / "landed"), pattern="*").count() == 3000
