import gzip
import random
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc

BIG = "<p>" + "x" * 200 + "</p>"


@pytest.fixture
def pages(spark):
    rows = [(5, "http://a/", BIG), (2, "http://b/", BIG), (9, "http://c/\r\nX: y", BIG), (2, "http://b/", BIG), (None, "http://d/", BIG),
            (7, None, "small"), (1, "http://e/", "small"), (3, "http://f/", None), (4, "http://g/", ""), (6, "http://h/", "é" * 60),
            (8, "http://h/", "é" * 60), (10, "u", "WARC/1.1\r\n\r\n" * 20), (None, "n", "only null " * 20), (None, "n", "only null " * 20),
            (11, "long", "y" * 3_000_000)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns(
        {"digest": F.lit("x"), "first_id": F.lit(1), "payload": F.lit("y")})


def plain(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h in rows:
        data, r = (h or "").encode(), first.get(h or "")
        again = r is not None and r != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", r if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("level", [6, 0])
def test_round_trip_with_revisits(spark, pages, tmp_path, level):
    path = str(tmp_path / "w")
    warc.write(warc.page_records(pages), path, level=level, fileBytes=500)
    got = warc.page_digests(warc.read(spark, path, payloads="response")).collect()
    want = plain([(r.page_id, r.url, r.html) for r in pages.collect()])
    assert sorted((tuple(r) for r in got), key=str) == want


def test_predicates_are_pushed_and_payloads_skipped(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write(warc.page_records(pages), path)
    found = warc.read(spark, path, payloads="none").filter(
        (F.col("record_type") == "revisit") & F.col("target_uri").startswith("http://") & (F.col("target_uri") != "http://a/")
        & F.col("refers_to").isin("<urn:page:2>", "<urn:page:6>"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("PushedFilters", "").replace("pushedFilters", "") or "startswith" not in plan.lower()
    assert sorted(r.target_uri for r in found.collect()) == ["http://c/%0D%0AX: y", "http://d/", "http://h/"]
    assert {r["payload"] for r in found.collect()} == {None}
    whole = warc.read(spark, path)
    assert whole.filter("record_type = 'response' and length(payload) = 3000000").count() == 1
    assert whole.filter("target_uri is null").count() == 1
    assert whole.filter("not (record_type = 'revisit') and profile is null").count() == whole.filter("record_type = 'response'").count()


def test_foreign_archives(spark, tmp_path):
    """Members without skip lengths, records that are not HTTP, one member with several records."""
    def rec(kind, body, extra=""):
        return f"WARC/1.0\r\nwarc-type: {kind}\r\n{extra}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(rec("warcinfo", b"info" * 50_000)) + gzip.compress(rec("resource", b"abc", "X-Own: 1\r\n")))
    (tmp_path / "b.warc").write_bytes(rec("resource", b"") + rec("metadata", b"q" * 200_000) + rec("resource", b"end"))
    (tmp_path / "_c.warc").write_bytes(b"half")
    found = warc.read(spark, str(tmp_path), payloads="resource", partitionBytes=10)
    assert found.rdd.getNumPartitions() == 2
    assert sorted((r.record_type, bytes(r["payload"]) if r["payload"] is not None else None) for r in found.collect() if r.record_type == "resource") == [
        ("resource", b""), ("resource", b"abc"), ("resource", b"end")]
    assert found.count() == 5
    assert [r.headers["X-Own"] for r in found.filter("record_type = 'resource'").collect() if r.headers] == ["1"]


@pytest.mark.parametrize("size", [0, 3, 70_000, 3_000_000])
@pytest.mark.parametrize("payloads", ["all", "none", "metadata"])
def test_a_file_compressed_as_a_whole(tmp_path, size, payloads):
    def rec(kind, body, extra=""):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\n{extra}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    bodies = [bytes([97 + k]) * (size + k) for k in range(4)]
    twice = "WARC-Concurrent-To: <urn:a>\r\nWARC-Concurrent-To: <urn:b>\r\n"
    plain = b"".join(rec(kind, b, twice) for kind, b in zip(("resource", "metadata", "resource", "metadata"), bodies))
    found = {}
    for name, data in {"plain": plain, "whole": gzip.compress(plain), "two": gzip.compress(plain) + gzip.compress(rec("resource", b"last"))}.items():
        path = tmp_path / name
        path.write_bytes(data)
        kinds = {"all": None, "none": frozenset(), "metadata": frozenset(["metadata"])}[payloads]
        with path.open("rb") as file:
            found[name] = [(r["record_type"], r["payload"], r["headers"].get("WARC-Concurrent-To"))
                           for r in warc.records(file, name != "plain", [], kinds)]
    read = {"all": ("resource", "metadata"), "none": (), "metadata": ("metadata",)}[payloads]
    want = [(k, b if k in read else None, "<urn:a>, <urn:b>") for k, b in zip(("resource", "metadata", "resource", "metadata"), bodies)]
    assert [(k, bytes(p) if p is not None else None, h) for k, p, h in found["plain"]] == want
    assert found["whole"] == found["plain"] == found["two"][:4] and found["two"][4][0] == "resource" and len(found["two"]) == 5


@pytest.mark.parametrize("payloads", ["all", "none"])
@pytest.mark.parametrize("zipped", [False, True])
def test_a_cut_file_is_an_error(tmp_path, payloads, zipped):
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 500000\r\n\r\n" + bytes(random.Random(1).randbytes(400_000))
    data = gzip.compress(record) if zipped else record
    path = tmp_path / ("a.warc.gz" if zipped else "a.warc")
    path.write_bytes(data)
    with path.open("rb") as file, pytest.raises(ValueError, match="cut short"):
        list(warc.records(file, zipped, [], None if payloads == "all" else frozenset()))


def test_no_rows(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write(warc.page_records(pages.limit(0)), path)
    assert warc.page_digests(warc.read(spark, path)).count() == 0
