"""Typed and rescued JSON lines, and their replay."""

import json

import pytest
from pyspark.errors import PySparkException

from tidemark.sources import schemas
from tidemark.streaming import rescue

FIRST = "id INT, customer STRUCT<customer_id: INT>, items ARRAY<STRUCT<sku: INT>>"
GROWN = "id INT, customer STRUCT<customer_id: INT, loyalty: STRUCT<tier: INT>>, items ARRAY<STRUCT<sku: INT, gift: BOOLEAN>>, coupon STRING"


@pytest.fixture
def drop(tmp_path):
    (tmp_path / "in").mkdir()

    def write(name, *lines):
        (tmp_path / "in" / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    write.source, write.root, write.mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    return write


def ids(spark, root):
    return sorted(r.id for r in rescue.typed_rows(spark, root).collect()), sorted((
        json.loads(r._line)["id"] if r._line.startswith("{") else r._line for r in rescue.rescued_lines(spark, root).collect()), key=str)


def test_rescued_lines_are_replayed_when_the_schema_grows(spark, drop):
    drop("a.json", {"id": 1}, {"id": 2, "customer": {"customer_id": 7, "loyalty": {"tier": 3}}}, "", "no json",
         {"id": 3, "items": [{"sku": 1}, {"sku": 2, "gift": True}]})
    rescue.ingest_json(spark, drop.source, drop.root, drop.mark, schemas.parse(FIRST))
    assert ids(spark, drop.root) == ([1], [2, 3, "no json"])
    drop("b.json", {"id": 4, "coupon": "C"}, {"id": 5, "customer": {"customer_id": "x"}}, {"id": 6})
    rescue.ingest_json(spark, drop.source, drop.root, drop.mark)
    assert ids(spark, drop.root) == ([1, 6], [2, 3, 4, 5, "no json"])
    rescue.grow(spark, drop.root, schemas.parse(GROWN))
    assert ids(spark, drop.root) == ([1, 2, 3, 4, 6], [5, "no json"])
    rows = {r.id: r for r in rescue.typed_rows(spark, drop.root).collect()}
    assert rows[2].customer.loyalty.tier == 3 and rows[3]["items"][1].gift and rows[4].coupon == "C" and rows[1].coupon is None
    drop("c.json", {"id": 7, "coupon": "D"})
    rescue.ingest_json(spark, drop.source, drop.root, drop.mark)
    assert ids(spark, drop.root) == ([1, 2, 3, 4, 6, 7], [5, "no json"])


def test_a_replay_that_did_not_finish_does_not_count(spark, drop, monkeypatch):
    drop("a.json", {"id": 1}, {"id": 2, "coupon": "C"}, {"id": 3, "other": 1})
    rescue.ingest_json(spark, drop.source, drop.root, drop.mark, schemas.parse(FIRST))

    def lost(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as broken:
        broken.setattr(rescue, "_register", lost)
        with pytest.raises(RuntimeError):
            rescue.grow(spark, drop.root, schemas.parse(GROWN))
    assert ids(spark, drop.root) == ([1], [2, 3])
    rescue.grow(spark, drop.root, schemas.parse(GROWN))
    assert ids(spark, drop.root) == ([1, 2], [3])


def test_a_batch_run_again_writes_once(spark, drop):
    drop("a.json", {"id": 1}, {"id": 2, "coupon": "C"})

    def lost(number):
        raise RuntimeError("lost")
    with pytest.raises(PySparkException):
        rescue.ingest_json(spark, drop.source, drop.root, drop.mark, schemas.parse(FIRST), after_write=lost)
    for _ in range(2):
        rescue.ingest_json(spark, drop.source, drop.root, drop.mark)
        assert ids(spark, drop.root) == ([1], [2])


def test_nothing_rescued_and_nothing_typed(spark, drop):
    drop("a.json", "no json")
    rescue.ingest_json(spark, drop.source, drop.root, drop.mark, schemas.parse(FIRST))
    assert ids(spark, drop.root) == ([], ["no json"])
    drop2 = drop.root + "2"
    drop("a.json", {"id": 1})
    rescue.ingest_json(spark, drop.source, drop2, drop.mark + "2", schemas.parse(FIRST))
    assert ids(spark, drop2) == ([1], [])
    rescue.grow(spark, drop2, schemas.parse(GROWN))
    assert ids(spark, drop2) == ([1], [])


@pytest.mark.parametrize("ddl", ["id INT", FIRST.replace("sku: INT", "sku: STRING"), FIRST.replace("id INT,", "id BIGINT,", 1)])
def test_existing_fields_keep_their_types(spark, drop, ddl):
    drop("a.json", {"id": 1})
    rescue.ingest_json(spark, drop.source, drop.root, drop.mark, schemas.parse(FIRST))
    with pytest.raises(rescue.NotGrownError):
        rescue.grow(spark, drop.root, schemas.parse(ddl))
