import json

import pytest

from tidemark.operators import commerce, quality
from tidemark.plans import inputs, jobs
from tidemark.sources import readers, sinks

KETTLE = {"id": 11, "name": "Tin kettle", "category": "Kitchen", "price": 20.25}
TENT = {"id": 12, "name": "Two-person tent", "category": "Outdoors", "price": 80.5}
ORDER = {
    "order_id": "o1", "customer_id": 77, "items": [{"product": KETTLE, "quantity": 2}],
    "subtotal": 40.5, "tax": 4.05, "tax_rate": 0.1, "shipping": 5.0, "total_amount": 49.55,
    "currency": "USD", "status": "fulfilled", "created_at": "2026-01-02T10:00:00.125000",
    "paid_at": "2026-01-02T10:01:00.125000",
}
CUSTOMER = {"customer_id": 77, "first_name": "Ida", "country": "Norway", "tax_rate": 0.1}


def event(event_id="e1", kind="order_paid", at="2026-01-02T10:01:00.125000", **payload):
    return {"event_id": event_id, "event_type": kind, "session_id": "s1", "event_timestamp": at,
            "customer": CUSTOMER, "session": {"channel": "Google", "device": "mobile"}, **payload}


@pytest.fixture
def bronze(spark, tmp_path):
    def make(*events):
        path = tmp_path / "events.json"
        path.write_text("".join((e if isinstance(e, str) else json.dumps(e)) + "\n" for e in events))
        return readers.commerce_events(spark, str(path))

    return make


def test_paid_order_becomes_one_flat_row(bronze):
    row = commerce.commerce_silver(bronze(event(order=ORDER))).first()
    assert (row.order_id, row.order_total_amount, row.product_id, row.quantity) == ("o1", 49.55, 11, 2)
    assert str(row.event_timestamp) == "2026-01-02 10:01:00.125000" and str(row.event_date) == "2026-01-02"
    assert row.event_type == "order_paid" and row.order_status == "fulfilled"
    assert len(row) == 33 and row.processed_at is not None


def test_item_list_priority(bronze):
    cart = {"cart_id": "c1", "items": [{"product": TENT, "quantity": 3}]}
    rows = commerce.commerce_silver(bronze(
        event("order", order=ORDER, cart=cart, product=TENT),
        event("empty", order={**ORDER, "items": []}, cart=cart),
        event("cart", "cart_add", cart=cart, product=KETTLE),
        event("view", "product_view", product=KETTLE),
        event("none", "cart_abandon", abandon_stage="cart"),
    ))
    found = {r.event_id: (r.product_id, r.quantity) for r in rows.collect()}
    assert found == {"order": (11, 2), "empty": (None, None), "cart": (12, 3), "view": (11, 1), "none": (None, None)}


def test_timestamp_without_fraction_and_malformed(bronze):
    rows = commerce.commerce_silver(bronze(
        event("whole", at="2025-12-09T00:09:02"), event("bad", at="yesterday"), event(None)
    ))
    found = {r.event_id: str(r.event_timestamp) for r in rows.collect()}
    assert found == {"whole": "2025-12-09 00:09:02", "bad": "None"}


def test_same_product_twice_keeps_one_stable_row(bronze):
    lines = [{"product": KETTLE, "quantity": 5}, {"product": KETTLE, "quantity": 2}]
    paid = event(order={**ORDER, "items": lines})
    assert [r.quantity for r in commerce.commerce_silver(bronze(paid, paid, paid)).collect()] == [2]


def test_lifetime_value_takes_each_order_once(bronze):
    two = {**ORDER, "items": [{"product": KETTLE, "quantity": 2}, {"product": TENT, "quantity": 1}]}
    silver = commerce.commerce_silver(bronze(event(order=two), event("e2", "order_create", order=two)))
    row = commerce.customer_ltv(silver).first()
    assert (row.orders, row.lifetime_value, row.total_quantity) == (1, 49.55, 3)
    assert commerce.orders_by_country(silver).first().total_orders == 1


def test_order_arithmetic(bronze):
    wrong = {**ORDER, "order_id": "o2", "total_amount": 46.0}
    found = quality.order_arithmetic(bronze(event(order=ORDER), event("e2", order=wrong))).collect()
    assert [(r.order_id, r.bad_subtotal, r.bad_tax, r.bad_total) for r in found] == [("o2", False, False, True)]


def test_split_keeps_every_row(bronze):
    silver = commerce.commerce_silver(bronze(event(order=ORDER), event("e2", "product_view", product=TENT)))
    valid, broken = quality.split_by_rules(silver, [("NO_ORDER", "order_id IS NULL"), ("CHEAP", "product_price < 30")])
    assert [r.failure_reason for r in broken.orderBy("event_id").collect()] == ["CHEAP", "NO_ORDER"]
    assert valid.count() == 0


def test_landing_is_newline_terminated_json(bronze, tmp_path, spark):
    out = str(tmp_path / "landing")
    sinks.land_json(bronze(event(order=ORDER)), out)
    text = "".join(p.read_text() for p in (tmp_path / "landing").glob("part-*.json"))
    assert text.endswith("\n") and json.loads(text)["order"]["order_id"] == "o1"
    assert readers.commerce_events(spark, out).count() == 1


def test_units_count_once_however_often_an_order_is_paid(bronze):
    two = {**ORDER, "items": [{"product": KETTLE, "quantity": 2}, {"product": TENT, "quantity": 1}]}
    silver = commerce.commerce_silver(bronze(event("e1", order=two), event("e2", order=two), event("e3", order=two)))
    row = commerce.customer_ltv(silver).first()
    assert (row.orders, row.lifetime_value, row.total_quantity) == (1, 49.55, 3)


def test_item_rows_give_what_lists_give(spark, sf_dir):
    nested = commerce.commerce_silver(inputs.commerce_events(spark, sf_dir), processed_at=False)
    rows = commerce.commerce_silver(inputs.commerce_item_rows(spark, sf_dir), processed_at=False)
    assert nested.columns == rows.columns
    assert sorted(map(str, nested.collect())) == sorted(map(str, rows.collect()))


def test_the_job_lands_packed_files(spark, sf_dir, tmp_path, monkeypatch):
    """All rows, in files of less than a third of the plain ones."""
    monkeypatch.setattr(jobs, "fresh", lambda _, what: str(tmp_path / what))
    jobs.commerce_append_job(spark, sf_dir).collect()
    sinks.land_json(inputs.commerce_events(spark, sf_dir), str(tmp_path / "plain"))
    landed = [p for drop in range(jobs.DROPS) for p in (tmp_path / "commerce" / f"landing-{drop}").glob("part-*")]
    plain = sum(p.stat().st_size for p in (tmp_path / "plain").glob("part-*"))
    assert landed and 3 * sum(p.stat().st_size for p in landed) < plain
    every = readers.commerce_events(spark, [str(tmp_path / "commerce" / f"landing-{drop}") for drop in range(jobs.DROPS)])
    whole = readers.commerce_events(spark, str(tmp_path / "plain"))
    assert every.count() == whole.count() and every.exceptAll(whole).isEmpty()
