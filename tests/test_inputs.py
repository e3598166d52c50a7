"""The adapters hand on every order line that belongs to an event."""

from pyspark.sql import functions as F

from tidemark.plans import inputs


def _owned_lines(spark, sf_dir):
    lines, events = inputs.table(spark, sf_dir, "lineitem"), inputs.table(spark, sf_dir, "events")
    return lines.join(events.select("event_id").distinct(), lines.l_orderkey == F.col("event_id"))


def test_web_events_hold_one_item_per_line(spark, sf_dir):
    owned = _owned_lines(spark, sf_dir).agg(F.count("*"), F.sum("l_quantity").cast("bigint")).first()
    events = inputs.numbered_events(spark, sf_dir).join(inputs.line_baskets(spark, sf_dir), F.col("event_id") == F.col("l_orderkey"))
    held = events.select(F.explode("basket").alias("i")).agg(F.count("*"), F.sum("i.qty")).first()
    assert tuple(held) == tuple(owned) and owned[0] > 1000


def test_commerce_events_hold_every_part_with_its_quantity(spark, sf_dir):
    owned = _owned_lines(spark, sf_dir).agg(
        F.count_distinct("l_orderkey", "l_partkey"), F.sum("l_quantity").cast("bigint")).first()
    bronze = inputs.commerce_events(spark, sf_dir).filter("order IS NOT NULL OR cart IS NOT NULL OR product IS NOT NULL")
    assert bronze.count() > 0
    events = inputs.numbered_events(spark, sf_dir).join(inputs.part_baskets(spark, sf_dir), F.col("event_id") == F.col("l_orderkey"))
    held = events.select(F.explode("basket").alias("i")).agg(F.count("*"), F.sum("i.qty")).first()
    assert tuple(held) == tuple(owned)


def test_items_of_an_order_have_one_order(spark, sf_dir):
    for baskets in (inputs.line_baskets, inputs.part_baskets):
        rows = baskets(spark, sf_dir).select("basket").collect()
        assert all([(i.slot, i.part, i.qty) for i in r.basket] == sorted((i.slot, i.part, i.qty) for i in r.basket) for r in rows)
