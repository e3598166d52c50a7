import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abdefgilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    bad = ["zorkling", "quaxful", "vyxterous"]
    docs, labels = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        toxic = i % 4 == 0
        for _ in range(3 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    docs += [(None, "zorkling quaxful zorkling"), (1000, None), (1001, ""), (1002, "plain words " * 30_000), (4, docs[4][1])]
    labels += [(0, 1, 0), (0, None, None), (None, 1, 1), (5000, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"toxic": F.lit(1), "score": F.lit(5), "ids": F.lit("x")})
    return d, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("text", F.lit("x"))


def test_held_out_rows(tables):
    rows = toxicity.judge(*tables).collect()
    assert len(rows) == 405
    by = {r.doc_id: r for r in rows}
    for i in range(400):
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 400]
    right = sum(r.predicted == int(r.doc_id % 4 == 0) for r in held)
    assert right >= 0.97 * len(held) > 100
    assert by[None].predicted == 1 and not by[None].held_out
    for i in (1000, 1001, 1002):
        assert by[i].predicted == 0 and 0 <= by[i].score <= 1
    assert len({r.score for r in rows if r.doc_id == 4}) == 1


def test_labels_do_not_reach_held_out_scores(tables):
    docs, labels = tables
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic"))
                               .otherwise(F.col("toxic")))
    a = {(r.doc_id, round(r.score, 9)) for r in toxicity.judge(docs, labels).collect()}
    assert a == {(r.doc_id, round(r.score, 9)) for r in toxicity.judge(docs, turned).collect()}


def test_without_labels_or_rows(tables):
    docs, labels = tables
    assert {r.predicted for r in toxicity.judge(docs, labels.limit(0)).collect()} == {0}
    assert {r.predicted for r in toxicity.judge(docs, labels.filter("toxic = 0")).collect()} == {0}
    assert {r.predicted for r in toxicity.judge(docs, labels.filter("toxic = 1 and doc_id < 400")).collect()} == {1}
    assert toxicity.judge(docs.limit(0), labels).count() == 0


def test_repeats_are_dropped_once():
    once = toxicity.Once()
    ids = toxicity.grams("abcdef abcdef abcdef")
    assert sorted(once(ids).tolist()) == sorted(set(ids.tolist()))
    assert len(toxicity.grams(None)) == 0


def test_the_share_of_a_sample_never_rounds_to_nothing(spark):
    from pyspark.sql import functions as F

    from tidemark.llm.common import share_of_hashes
    n = 20_000
    few = spark.range(n).filter(F.xxhash64("id") <= share_of_hashes(500, n)).count()
    assert 400 < few < 600
    assert spark.range(n).filter(F.xxhash64("id") <= share_of_hashes(500, 400)).count() == n
    limits = spark.range(1).select(share_of_hashes(20_000, 10 ** 14).alias("a"), share_of_hashes(20_000, 0).alias("b")).first()
    assert limits.a + 2 ** 63 == 2 ** 64 * 20_000 // 10 ** 14 > 0 and limits.b == 2 ** 63 - 1
