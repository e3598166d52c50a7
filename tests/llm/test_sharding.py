import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import sharding


def plain(sizes, shards):
    """Differencing with lists of groups: combine the two parts of largest spread, the largest list with the smallest."""
    parts = [(sorted([[s, [i]]] + [[0, []] for _ in range(shards - 1)], key=lambda x: -x[0]), i) for i, s in enumerate(sizes)]
    made = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (-(p[0][0][0] - p[0][-1][0]), p[1]))
        (a, _), (b, _) = parts[:2]
        both = [[x[0] + y[0], x[1] + y[1]] for x, y in zip(a, reversed(b))]
        parts = parts[2:] + [(sorted(both, key=lambda x: -x[0]), made)]
        made += 1
    return sorted(s for s, _ in parts[0][0])


@pytest.mark.parametrize("shards", [1, 2, 3, 16])
def test_difference_equals_plain_differencing(shards):
    rng = random.Random(shards)
    for _ in range(30):
        sizes = [rng.randint(1, 1000) for _ in range(rng.randint(1, 40))]
        goes, sums = sharding.difference(sharding._singles(np.array(sizes), shards))
        dealt = np.zeros(shards, int)
        np.add.at(dealt, goes[:, 0], sizes)
        assert dealt.tolist() == sums.tolist() and sorted(sums.tolist()) == plain(sizes, shards)


def test_two_ways_as_in_the_textbook():
    goes, sums = sharding.difference(sharding._singles(np.array([8, 7, 6, 5, 4]), 2))
    assert sorted(sums.tolist()) == [14, 16]


def test_parts_are_combined_whole():
    rng = np.random.default_rng(3)
    parts = rng.integers(0, 1000, (50, 7))
    goes, sums = sharding.difference(parts)
    out = np.zeros(7, int)
    for part, to in zip(parts, goes):
        assert sorted(to.tolist()) == list(range(7))
        out[to] += part
    assert out.tolist() == sums.tolist() and np.ptp(sums) < np.ptp(parts.sum(axis=0))


def check(rows, docs_rows, shards=16):
    by_shard, by_text = defaultdict(list), defaultdict(set)
    for r in rows:
        by_shard[r.shard].append(r.slot)
        by_text[r.text or ""].add(r.shard)
    assert all(0 <= s < shards for s in by_shard)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert all(len(found) == 1 for found in by_text.values())
    assert sorted((str(r.doc_id), str(r.text)) for r in rows) == sorted((str(i), str(t)) for i, t in docs_rows)
    sums = [0] * shards
    for r in rows:
        sums[r.shard] += len((r.text or "").encode()) + 1
    return sums


def test_awkward_rows(spark, docs_of, awkward):
    docs = docs_of(awkward, clash=True).drop("shard")
    out = sharding.shard_documents(docs)
    assert out.columns == [*docs.columns, "shard", "slot"]
    check(out.collect(), awkward)
    assert sharding.shard_documents(docs_of([])).count() == 0


@pytest.mark.parametrize("fan,large,shards", [(4096, 4096, 16), (50, 200, 16), (16, 200, 2)])
def test_bytes_are_near_equal_over_many_blocks(spark, docs_of, monkeypatch, fan, large, shards):
    monkeypatch.setattr(sharding, "FAN", fan)       # 16: the blocks' parts are combined in several rounds
    monkeypatch.setattr(sharding, "LARGE", large)
    rng = random.Random(fan)
    rows = [(i, "x" * min(5000, int(rng.paretovariate(1.1) * 20)) + str(i)) for i in range(1500)]
    rows += [(5000 + i, "a group of copies") for i in range(300)]
    sums = check(sharding.shard_documents(docs_of(rows), shards).collect(), rows, shards)
    assert max(sums) - min(sums) <= 20


def test_a_hot_group_has_its_shard_to_itself(spark, docs_of):
    rows = [(i, "the same text") for i in range(2000)] + [(9000 + i, f"other {i}" * 3) for i in range(1200)]
    sums = sorted(check(sharding.shard_documents(docs_of(rows)).collect(), rows))
    assert sums[-1] == 2000 * 14 and sums[-2] - sums[0] <= 3


def test_layout_does_not_matter(spark, docs_of):
    rng = random.Random(8)
    rows = [(i, "word " * rng.randint(1, 300)) for i in range(400)] + [(7, "again"), (7, "again")]
    docs = docs_of(rows)
    one = sharding.placements(docs.coalesce(1)).collect()
    two = sharding.placements(docs.repartition(7, F.rand(1))).collect()
    assert sorted(one) == sorted(two)
    for r in one:
        assert (r.size, r.text_crc32) in {(len(t) + 1, zlib.crc32(t.encode())) for i, t in rows if i == r.doc_id}


def test_files_hold_ranges_of_slots(spark, docs_of, tmp_path):
    rows = [(i, f"text number {i} " * (i % 13)) for i in range(300)] + [(None, None)]
    path = sharding.write_shards(docs_of(rows), str(tmp_path / "out"), 4)
    found = spark.read.parquet(path)
    check(found.collect(), rows, 4)
    part = sharding.read_shard(spark, path, 2, 10).collect()
    assert {r.shard for r in part} == {2} and min(r.slot for r in part) == 10


def test_nothing_to_shard_over(spark, docs_of):
    with pytest.raises(ValueError):
        sharding.shard_documents(docs_of([]), 0)
