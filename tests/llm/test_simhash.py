import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import components, simhash


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, bits=3):
    prints, root = [plain_fingerprint(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for j, (d, _) in enumerate(rows) if find(j) == find(i) and d is not None]
        out.append((doc, prints[i], min(ids) if ids else None))
    return out


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_matches_brute_force(spark, docs_of, awkward):
    rng = random.Random(1)
    rows = list(awkward)
    text = awkward[0][1].split()
    for i in range(100, 160):      # near copies of near copies
        text = list(text)
        text[rng.randrange(len(text))] = f"w{i}"
        rows.append((i, " ".join(text)))
    found = simhash.near_duplicates(docs_of(rows, clash=True)).collect()
    got = key((r.doc_id, r.fp & (2 ** 64 - 1), r.component_id) for r in found)
    assert got == key(plain_components(rows))


@pytest.mark.parametrize("bits", [1, 2, 3, 4])
def test_links_are_exact(spark, bits):
    rng = random.Random(bits)
    prints = set()
    for _ in range(25):
        x = rng.getrandbits(64)
        prints.add(x)
        for _ in range(8):
            y = x
            for b in rng.sample(range(64), rng.randint(1, 6)):
                y ^= 1 << b
            prints.add(y)
    prints = sorted(prints)
    signed = [(int(np.uint64(x).astype(np.int64)),) for x in prints]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame(signed, "fp bigint"), bits).collect()}
    want = {tuple(sorted((signed[i][0], signed[j][0]))) for i in range(len(prints)) for j in range(i)
            if (prints[i] ^ prints[j]).bit_count() <= bits}
    assert got == want


def test_candidates_grow_with_the_fingerprints_not_their_square(spark):
    """Pairs that meet in a cell, of unlike fingerprints: at either size far fewer than fingerprints."""
    rng = random.Random(11)
    for n in (2000, 20_000):
        prints = [(int(np.uint64(rng.getrandbits(64)).astype(np.int64)),) for _ in range(n)]
        table = spark.createDataFrame(prints, "fp bigint")
        left = simhash._cells(table, simhash._open_cells(0) + simhash._count_cells(0), "a")
        right = simhash._cells(table, simhash._open_cells(0) + simhash._count_cells(1), "b")
        assert left.join(right, "cell").filter("a <> b").count() < n / 100


def test_manhattan_distance_is_a_lower_bound(spark):
    rng = random.Random(3)
    pairs = [(int(np.uint64(rng.getrandbits(64)).astype(np.int64)), int(np.uint64(rng.getrandbits(64)).astype(np.int64))) for _ in range(200)]
    a, b = F.col("a"), F.col("b")
    out = spark.createDataFrame(pairs, "a bigint, b bigint").select(
        "a", "b", simhash.apart(simhash.embedding(a), simhash.embedding(b)).alias("l1"), simhash.apart(a, b).alias("bits")).collect()
    for r in out:
        x, y = r.a & (2 ** 64 - 1), r.b & (2 ** 64 - 1)
        plain = sum(abs((x >> s & 3).bit_count() - (y >> s & 3).bit_count()) for s in range(0, 64, 2))
        assert r.l1 == plain <= r.bits


def test_no_rows(spark, docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.one_per_group(docs_of([])).count() == 0


def test_one_of_each_group_stays(spark, docs_of, awkward):
    kept = simhash.one_per_group(docs_of(awkward, clash=True))
    rows = kept.collect()
    assert kept.columns == docs_of(awkward, clash=True).columns
    groups = {}
    for doc, print_, component in plain_components(awkward):
        groups.setdefault((component, print_ if component is None else None), []).append(doc)
    assert len(rows) == len(groups)
    assert {r.doc_id for r in rows} == {c for c, _ in groups}


def test_components_of_a_path_a_hub_and_nothing(spark):
    path = [(i, i + 1) for i in range(60)]
    hub = [(1000, 1000 + i) for i in range(1, 200)] + [(1100, 1000), (1001, 1001)]
    found = components.components(spark.createDataFrame(path + hub, "a bigint, b bigint"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(200)}}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
