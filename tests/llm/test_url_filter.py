import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import url_filter

ODD = [None, "", "no scheme/x", "http://", "https://EXAMPLE.net/en/1", "http://a.example.net/EN/1", "http://net/x", "http://anet/x",
       "http://x.net", "http://x.net?q=/", "http://x.example.com/de/a?b#c", "http://x.example.com/de", "ftp://b.org/fr/#z",
       "http://b.org/fr?x", "http://u://v.net/a", "http://É.net/é?a=1&b=2", "http://x.net/a\nb?c", "http://" + "a" * 100_000 + ".org/fr/"]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for rule, _ in url_filter.RULES:
        own, _, begin = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + begin) and len(rule) > len(best or ""):
            best = rule
    return host, path, best


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(1)
    rows = list(enumerate(ODD))
    for i in range(100, 400):
        rows.append((i, f"http://{rng.choice(['a', 'b-c', 'm.d9'])}.example.{rng.choice(['net', 'com', 'org'])}/{rng.choice(['en', 'de', 'fr'])}/{i}"))
    rows += [(100, rows[-1][1]), (None, "http://q.net/1")]
    return spark.createDataFrame(rows, "page_id bigint, url string").withColumns({c: F.lit("x") for c in ("host", "path", "rule", "label", "suffix")})


def test_hosts_paths_and_rules(pages):
    rows, said = url_filter.judge(pages).collect(), dict(url_filter.RULES)
    own = {r.page_id: r.url for r in pages.collect() if r.page_id != 100}
    assert len(rows) == pages.count()
    for r in rows:
        if r.page_id != 100:
            assert (r.host, r.path, r.rule) == plain(own[r.page_id])
        assert r.verdict == said.get(r.rule, r.verdict) and r.verdict in ("allow", "block") and 0 <= r.chance <= 1


def test_trees_learn_labelled_urls(spark, pages):
    rng = random.Random(2)
    url = lambda bad: f"http://{'x' * 3}{'-win-9' * (3 * bad)}.com/{'a/' * rng.randint(1, 4)}{rng.randint(0, 10 ** (6 if bad else 2))}"
    labelled = spark.createDataFrame([(url(i % 2), i % 2) for i in range(300)], "url string, label int")
    asked = spark.createDataFrame([(i, url(i % 2)) for i in range(100)], "page_id bigint, url string")
    out = url_filter.judge(asked, rules=[], labelled=labelled).collect()
    assert sum((r.verdict == "block") == bool(r.page_id % 2) for r in out) >= 95 and {r.rule for r in out} == {None}


def test_partitions_of_the_fit_follow_its_rows(spark, pages, monkeypatch):
    """The trees take hundreds of stages over them: a session that deals to many partitions must not multiply their tasks."""
    seen, dealt, fit = [], type(pages).repartitionByRange, url_filter.GBTClassifier.fit
    monkeypatch.setattr(type(pages), "repartitionByRange", lambda self, n, *cols: dealt(self, max(n, 60), *cols))
    monkeypatch.setattr(url_filter.GBTClassifier, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    out = url_filter.judge(pages).collect()
    assert len(out) == pages.count() and seen == [1]


def test_nothing_to_learn_from_and_no_rows(pages):
    out = url_filter.judge(pages, rules=[("net/", "block")]).collect()
    assert {r.verdict for r in out if r.rule is None} == {"allow"} and {r.chance for r in out} == {0.0}
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_entropy(spark):
    rows = spark.createDataFrame([("",), ("aaaa",), ("abab",), ("abcd",)], "t string").select(url_filter.entropy(F.col("t"))).collect()
    assert [r[0] for r in rows] == [0, 0, 1, 2]
