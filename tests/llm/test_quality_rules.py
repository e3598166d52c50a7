import random
import re
from collections import Counter

import pytest

from tidemark.llm import quality_rules as rules


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    kept = not failed and not any(rule(rules.Text(text)) for rule in rules.RULES.values())
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), failed, kept


def test_matches_brute_force(spark, docs_of, awkward):
    rng = random.Random(3)
    rows = [r for r in awkward if r[0] != 6]
    for i in range(200, 300):
        words = [rng.choice("ab cd efg hij k# *l\u00a0m 日本 x\x0by".split(" ")) for _ in range(rng.randint(0, 90))]
        rows.append((i, "".join(w + rng.choice(["\n", " ", "  ", "\t"]) for w in words * rng.choice([1, 1, 2]))))
    got = sorted((str(r.doc_id), *r[1:8]) for r in rules.judge(docs_of(rows, clash=True)).collect())
    assert got == sorted((str(i), *plain(t)) for i, t in rows)


def test_long_text(spark, docs_of, awkward):
    rows = [r for r in awkward if r[0] == 6]
    assert tuple(rules.judge(docs_of(rows)).first()[1:5]) == plain(rows[0][1])[:4]


@pytest.mark.parametrize("order", [list(rules.RULES), list(rules.RULES)[::-1]])
def test_order_changes_no_verdict(spark, docs_of, awkward, order):
    docs = docs_of(awkward)
    assert sorted(map(str, rules.judge(docs, order=order).drop("rejected_by").collect())) == sorted(
        map(str, rules.judge(docs).drop("rejected_by").collect()))


def test_rules_go_by_rejections_per_second(spark, docs_of):
    def slow(t):
        sum(range(200_000))
        return True
    own = {"slow": slow, "never": lambda t: False, "quick": lambda t: True}
    docs = docs_of([(i, " ".join(f"word{k}" for k in range(i, i + 30))) for i in range(20)])
    assert rules.order_rules(docs, own) == ["quick", "slow", "never"]
    assert {r.rejected_by for r in rules.judge(docs, own).collect()} == {"quick"}


def test_no_rows(spark, docs_of):
    assert rules.judge(docs_of([])).count() == 0
    assert rules.order_rules(docs_of([])) == sorted(rules.RULES)
