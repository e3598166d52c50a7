import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import spelling


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def plain(rows):
    counts = plain_words(rows)
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if one_apart(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def edited(rng, word, letters):
    at = rng.randrange(len(word))
    return rng.choice([word[:at] + word[at + 1:], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1:]])


def corpus(seed, letters):
    rng = random.Random(seed)
    bases = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 10))) for _ in range(25)]
    words = []
    for b in bases:
        words += [b] * rng.choice([5, 30, 200, 900])
        for _ in range(12):
            v = edited(rng, b, letters)
            words += [v] * rng.choice([4, 5, 6, 30])
            words += [edited(rng, v, letters)] * rng.choice([5, 6])
    rng.shuffle(words)
    return [(i, " ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in words[k:k + 60]) + ".")
            for i, k in enumerate(range(0, len(words), 60))]


def got(docs):
    return sorted(tuple(r) for r in spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("letters", ["ab", "abcdé", "abcdefghijklmnopqrstuvwxyzÀÿ×"])
def test_matches_brute_force(spark, docs_of, letters):
    rows = corpus(len(letters), letters)
    assert got(docs_of(rows)) == plain(rows)


def test_awkward_rows(spark, docs_of, awkward):
    rows = awkward + [(20, "mississippi " * 9 + "misissippi " * 5 + "aaaaaaaa " * 30 + "aaaaaaa " * 5 + "a" * 3000 + " "), (21, None)]
    rows += [(30 + i, "z" * 4_000 + " " + "z" * 3_999) for i in range(6)]
    found = got(docs_of(rows, clash=True))
    assert found == plain(rows) and ("aaaaaaa", "aaaaaaaa", "aaaaaaaa", 5, 1, 30) in found
    assert got(docs_of([])) == []


def test_a_chain_of_forms_ends_at_its_root(spark, docs_of):
    chain = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx", "abcdwzyx", "abcvwzyx"]
    rows = [(1, " ".join(w for k, w in enumerate(chain) for _ in range(5 * 5 ** k)))]
    rows = [r for r in rows if plain(rows)[0][2] == chain[-1]] or [(2, rows[0][1])]
    found = got(docs_of(rows))
    assert found == plain(rows) and {r[2] for r in found} == {chain[-1]}


def test_pivots_are_the_cheapest_pair_that_does_not_overlap():
    rng = random.Random(2)
    for _ in range(500):
        grams = [(r, p) for r, p in zip(rng.sample(range(50), 4), rng.sample(range(8), 4))][:rng.choice([3, 4])]
        cost = {p: r for r, p in grams}
        best = min(cost[a] + cost[b] for a, b in itertools.combinations(sorted(cost), 2) if b - a >= 2)
        a, b = spelling.pivots(grams)
        assert b - a >= 2 and cost[a] + cost[b] == best


def test_counts_are_handed_on_before_they_fill_a_task(spark, docs_of, monkeypatch):
    rows = corpus(7, "abcdefgh")
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    assert {r.word: r.n for r in spelling.words(docs_of(rows)).collect()} == plain_words(rows)
