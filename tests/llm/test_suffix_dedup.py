import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import run_index, suffix_dedup


def plain(rows, length, words=0):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if len(t[a:b].split()) < words:
                gone[a:b] = False
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((str(doc), len(t), int(gone.sum()), spans, kept))
    return sorted(out)


def found(docs, length):
    rows = suffix_dedup.remove_repeats(docs, length).collect()
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r["kept"])) for r in rows)


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefghijkl é") for _ in range(n))
    passages = [text(rng.randint(90, 400)) for _ in range(6)]
    rows = [(i, text(rng.randint(0, 300)) + rng.choice(passages)[rng.randint(0, 80):] + text(rng.randint(0, 200))) for i in range(40)]
    rows += [(100, "ab" * 700), (101, "x" * 500), (102, "x" * 300), (103, passages[0] * 3), (104, text(99)), (105, text(100))]
    return rows


@pytest.mark.parametrize("crowd,crowd_bytes", [(2000, 1 << 22), (1, 1 << 22), (2000, 600)])
def test_matches_brute_force(spark, docs_of, awkward, monkeypatch, crowd, crowd_bytes):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)      # 1: every shared anchor is filed anew until it is settled
    monkeypatch.setattr(suffix_dedup, "CROWD_BYTES", crowd_bytes)
    rows = corpus(crowd) + [r for r in awkward if r[0] != 6]
    assert found(docs_of(rows), 100) == plain(rows, 100)


def test_long_periodic_texts_never_meet_in_one_index(spark, docs_of, monkeypatch):
    """Rules and padding give segments of any length under few anchors: they are divided by their bytes."""
    # The index notes what it was given; Python workers of local tasks share no memory, so they note it in a file.
    rows = [(i, "=-" * (2000 + 37 * i) + f"end {i}" * 30) for i in range(12)] + [(50, "=" * 5000), (51, "x" + "=" * 4000)]
    whole = found(docs_of(rows), 100)
    monkeypatch.setattr(suffix_dedup, "CROWD_BYTES", 10_000)
    limit = suffix_dedup.INDEX_BYTES

    def indexed(texts, length, real=run_index.repeated_windows):
        assert sum(map(len, texts)) <= 25_000, "an index over more than its share"
        return real(texts, length)
    monkeypatch.setattr(suffix_dedup, "INDEX_BYTES", 10_000)
    monkeypatch.setattr(suffix_dedup, "repeated_windows", indexed)
    assert found(docs_of(rows), 100) == whole == plain(rows, 100) and limit == 1 << 21


def test_a_content_with_a_third_of_all_rows(spark, docs_of):
    rng = random.Random(12)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(300))
    rows = [(i, f"{i} " + passage + f" {i * 7}") for i in range(400)] + [(1000 + i, "".join(rng.choice("abcdefgh ") for _ in range(300))) for i in range(800)]
    got = found(docs_of(rows), 100)
    assert got == plain(rows, 100) and sum(r[2] >= 300 for r in got) == 400


def test_only_runs_of_enough_words(spark, docs_of):
    long, short = "many words of one passage " * 12, "averylongword" * 10
    rows = [(1, f"one {long} 1234 {short}"), (2, f"two {short} two {long}")]
    out = {r.doc_id: r["kept"] for r in suffix_dedup.remove_repeats(docs_of(rows), 100, as_text=True, words=51).collect()}
    assert all(short in t and "passage" not in t for t in out.values())
    out = {r.doc_id: r["kept"] for r in suffix_dedup.remove_repeats(docs_of(rows), 100, as_text=True).collect()}
    assert all(short not in t for t in out.values())


def test_recall_by_length_of_the_passage(spark, docs_of):
    """A passage shared by two texts is caught from the length asked for on, and never below."""
    rng = random.Random(13)
    text = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passages = {n: text(n) for n in (250, 399, 400, 401, 600)}
    rows = [(10 * n + k, text(200) + f"{k}{p}{k}" + text(150)) for n, p in passages.items() for k in (1, 2)]
    caught = {(int(d) // 10): removed for d, _, removed, _, _ in found(docs_of(rows), 400)}
    assert {n: r >= n for n, r in caught.items()} == {250: False, 399: False, 400: True, 401: True, 600: True}


def test_long_texts_are_cut_into_groups_without_loss(spark, docs_of, monkeypatch):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(9000))
    rows = [(1, long), (2, "zz" + long[4000:4600] + "yy"), (3, long[100:180])]
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 1000)
    assert found(docs_of(rows), 100) == plain(rows, 100)


def test_no_rows_and_clashing_columns(spark, docs_of, awkward):
    assert found(docs_of([]), 400) == []
    docs = docs_of(awkward, clash=True).drop("kept")
    out = suffix_dedup.remove_repeats(docs, as_text=True)
    assert out.columns == [*docs.columns, "n_bytes", "n_removed", "n_spans", "kept"]
    for r in out.collect():
        assert len((r.text or "").encode()) == r.n_bytes and r["tid"] == "x"
        assert r.n_removed or r["kept"] == (r.text or "")


def test_a_character_cut_in_two_is_dropped_from_text(spark, docs_of):
    shared = "é" * 60
    out = suffix_dedup.remove_repeats(docs_of([(1, "a" + shared), (2, "b" + shared + "c")]), 100, as_text=True).collect()
    assert sorted(r["kept"] for r in out) == ["a", "bc"]


def test_lengths_below_an_anchor_are_refused(spark, docs_of):
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs_of([]), 47)


def test_run_index_equals_counting():
    rng = random.Random(4)
    for _ in range(60):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 60))) for _ in range(4)]
        texts = [b"".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) for _ in range(5)] + [b"a" * 50]
        length = rng.choice([4, 10, 20])
        seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
        for t, got in zip(texts, run_index.repeated_windows(texts, length)):
            assert got.tolist() == [seen[t[i:i + length]] > 1 for i in range(max(0, len(t) - length + 1))]


def test_run_index_is_compressed_by_repetition():
    rng = random.Random(6)
    once = bytes(rng.choice(b"abcdefgh") for _ in range(500))
    index = run_index.RunIndex(np.frombuffer(once * 20, np.uint8))
    assert len(index.runs) < 700 and index.lengths.sum() == 10_000


def test_run_index_takes_few_bytes_for_each_byte():
    rng = random.Random(8)
    once = [bytes(rng.choice(b"abcdefgh ") for _ in range(300)) for _ in range(20)]
    texts = [rng.choice(once)[:k] + b"#" + rng.choice(once)[k:] for k in (rng.randint(1, 299) for _ in range(3000))]
    tracemalloc.start()
    try:
        assert sum(w.any() for w in run_index.repeated_windows(texts, 200)) > 1000
        assert tracemalloc.get_traced_memory()[1] < 64 * sum(map(len, texts))
    finally:
        tracemalloc.stop()
