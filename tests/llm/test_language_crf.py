import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_crf as crf

EN = "the of and that with house there would should thing".split()
DE = "der die und nicht schon über weil zwischen straße möchte".split()


def sentence(rng, words, n=12):
    return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    return [(i, "\n".join(sentence(rng, EN if i % 2 else DE) for _ in range(4)), "en" if i % 2 else "de") for i in range(160)]


@pytest.fixture(scope="module")
def table(spark, rows):
    extra = [(None, "the house", "en"), (900, None, "en"), (901, "", None), (902, "12 34 !!", "de"), (903, "the thing " * 20_000, None),
             (1, rows[1][1], "en")]
    out = spark.createDataFrame(rows + extra, "doc_id bigint, text string, lang string")
    return out.withColumns({"score": F.lit(9), "lang_pred": F.lit("x"), "n_chars": F.length("text")})


def test_held_out_texts_are_told_apart(table):
    out = crf.judge(table).collect()
    assert len(out) == 166
    by = {r.doc_id: r for r in out}
    for i in range(160):
        assert by[i].lang_pred == ("en" if i % 2 else "de") and 0 <= by[i].score <= 1
    assert any(by[i].held_out for i in range(160)) and not by[None].held_out
    assert {(by[i].lang_pred, by[i].score) for i in (900, 901, 902)} == {("und", 0.0)}
    assert by[903].lang_pred == "en" and by[None].lang_pred == "en"


def test_words_of_mixed_text(table, rows):
    field = crf.train(table)
    text = "der die und nicht schon weil the of and that with house"
    cut = crf.chains(text)
    assert [len(c) for c in cut] == [12]
    mask = np.ones((1, 12), bool)
    words = crf.marginals(field.emissions(cut[0])[None], field.move, field.start, mask)[0][0].argmax(axis=1)
    assert [field.labels[k] for k in words] == ["de"] * 6 + ["en"] * 6
    assert field.move.trace() > field.move.sum() - field.move.trace()        # neighbours share a language


def test_marginals_equal_enumeration():
    from itertools import product
    rng = np.random.default_rng(0)
    emission, move, start = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    mask = np.array([[True] * 4, [True, True, False, False]])
    got = crf.marginals(emission, move, start, mask)[0]
    for c, n in ((0, 4), (1, 2)):
        want = np.zeros((n, 3))
        for path in product(range(3), repeat=n):
            score = start[path[0]] + sum(emission[c, i, y] for i, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:]))
            for i, y in enumerate(path):
                want[i, y] += np.exp(score)
        assert np.allclose(got[c, :n], want / want.sum(axis=1, keepdims=True))


def test_training_is_repeatable(table):
    a, b = crf.train(table), crf.train(table.repartition(3))
    assert np.allclose(a.w, b.w) and np.allclose(a.move, b.move)


def test_nothing_to_learn_from(spark, table):
    none = table.filter("lang is null")
    assert {r.lang_pred for r in crf.judge(none).collect()} == {"und"}
    assert crf.judge(table.limit(0)).count() == 0
    assert crf.confident(table.limit(0), 0.5).count() == 0
    assert [r.doc_id for r in crf.confident(none, 0.5).collect()] == [903]


def test_confident_keeps_rows_whole(table):
    kept = crf.confident(table, 0.4)
    assert kept.columns == table.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == 163 and not {900, 901, 902} & set(ids)


def test_words_of_mixed_text_are_labelled(spark, table, rows):
    """Code-switched lines: each word's label and score equal the enumeration of all labellings of its chain."""
    import itertools
    field = crf.train(table)
    mixed = "the house would\nnicht über the thing schon und 12 of"
    k, out = len(field.labels), crf.label_words(spark.createDataFrame([(1, mixed), (2, None), (3, "12"), (1, mixed)], "doc_id bigint, text string"), field).collect()
    assert {r.doc_id for r in out} == {1} and len(out) == 20
    got = sorted({(r.start, r.end, r.lang, round(r.score, 6)) for r in out})
    want = []
    for line in crf.chains(mixed):
        e = field.emissions(line)
        total = np.zeros((len(line), k))
        for ys in itertools.product(range(k), repeat=len(line)):
            score = field.start[ys[0]] + sum(e[i, y] for i, y in enumerate(ys)) + sum(field.move[a, b] for a, b in zip(ys, ys[1:]))
            for i, y in enumerate(ys):
                total[i, y] += np.exp(score)
        total /= total.sum(axis=1, keepdims=True)
        want += [(w, field.labels[p.argmax()], p.max()) for w, p in zip(line, total)]
    assert [(mixed[a:b].lower(), lang) for a, b, lang, _ in got] == [(w, lang) for w, lang, _ in want]
    assert np.allclose([x[3] for x in got], [x[2] for x in want], atol=1e-3)
    by = {mixed[a:b]: lang for a, b, lang, _ in got}
    assert by["nicht"] == by["schon"] == "de" and by["house"] == by["thing"] == "en"
    assert crf.label_words(table, None).count() == 0


def test_words_of_a_long_line_keep_their_places(table):
    field = crf.train(table)
    text = "  ".join(["the", "Über", "house"] * 60) + "\n\nthing"
    found = field.label_words(text)
    assert [text[a:b] for a, b, _, _ in found] == ["the", "Über", "house"] * 60 + ["thing"]


def test_groups_are_bounded_by_their_characters():
    """Many long texts: no group holds more than the bound and one text; none is lost, null and empty ones neither."""
    size = crf.GROUP_CHARS // 4
    texts = [None, "", "a"] + ["b" * size] * 9 + [None]
    found = list(crf.groups(pa.array(texts, pa.string())))
    assert [t for _, held in found for t in held] == texts
    assert [at for at, _ in found] == [0, 7, 11] and max(sum(len(t or "") for t in held) for _, held in found) < crf.GROUP_CHARS + size
    assert list(crf.groups(pa.array([], pa.string()))) == []


def test_the_filter_sends_texts_only(table):
    """Rows stay in Spark; what comes back from Python is a verdict each."""
    text = crf.confident(table, 0.4)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in text and "MapInArrow" not in text


def test_many_new_words_are_scored_in_pieces():
    rng = random.Random(3)
    field = crf.Field(["de", "en"], frozenset())
    field.w[:] = np.random.default_rng(3).random(field.w.shape)
    words = list({"".join(rng.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(30_000)})
    tracemalloc.start()
    try:
        found = field.emissions(words)
        assert tracemalloc.get_traced_memory()[1] < 12_000_000
    finally:
        tracemalloc.stop()
    assert found.shape == (len(words), 2)
    assert np.array_equal(found[::5000], np.concatenate([field.emissions([w]) for w in words[::5000]]))


def plain_features(word, lexicon):
    own = f"^{word}$"
    names = [f"p{word[:n]}" for n in (1, 2, 3)] + [f"s{word[-n:]}" for n in (1, 2, 3)]
    names += [f"g{own[i:i + n]}" for n in (2, 3) for i in range(len(own) - n + 1)] + [f"w{word}"] * (word in lexicon)
    return sorted({zlib.crc32(x.encode("utf-8", "replace")) % (1 << crf.BITS) for x in names})


WORDS = ["a", "ab", "abc", "été", "d’où", "straße", "日本", "x𠀀y𠀁", "ñ", "mañana", "z" * 700, "aaaa", "b\ud800"]


def test_features_equal_the_plain_ones():
    lexicon = frozenset(WORDS[::2])
    found, sizes = crf.features(WORDS, lexicon)
    assert [x.tolist() for x in np.split(found, np.cumsum(sizes)[:-1])] == [plain_features(w, lexicon) for w in WORDS]


def test_words_are_hashed_side_by_side(monkeypatch):
    """No Python call for each feature of a new word: unknown words, which a corpus brings without end, took two dozen."""
    calls, real = [], zlib.crc32
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(3000)]
    field = crf.Field(["de", "en"], frozenset())
    monkeypatch.setattr(crf.zlib, "crc32", lambda *x: calls.append(1) or real(*x))
    found = field.label([" ".join(words)])
    assert len(calls) < 100 and found[0][0] in ("de", "en")


def test_forgotten_words_are_scored_again(table, rows, monkeypatch):
    """More words than a worker remembers: the same labels, and no more held than the bound or one group's words."""
    whole, field = crf.train(table), crf.train(table)
    texts = [text for _, text, _ in rows]
    want = whole.label(texts)
    monkeypatch.setattr(crf, "KNOWN", 8)
    got = []
    for text in texts:
        got += field.label([text])
        own = {w for c in crf.chains(text) for w in c}
        assert len(field.known) == len(field.held) <= max(8, len(own))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_lines_are_cut_into_chains():
    line = [f"w{'x' * (i % 5)}" for i in range(2 * crf.CHAIN + 1)]
    text = " ".join(line) + "\n\n" + " ".join(line[:crf.CHAIN]) + "\r\n12\nEnd"
    assert crf.chains(text) == [line[:crf.CHAIN], line[crf.CHAIN:2 * crf.CHAIN], line[-1:], line[:crf.CHAIN], ["end"]]
    assert crf.chains(None) == crf.chains("\n \n") == []
