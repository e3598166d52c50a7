"""Spelling variants: words one edit apart, found by pivotal grams.

Every bigram of a word has its place in one order, rarest first. A word's prefix is its three rarest bigrams; two of
them that do not overlap are its pivots, chosen by dynamic programming so that they are rare together. One edit cannot
touch both pivots. So of two words one edit apart, that with the rarer prefix has a pivot among the other's prefix
bigrams, at the same place from the left if the edit is behind it, from the right if the edit is in front of it.

Where the edit lies, seen from the two pivots, also says which piece of the word around a pivot is whole (``looked_up``):
the index has such pieces around each word's prefix bigrams (``indexed``). Both sides meet in an equi-join of the
pieces' hashes, so that a pair meets only if it agrees in place and text, and is then verified by its edit distance.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rows import loose
from tidemark.llm.common import bare, settle, store

RUN = re.compile("[A-Za-zÀ-ÿ]+")
NOISE = 199             # one of so many (document, run) pairs loses a letter
SHORTEST = 6            # letters of a word
SEEN = 5                # occurrences of a word
LEADS = 5               # a form is so many times as frequent as its variants
HELD_WORDS, HELD_CHARS = 300_000, 1 << 25      # words and letters a task counts before it hands them on
GRAMS = 3               # bigrams of a prefix: two pivots that do not overlap are always among them


def lowered(run: str) -> str:
    """A-Z in small letters, all others as they are."""
    return run.encode("latin-1").lower().decode("latin-1")


def noised(doc_id: str, run: str) -> str:
    """The run, without one letter in one of ``NOISE`` (document, run) pairs."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % NOISE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def text_words(doc_id: str, text: str) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of a text; a word may come more than once."""
    runs: Counter[str] = Counter()
    for run, n in Counter(RUN.findall(text)).items():
        runs[lowered(run)] += n
    for run, n in runs.items():
        word = noised(doc_id, run)
        if len(word) >= SHORTEST:
            yield word, n


def words(docs: DataFrame) -> DataFrame:
    """(word, n): all words of ``docs`` (doc_id, text) that occur ``SEEN`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        chars = 0

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                for word, n in text_words(doc_id.as_py(), text.as_py()):
                    if word not in held:
                        chars += len(word)
                    held[word] += n
                if len(held) >= HELD_WORDS or chars >= HELD_CHARS:
                    yield counted()
                    held.clear()
                    chars = 0
        if held:
            yield counted()

    whole = bare(docs, "doc_id", "text").filter("text is not null").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    found = whole.mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= SEEN)


def gram_ranks(words_: DataFrame) -> dict[str, int]:
    """Place of every bigram in the order from rare to frequent, by the words that it stands in.

    Words are over 90 letters, so there are 8,100 bigrams at most, whatever the number of words.
    """
    starts = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words_.select(F.explode(F.array_distinct(F.transform(starts, lambda i: F.substr("word", i, F.lit(2))))).alias("gram"))
    found = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()
    return {g: i for i, (_, g) in enumerate(sorted((r["n"], r["gram"]) for r in found))}


def prefix(word: str, ranks: dict[str, int]) -> list[tuple[int, int]]:
    """(rank, place) of the word's rarest bigrams, in order."""
    return heapq.nsmallest(GRAMS, ((ranks[word[i:i + 2]], i) for i in range(len(word) - 1)))


def pivots(grams: list[tuple[int, int]], count: int = 2) -> list[int]:
    """Places of ``count`` bigrams that do not overlap and have the least sum of ranks, from left to right.

    ``best[k]`` is the cheapest choice of k bigrams among those seen; a bigram extends the best choice that ends before it.
    """
    by_place = sorted((place, rank) for rank, place in grams)
    # ends[j][k]: (cost, places) of the best k bigrams among the first j by place
    ends: list[list[tuple[int, list[int]] | None]] = [[(0, [])] + [None] * count]
    for j, (place, rank) in enumerate(by_place):
        before = max((i for i in range(j + 1) if i == 0 or by_place[i - 1][0] + 2 <= place))
        row = list(ends[j])
        for k in range(1, count + 1):
            base = ends[before][k - 1]
            if base and (row[k] is None or base[0] + rank < row[k][0]):
                row[k] = (base[0] + rank, [*base[1], place])
        ends.append(row)
    return ends[-1][count][1]


# Which side of an edit a piece is from, and what it is anchored to: each kind of piece is hashed apart from the others.
FROM_LEFT_PIVOT, TO_RIGHT_PIVOT, AROUND, BEHIND_LEFT, BEHIND_START, BEFORE_RIGHT, BEFORE_END = range(1, 8)


def looked_up(word: str, left: int, right: int) -> Iterator[tuple[int, str]]:
    """(kind, piece): of any word one edit away, one of these is whole there too. ``left`` and ``right`` are the pivots."""
    # The edit is in front of the left pivot, in it, between both, in the right one, or behind that.
    yield FROM_LEFT_PIVOT, word[left:]
    yield (BEHIND_LEFT, f"{word[:2]} {word[right:]}") if left >= 2 else (BEHIND_START, word[left + 2:])
    yield AROUND, f"{word[:left + 2]} {word[right:]}"
    yield (BEFORE_RIGHT, f"{word[:left + 2]} {word[-2:]}") if len(word) - right >= 4 else (BEFORE_END, word[:right])
    yield TO_RIGHT_PIVOT, word[:right + 2]


def indexed(word: str, places: list[int]) -> Iterator[tuple[int, str]]:
    """(kind, piece): all pieces around the prefix bigrams at ``places`` that a look-up may ask for."""
    for p in places:
        yield FROM_LEFT_PIVOT, word[p:]
        yield TO_RIGHT_PIVOT, word[:p + 2]
        yield BEHIND_LEFT, f"{word[:2]} {word[p:]}"
        yield BEFORE_RIGHT, f"{word[:p + 2]} {word[-2:]}"
        for q in places:
            if q >= p + 2:
                yield AROUND, f"{word[:p + 2]} {word[q:]}"
    # An edit in a pivot at the word's edge: one to four letters there, and a prefix bigram in the rest.
    for k in range(1, 5):
        if max(places) >= k:
            yield BEHIND_START, word[k:]
        if min(places) + 2 <= len(word) - k:
            yield BEFORE_END, word[:-k]


def _keys(words_: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """(word, n, pivot, key): index and look-up entries of every word; a key stands for a piece and its kind."""

    def entries(word: str) -> Iterator[tuple[bool, int]]:
        grams = prefix(word, ranks)
        for kind, piece in looked_up(word, *pivots(grams)):
            yield True, xxhash.xxh64_intdigest(piece, kind)
        places = [p for _, p in grams]
        # The same bigram one place on: an edit in front of it may have moved it there.
        place = places[-1]
        if word[place + 1:place + 3] == word[place:place + 2]:
            places.append(place + 1)
        for kind, piece in indexed(word, places):
            yield False, xxhash.xxh64_intdigest(piece, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                rows = [(i, *e) for i, word in enumerate(batch.column(0).to_pylist()) for e in entries(word)]
                picked = batch.take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    *picked.columns, pa.array([r[1] for r in rows], pa.bool_()),
                    pa.array([r[2] - (1 << 63) for r in rows], pa.int64())], names=["word", "n", "pivot", "key"])

    return words_.select("word", "n").mapInArrow(run, "word string, n bigint, pivot boolean, key bigint")


def near_words(words_: DataFrame) -> DataFrame:
    """(word, other, n, other_n): all ordered pairs of ``words_`` (word, n) exactly one insertion, deletion or replacement apart.

    Every word comes once; words are ``SHORTEST`` letters or longer.
    """
    entries = store(_keys(words_, gram_ranks(words_)), "spelling-keys")
    probe = entries.filter("pivot").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    index = entries.filter("not pivot").select("key", F.col("word").alias("b"), F.col("n").alias("n_b"))
    possible = (F.abs(F.length("a") - F.length("b")) <= 1) & (F.col("a") != F.col("b"))
    met = probe.join(index, (probe["key"] == index["key"]) & possible & (F.levenshtein("a", "b", 1) == 1))
    there = met.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_a").alias("n"), F.col("n_b").alias("other_n"))
    back = met.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_b").alias("n"), F.col("n_a").alias("other_n"))
    return there.unionByName(back).distinct()


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root): from every word of ``forms`` (word, form) along the forms to the last.

    Each form is ``LEADS`` times as frequent as its word, so ``most`` bounds the steps; every round doubles those taken.
    """
    steps = 1
    while SEEN * LEADS ** (steps + 1) <= most:
        steps += 1
    held, taken = forms.select("word", F.col("form").alias("root")), 1
    while taken < steps:
        held = settle(held)
        on = held.select(F.col("word").alias("root"), F.col("root").alias("next"))
        held = held.join(loose(on), "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        taken *= 2
    return held


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word in ``docs`` (doc_id, text; other columns are ignored).

    Null texts have no words; a null doc_id counts as empty; repeated rows count each. No rows give no words.
    A form is the most frequent near word (of ties the smallest), if it is ``LEADS`` times as frequent.
    """
    known = store(words(docs), "spelling-words")
    near = near_words(known)
    best = store(near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")), "spelling-near")
    leads = -F.col("best.less") >= LEADS * F.col("n")
    held = known.join(loose(best), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(leads, F.col("best.form")).alias("form"), F.when(leads, -F.col("best.less")).alias("form_n"))
    most = known.agg(F.max("n")).first()[0] or 0
    roots = _roots(held.filter("form is not null"), most)
    return held.join(loose(roots), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
