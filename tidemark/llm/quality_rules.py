"""Quality rules as a short-circuit cascade ordered by measured cost and selectivity.

Every rule is a test on one text. On a bounded sample each rule is run on every text, its time and its share
of rejections are taken, and the rules are ordered by rejections per second. The full pass asks them in that
order and stops at the first that rejects. The order changes the time, never the verdict.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import bare

SAMPLE = 1000           # texts on which costs and selectivities are estimated
WINDOW = 8              # words of a window that counts as repeated
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# The characters that count as symbols, and what separates words.
SYMBOLS = re.compile(r"[#*$%&|<>]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = re.compile(r"[\x20\x09-\x0D]")
CODES = np.random.default_rng(7).integers(1, 1 << 63, WINDOW, np.uint64) | np.uint64(1)


class Text:
    """A text and what the rules ask of it, worked out when first asked."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return WORD.findall(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return len(SYMBOLS.findall(self.text))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x and BLANK.sub("", x)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def counts(self) -> Counter:
        return Counter(self.words)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of ``WINDOW`` words that occur twice or more, the first time included."""
        if self.n_words <= WINDOW or len(self.counts) == self.n_words:
            return 0
        number = {w: i for i, w in enumerate(self.counts)}
        ids = np.fromiter(map(number.__getitem__, self.words), np.uint64, self.n_words)
        n = self.n_words - WINDOW + 1
        key = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            key += (ids[k:k + n] + np.uint64(1)) * CODES[k]
        _, of, times = np.unique(key, return_inverse=True, return_counts=True)
        again = np.flatnonzero(times[of] > 1)
        if not len(again):
            return 0
        # the hash only picks windows; these are compared word by word
        rows = np.stack([ids[again + k] for k in range(WINDOW)], axis=1)
        _, of, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        starts = again[times[of.ravel()] > 1]
        cover = np.zeros(self.n_words + 1, np.int64)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + WINDOW, -1)
        return int((np.cumsum(cover) > 0).sum())

    @cached_property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words


Rule = Callable[[Text], bool]

# Each rule says whether a text is rejected. Word counts are never 0 here: the base test goes first.
RULES: dict[str, Rule] = {
    "word_length": lambda t: t.word_chars < 2 * t.n_words or t.word_chars > 12 * t.n_words,
    "symbols": lambda t: 10 * t.n_symbols > t.n_words,
    "repeated_lines": lambda t: 2 * t.n_dup_lines > len(t.lines),
    "top_word": lambda t: 10 * max(t.counts.values()) > 3 * t.n_words,
    "letterless_words": lambda t: 10 * sum(not any(map(str.isalpha, w)) for w in t.words) > 3 * t.n_words,
    "ellipsis_lines": lambda t: 10 * sum(x.rstrip().endswith(("...", "…")) for x in t.lines) > 3 * len(t.lines),
    "bullet_lines": lambda t: 10 * sum(x.lstrip().startswith(("- ", "* ", "•")) for x in t.lines) > 9 * len(t.lines),
    "stuttered_words": lambda t: 10 * sum(a == b for a, b in zip(t.words, t.words[1:])) > 2 * t.n_words,
}


def order_rules(docs: DataFrame, rules: dict[str, Rule] = RULES, sample: int = SAMPLE) -> list[str]:
    """Rule names by rejections per second on the first ``sample`` texts; ties and unseen rules by name.

    Every rule gets fresh texts, so the cost of what it asks for is its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, gone, seen = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if Text(text).base_failed:
                    continue
                seen += 1
                for name, rejects in rules.items():
                    began = time.perf_counter()
                    gone[name] += rejects(Text(text))
                    spent[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(rules)), pa.array(list(gone.values()), pa.int64()), pa.array(list(spent.values()))],
            names=["rule", "rejected", "seconds"])

    found = bare(docs, "text").limit(sample).mapInArrow(run, "rule string, rejected bigint, seconds double")
    per = {n: (0, 0.0) for n in rules}
    for r in found.groupBy("rule").agg({"rejected": "sum", "seconds": "sum"}).collect():     # one row per rule
        per[r["rule"]] = (r["sum(rejected)"], r["sum(seconds)"])
    return sorted(rules, key=lambda n: (-per[n][0] / max(per[n][1], 1e-9), n))


def judge(docs: DataFrame, rules: dict[str, Rule] = RULES, order: list[str] | None = None) -> DataFrame:
    """Per row doc_id, n_words, the four base figures, base_failed, kept and the rule that rejected (or null).

    Null and empty texts have no words and fail the base test. Every row of a repeated document is judged;
    columns other than doc_id and text are ignored. ``rejected_by`` is ``base`` or the first rule in the
    cascade's order, which may differ from run to run where several rules reject; ``kept`` does not.
    """
    order = order or order_rules(docs, rules)
    cascade = [(name, rules[name]) for name in order]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                rows = []
                for text in batch.column(1):
                    t = Text(text.as_py())
                    by = "base" if t.base_failed else next((name for name, rejects in cascade if rejects(t)), None)
                    rows.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words,
                                 t.base_failed, by is None, by))
                types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], names=names)

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "rejected_by"]
    return bare(docs, "doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
             "n_repeat_words bigint, base_failed boolean, kept boolean, rejected_by string")
