"""Benchmark decontamination by template windows.

A text becomes a template: lower-cased words without punctuation, with numbers, names and units replaced by
typed placeholders. Windows of ``WINDOW`` template words are hashed and joined with those of the benchmark.
Where a document follows an item, also around words put in or left out, every value of the item's placeholders must
stand for one value of the document, whatever that is: a question with other numbers and names is found, a chance
likeness is not. Windows of the plain lower-cased words are hashed beside them, so that copies match in any case.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import chain, groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.functions.rows import loose
from tidemark.llm.common import bare, stash, store, text_key, unstash

WINDOW = 8               # template words of a window; shorter items count as one window
COVER = 0.5              # share of an item's windows that a document has to hold
LONG = 20                # template words of an item that count by themselves if they follow one another
SHIPPED = 1_000_000      # different window hashes sent to the tasks as a filter; beyond, all windows are joined
KNOWN = 250_000          # words a worker remembers
GROUP_CHARS = 1 << 18    # characters of the texts read at once
# Words for numbers and units that stand behind a number.
NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split())
SCALES = frozenset("hundred thousand million billion".split())
UNITS = frozenset(
    "% percent mm cm m km meter meters metre metres inch inches foot feet yard yards mile miles g mg kg gram grams lb lbs "
    "pound pounds oz ton tons l ml liter liters litre litres gallon gallons second seconds minute minutes hour hours day "
    "days week weeks month months year years dollar dollars cent cents euro euros mph kmh degree degrees".split())
# Words that are no names where they open a sentence, whatever the benchmark holds.
OPENERS = frozenset(
    "a an the this that these those there here it its he she his her they their we our you your my who whom whose what which "
    "when where why how if is are was were be been am do does did has have had can could will would shall should may might "
    "must and or but nor so yet for of in on at to from by with without about into over under between through during before "
    "after since until while as because although though unless then than next now later first second last finally also "
    "however therefore thus hence each every all any both some no not none many much more most few other another such only "
    "one once let suppose assume given".split())
TEMPLATE, PLAIN = range(2)
NUMBER, NAME, UNIT, BREAK, NOTHING, WORD, END = range(7)
QUANTITY = regex.compile(r"(?:\p{Sc})?([+-]?\p{N}[\p{N}.,:/]*)[-\u2010\u2011]?(\p{L}*|%)").fullmatch
HYPHENS = regex.compile(r"[-\u2010\u2011]")
EDGES = regex.compile(r"^[^\p{L}\p{N}%]+|[^\p{L}\p{N}%]+$")
STOPS = regex.compile(r"[.!?:;][^\p{L}\p{N}]*$").search


def _codes(words: list[str]) -> np.ndarray:
    """A hash of each word, the same in every process."""
    return hash_array(np.array(words, dtype=object), categorize=False)


MARKS = dict(zip((NUMBER, NAME, UNIT), _codes(["\0number", "\0name", "\0unit"]).tolist()))
AND = _codes(["and"])[0]
FACTORS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(WINDOW)], np.uint64)


class _Numbers(dict):
    """Word -> number in the order met."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Templates:
    """Turns texts into templates; words met before are looked up.

    ``common`` has the codes of the words that are no names, in order. Without it a capitalised word is a name only
    within a sentence and one in capitals never, because nothing tells it from other words.
    """

    def __init__(self, common: np.ndarray | None = None):
        self.common, self.number, self.plain = common, _Numbers(), []
        self.kind, self.code, self.bare = np.zeros(0, np.int8), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.title, self.stop, self.glued, self.sure = (np.zeros(0, bool) for _ in range(4))
        self.spelled, self.scale, self.tail = (np.zeros(0, bool) for _ in range(3))
        self.parts: dict[int, tuple[int, int]] = {}         # a number with its unit glued on -> the two as words

    def _numbered(self, words: list[str]) -> np.ndarray:
        """The numbers of words; such not met before are described."""
        if len(self.number) > KNOWN:
            self.__init__(self.common)
        at = len(self.number)
        ids = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        while len(self.number) > at:                        # parts of words are words met as well
            new = list(islice(self.number, at, None))
            self._learn(at, new)
            at += len(new)
        return ids

    def _learn(self, at: int, new: list[str]) -> None:
        end, cores = at + len(new), []
        if end > len(self.kind):
            room = 2 * end - len(self.kind)
            for name in ("kind", "code", "bare", "title", "stop", "glued", "sure", "spelled", "scale", "tail"):
                held = getattr(self, name)
                setattr(self, name, np.concatenate((held, np.zeros(room, held.dtype))))
        self.kind[at:end] = WORD
        for i, (word, low) in enumerate(zip(new, "\n".join(new).lower().split("\n")), at):
            if not low.isalpha():
                if low[-1] in ".,;:!?" and low[:-1].isalpha():
                    low, self.stop[i], self.tail[i] = low[:-1], low[-1] != ",", True
                else:
                    self.kind[i], low, self.stop[i], parts = self._describe(word)
                    self.tail[i], self.glued[i] = not word[-1].isalnum(), bool(parts)
                    self.spelled[i] = self.kind[i] == NUMBER and low[0].isalpha()
                    self.scale[i] = self.spelled[i] and not SCALES.isdisjoint(HYPHENS.sub(" ", low).split())
                    if parts:
                        self.parts[i] = self.number[parts[0]], self.number[parts[1]]
            if word[:1] != low[:1] and self.kind[i] == WORD:
                core = word if word.isalpha() else EDGES.sub("", word)
                self.title[i] = len(core) > 1 and core[0].isupper() and not core.isupper()
                self.sure[i] = self.common is not None and len(core) > 1 and core[0].isupper()
            if low in NUMBERS:
                self.kind[i], self.spelled[i], self.scale[i] = NUMBER, True, low in SCALES
            cores.append(low)
        self.plain += cores
        self.code[at:end] = self.bare[at:end] = _codes(cores)
        for i in np.flatnonzero(self.sure[at:end]) + at:
            k = np.searchsorted(self.common, self.bare[i])
            self.sure[i] = k == len(self.common) or self.common[k] != self.bare[i]
        for kind, mark in MARKS.items():
            self.code[at:end][self.kind[at:end] == kind] = mark
        self.title[at:end] &= self.kind[at:end] == WORD
        self.sure[at:end] &= self.kind[at:end] == WORD

    @staticmethod
    def _describe(word: str) -> tuple[int, str, bool, tuple]:
        """(kind, plain form, ends a sentence, number and unit glued on) of a word that is not letters and a mark."""
        if word in "\x01\x02":
            return (BREAK if word == "\x01" else END), "", False, ()
        core = EDGES.sub("", word)
        if not core:
            return NOTHING, "", bool(STOPS(word)), ()
        low, stop = core.lower(), bool(STOPS(word))
        quantity = None if core.isalpha() else QUANTITY(core)
        if quantity and (not quantity[2] or quantity[2].lower() in UNITS):
            return NUMBER, low, stop, (quantity[1], quantity[2].lower()) if quantity[2] else ()
        *spelled, last = HYPHENS.split(low)                 # twenty-five, five-year
        if spelled and NUMBERS.issuperset(spelled) and (last in NUMBERS or last in UNITS):
            if last in NUMBERS:
                return NUMBER, " ".join([*spelled, last]), stop, ()
            return NUMBER, low, stop, (" ".join(spelled), last)
        return WORD, low, stop, ()

    def read(self, texts: list[str | None]):
        """(codes, kinds, word ids, bounds, texts) of the template words of several texts, one after another.

        Word ids and bounds give the words that a template word came from, the last array its text's number.
        """
        lines = [(t or "").replace("\x02", " ").replace("\n", " \x01 ") for t in texts]
        words = (" \x02 ".join(lines) + " \x02").split()
        ids = self._numbered(words)
        ids = ids[self.kind[ids] != NOTHING]
        kind, code = self.kind[ids], self.code[ids]
        ends, breaks = kind == END, (kind == BREAK) | (kind == END)
        text = np.cumsum(ends)
        opens = np.ones(len(ids), bool)                     # the word that begins a sentence or line
        opens[1:] = self.stop[ids[:-1]] | breaks[:-1]
        named = self.title[ids] & ~opens | self.sure[ids]
        after = np.zeros(len(ids), bool)
        after[1:] = (kind[:-1] == NUMBER) & ~self.glued[ids[:-1]]
        for i in np.flatnonzero(after & (kind == WORD)).tolist():
            if self.plain[ids[i]] in UNITS:
                kind[i], code[i], named[i] = UNIT, MARKS[UNIT], False
        kind[named], code[named] = NAME, MARKS[NAME]
        live = ~breaks
        ids, kind, code, text, opens = ids[live], kind[live], code[live], text[live], opens[live]
        again = np.zeros(len(ids), bool)                    # a name of several words is one name
        again[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) & ~opens[1:]
        again |= self._spelled_out(kind, ids, opens)        # and a number of several words one number
        first = np.flatnonzero(~again)
        return code[first], kind[first], ids, np.append(first, len(ids)), text[first]

    def _spelled_out(self, kind: np.ndarray, ids: np.ndarray, opens: np.ndarray) -> np.ndarray:
        """Which words go on with the number before them: twenty five, 5 million, one hundred and five.

        The "and" of a number becomes a number word in ``kind``; one hundred and two hundred are two numbers.
        """
        on = np.zeros(len(ids), bool)
        spelled, scale = self.spelled[ids], self.scale[ids]
        if not spelled.any():
            return on
        close = ~(self.tail[ids[:-1]] | self.glued[ids[:-1]] | opens[1:])
        number = kind == NUMBER
        on[1:] = number[1:] & number[:-1] & spelled[1:] & (spelled[:-1] | scale[1:]) & close
        at = np.flatnonzero(scale[:-2] & (self.bare[ids[1:-1]] == AND) & spelled[2:] & close[:-1] & close[1:]) + 1
        at = at[~(np.append(scale, False)[at + 2] & np.append(on, False)[at + 2])]
        kind[at] = NUMBER
        on[at] = on[at + 1] = True
        return on

    def _parted(self, code: np.ndarray, kind: np.ndarray, ids: np.ndarray, bounds: np.ndarray, text: np.ndarray):
        """What ``read`` gives, with a number and the unit glued to it as two words, as if they stood apart."""
        glued = self.glued[ids]
        if not glued.any():
            return code, kind, ids, bounds, text
        words = np.flatnonzero(glued)
        at = np.searchsorted(bounds, words, "right")        # a glued word is the last of its template word
        before = np.concatenate(([0], np.cumsum(glued)))
        units = words + np.arange(len(words)) + 1
        both = np.array([self.parts[i] for i in ids[words].tolist()])
        ids = np.repeat(ids, 1 + glued)
        ids[units - 1], ids[units] = both.T
        return (np.insert(code, at, np.uint64(MARKS[UNIT])), np.insert(kind, at, UNIT), ids,
                np.insert(bounds + before[bounds], at, units), np.insert(text, at, text[at - 1]))

    def views(self, texts: list[str | None]):
        """(codes, texts, slots of a window by its place and width) of the template and of the plain words."""
        code, kind, ids, bounds, text = self._parted(*self.read(texts))
        yield code, text, lambda at, width: self.slots(kind, ids, bounds, at, width)
        yield self.bare[ids], np.repeat(text, np.diff(bounds)), lambda at, width: []

    def told(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The codes of the words in small letters, and of those that are names by their place in a sentence."""
        _, kind, ids, bounds, _ = self.read(texts)
        named = np.repeat(kind, np.diff(bounds)) == NAME
        low = np.fromiter((w.islower() for w in self.number), bool, len(self.number))
        return np.unique(self.bare[ids[low[ids] & ~named]]), np.unique(self.bare[ids[named]])

    def slots(self, kind: np.ndarray, ids: np.ndarray, bounds: np.ndarray, at: int, width: int) -> list[str]:
        """The values behind the placeholders of a window."""
        return [" ".join(self.plain[w] for w in ids[bounds[i]:bounds[i + 1]])
                for i in range(at, at + width) if kind[i] in MARKS]


def hashes(code: np.ndarray, width: int, view: int = TEMPLATE) -> np.ndarray:
    n = len(code) - width + 1
    h = np.full(max(0, n), width | view << 32, np.uint64)
    for k in range(width if n > 0 else 0):
        h = (h ^ code[k:k + n]) * FACTORS[k]
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def common_words(benchmark: DataFrame) -> np.ndarray:
    """The codes, in order, of the words that are no names where they open a sentence or stand in capitals.

    These are ``OPENERS`` and words that the benchmark has in small letters, but not capitalised within a sentence. The
    driver gets 9 bytes for each different word of the benchmark.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Templates()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                low, named = own.told([text])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((low, named)).view(np.int64)),
                                                  pa.array(np.repeat([False, True], (len(low), len(named))))], names=["code", "named"])

    words = bare(benchmark, "text").mapInArrow(run, "code bigint, named boolean").groupBy("code").agg(F.max("named").alias("named"))
    found = words.filter("not named").select("code").toPandas().code.to_numpy(np.int64).view(np.uint64)
    return np.unique(np.concatenate((found, _codes(sorted(OPENERS)))))


def item_windows(benchmark: DataFrame, window: int = WINDOW, common: np.ndarray | None = None) -> DataFrame:
    """(item_id, view, place, width, h, slots, windows): the windows of every item that has a word, in both views."""
    shared = benchmark.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Templates(shared.value)
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for view, (code, _, slots) in enumerate(own.views([text])):
                    width = min(window, len(code))
                    found = hashes(code, width, view).tolist() if width else []
                    rows += [(item, view, i, width, h, slots(i, width), len(found)) for i, h in enumerate(found)]
            cols = zip(*rows) if rows else [[]] * 7
            types = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["item_id", "view", "place", "width", "h", "slots", "windows"])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    return bare(benchmark, "item_id", "text").mapInArrow(
        run, f"item_id {kind}, view bigint, place bigint, width bigint, h bigint, slots array<string>, windows bigint")


def document_windows(docs: DataFrame, widths: list[tuple[int, int]], wanted: np.ndarray | None,
                     common: np.ndarray | None = None) -> DataFrame:
    """(text_id, at, h, held): the windows of each text, by (view, width), whose hash is in ``wanted`` (null: all)."""
    shared = docs.sparkSession.sparkContext.broadcast((sorted(widths), wanted, common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widths, wanted, common = shared.value
        own = Templates(common)
        gate = np.zeros(1 << 20, bool)
        if wanted is not None:
            gate[wanted & 0xFFFFF] = True

        def found(texts, keys):
            views = list(own.views(texts))
            for view, width in widths:
                code, text, slots = views[view]
                h = hashes(code, width, view)
                if wanted is None:
                    hit = np.arange(len(h))
                else:
                    hit = np.flatnonzero(gate[h & 0xFFFFF])
                    hit = hit[np.isin(h[hit], wanted)]
                hit = hit[text[hit] == text[hit + width - 1]]
                at = hit - np.searchsorted(text, text[hit])
                for i, place in zip(hit.tolist(), at.tolist()):
                    yield keys[text[i]], place, int(h[i]), slots(i, width)

        for batch in batches:
            texts, keys, chars, rows = [], [], 0, []
            for i in range(batch.num_rows):
                texts.append(batch.column(1)[i].as_py())
                keys.append(batch.column(0)[i].as_py())
                chars += len(texts[-1] or "")
                if chars >= GROUP_CHARS or i + 1 == batch.num_rows:
                    for row in found(texts, keys):
                        rows.append(row)
                        if len(rows) >= 5000:
                            yield _rows(rows)
                            rows = []
                    texts, keys, chars = [], [], 0
            yield _rows(rows)

    return docs.select(text_key(F.col("text")).alias("text_id"), "text").mapInArrow(
        run, "text_id binary, at bigint, h bigint, held array<string>")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, types)],
                                      names=["text_id", "at", "h", "held"])


class _Shift:
    """The windows that a text and an item share along one shift, and what the item's values stand for there."""

    def __init__(self, shift: int):
        self.shift, self.places, self.values, self.torn, self.windows = shift, [], {}, False, 0

    def add(self, place: int, slots: list[str], held: list[str]) -> None:
        self.places.append(place)
        for value, other in zip(slots, held):
            self.torn |= self.values.setdefault(value, other) != other

    def longest(self) -> int:
        """The most windows that follow one another."""
        best = n = 0
        for i, place in enumerate(self.places):
            n = n + 1 if i and place == self.places[i - 1] + 1 else 1
            best = max(best, n)
        return best


def _shifts(rows: Iterable[tuple]) -> Iterator[_Shift]:
    """The shifts of one text and item in one view, from rows sorted by shift and place."""
    for shift, own in groupby(rows, itemgetter(3)):
        made = _Shift(shift)
        for _, _, _, _, place, made.windows, slots, held in own:
            made.add(place, slots, held)
        yield made


def _in_order(shifts: Iterable[_Shift]) -> int:
    """The most windows of the shifts whose places rise in the item and in the text."""
    ends: list[int] = []
    for _, at in sorted((place, -place - s.shift) for s in shifts for place in s.places):
        i = bisect_left(ends, -at)
        ends[i:i + 1] = [-at]
    return len(ends)


def _joined(seed: _Shift, near: list[_Shift], need: float) -> bool:
    """Whether ``seed`` and shifts that agree with it hold ``need`` windows in order."""
    best = len(seed.places)
    if best < need and _in_order([seed, *near]) < need:
        return False
    taken, values = [seed], dict(seed.values)
    for s in sorted(near, key=lambda s: (-len(s.places), abs(s.shift - seed.shift))):
        if best >= need:
            break
        if all(values.get(k, v) == v for k, v in s.values.items()) and (n := _in_order([*taken, s])) > best:
            best = n
            taken.append(s)
            values |= s.values
    return best >= need


def _held(shifts: Iterator[_Shift], window: int, cover: float) -> bool:
    """Whether a text holds an item, by their shifts in order. Only shifts near one another are kept."""
    long, near = max(1, LONG - window + 1), deque()
    seed = 0
    for s in chain(shifts, [None]):
        if s is not None:
            reach, need = max(window, s.windows), cover * s.windows
        while seed < len(near) and (s is None or near[seed].shift + reach < s.shift):
            own = near[seed]
            while near[0].shift < own.shift - reach:
                near.popleft()
                seed -= 1
            if _joined(own, [n for n in near if n is not own], need):
                return True
            seed += 1
        if s is not None and not s.torn:
            if len(s.places) >= need or s.longest() >= long:
                return True
            near.append(s)
    return False


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """(text_id, item_id): texts that hold ``cover`` or more of an item's windows with consistent slots.

    Words put in or left out move the shift between text and item. Windows are counted over shifts that differ by the
    item's length at most, in the order of item and text, if all their values agree; a shift that is torn in itself does
    not count. ``LONG`` words that follow one another are enough. Copies of a text are folded before the join.
    """
    common = common_words(benchmark)
    items = store(item_windows(benchmark, window, common), "benchmark-windows")
    widths = [tuple(r) for r in items.select("view", "width").distinct().collect()]     # twice ``window`` at most
    distinct = items.select("h").distinct()
    few = distinct.count() <= SHIPPED
    wanted = np.sort(distinct.toPandas().h.to_numpy(np.int64)) if few else None
    held = document_windows(bare(docs, "text"), widths, wanted, common).dropDuplicates(["text_id", "at", "h"])
    met = held.join(items, "h").withColumn("shift", F.col("at") - F.col("place"))
    along = met.select("text_id", "item_id", "view", "shift", "place", "windows", "slots", "held").repartition(
        "text_id", "item_id").sortWithinPartitions("text_id", "item_id", "view", "shift", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for (text, item), pair in groupby(rows, itemgetter(0, 1)):
            if any(_held(_shifts(seen), window, cover) for _, seen in groupby(pair, itemgetter(2))):
                yield pa.RecordBatch.from_arrays([pa.array([text], pa.binary()), pa.array([item], kind)], names=["text_id", "item_id"])

    name, kind = met.schema["item_id"].dataType.simpleString(), to_arrow_type(met.schema["item_id"].dataType)
    return along.mapInArrow(run, f"text_id binary, item_id {name}")


def judge(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """(doc_id, contaminated, item_ids) of every row; item_ids lists the items found, in order.

    Null and empty texts and items without a word match nothing; items with one text are all listed. Repeated
    rows get the same answer, other columns are ignored. Of a placeholder-only window the slots decide.
    A word that opens a sentence is a name unless ``common_words`` has it, which is the same for texts and items.
    """
    found = matches(docs, benchmark, window, cover).groupBy("text_id").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    keyed = bare(docs, "doc_id", "text").select("doc_id", text_key(F.col("text")).alias("text_id"))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    return keyed.join(loose(found), "text_id", "left").select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast(f"array<{kind}>")).alias("item_ids"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with all their columns."""
    found = store(matches(docs, benchmark, window, cover).select("text_id").distinct(), "leaks")
    own = stash(docs, text_id=text_key(F.col("text")))
    return unstash(own.join(loose(found), "text_id", "left_anti"), docs)
