"""Language identification of words with a linear-chain conditional random field.

A text is cut into chains of words (a line, or ``CHAIN`` words of it). A word's features are its affixes, its
letter n-grams and itself if the lexicon knows it; transitions between the languages of neighbours are learnt
with them, by stochastic gradient ascent on the chains' likelihood. Training chains are spliced from texts of
different languages, so that switching is seen. Forward-backward gives every word its marginals; a text's
language is the one with most of them.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bare, crc_fold

FOLDS, HELD = 4, 2        # texts of this crc32 remainder are never learnt from
TRAIN_ROWS = 1500         # texts the field is fitted on, about (by hash of the text), shared out over languages
TRAIN_WORDS = 1_000_000   # words of these texts, spread over them evenly
LEXICON = 20_000          # words the lexicon holds
CHAIN = 48                # words of a chain at most
BITS = 17                 # hashed features: 2 ** BITS
EPOCHS = 3
BATCH = 256               # chains of a gradient step
RATE, PENALTY = 0.3, 1e-6
SPLICE = 0.3              # share of training chains that switch language
KNOWN = 200_000           # words a worker remembers
SIDE = 1024               # chains gone through side by side
SCORED = 4096             # words whose features are made at once
GROUP_CHARS = 1 << 20
WORD = regex.compile(r"\p{L}[\p{L}\p{M}'’]*|\n")
WORDS, FOUND = WORD.findall, WORD.finditer


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, out >> 1 ^ 0xEDB88320, out >> 1)
    return out.astype(np.uint32)


CRC = _crc_table()


def features(words: list[str], lexicon: frozenset) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of lower-cased words, after one another, and how many each word has.

    A word's are its affixes (``p``, ``s``) of up to three letters, the 2- and 3-grams (``g``) of ``^word$`` and
    itself (``w``) if it is known, each once and in order. The hash is the crc32 of kind and letters; it is made for
    all words side by side.
    """
    text, mask = "".join([f"^{w}$" for w in words]), (1 << BITS) - 1
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    last = np.cumsum(size) - 1
    first, own = last - size + 1, np.repeat(np.arange(len(words)), size)
    letters = sorted(set(text))
    raw = [c.encode("utf-8", "replace") for c in letters]
    width, octets = np.array(list(map(len, raw))), np.array([list(x.ljust(4, b"\0")) for x in raw], np.uint32)
    codes = np.searchsorted(np.array(list(map(ord, letters)), np.uint32),
                            np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"))

    def kind(name: bytes, n: int) -> np.ndarray:
        return np.full(n, zlib.crc32(name) ^ 0xFFFFFFFF, np.uint32)

    def then(state: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The hashes' registers behind one more letter, that at each place ``at``."""
        c = codes[at]
        for j in range(width.max()):
            live = width[c] > j
            state = np.where(live, CRC[(state ^ octets[c, j]) & 255] ^ (state >> 8), state)
        return state

    at = np.flatnonzero(np.arange(len(codes)) < last[own])
    pair = then(then(kind(b"g", len(at)), at), at + 1)
    longer = at + 2 <= last[own[at]]
    found = [(own[at], pair), (own[at[longer]], then(pair[longer], at[longer] + 2))]
    for n in (1, 2, 3):
        has = np.flatnonzero(size - 2 >= n)
        head, tail = kind(b"p", len(has)), kind(b"s", len(has))
        for i in range(n):
            head, tail = then(head, first[has] + 1 + i), then(tail, last[has] - n + i)
        found += [(has, head), (has, tail)]
    keys = [of << BITS | (state ^ 0xFFFFFFFF) & mask for of, state in found]
    keys.append(np.array([i << BITS | zlib.crc32(f"w{w}".encode("utf-8", "replace")) & mask
                          for i, w in enumerate(words) if w in lexicon], np.int64))
    key = np.sort(np.concatenate(keys))
    key = key[np.append(True, key[1:] != key[:-1])]
    return key & mask, np.bincount(key >> BITS, minlength=len(words))


def chains(text: str | None) -> list[list[str]]:
    """The words of each line, in pieces of ``CHAIN``; case is folded."""
    lines = map(WORDS, (text or "").lower().split("\n"))
    return [words[i:i + CHAIN] for words in lines for i in range(0, len(words), CHAIN)]


def _passes(e: np.ndarray, m: np.ndarray, start: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward shares of padded chains, all by (label, place, chain): chains lie side by side in memory."""
    a, b, t = np.empty(e.shape), np.ones(e.shape), e.shape[1]
    now = np.exp(start)[:, None] * e[:, 0]
    np.divide(now, now.sum(axis=0), out=a[:, 0])
    for i in range(1, t):
        now = (m.T @ a[:, i - 1]) * e[:, i]
        np.divide(now, now.sum(axis=0), out=a[:, i])
    for i in range(t - 2, -1, -1):
        now = m @ (b[:, i + 1] * e[:, i + 1])
        np.divide(now, now.sum(axis=0), out=b[:, i], where=mask[i + 1])
    return a, b


def marginals(emission: np.ndarray, move: np.ndarray, start: np.ndarray, mask: np.ndarray):
    """Forward-backward over padded chains (chain, place, label): word marginals and summed pair marginals."""
    e, m = np.exp(emission - emission.max(axis=2, keepdims=True)), np.exp(move)
    a, b = _passes(np.ascontiguousarray(e.transpose(2, 1, 0)), m, start, np.ascontiguousarray(mask.T))
    word = a * b
    word /= word.sum(axis=0)
    return word.transpose(2, 1, 0), a.transpose(1, 2, 0), b.transpose(1, 2, 0), e, m


class Field:
    """A fitted field: feature weights (feature, label), transitions, start weights, labels and lexicon."""

    def __init__(self, labels: list[str], lexicon: frozenset):
        self.labels, self.lexicon = labels, lexicon
        k = len(labels)
        self.w, self.move, self.start = np.zeros((1 << BITS, k)), np.zeros((k, k)), np.zeros(k)
        self.forget()

    def forget(self) -> None:
        """Words get numbers as they come; ``held`` has their emissions, as factors of at most 1, by number."""
        self.known: dict[str, int] = defaultdict(count().__next__)
        self.held = np.zeros((0, len(self.labels)))

    def emissions(self, words: list[str]) -> np.ndarray:
        out = np.empty((len(words), len(self.labels)))
        for at in range(0, len(words), SCORED):
            flat, sizes = features(words[at:at + SCORED], self.lexicon)
            out[at:at + SCORED] = np.add.reduceat(self.w[flat], np.cumsum(sizes) - sizes, axis=0)
        return out

    def fit(self, data: list[tuple[list[str], list[int]]], rng: np.random.Generator) -> None:
        vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for words, _ in data for w in words))}
        words = list(vocabulary)
        found = [features(words[at:at + SCORED], self.lexicon) for at in range(0, len(words), SCORED)]
        flat, sizes = (np.concatenate(x) for x in zip(*found))
        begin = np.cumsum(sizes) - sizes
        grad2 = np.full(self.w.shape, 1e-3)
        move2, start2, k = np.full(self.move.shape, 1e-3), np.full(self.start.shape, 1e-3), len(self.labels)
        data = [(np.array([vocabulary[w] for w in words]), np.array(y)) for words, y in data]
        for _ in range(EPOCHS):
            order = rng.permutation(len(data))
            for at in range(0, len(order), BATCH):
                part = [data[i] for i in order[at:at + BATCH]]
                size = np.array([len(y) for _, y in part])
                mask = np.arange(size.max()) < size[:, None]
                ids, gold = np.zeros(mask.shape, np.int64), np.zeros(mask.shape, np.int64)
                ids[mask], gold[mask] = np.concatenate([x for x, _ in part]), np.concatenate([y for _, y in part])
                met, of = np.unique(ids[mask], return_inverse=True)
                width, first = sizes[met], begin[met]
                cuts = np.cumsum(width) - width
                feats = flat[np.repeat(first - cuts, width) + np.arange(width.sum())]
                scores = np.add.reduceat(self.w[feats], cuts, axis=0)
                emission = np.zeros((*mask.shape, k))
                emission[mask] = scores[of]
                word, a, b, e, m = marginals(emission, self.move, self.start, mask)
                gap = np.eye(k)[gold] - word
                by_word = np.stack([np.bincount(of, gap[mask][:, j], len(met)) for j in range(k)], axis=1)
                spread = np.repeat(by_word, width, axis=0)
                hit, where = np.unique(feats, return_inverse=True)
                g = np.stack([np.bincount(where, spread[:, j], len(hit)) for j in range(k)], axis=1) / len(part)
                g -= PENALTY * self.w[hit]
                grad2[hit] += g * g
                self.w[hit] += RATE * g / np.sqrt(grad2[hit])
                pair = np.zeros((k, k))
                for i in range(1, mask.shape[1]):
                    live = mask[:, i]
                    if live.any():
                        p = a[i - 1][live][:, :, None] * m * (b[i] * e[:, i])[live][:, None, :]
                        p /= p.sum(axis=(1, 2), keepdims=True)
                        np.add.at(pair, (gold[live, i - 1], gold[live, i]), 1.0)
                        pair -= p.sum(axis=0)
                pair, first_gap = pair / len(part), gap[:, 0].sum(axis=0) / len(part)
                move2, start2 = move2 + pair * pair, start2 + first_gap * first_gap
                self.move += RATE * pair / np.sqrt(move2)
                self.start += RATE * first_gap / np.sqrt(start2)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The words' places in ``held``, which is made to have them all."""
        ids = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if len(self.known) > KNOWN and len(self.held):
            self.forget()
            return self.numbers(words)
        if len(self.known) > len(self.held):
            new = self.emissions(list(islice(self.known, len(self.held), None)))
            self.held = np.concatenate((self.held, np.exp(new - new.max(axis=1, keepdims=True))))
        return ids

    def word_marginals(self, flat: list[list[str]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(chains, mask, marginals) of some of the chains at a time: by label, place and chain, padded."""
        size = np.array([len(c) for c in flat])
        ids, begin, m = self.numbers(list(chain.from_iterable(flat))), np.cumsum(size) - size, np.exp(self.move)
        by = np.argsort(size, kind="stable")
        for at in range(0, len(by), SIDE):
            part = by[at:at + SIDE]
            place = np.arange(size[part].max())[:, None]
            mask = place < size[part]
            e = self.held[ids[np.where(mask, begin[part] + place, 0)]]
            a, b = _passes(np.ascontiguousarray(e.transpose(2, 0, 1)), m, self.start, mask)
            a *= b
            a /= a.sum(axis=0)
            yield part, mask, a

    def label(self, texts: list[str | None]) -> list[tuple[str | None, float, list[float]]]:
        """For each text its language (null without words), that language's share, and all shares."""
        cut = [chains(t) for t in texts]
        flat = [c for own in cut for c in own]
        if not flat:
            return [(None, 0.0, [])] * len(texts)
        shares = np.zeros((len(flat), len(self.labels)))
        for part, mask, word in self.word_marginals(flat):
            shares[part] = (word * mask).sum(axis=1).T
        out, at = [], 0
        for own in cut:
            total = shares[at:at + len(own)].sum(axis=0)
            at += len(own)
            if not own:
                out.append((None, 0.0, []))
                continue
            best = int(total.argmax())
            out.append((self.labels[best], float(total[best] / total.sum()), (total / total.sum()).tolist()))
        return out


    def label_words(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, language, its marginal) of every word, in order; places count code points of ``text``."""
        places, flat, open_chain = [], [], False
        for m in FOUND(text):
            if m[0] == "\n":
                open_chain = False
                continue
            if not open_chain or len(flat[-1]) == CHAIN:
                flat.append([])
                open_chain = True
            flat[-1].append(m[0].lower())
            places.append(m.span())
        rows: list[list] = [[] for _ in flat]
        for part, mask, word in self.word_marginals(flat) if flat else ():
            best, most = word.argmax(axis=0).T, word.max(axis=0).T
            for chain_, live, k, score in zip(part.tolist(), mask.T, best, most):
                rows[chain_] = list(zip(k[live].tolist(), score[live].tolist()))
        found = chain.from_iterable(rows)
        return [(a, b, self.labels[k], min(1.0, score)) for (a, b), (k, score) in zip(places, found)]


def train(docs: DataFrame, folds: int = FOLDS, held: int = HELD, rows: int = TRAIN_ROWS, seed: int = 11) -> Field | None:
    """Fit on about ``rows`` labelled texts, equally many of each language as far as there are; null without any."""
    own = bare(docs, "doc_id", "text", "lang").filter(
        (crc_fold(F.col("doc_id"), folds) != held) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    per = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per:
        return None
    labels = sorted(per)
    each, draw = max(1, rows // len(labels)), F.pmod(F.xxhash64("text", "doc_id"), F.lit(1_000_000))
    share = F.lit(0)
    for lang in labels:
        share = F.when(F.col("lang") == lang, min(1_000_000, 1 + each * 1_000_000 // per[lang])).otherwise(share)
    drawn = own.filter(draw < share).select("text", "lang", F.xxhash64("text", "doc_id").alias("k")).toPandas()
    drawn = drawn.sort_values(["k", "text", "lang"])
    found = [(c, labels.index(lang)) for text, lang in zip(drawn.text, drawn.lang) for c in chains(text)]
    rng = np.random.default_rng(seed)
    words = sum(len(c) for c, _ in found)
    keep = rng.random(len(found)) < TRAIN_WORDS / max(1, words)
    found = [f for f, k in zip(found, keep) if k]
    counts: dict[str, int] = {}
    for c, _ in found:
        for w in c:
            counts[w] = counts.get(w, 0) + 1
    common = sorted((w for w, n in counts.items() if n > 2), key=lambda w: (-counts[w], w))[:LEXICON]
    field = Field(labels, frozenset(common))
    data = []
    for c, y in found:
        other, z = found[int(rng.integers(len(found)))]
        if rng.random() < SPLICE and z != y:
            a, b = rng.integers(len(c) + 1), rng.integers(len(other) + 1)
            c, ys = c[:a] + other[b:], [y] * int(a) + [z] * (len(other) - int(b))
        else:
            ys = [y] * len(c)
        if c:
            data.append((c, ys))
    if data:
        field.fit(data, rng)
    return field


@lru_cache(maxsize=1)    # with its words it is large, and no task needs two
def _rebuild(labels: tuple, lexicon: frozenset, weights: bytes, move: bytes, start: bytes) -> Field:
    field = Field(list(labels), lexicon)
    k = len(labels)
    field.w = np.frombuffer(weights, np.float32).reshape(-1, k).astype(np.float64)
    field.move, field.start = np.frombuffer(move).reshape(k, k), np.frombuffer(start)
    return field


def _parts(field: Field | None) -> tuple | None:
    """What a task rebuilds the field from."""
    return None if field is None else (
        tuple(field.labels), field.lexicon, field.w.astype(np.float32).tobytes(), field.move.tobytes(), field.start.tobytes())


def groups(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Texts to be labelled at a time and where they begin: ``GROUP_CHARS`` of them, and what the last has beyond."""
    held, chars, at = [], 0, 0
    for i, text in enumerate(texts):
        held.append(text.as_py())
        chars += len(held[-1] or "")
        if chars >= GROUP_CHARS or i + 1 == len(texts):
            yield at, held
            at, held, chars = i + 1, [], 0


def predict(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row by its whole text; ``und`` with score 0 for null or no letter.

    Repeated rows and null ids come out as they came; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(_parts(field))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if shared.value is None else _rebuild(*shared.value)
        for batch in batches:
            for at, held in groups(batch.column(1)):
                made = [(None, 0.0, [])] * len(held) if own is None else own.label(held)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(held)), pa.array([m[0] or "und" for m in made], pa.string()),
                     pa.array([min(1.0, m[1]) for m in made], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return bare(docs, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def label_words(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, start, end, lang, score) of every word of every text: code-switched texts change language between words.

    ``text[start:end]`` is the word, ``score`` the language's marginal there. Texts without a letter and a null field
    give no rows; repeated rows theirs as often as they come.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(_parts(field))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if shared.value is None else _rebuild(*shared.value)
        for batch in batches if own is not None else ():
            for i in range(batch.num_rows):
                rows = own.label_words(batch.column(1)[i].as_py() or "")
                if rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.string(), pa.float64()])]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i] * len(rows))), *columns], names=names)

    names = ["doc_id", "start", "end", "lang", "score"]
    return bare(docs, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, start bigint, end bigint, lang string, score double")


def judge(docs: DataFrame, folds: int = FOLDS, held: int = HELD) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; a null doc_id is neither held out nor learnt from."""
    out = predict(docs, train(docs, folds, held))
    return out.select("doc_id", F.coalesce(crc_fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"),
                      "lang_pred", "score")


def confident(docs: DataFrame, least: float, folds: int = FOLDS, held: int = HELD) -> DataFrame:
    """The rows of ``docs``, all columns, with a letter and a language that holds ``least`` or more of the words.

    The field is trained on the rows that have a language. Without any such row nothing can be told apart and
    every text with a letter stays. Null and empty texts go.
    """
    field = train(docs, folds, held)
    lettered = docs.filter(F.col("text").rlike(r"\p{L}"))
    if field is None:
        return lettered
    shared = docs.sparkSession.sparkContext.broadcast(_parts(field))

    # Only texts go to Python and only verdicts come back; the rows wait in Spark's own memory.
    @F.arrow_udf("boolean")
    def keeps(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = _rebuild(*shared.value)
        for texts in batches:
            found = [m[0] is not None and m[1] >= least for _, held in groups(texts) for m in own.label(held)]
            yield pa.array(found, pa.bool_())
        # Other operators' tasks follow in the same workers.
        _rebuild.cache_clear()

    return lettered.filter(keeps("text"))
