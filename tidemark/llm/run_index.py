"""A run-length index of one block of text, and the long matches inside it.

The block's texts are joined by separators and their Burrows-Wheeler transform is cut into runs of equal
characters. Only run ends are sampled: the match length of a suffix with its neighbour in suffix order. Inside
a run the neighbour moves along with the text, so going one place to the right shortens the match by one; the
matching statistics of every place are streamed off the samples in text order, without the suffix array.
"""

from __future__ import annotations

import numpy as np

MATCHED = 1 << 18      # run borders compared at once


def words_of(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, first byte highest, zeros behind the end."""
    padded, word = np.concatenate((text, np.zeros(8, np.uint8))), np.zeros(len(text), np.uint64)
    for k in range(8):
        word <<= np.uint64(8)
        word |= padded[k:k + len(text)]
    return word


def suffix_array(words: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling over what is still tied. Places are 32-bit numbers."""
    n = len(words)
    order = np.argsort(words).astype(np.int32)

    def changes(key: np.ndarray) -> np.ndarray:
        return np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1]))

    def heads(new: np.ndarray) -> np.ndarray:
        at = np.arange(len(new), dtype=np.int32)
        at[~new] = 0
        return np.maximum.accumulate(at, out=at)

    new = changes(words[order])
    del words
    slots, head, rank = np.arange(n, dtype=np.int32), heads(new), np.empty(n, np.int32)
    rank[order] = head
    width = 8
    while True:
        tied = ~(new & np.concatenate((new[1:], [True])))
        slots, head = slots[tied], head[tied]
        if not len(slots):
            return order
        places = order[slots]
        ahead = places + np.int32(width)
        beyond = ahead >= n
        ahead[beyond] = 0
        then = rank[ahead]
        then += 1
        then[beyond] = 0
        key = head.astype(np.int64)
        key *= n + 1
        key += then
        del ahead, then, beyond
        by = np.argsort(key)
        places, key = places[by], key[by]
        del by
        order[slots] = places
        new = changes(key)
        del key
        head = slots[heads(new)]
        rank[places] = head
        width *= 2


def match_lengths(words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a[k]`` and ``b[k]``."""
    n, out, todo = len(words), np.zeros(len(a), np.int64), np.arange(len(a))
    room = n - np.maximum(a, b)
    while todo.size:
        at = out[todo]
        differ = words[a[todo] + at] ^ words[b[todo] + at]
        same = np.zeros(len(todo), np.int64)
        for k in range(8):
            same += differ < np.uint64(1 << (8 * k))
        out[todo] = np.minimum(at + same, room[todo])
        todo = todo[(same == 8) & (out[todo] < room[todo])]
    return out


class RunIndex:
    """Run-compressed transform of a text with sampled run ends."""

    def __init__(self, text: np.ndarray):
        order, words = suffix_array(words_of(text)), words_of(text)
        before = text[order - 1].astype(np.int16)
        before[order == 0] = -1
        starts = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        self.runs = before[starts]
        self.lengths = np.diff(np.concatenate((starts, [len(text)])))
        inner = starts[1:]
        parts = [inner[k:k + MATCHED] for k in range(0, len(inner), MATCHED)]
        across = np.concatenate(([0], *[match_lengths(words, order[p - 1], order[p]) for p in parts], [0])).astype(np.int32)
        self.first, self.last = order[starts], order[starts + self.lengths - 1]
        self.up, self.down = across[:-1], across[1:]      # match with the suffix before a run's first, after its last
        self.n = len(text)

    def _stream(self, places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Place 0 has no character before it, is a run of its own and therefore sampled."""
        by = np.argsort(places)
        places, lengths = places[by], lengths[by]
        found = np.repeat(places + lengths, np.diff(places, append=self.n))
        found -= np.arange(self.n, dtype=np.int32)
        return found

    def statistics(self) -> np.ndarray:
        """For every place the longest match of its suffix with one that starts elsewhere."""
        return np.maximum(self._stream(self.first, self.up), self._stream(self.last, self.down))


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text which of its ``length``-byte windows starts anywhere else in ``texts`` too.

    Texts are separated by a byte that UTF-8 never holds, so no window of a text reaches into the next.
    """
    flat = np.frombuffer(b"".join(t + b"\xff" for t in texts), np.uint8)
    found = RunIndex(flat).statistics()
    out, at = [], 0
    for t in texts:
        out.append(found[at:at + max(0, len(t) - length + 1)] >= length)
        at += len(t) + 1
    return out
