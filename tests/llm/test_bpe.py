import base64
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tidemark.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        ranks = f.read()
    return bpe.Codec(ranks, P.PATTERN, bpe.late_letters(ranks, P.PATTERN))


def ids(blob):
    return np.frombuffer(blob, "<u4").tolist()


def test_equals_the_library(codec, library):
    rng = random.Random(1)
    odd = ["", " ", "a" * 5000, "日本語" * 900, "xyz" * 900 + "é" * 900, "<|endoftext|> it's", " \x1c x\x85y \n\n z", "՘'s \U0003d000's"]
    odd += ["".join(chr(rng.choice([32, 10, 39, 115, 0x41, 0xE9, 0x4E2D, 0x1F600, 0x558, rng.randrange(1, 0xD000)])) for _ in range(200))
            for _ in range(300)]
    for text, got in zip(odd, codec.encode(odd)):
        assert ids(got) == library.encode_ordinary(text)
        assert codec.decode(got) == text.encode()
    for text in odd:            # remembered pieces do not hide late letters
        assert ids(codec.encode([text])[0]) == library.encode_ordinary(text)


def test_matrix_and_heap_agree(codec):
    rng = random.Random(2)
    for _ in range(40):
        piece = "".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 300))).encode()
        row = codec.of_byte[np.frombuffer(piece, np.uint8)][None, :]
        assert codec.merge(row)[0].tolist() == codec.merge_long(piece).tolist()


def test_pair_table_finds_what_was_put_in(codec):
    left, right = np.array([1, 2, 3, 500]), np.array([9, 8, 7, 6])
    pairs = bpe.PairTable(left, right, np.array([10, 20, 30, 40]))
    assert pairs.find(left, right).tolist() == [10, 20, 30, 40]
    assert (pairs.find(right, left) == bpe.NONE).all()
    assert (pairs.find(np.array([-1, 1]), np.array([9, -1])) == bpe.NONE).all()


def test_every_row_round_trips(spark, docs_of, awkward, library):
    docs = docs_of(awkward, clash=True)
    rows = bpe.decode(bpe.encode(docs, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    got = sorted((str(r.doc_id), bytes(r.decoded).decode(), tuple(ids(r.ids))) for r in rows)
    assert got == sorted((str(i), t or "", tuple(library.encode_ordinary(t or ""))) for i, t in awkward)
    assert bpe.encode(docs_of([]), PATH, P.PATTERN).count() == 0


def test_a_small_memory_forgets_and_stays_right(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 5)
    texts = [f"word{i} other{i}" for i in range(50)]
    for t in texts:
        assert ids(codec.encode([t])[0]) == library.encode_ordinary(t)


def test_a_decoder_makes_no_pairs(spark):
    """What only encoding needs is made when it encodes."""
    path, pattern = P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN
    with open(path, "rb") as f:
        ranks = f.read()
    own = bpe.Codec(ranks, pattern, bpe.late_letters(ranks, pattern))
    whole = own.id_of[b"the"].to_bytes(4, "little")
    assert own.decode(whole) == b"the" and "pairs" not in vars(own)
    assert own.decode(own.encode(["the housezq"])[0]) == b"the housezq" and "pairs" in vars(own)
