import random

import pytest
from pyspark.sql import functions as F

CLASHES = ["fp", "tid", "text_id", "h", "cell", "ids", "score", "kept", "component_id", "spans", "_id", "c0", "digest", "shard"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """Make a ``documents`` table from (doc_id, text) pairs, with extra columns whose names operators use themselves."""
    def make(rows, clash=False, lang="en"):
        out = spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string")
        if clash:
            out = out.withColumns({c: F.lit("x") for c in CLASHES})
        return out.withColumns({"lang": F.lit(lang), "source": F.lit("s"), "n_chars": F.length("text").cast("bigint")})
    return make


@pytest.fixture(scope="session")
def awkward():
    """Null ids and texts, empty, blank and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    base = " ".join(rng.choice(words) for _ in range(150))
    long = " ".join(rng.choice(words) for _ in range(30_000))
    return [(1, base), (1, base), (2, base + " tail"), (None, base), (None, None), (3, None), (4, ""), (5, " \n\t "),
            (6, long), (7, "Short one."), (8, "Short one."), (9, "é日本 " * 50), (10, "line of text\n" * 60)]
