"""The corpus pipeline and the registered queries, against brute force on the smallest data."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from tidemark.llm import catalog
from test_simhash import plain_components
from test_suffix_dedup import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = corpus_pipeline.fresh_path(spark, f"test-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        held.append((name, docs))
    return {name: df.toPandas() for name, df in held}


def test_stages_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash", "suffix_dedup", "decontamination", "byte_bpe"]
    for name, df in list(stages.items())[:-1]:
        assert list(df.columns) == corpus_pipeline.COLUMNS, name


def test_clean_languages_stay(stages):
    before, after = stages["documents"], stages["language_id"]
    gone = before[~before.doc_id.isin(after.doc_id)]
    assert len(gone) <= 0.01 * len(before)


def test_one_near_copy_stays(stages):
    before = list(zip(stages["language_id"].doc_id, stages["language_id"].text))
    assert set(stages["simhash"].doc_id) == {c for _, _, c in plain_components(before)}


def test_repeats_are_cut(stages):
    before = list(zip(stages["simhash"].doc_id, stages["simhash"].text))
    want = {int(i): kept.decode("utf-8", "ignore")
            for i, _, _, _, kept in plain(before, corpus_pipeline.REPEAT, corpus_pipeline.REPEAT_WORDS)}
    after = stages["suffix_dedup"]
    assert dict(zip(after.doc_id, after.text)) == want
    assert all(n == len(t) for n, t in zip(after.n_chars, after.text))


def test_leaks_go_and_nothing_else(spark, stages):
    def windows(text):
        found = [w for w in (re.sub(r"^[\W_]+|[\W_]+$", "", x) for x in (text or "").lower().split()) if w]
        return {tuple(found[i:i + 8]) for i in range(max(1, len(found) - 7))}

    items = [windows(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = stages["suffix_dedup"], stages["decontamination"]
    held = {d: windows(t) for d, t in zip(before.doc_id, before.text)}
    leaks = {d for d, w in held.items() if any(2 * len(w & i) >= len(i) for i in items)}
    assert set(before.doc_id) - set(after.doc_id) == leaks


def test_tokens_decode_to_the_text(stages):
    import hashlib
    last, before = stages["byte_bpe"], stages["decontamination"]
    text = dict(zip(before.doc_id, before.text))
    assert set(last.doc_id) == set(text)
    for r in last.itertuples():
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
        assert r.n_tokens * 4 == len(r.ids) and r.ids_sha256 == hashlib.sha256(r.ids).hexdigest()


def test_run_equals_the_stages(spark, stages):
    out = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").toPandas()
    assert Counter(zip(out.doc_id, out.ids_sha256)) == Counter(zip(stages["byte_bpe"].doc_id, stages["byte_bpe"].ids_sha256))


def test_a_task_of_the_tokeniser_needs_one_python_worker(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    plan = corpus_pipeline.tokenise(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_all_operators_are_registered():
    found = Counter(m[1] for n in catalog.QUERIES if (m := re.match(r"op(\d+)_", n)))
    assert found == Counter(map(str, range(1, 14))) and catalog.QUERIES["pipeline"] is corpus_pipeline.run
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)


COLUMNS = {
    "op1_simhash": ["doc_id", "fingerprint", "component_id"],
    "op2_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op3_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op4_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op5_language_crf": ["doc_id", "held_out", "lang_pred", "score"],
    "op6_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op7_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op9_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op10_decontamination": ["doc_id", "contaminated", "item_ids"],
    "op12_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_queries_answer_for_every_row(spark, name):
    source = "pages" if name in ("op2_warc", "op3_url_filter") else "documents"
    out, base = catalog.QUERIES[name](spark, SF), spark.read.parquet(f"{SF}/{source}.parquet")
    assert set(COLUMNS[name]) <= set(out.columns)
    key = COLUMNS[name][0]
    assert Counter(r[0] for r in out.select(key).collect()) == Counter(r[0] for r in base.select(key).collect())
