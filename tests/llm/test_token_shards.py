import numpy as np
import pytest

from tidemark.llm import token_shards as shards


@pytest.fixture
def by_bytes():
    def encode(texts):          # local, so that tasks get it by value
        return [np.frombuffer((t or "").encode(), np.uint8).astype(np.uint32) for t in texts]
    return encode


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_the_permutation_is_one(n):
    slots = shards.permute(np.arange(n), n, "key")
    assert sorted(slots.tolist()) == list(range(n))
    assert shards.permute(slots, n, "key", back=True).tolist() == list(range(n))
    if n >= 64:
        assert slots.tolist() != shards.permute(np.arange(n), n, "other").tolist() != list(range(n))


def wanted(rows, context):
    out = []
    for doc, t in rows:
        data = (t or "").encode()
        out += [(str(doc), k // context, data[k:k + context]) for k in range(0, len(data), context)]
    return sorted(out)


def test_whole_texts_come_back_in_slot_order(spark, docs_of, awkward, tmp_path, by_bytes):
    docs = docs_of(awkward, clash=True)
    layout = shards.write(docs, str(tmp_path / "s"), by_bytes, "key", id_bytes=1, context=100, shard_bytes=10_000)
    rows = shards.read(spark, layout, block=7).collect()
    assert [r.slot for r in sorted(rows, key=lambda r: (r.shard, r.offset))] == list(range(layout.n))
    assert sorted((str(r.doc_id), r.part, bytes(r.ids)) for r in rows) == wanted(awkward, 100)
    assert all(layout.place(r.slot) == (r.shard, r.offset) for r in rows) and len(layout.starts) > 10
    part = shards.read(spark, layout, 50, 333).collect()
    whole = {r.slot: r for r in rows}
    assert sorted(r.slot for r in part) == list(range(50, 333)) and all(whole[r.slot] == r for r in part)
    assert shards.read(spark, layout, layout.n, layout.n + 5).count() == 0


def test_a_second_run_writes_the_same_bytes(spark, docs_of, awkward, tmp_path, by_bytes):
    made = []
    for name in ("a", "b", "c"):
        shards.write(docs_of(awkward), str(tmp_path / name), by_bytes, "key" if name != "c" else "other", id_bytes=1, context=64, shard_bytes=5000)
        made.append({f.name: f.read_bytes() for f in (tmp_path / name).iterdir()})
    assert made[0] == made[1] != made[2]
    assert not any(f.startswith("_") for f in made[0])


def test_no_rows_and_ids_too_large(spark, docs_of, tmp_path, by_bytes):
    layout = shards.write(docs_of([(1, None), (2, "")]), str(tmp_path / "e"), by_bytes, "key")
    assert layout.n == 0 and shards.read(spark, layout).count() == 0
    assert shards.write(docs_of([]), str(tmp_path / "f"), by_bytes, "key").n == 0
    with pytest.raises(Exception, match="does not fit"):
        shards.write(docs_of([(1, "é")]), str(tmp_path / "g"), lambda ts: [np.array([300], np.uint32)] * len(ts), "key", id_bytes=1)


def test_another_process_reads_and_resumes_by_the_path(spark, docs_of, awkward, tmp_path, by_bytes):
    import subprocess
    import sys
    path = str(tmp_path / "s")
    layout = shards.write(docs_of(awkward), path, by_bytes, "key", id_bytes=1, context=100, shard_bytes=10_000)
    assert shards.load(path) == layout
    whole = [tuple(r) for r in shards.read(spark, path).orderBy("slot").collect()]
    half = layout.n // 2
    assert [tuple(r) for r in shards.read(spark, path, half).orderBy("slot").collect()] == whole[half:]
    code = f"from tidemark.llm import token_shards as t; x = t.load({path!r}); print(x.n, x.place({half}))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=sys.path[0] or ".", env={**__import__("os").environ, "PYTHONPATH": ":".join(sys.path)})
    assert out.stdout.strip() == f"{layout.n} {layout.place(half)}", out.stderr


def test_shards_without_a_layout_are_not_whole(tmp_path):
    with pytest.raises(FileNotFoundError):
        shards.load(str(tmp_path))
