import hashlib
import random
import zlib

import pytest

from tillroll.llm import minimax_shards as S


def brute(texts, shards):
    """The smallest feasible capacity over groups in SHA order, by trying every one."""
    sizes = {}
    for t in texts:
        key = hashlib.sha256((t or "").encode()).hexdigest()
        sizes[key] = sizes.get(key, 0) + len((t or "").encode()) + 1
    ordered = [sizes[k] for k in sorted(sizes)]
    capacity = max(ordered)
    while True:
        used, room = 1, capacity
        for s in ordered:
            if s > room:
                used, room = used + 1, capacity
            room -= s
        if used <= shards:
            return capacity
        capacity += 1


def place(spark, tmp_path, texts):
    rows = [(i, t, 1, "x", 0) for i, t in enumerate(texts)]
    schema = "doc_id BIGINT, text STRING, size INT, `group` STRING, slot INT"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    return S.op3_minimax_shards(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_smallest_capacity(spark, tmp_path, seed):
    pick = random.Random(seed)
    texts = ["é" * pick.randrange(1, 90) + str(pick.random()) for _ in range(60)]
    texts += [texts[0]] * 30 + [None, "", None, "y" * 3000]
    rows = place(spark, tmp_path, texts)
    assert len(rows) == len(texts)
    shard_bytes, slots, shard_of_text = {}, {}, {}
    for r in rows:
        t = texts[r.doc_id] or ""
        assert r["size"] == len(t.encode()) + 1 and r.text_crc32 == zlib.crc32(t.encode())
        assert (r.law, r.grown_shard) == ("bytes", None) and 0 <= r.shard < 8
        shard_bytes[r.shard] = shard_bytes.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
        assert shard_of_text.setdefault(t, r.shard) == r.shard
    assert max(shard_bytes.values()) == brute(texts, 8)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_empty_and_single(spark, tmp_path):
    assert place(spark, tmp_path / "none", []) == []
    assert [(r.shard, r.slot) for r in place(spark, tmp_path / "one", [None])] == [(0, 0)]


def test_native(spark, tmp_path):
    place(spark, tmp_path, ["a", "b"])
    plan = S.op3_minimax_shards(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
