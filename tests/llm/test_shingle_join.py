import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import shingle_join as S


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {(i, len(s), find(i)) for i, s in enumerate(sets)}


def cases(seed, copies=25):
    pick = random.Random(seed)
    say = lambda n: [f"w{pick.randrange(400)}" for _ in range(n)]
    passage = say(40)
    texts = [None, "", " \n\t", "A b", "a\x0bB", "a b", "É é", "é É", "x y z v w", "x Y z v w"]
    for n in (30, 60, 200):
        base = say(n)
        for _ in range(copies):
            w = list(base)
            for _ in range(pick.choice((0, 1, 1, 2, n // 40 + 1))):
                at = pick.randrange(len(w))
                w[at : at + pick.choice((0, 1, 1))] = say(pick.choice((0, 1, 2)))
            texts.append(" ".join(w))
    texts += [" ".join(say(pick.choice((0, 10, 60))) + passage + say(pick.choice((0, 5, 30)))) for _ in range(copies)]
    chain = say(60)  # neighbours are similar, ends are not
    texts += [" ".join(chain[k : k + 40]) for k in range(0, 20, 2)]
    return texts + [texts[20]] * 12 + [" ".join(say(50)) for _ in range(10)]


def run(spark, path, texts):
    rows = [(i, t, 7, b"clash") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING, n INT, set_id BINARY").write.parquet(f"{path}/documents.parquet")
    return {tuple(r) for r in S.op5_shingle_join(spark, str(path)).collect()}


@pytest.mark.parametrize("tile, bucket", [(256, 4_000_000), (4, 300)])
def test_equals_brute_force(spark, tmp_path, monkeypatch, tile, bucket):
    monkeypatch.setattr(S, "TILE_SETS", tile)
    monkeypatch.setattr(S, "BUCKET_TOKENS", bucket)
    texts = cases(tile)
    want = brute(texts)
    assert len({c for _, _, c in want}) < len(texts) * 0.7
    assert run(spark, tmp_path, texts) == want


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == set()


def test_overlap_bound_is_exact():
    for a in range(1, 60):
        for b in range(1, 60):
            o = next((o for o in range(min(a, b) + 1) if 100 * o >= 75 * (a + b - o)), None)
            assert o is None or S._least_overlap(a, b, 75) == o


def test_bitmap_bound_is_above_the_overlap():
    random_ = np.random.default_rng(2)
    for _ in range(50):
        x, y = (np.unique(random_.integers(0, 4000, 900, dtype=np.uint64)) for _ in range(2))
        a, b = S.bitmaps([x, y])
        bound = (len(x) + len(y) - int(np.bitwise_count(a ^ b).sum())) // 2
        assert len(np.intersect1d(x, y)) <= bound


def test_one_of_each_group_stays(spark):
    texts = cases(9, copies=6)
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, source STRING")
    kept = S.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {i for i, n, c in brute(texts) if i == c}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_long_and_repeated_rows(spark):
    long = " ".join(f"t{i}" for i in range(60_000))
    rows = [(1, long), (1, long), (2, long + " more words at the end"), (None, long), (3, None), (3, None)]
    got = S.similar_documents(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == [("1", 1), ("1", 1), ("2", 1), ("3", 3), ("3", 3), ("None", 1)]


def test_stored_tokens_round_trip():
    random_ = np.random.default_rng(6)
    for buckets in (1, 250, 70_000):
        named = random_.integers(0, 1 << 40, 50, dtype=np.uint64) | (random_.integers(0, buckets, 50, dtype=np.uint64) << np.uint64(40))
        assert S._long(S._short(named)).tolist() == named.tolist()
    assert S._long(S._short(np.zeros(0, np.uint64))).tolist() == []


def test_bucket_of_more_than_24_bits_of_sets():
    n = (1 << 24) + 5
    ids = np.stack([np.zeros(n, np.uint64), np.arange(n, dtype=np.uint64)], 1)
    tokens = np.arange(n, dtype=np.uint64) * np.uint64(2)
    tokens[-5:] = 1
    row = S._packed_row(0, ids, np.full(n, 9), np.ones(n), tokens, np.zeros(n))
    out = S._count(1)(pa.Table.from_batches([S._packed_batch([row])]))
    got, _, owner, shared, marks = S._unpacked(out)
    assert got[owner, 1].tolist() == list(range(n - 5, n)) and set(shared.tolist()) == {1} and set(marks.tolist()) == {19}


def test_no_group_grows_with_a_hot_token(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "HOT_SETS", 20)
    monkeypatch.setattr(S, "BUCKET_TOKENS", 1000)
    seen, plain = [], S._hot_tokens
    monkeypatch.setattr(S, "_hot_tokens", lambda *a: seen.append(plain(*a)) or seen[-1])
    pick = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    texts = cases(3) + [" ".join(passage + [f"u{k}x{i}" for i in range(pick.choice((1, 3, 9, 30)))]) for k in range(200)]
    assert run(spark, tmp_path, texts) == brute(texts)
    hot, marks, salts = seen[0]
    assert len(hot) >= 36 and salts > 1
    batch = pa.RecordBatch.from_arrays([pa.array([texts[-1], texts[-2], texts[-3], texts[-4]])], names=["text"])
    named = np.concatenate([b.column("named").to_numpy() for b in S._occurrences(5, 1)(iter([batch]))]).view(np.uint64)
    shared = np.sort(named)
    dealt = pa.Table.from_batches(list(S._deal(5, 1, shared, np.ones(len(shared), np.uint8), 4)(iter([batch]))))
    assert set(dealt.column("part").to_pylist()) <= {1, 2, 3, 4} and dealt.num_rows > 1
