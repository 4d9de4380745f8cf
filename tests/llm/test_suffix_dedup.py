import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import suffix_dedup as S


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[s : s + length] for d in data for s in range(len(d) - length + 1))
    out = []
    for i, d in enumerate(data):
        gone = np.zeros(len(d), bool)
        for s in range(len(d) - length + 1):
            if seen[d[s : s + length]] > 1:
                gone[s : s + length] = True
        runs = int((np.diff(np.r_[0, gone.astype(np.int8)]) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((i, len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def cases(seed, length):
    pick = random.Random(seed)
    alphabet = pick.choice(("ab", "abcdé", "abcdefghij klmno"))
    say = lambda n: "".join(pick.choice(alphabet) for _ in range(n))
    shared = [say(pick.choice((length - 1, length, length + 1, 2 * length, 5 * length))) for _ in range(8)]
    texts = [None, "", say(length - 1), "a" * (3 * length), "ab" * length, say(length)]
    for _ in range(60):
        texts.append("".join(pick.choice((say(pick.randrange(2 * length)), pick.choice(shared))) for _ in range(pick.randrange(1, 5))))
    base = say(8 * length)
    for _ in range(25):  # near copies
        w = list(base)
        for _ in range(pick.randrange(1, 9)):
            w[pick.randrange(len(w))] = pick.choice("xyz")
        texts.append("".join(w))
    return texts + [texts[20]] * 6 + [texts[5]] * 2


def run(spark, docs, length):
    got = S.repeated_spans(docs, length=length).collect()
    return sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got)


@pytest.mark.parametrize("seed, length, piece", [(1, 40, 1 << 19), (2, 40, 64), (3, 23, 1 << 19), (4, 100, 1 << 19)])
def test_equals_brute_force(spark, monkeypatch, seed, length, piece):
    monkeypatch.setattr(S, "PIECE", piece)
    monkeypatch.setattr(S, "BUCKET_BYTES", 5_000)
    S.anchors.cache_clear()
    texts = cases(seed, length)
    docs = spark.createDataFrame([(i, t, b"c", 1) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, text_id BINARY, n_bytes INT").repartition(5)
    want = brute(texts, length)
    assert sum(0 < r[2] < r[1] for r in want) > 20
    try:
        # Python workers see the module as it is on disk, so pieces are tried in this process.
        if piece < 1000:
            tool = S.Anchors(length)
            for t in texts:
                data = np.frombuffer((t or "").encode(), np.uint8)
                monkeypatch.setattr(S, "PIECE", piece)
                small = tool.places(data), tool.positions(data)
                monkeypatch.setattr(S, "PIECE", 1 << 19)
                big = S.Anchors(length)
                assert np.array_equal(small[0], big.places(data)) and np.array_equal(small[1], big.positions(data))
        assert run(spark, docs, length) == want
    finally:
        S.anchors.cache_clear()


def test_query(spark, tmp_path):
    pick = random.Random(8)
    shared = "".join(pick.choice("abcdefgh ") for _ in range(700))
    texts = [f"{i} " * 50 + shared[i : i + 400 + 30 * i] + f" {i}" * 80 for i in range(8)] + [None, "", shared, shared, "z" * 399, "z" * 1500]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r)[:5] for r in S.op1_suffix_dedup(spark, str(tmp_path)).collect())
    assert got == brute(texts, 400)
    spark.createDataFrame([], "doc_id BIGINT, text STRING").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert S.op1_suffix_dedup(spark, f"{tmp_path}/none").collect() == []


def test_every_string_has_an_early_anchor():
    random_ = np.random.default_rng(1)
    for letters in (1, 2, 26):
        data = random_.integers(0, letters, 5000).astype(np.uint8)
        tool = S.Anchors(80)
        places = tool.places(data)
        for s in range(len(data) - 80):
            near = places[(places >= s) & (places < s + tool.window)]
            assert len(near)


def test_remaining_text(spark):
    shared = "ü" + "passage " * 60
    rows = [(1, "head " + shared + " tail"), (2, shared + "é end"), (3, "alone"), (4, None), (5, "copy " * 100), (5, "copy " * 100)]
    got = S.repeated_spans(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    whole = {1: rows[0][1], 2: rows[1][1], 3: "alone", 4: "", 5: "copy " * 100}
    for r in got:
        data, last, kept = whole[r.doc_id].encode(), 0, b""
        for span in r.spans:
            kept += data[last : span.start]
            last = span.stop
        kept += data[last:]
        assert r.text == kept.decode(errors="replace")
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest() and r.n_removed == len(data) - len(kept)
    assert {r.doc_id: r.text for r in got}[3] == "alone" and [r.text for r in got if r.doc_id == 5] == ["", ""]


def test_runs_send_two_positions_of_a_kind(spark):
    tool = S.Anchors(400)
    for run in (b"-" * 1_000_000, b"ab" * 500_000):
        positions = tool.positions(np.frombuffer(run, np.uint8))
        sent = S._two_of_each(positions)
        assert len(positions) > 100_000 and len(sent) < 2_000
        all_of_them = S._all_of_each(positions, sent["at"])
        assert len(all_of_them) == len(positions)
    texts = ["-" * 300_000 + "x", "head " + "-" * 250_000, "ab" * 100_000, "only ab" + "ab" * 300, "clean text"]
    got = S.repeated_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")).collect()
    removed = {r.doc_id: r.n_removed for r in got}
    assert removed == {0: 300_000, 1: 250_000, 2: 200_000, 3: 602, 4: 0}
