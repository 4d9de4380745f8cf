import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tillroll.llm import packing as P

REFERENCE = Tokenizer.from_file(P.tokenizer_file())


def true_ids(text):
    return [*REFERENCE.encode(text or "", add_special_tokens=False).ids, P.END_ID]


TEXTS = ["", "Hello world", "l'été où naïve\n\n  x  \t y 123 4567", "<|endoftext|> inside <|endoftext|>", "日本語 ça va !!", "a" * 3000, " ".join(["don't"] * 50) + "  "]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_the_tokenizers(text):
    tokens = P.Tokens(P.tokenizer_file())
    assert tokens.encode(text).tolist() == true_ids(text)
    tokens.PIECE = 20  # cuts between words change nothing
    assert tokens.encode(text).tolist() == true_ids(text)


def run(spark, path, texts, repeat=()):
    rows = [(i, t, -1, "clash") for i, t in enumerate(texts)] + [(i, texts[i], -1, "clash") for i in repeat]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING, length INT, `key` STRING").write.parquet(f"{path}/documents.parquet")
    return P.op6_window_packing(spark, str(path)).collect()


def check(pieces, texts, padding_of_one=True):
    ids = {i: np.array(true_ids(t), "<u4") for i, t in enumerate(texts)}
    seen, sequences = {}, {}
    for p in pieces:
        got = ids[p.doc_id][p.start : p.start + p.length]
        assert len(got) == p.length and zlib.crc32(got.tobytes()) == p.ids_crc32
        assert p.doc_tokens == len(ids[p.doc_id])
        seen.setdefault(p.doc_id, []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= P.WINDOW
    short = [s for s in sequences.values() if sum(n for _, n in s) < P.WINDOW]
    assert len(short) <= 1
    return seen, ids


def test_every_id_once_and_little_padding(spark, tmp_path):
    pick = random.Random(3)
    texts = TEXTS + [None, "word " * 9000] + [" ".join(f"w{pick.randrange(500)}" for _ in range(pick.choice([3, 400, 900]))) for _ in range(60)]
    texts += [texts[20]] * 30  # one length holds a third
    seen, ids = check(run(spark, tmp_path, texts), texts)
    for i in range(len(texts)):
        at = 0
        for start, length in sorted(seen[i]):
            assert start == at
            at += length
        assert at == len(ids[i])


def test_repeated_rows_and_empty_table(spark, tmp_path):
    texts = ["one two three " * 300, "x y " * 700]
    pieces = run(spark, tmp_path / "a", texts, repeat=[0, 0, 1])
    check(pieces, texts)
    assert sum(p.length for p in pieces) == sum(len(true_ids(texts[i])) for i in (0, 1, 0, 0, 1))
    assert run(spark, tmp_path / "b", []) == []


def test_filled_sequences_round_trip(spark):
    docs = spark.createDataFrame([(i, f"some words {i} " * 40 * i) for i in range(1, 25)], "doc_id BIGINT, text STRING")
    packed = {r.sequence_id: r.ids for r in P.fill_sequences(P.pack(docs), docs).collect()}
    for p in P.pack(docs).collect():
        part = np.array(packed[p.sequence_id][p.offset : p.offset + p.length], "<u4")
        assert zlib.crc32(part.tobytes()) == p.ids_crc32


def test_least_squares_and_plan():
    h = np.zeros(11, np.int64)
    h[[3, 7, 4, 6, 10, 5]] = [10, 8, 5, 5, 2, 4]
    combos = P.combinations(h, 10)
    x = P.solve_repeats(combos, h)
    assert (x >= 0).all()
    for j, c in enumerate(combos):  # no step along one combination helps
        rest = h - sum(x[i] * np.bincount(k, minlength=11) for i, k in enumerate(combos))
        slope = np.bincount(c, minlength=11) @ rest
        assert slope < 1 and (x[j] == 0 or abs(slope) < 1)
    plan = P.make_plan(h, 10)
    assert plan.sequences == -(-int((h * np.arange(11)).sum()) // 10)


def test_greedy_fills_and_never_takes_more_than_there_is():
    pick = random.Random(11)
    for _ in range(20):
        histogram = np.zeros(65, np.int64)
        for _ in range(40):
            histogram[pick.randrange(1, 65)] += pick.choice([1, 2, 5, 300])
        for first in np.flatnonzero(histogram).tolist():
            filled = P.greedy_fill(histogram, first, 64)
            assert filled[0] == first and sum(filled) <= 64
            lengths, times = np.unique(filled, return_counts=True)
            assert (times <= histogram[lengths]).all()
            room = 64 - sum(filled)
            rest = histogram.copy()
            rest[lengths] -= times
            assert not rest[1 : room + 1].any()
        plan = P.make_plan(histogram, 64)
        number = np.concatenate([np.arange(n) for n in histogram])
        length = np.repeat(np.arange(65), histogram)
        sequence, offset = plan.place(length, number, 64)
        places = np.concatenate([s * 64 + o + np.arange(n) for s, o, n in zip(sequence, offset, length)])
        assert (np.sort(places) == np.arange(length.sum())).all()
        assert plan.sequences == -(-int(length.sum()) // 64)
