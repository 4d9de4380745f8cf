import random
import re

import pytest

from tillroll.llm import string_tiling as S


def brute(doc, item, least=5):
    """Greedy string tiling as defined: look for the longest unmarked match, again and again."""
    d, i = (re.findall(r"\w+", (t or "").lower()) for t in (doc, item))
    if not i:
        return None
    least = min(least, len(i))
    in_d, in_i, n_tiles = [False] * len(d), [False] * len(i), 0
    while True:
        best = (0, 0, 0)
        for a in range(len(d)):
            for b in range(len(i)):
                n = 0
                while a + n < len(d) and b + n < len(i) and d[a + n] == i[b + n] and not in_d[a + n] and not in_i[b + n]:
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < least:
            return sum(in_i) / len(i), sum(in_i), n_tiles
        for j in range(n):
            in_d[a + j] = in_i[b + j] = True
        n_tiles += 1


def cases():
    pick = random.Random(11)
    words = [f"w{k}" for k in range(30)]
    say = lambda n: [pick.choice(words) for _ in range(n)]
    items = [" ".join(say(n)) for n in (12, 20, 33, 3, 5)] + ["", None, "Épée, d'or — très «fine» ici là"]
    docs = [" ".join(say(60)) for _ in range(4)] + [None, "", "épée d or très fine ici là"]
    for t in items[:5]:
        w = t.split()
        half = len(w) // 2
        docs += [" ".join(say(9) + w + say(9)), " ".join(w[half:] + say(4) + w[:half]), " ".join(w[:half] + say(30)), ", ".join(w).upper()]
    docs += ["same " * 300, docs[7], docs[7]]
    return docs, [*items, "same " * 9]


@pytest.fixture(scope="module")
def given(spark):
    docs, items = cases()
    d = spark.createDataFrame([(k, t, "x", 1.0) for k, t in enumerate(docs)], "doc_id BIGINT, text STRING, item STRING, coverage DOUBLE")
    b = spark.createDataFrame([(k, t, "y") for k, t in enumerate(items)], "item_id BIGINT, text STRING, `key` STRING")
    return docs, items, d, b


@pytest.mark.parametrize("most", [S.BROADCAST_BYTES, 0])
def test_equals_brute_force(given, most):
    docs, items, d, b = given
    want = {}
    for k, t in enumerate(docs):
        for j, i in enumerate(items):
            found = brute(t, i)
            if found and found[0] >= S.COVERAGE:
                want[k, j] = (round(found[0], 9), found[1])
    benchmark = S.Benchmark(b, broadcast_bytes=most)
    got = {(r.doc_id, r.item_id): (round(r.coverage, 9), r.covered_words) for r in benchmark.matches(d).collect()}
    assert got == want and len(want) > 15
    clean = benchmark.clean(d)
    assert clean.columns == d.columns
    assert {r.doc_id for r in clean.collect()} == set(range(len(docs))) - {k for k, _ in want}


def test_tiles_do_not_overlap_and_reordering_is_found():
    item = " ".join(f"t{k}" for k in range(20))
    w = item.split()
    laid = S.tiles(S.text_words(" ".join(w[13:] + w[6:13] + w[:6])), S.text_words(item), 5)
    assert sorted((b, n) for _, b, n in laid) == [(0, 6), (6, 7), (13, 7)]


@pytest.mark.parametrize("most", [S.BROADCAST_BYTES, 0])
def test_empty_tables(spark, given, most):
    _, _, d, b = given
    assert S.Benchmark(b.limit(0), broadcast_bytes=most - 1 if not most else most).matches(d).collect() == []
    assert S.Benchmark(b, broadcast_bytes=most).matches(d.limit(0)).collect() == []


def test_long_rows_are_cut_at_separators(monkeypatch):
    text = " ".join(f"x{k}" for k in range(500))
    whole = S.text_words(text).tolist()
    monkeypatch.setattr(S._WORDS, "PIECE", 64, raising=False)
    assert S.text_words(text).tolist() == whole


@pytest.mark.parametrize("most", [S.BROADCAST_BYTES, 0])
def test_verbatim_items_of_many_repetitions(spark, most):
    items = ["yes " * 11, "la la land of plenty " * 12, "no " * 200, "a b " * 40 + "unlike words to end on", "one two three " * 2]
    docs = [f"before it {t} and after" for t in items] + ["yes no " * 90, "no " * 99, "no " * 100, items[1] * 3]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id BIGINT, text STRING")
    b = spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING")
    want = {}
    for k, t in enumerate(docs):
        for j, i in enumerate(items):
            found = brute(t, i)
            if found[0] >= S.COVERAGE:
                want[k, j] = (round(found[0], 9), *found[1:])
    assert {(k, k) for k in range(5)} <= set(want)
    benchmark = S.Benchmark(b, broadcast_bytes=most)
    got = {(r.doc_id, r.item_id): (round(r.coverage, 9), r.covered_words, r.n_tiles) for r in benchmark.matches(d).collect()}
    assert got == want
    assert {r.doc_id for r in benchmark.clean(d).collect()} == set(range(len(docs))) - {k for k, _ in want}


def test_tiles_in_small_steps(monkeypatch):
    docs, items = cases()
    pairs = [(S.text_words(t), S.text_words(i)) for t in docs for i in items if i]
    whole = [S.tiles(d, i, 5) for d, i in pairs]
    monkeypatch.setattr(S, "PAIRS", 3)
    assert [S.tiles(d, i, 5) for d, i in pairs] == whole and any(whole)
