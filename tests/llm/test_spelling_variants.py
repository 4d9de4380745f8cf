import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tillroll.llm import spelling_variants as sv

SCHEMA = "doc_id BIGINT, text STRING"


def plain_counts(rows, least=7, times=2, one_in=31):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % one_in == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= times}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, factor=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {
        (w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()
    }


def result(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = plain_counts([(r.doc_id, r.text) for r in docs.collect()])
    assert {tuple(r) for r in sv.word_counts(docs).collect()} == set(counts.items())
    # All pairs of some thousand words are too slow in plain Python: buckets of one deletion.
    by_deletion = {}
    for w in counts:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by_deletion.setdefault(v, set()).add(w)
    near = {w: set() for w in counts}
    for group in by_deletion.values():
        for w in group:
            near[w] |= {v for v in group if one_edit(w, v)}
    got = result(sv.op11_spelling_variants(spark, "/root/testdata/sf0.01"))
    assert {w for w, *_ in got} == set(counts) and len(got) == len(counts)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    for w, f, root, n, n_near, form_n in got:
        end = w
        while form[end] is not None:
            end = form[end]
        assert (f, root, n, n_near, form_n) == (form[w], end, counts[w], len(near[w]), counts[f] if f else None)
    assert sum(f is not None for f in form.values()) > 100 and any(len(v) > 3 for v in near.values())


def test_random_words_equal_brute_force(spark):
    rng = random.Random(5)
    counts = {"".join(rng.choice("abé") for _ in range(rng.randint(2, 6))): rng.choice([2, 3, 20, 30, 400]) for _ in range(400)}
    df = spark.createDataFrame(list(counts.items()), "word STRING, n BIGINT").repartition(5)
    assert result(sv.variants(df)) == plain_variants(counts)


def test_chains_ties_and_runs_of_a_letter(spark):
    counts = {"aaaaaaa": 3000, "aaaaaaaa": 300, "aaaaaaaaa": 30, "aaaaaaaaaa": 3, "zbcdefg": 50, "xbcdefg": 50, "bcdefg": 5}
    got = result(sv.variants(spark.createDataFrame(list(counts.items()), "word STRING, n BIGINT")))
    assert got == plain_variants(counts)
    by_word = {r[0]: r for r in got}
    assert by_word["aaaaaaaaaa"][2] == "aaaaaaa" and by_word["bcdefg"][1] == "xbcdefg"
    assert by_word["aaaaaaaa"][4] == 2


def test_nulls_empty_repeated_rows_and_very_long_runs(spark):
    long = "ab" * 30_000
    rows = [
        (None, "Wonderland wonderland"),
        (1, None),
        (2, ""),
        (3, long),
        (3, long),
        (4, long[:-1] + "c " + long[:-1] + "c"),
        (5, "Étranger× étranger× ÉTRANGER× naïvetés 1234567 smőrgåsbord"),
    ]
    docs = spark.createDataFrame([(*r, "x", 9) for r in rows], SCHEMA + ", word STRING, n INT")
    counts = plain_counts(rows)
    assert {tuple(r) for r in sv.word_counts(docs).collect()} == set(counts.items())
    assert result(sv.variants(sv.word_counts(docs))) == plain_variants(counts)
    assert any(len(w) > 50_000 for w in counts)


def test_empty_table(spark):
    assert sv.variants(sv.word_counts(spark.createDataFrame([], SCHEMA))).count() == 0


def test_frequent_word_is_counted_before_the_shuffle(spark):
    docs = spark.range(20_000).select(F.col("id").cast("string").alias("key"), F.lit("elephant elephant mammoth").alias("text"))
    sent = docs.coalesce(4).mapInArrow(sv._count(7, 31), "word STRING, n BIGINT")
    assert sent.count() < 4 * 40


def test_entries_do_not_grow_with_the_corpus():
    words = [bytes([x]) + b"bcdefg" for x in range(97, 123)]
    word, p, s, skips = sv.entries_of(words)
    keys = Counter(zip(p[skips > 0].tolist(), s[skips > 0].tolist()))
    assert max(keys.values()) == 26 and len(word) == sum(2 * len(w) + 1 for w in words)
    assert np.unique(p).size == 1 + 26 * 7
