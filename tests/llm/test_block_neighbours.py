import math

import numpy as np
import pytest

from tillroll.llm import block_neighbours as B


def brute(rows, k=5):
    ok = [
        (i, np.array(v, np.float32).astype(float))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for i, v in ok:
        if i % 50 == 0:
            scored = [
                (-(v @ w) / (math.sqrt(v @ v) * math.sqrt(w @ w)), j) for j, w in ok if j != i and len(w) == len(v)
            ]
            out[i] = sorted((round(s, 12), j) for s, j in scored)[:k]
    return out


def run(spark, tmp_path, rows):
    given = [(i, v, 1, 0.5) for i, v in rows]
    spark.createDataFrame(given, "vec_id BIGINT, embedding ARRAY<FLOAT>, id INT, score DOUBLE").write.parquet(
        f"{tmp_path}/embeddings.parquet"
    )
    out = {}
    for r in B.op8_block_neighbours(spark, str(tmp_path)).orderBy("query_id", "rank").collect():
        got = out.setdefault(r.query_id, [])
        got.append((round(-r.score, 12), r.vec_id))
        assert r["rank"] == len(got)
    return out


@pytest.mark.parametrize("block", [4096, 37])
def test_equals_brute_force(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(B, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(B, "QUERY_BLOCK", 3)
    random = np.random.default_rng(5)
    vectors = random.normal(size=(400, 16)).astype(np.float32)
    vectors[100:240] = vectors[100]  # ties, a third of all rows
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1050, [0.0] * 16), (1100, []), (1150, [float("nan")] * 16), (1200, [None] * 16)]
    rows += [(1250, [1.0, 2.0]), (1251, [2.0, 1.0]), (None, [1.0] * 16), (1300, [float("inf")] * 16), (1350, [1.0] * 3)]
    assert run(spark, tmp_path, rows) == {q: best for q, best in brute(rows).items() if best}


def test_empty(spark, tmp_path):
    assert run(spark, tmp_path, []) == {}


def test_error_bound_holds():
    random = np.random.default_rng(1)
    a, b = (B.Codes(np.arange(300), random.normal(size=(300, 64))) for _ in range(2))
    approx = (a.codes.astype(np.float32) @ b.codes.astype(np.float32).T) * a.scale[:, None] * b.scale
    true = (a.vectors / a.norms[:, None]) @ (b.vectors / b.norms[:, None]).T
    assert (np.abs(approx - true) <= a.rest[:, None] + a.coded[:, None] * b.rest + 1e-6).all()


def test_repeated_query_rows_and_extreme_components(spark):
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [1.0, 0.0]),
        (1, [1.0, 0.1]), (2, [1.0, 0.2]), (3, [1.0, 0.3]),
        (4, [1e300, 4e299]), (5, [1e-200, 5e-201]), (6, [-5e-324, 0.0]), (7, [1.7e308, -1.7e308]),
    ]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>").repartition(3)
    got = sorted((r.rank, r.vec_id, round(r.score, 12)) for r in B.neighbours(df, df.filter("vec_id = 0"), 7).collect())
    cosine = lambda y: round(1 / (1 + y * y) ** 0.5, 12)
    want = [(1, cosine(0.1)), (2, cosine(0.2)), (3, cosine(0.3)), (4, cosine(0.4)), (5, cosine(0.5)), (7, cosine(1.0)), (6, -1.0)]
    assert got == [(i + 1, *w) for i, w in enumerate(want)]
