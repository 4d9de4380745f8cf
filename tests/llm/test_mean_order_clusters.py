import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import connect, difference, duck_result, spark_result
from tillroll.llm import mean_order_clusters as mc

SCHEMA = "vec_id BIGINT, embedding ARRAY<DOUBLE>"


def plain(rows, k, rounds, width):
    """Python integers, every distance computed."""
    kept = [(key, [int(np.floor(64 * x)) for x in v]) for key, v in rows if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    mark = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=mark)[:k]]

    def assign():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids)))
        return out

    for _ in range(rounds):
        at = assign()
        for i in range(len(centroids)):
            own = [v for (_, v), (_, j) in zip(kept, at) if j == i]
            if own:
                centroids[i] = [sum(c) // len(own) for c in zip(*own)]
    at = assign()
    total = sum(d for d, _ in at)
    inertia = [sum(d for d, j in at if j == i) for i in range(len(centroids))]
    return sorted(((k or -1), j, d, inertia[j], total, tuple(centroids[j])) for (k, _), (d, j) in zip(kept, at))


def found(df):
    return sorted(((r[0] or -1), *r[1:5], tuple(r.centroid)) for r in df.collect())


def test_query_equals_sql(spark):
    duck = connect("/root/testdata/sf0.001")
    got = spark_result(mc.op13_mean_order_clusters(spark, "/root/testdata/sf0.001"))
    assert difference(got, duck_result(duck, mc.ORACLE_SQL)) is None


@pytest.mark.parametrize("seed", range(3))
def test_small_integers_with_many_ties_equal_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.integers(-3, 4, 3) / 64).tolist()) for i in range(150)]
    rows += rows[:20]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = found(mc.clustered(df, clusters=7, rounds=3, components=3))
    assert got == plain(rows, 7, 3, 3)


def test_odd_rows_clashing_columns_and_few_vectors(spark):
    rows = [
        (1, None),
        (2, []),
        (3, [1.0, None]),
        (4, [1.0, float("nan")]),
        (5, [float("inf"), 0.0]),
        (6, [1.0]),
        (7, [0.5, -0.5]),
        (7, [0.5, -0.5]),
        (7, [100.0, -0.26]),
        (None, [-3.0, 2.0]),
        (8, [2.0**21 - 1, -(2.0**20)]),
    ]
    df = spark.createDataFrame([(*r, 1, "x", 5) for r in rows], SCHEMA + ", cluster INT, vector STRING, distance INT")
    assert found(mc.clustered(df, clusters=4, components=2)) == plain(rows, 4, 3, 2)
    assert found(mc.clustered(df, clusters=40, components=2)) == plain(rows, 40, 3, 2)
    beyond = spark.createDataFrame([(1, [1e300, 0.0]), (2, [1.0, 1.0])], SCHEMA)
    assert [r.vec_id for r in mc.clustered(beyond, clusters=4, components=2).collect()] == [2]


def test_empty_table(spark):
    assert mc.clustered(spark.createDataFrame([], SCHEMA)).collect() == []


def test_search_is_exact_and_rejects():
    rng = np.random.default_rng(3)
    for scale in (3, 1000, 1 << 26):
        centroids, vectors = rng.integers(-scale, scale, (60, 8)), rng.integers(-scale, scale, (500, 8))
        vectors[:60] = centroids
        number, distance, computed = mc.Search(centroids).nearest(vectors)
        exact = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert (number == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
        assert computed < 0.9 * exact.size
    equal = np.zeros((5, 4), np.int64)
    assert mc.Search(equal).nearest(np.ones((3, 4), np.int64))[0].tolist() == [0, 0, 0]


def test_one_row_per_task_and_cluster(spark):
    rows = spark.range(5000).select(F.col("id").alias("vec_id"), F.array(*[F.lit(0.25)] * 4).alias("embedding")).coalesce(3)
    vectors = mc.scaled_vectors(rows, "vec_id", "embedding", 4, 64)
    sent = vectors.select("vector").mapInArrow(mc._add_up(np.zeros((2, 4), np.int64)), "cluster INT, n BIGINT, sums ARRAY<BIGINT>")
    assert sent.count() <= 3
