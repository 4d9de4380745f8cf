"""Centroid clustering with an equal-average equal-variance search.

The centroids are sorted by the mean of their components. A vector starts at the
centroid whose mean is nearest to its own and scans outward, always taking the
nearer of the two next means. With ``d`` components, sums ``S`` and deviation
norms ``V`` (the length of a vector minus its mean)

    distance**2  >=  (S_x - S_c)**2 / d  +  (V_x - V_c)**2

so the scan of a vector ends once the first term alone is beyond its best
distance, and a centroid is skipped where both together are. Bounds are taken
in floating point with a margin and reject only what is strictly farther; what
remains is compared by exact integer distances, ties going to the smaller
number. The search is therefore exact.

Each round is one pass: a task adds up its vectors by cluster and sends one row
per cluster, so a cluster that holds a third of all vectors costs no more than
another. The driver holds the ``k`` centroids, a parameter, and nothing that
grows with the data.

Defined results: a vector takes part if it has exactly ``d`` components, none of
them null or non-finite, and if its integers lie within ``LIMIT``, beyond which
no long holds a squared distance. Rows that repeat an id each take part; of equal
hashes the smaller vector starts first; a null id hashes as an empty one and is
returned as null. With fewer vectors than centroids there are fewer centroids.
An empty centroid stays where it is. Where a sum of distances exceeds a long it
is null. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm.common import materialize, table

CLUSTERS = 16
ROUNDS = 3
COMPONENTS = 64
SCALE = 64
LIMIT = 1 << 27
# Vectors of a task that are compared at once.
_AT_ONCE = 1 << 14
_MARGIN = 1 - 1e-9


def scaled_vectors(rows: DataFrame, key: str, vector: str, components: int, scale: int) -> DataFrame:
    """``key`` and ``vector``, an array of longs, of the rows that take part."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double") * scale) < LIMIT))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    return rows.filter((F.size(x) == components) & finite).select(F.col(key).alias("key"), whole.alias("vector"))


def first_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of their ids."""
    mark = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    first = vectors.select(mark.alias("mark"), "vector").orderBy("mark", "vector").limit(k).collect()
    return np.array([r.vector for r in first], np.int64)


class Search:
    """Nearest centroids of integer vectors."""

    def __init__(self, centroids: np.ndarray):
        sums, norms = self._moments(centroids)
        self.order = np.argsort(sums, kind="stable")
        self.centroids = centroids[self.order]
        self.sums, self.norms = sums[self.order], norms[self.order]

    @staticmethod
    def _moments(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = vectors.sum(axis=1)
        centered = vectors - sums[:, None] / max(vectors.shape[1], 1)
        return sums, np.sqrt((centered * centered).sum(axis=1))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid, squared distance, and how many distances were computed."""
        n, k = len(vectors), len(self.order)
        sums, norms = self._moments(vectors)
        width = vectors.shape[1]
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, k, np.int64)
        going, computed = np.arange(n), 0
        for _ in range(k):
            low, high = left[going], right[going]
            down = np.where(low >= 0, np.abs(sums[going] - self.sums[np.maximum(low, 0)]), np.inf)
            up = np.where(high < k, np.abs(self.sums[np.minimum(high, k - 1)] - sums[going]), np.inf)
            take = np.where(down <= up, low, high)
            by_mean = np.minimum(down, up) ** 2 / width
            # All further means are farther still.
            on = by_mean * _MARGIN <= best[going]
            going, take, by_mean, lower = going[on], take[on], by_mean[on], (down <= up)[on]
            if not len(going):
                break
            left[going[lower]] -= 1
            right[going[~lower]] += 1
            by_both = by_mean + (norms[going] - self.norms[take]) ** 2
            near = by_both * _MARGIN - 1e-6 <= best[going]
            who, which = going[near], take[near]
            gap = vectors[who] - self.centroids[which]
            distance = np.einsum("ij,ij->i", gap, gap)
            computed += len(who)
            named = self.order[which]
            closer = (distance < best[who]) | ((distance == best[who]) & (named < number[who]))
            best[who[closer]], number[who[closer]] = distance[closer], named[closer]
        return number, best, computed


def _vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _add_up(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            vectors = _vectors(batch, centroids.shape[1])
            for at in range(0, len(vectors), _AT_ONCE):
                part = vectors[at : at + _AT_ONCE]
                number, _, _ = search.nearest(part)
                counts += np.bincount(number, minlength=len(counts))
                np.add.at(sums, number, part)
        full = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int32)), pa.array(counts[full]), pa.array(sums[full].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    return run


def _assign(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for batch in batches:
            vectors = _vectors(batch, centroids.shape[1])
            parts = [search.nearest(vectors[at : at + _AT_ONCE])[:2] for at in range(0, len(vectors), _AT_ONCE)]
            number, distance = (np.concatenate(x) if parts else np.zeros(0, np.int64) for x in (list(zip(*parts)) or [[], []]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(number.astype(np.int32)), pa.array(distance)],
                names=["key", "cluster", "distance"],
            )

    return run


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of the means of their vectors."""
    width = centroids.shape[1]
    added = vectors.select("vector").mapInArrow(_add_up(centroids), "cluster INT, n BIGINT, sums ARRAY<BIGINT>")
    totals = added.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    out = centroids.copy()
    for row in totals.collect():  # at most one row per centroid
        out[row.cluster] = [row[f"s{i}"] // row.n for i in range(width)]
    return out


def clustered(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    work: str | None = None,
) -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia, centroid (array) of every vector that takes part."""
    spark = rows.sparkSession
    vectors = scaled_vectors(rows, key, vector, components, scale)
    centroids = first_centroids(vectors, clusters)
    kind = vectors.schema["key"].dataType.simpleString()
    if not len(centroids):
        schema = f"key {kind}, cluster INT, distance BIGINT, cluster_inertia BIGINT, inertia BIGINT, centroid ARRAY<BIGINT>"
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    assigned = materialize(
        vectors.mapInArrow(_assign(centroids), f"key {kind}, cluster INT, distance BIGINT"), "assigned", work
    )
    by_cluster = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()
    total = sum(r.sum for r in by_cluster)

    def as_long(x) -> int | None:
        return int(x) if x < 1 << 63 else None

    # At most one row per centroid.
    facts = spark.createDataFrame(
        [(r.cluster, as_long(r.sum), as_long(total), centroids[r.cluster].tolist()) for r in by_cluster],
        "cluster INT, cluster_inertia BIGINT, inertia BIGINT, centroid ARRAY<BIGINT>",
    )
    return assigned.join(F.broadcast(facts), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def op13_mean_order_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clustered(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.withColumn("centroid_sha256", digest).drop("centroid")


def _oracle(rounds: int = ROUNDS) -> str:
    near = """
{name} AS MATERIALIZED (
  SELECT r, vec_id, v, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
  FROM (
    SELECT k.r, k.vec_id, k.v, c.cluster,
           CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
    FROM kept k CROSS JOIN {centroids} c
  ) GROUP BY r, vec_id, v
)"""
    move = """
{name} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v
  FROM {centroids} c LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v
    FROM (SELECT cluster, i, CAST(sum(v[i]) AS HUGEINT) AS s, count(*) AS n FROM {near}, range(1, 65) t(i) GROUP BY cluster, i)
    GROUP BY cluster
  ) m USING (cluster)
)"""
    parts = [
        f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS INTEGER) AS cluster, v FROM kept
  QUALIFY cluster < {CLUSTERS}
)""",
    ]
    for i in range(rounds):
        parts.append(near.format(name=f"n{i}", centroids=f"c{i}"))
        parts.append(move.format(name=f"c{i + 1}", centroids=f"c{i}", near=f"n{i}"))
    parts.append(near.format(name="last", centroids=f"c{rounds}"))
    return f"""WITH {','.join(parts)}
SELECT vec_id, cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM last JOIN c{rounds} c USING (cluster)"""


ORACLE_SQL = _oracle()
