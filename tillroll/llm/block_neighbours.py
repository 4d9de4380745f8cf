"""Nearest neighbours by a block matrix join with int8 products.

Queries and candidates are dealt into blocks; each pair of a query block and a
candidate block is one tile. A tile multiplies int8 codes of the unit vectors
and knows for each product how far it can be from the true cosine: with codes
``s*q`` and rests ``e = u - s*q`` of two unit vectors, the error is at most
``|e1| + |s1*q1| * |e2|``. A candidate survives if its largest possible cosine
reaches the k-th best of the smallest possible ones. Only survivors are
computed in double precision; each tile keeps k per query, and the tiles' heaps
are merged by Spark's top-k per group, which keeps k rows per query in every
map task.

Results are exact, not approximate: no candidate is dropped by a guess.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do rows without an id; rows that repeat a query's
id count as its own; a query id on several rows is one query, of the smallest
vector if they differ; finite components of any size are exact to a double's
digits; vectors are compared only with vectors of their length; equal scores go to the
smaller id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillroll.llm.common import table

# Rows of a block: a tile holds both blocks and, by strips of queries, their products.
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 4096
STRIP = 256

FOUND = "query_id BIGINT, vec_id BIGINT, score DOUBLE"
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id and vector of the rows that take part."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    ok = F.col(key).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    return vectors.filter(ok).select(F.col(key).alias("id"), v.cast("array<double>").alias("v"))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The inner product of each pair of rows, added component by component: the same digits on every machine."""
    total = np.zeros(len(left))
    for j in range(left.shape[1]):
        total += left[:, j] * right[:, j]
    return total


class Codes:
    """int8 codes of vectors, what they leave out, and the vectors themselves."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        # By a power of two, which changes no digit, so that no square is beyond a double.
        _, exponent = np.frexp(np.abs(vectors).max(1))
        vectors = np.ldexp(vectors, -exponent[:, None])
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt(products(vectors, vectors))
        unit = vectors / self.norms[:, None]
        scale = np.abs(unit).max(1) / 127
        # int8 values; as float32 their products are exact sums, and multiply fast.
        self.codes = np.rint(unit / scale[:, None]).astype(np.int8)
        coded = self.codes * scale[:, None]
        rest = unit - coded
        self.scale = scale
        self.rest = np.sqrt(np.einsum("ij,ij->i", rest, rest))
        self.coded = np.sqrt(np.einsum("ij,ij->i", coded, coded))


def tile(queries: Codes, candidates: Codes, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query id, candidate id and cosine of at least the k best candidates of each query."""
    out = []
    right = candidates.codes.astype(np.float32).T
    dims = right.shape[0]
    slack = 1e-6 * max(1, dims / 64)  # rounding of the scaled products
    for a in range(0, len(queries.ids), STRIP):
        s = slice(a, a + STRIP)
        # Exact up to 1040 dimensions, beyond that off by less than the slack's share.
        product = (queries.codes[s].astype(np.float32) @ right) * queries.scale[s, None] * candidates.scale
        error = queries.rest[s, None] + queries.coded[s, None] * candidates.rest + slack
        own = queries.ids[s, None] == candidates.ids
        low = np.where(own, -np.inf, product - error)
        most = min(k, low.shape[1])
        bar = np.partition(low, low.shape[1] - most, axis=1)[:, low.shape[1] - most]
        q, c = np.nonzero((product + error >= bar[:, None]) & ~own)
        q += a
        for b in range(0, len(q), 65_536):
            qb, cb = q[b : b + 65_536], c[b : b + 65_536]
            dot = products(queries.vectors[qb], candidates.vectors[cb])
            score = dot / (queries.norms[qb] * candidates.norms[cb])
            out.append((queries.ids[qb], candidates.ids[cb], score))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    ids, vecs, scores = (np.concatenate(x) for x in zip(*out))
    # The heap of each query: highest score, then smallest id.
    order = np.lexsort((vecs, -scores, ids))
    ids, vecs, scores = ids[order], vecs[order], scores[order]
    first = np.r_[True, ids[1:] != ids[:-1]] if len(ids) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))
    keep = np.arange(len(ids)) - start < k
    return ids[keep], vecs[keep], scores[keep]


def _by_length(group: pa.Table) -> dict[int, Codes]:
    lists = group.column("v").combine_chunks()
    ids = group.column("id").to_numpy()
    lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    flat = lists.flatten().to_numpy()
    starts = np.r_[0, np.cumsum(lengths)]
    out = {}
    for n in np.unique(lengths):
        rows = np.nonzero(lengths == n)[0]
        at = starts[rows][:, None] + np.arange(n)
        out[int(n)] = Codes(ids[rows], flat[at].astype(np.float64))
    return out


def _tiles(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        queries, candidates = _by_length(left), _by_length(right)
        parts = [tile(queries[n], candidates[n], k) for n in queries.keys() & candidates.keys()]
        columns = [np.concatenate(x) for x in zip(*parts)] if parts else [[], [], []]
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _FOUND)], schema=_FOUND)

    return run


def neighbours(
    vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors of largest cosine for each query id."""
    candidates = usable(vectors, key, vector)
    wanted = usable(queries, key, vector).groupBy("id").agg(F.min("v").alias("v"))
    # Two counts decide the grid, so that a tile has the same size whatever the input.
    n_candidates, n_queries = candidates.count(), wanted.count()
    rows = max(1, -(-n_queries // QUERY_BLOCK))
    columns = max(1, -(-n_candidates // CANDIDATE_BLOCK))

    def dealt(df: DataFrame, into: str, blocks: int, across: str, others: int) -> DataFrame:
        # Row positions deal evenly even where one id or vector fills a third of the table.
        mine = F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int")
        return df.withColumn(into, mine).withColumn(across, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    left = dealt(wanted, "tile_row", rows, "tile_column", columns).groupBy("tile_row", "tile_column")
    right = dealt(candidates, "tile_column", columns, "tile_row", rows).groupBy("tile_row", "tile_column")
    found = left.cogroup(right).applyInArrow(_tiles(k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op8_block_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)
