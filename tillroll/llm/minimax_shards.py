"""Sharding: the smallest largest shard over ordered atomic groups.

Groups of equal texts are atomic and ordered by their SHA-256. A shard is a run
of consecutive groups. The smallest feasible capacity is searched for, each
capacity being checked greedily: from the current cut go to the furthest group
end within reach, as often as there are shards. The cuts are then made there.

All rows stay in Spark and in generated code. Group sizes become running sums
by range partition; a greedy step for a capacity is one ``max`` over the group
ends within one group's size of the reach, which the Parquet statistics of the
sorted sums narrow to a few row groups. Each round tries ``PROBES`` capacities
at once, so the search halves five times per round. The driver sees one number
per probe and step.

A group may hold a third of all rows: its rows are counted and numbered in
``SALTS`` cells, so no task gets all of it.

Defined results: a null text has no bytes and belongs with the empty texts; an
empty table has no shards; repeated rows each get their own slot; extra columns
are ignored. With fewer groups than shards the last shards stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillroll.llm.common import materialize, table, whole_text

SALTS = 64
PROBES = 32
# monotonically_increasing_id(): partition number above 33 bits of row position.
_ROW_BITS = 33


def running_cells(keyed: DataFrame) -> DataFrame:
    """Per (group, salt) what lies before it: ``bytes0``, ``rows0``, and whether it ends its group.

    Written once: the search reads it again and again.
    """
    cells = keyed.groupBy("group", "salt").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    in_order = cells.repartitionByRange("group").sortWithinPartitions("group", "salt")
    frozen = materialize(in_order.withColumn("at", F.monotonically_increasing_id()), "shard-cells")
    numbered = frozen.withColumn("range", F.shiftright("at", _ROW_BITS))
    # One row per range partition.
    totals = numbered.groupBy("range").agg(F.sum("bytes").alias("b"), F.sum("rows").alias("r"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "range",
        F.coalesce(F.sum("b").over(before), F.lit(0)).alias("range_bytes"),
        F.coalesce(F.sum("r").over(before), F.lit(0)).alias("range_rows"),
    )
    inside = Window.partitionBy("range").orderBy("at")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    # A group lies whole in one range, as ranges are cut by group alone.
    summed = numbered.select(
        "*",
        F.sum("bytes").over(upto).alias("b_upto"),
        F.sum("rows").over(upto).alias("r_upto"),
        F.lead("group").over(inside).alias("next"),
    ).join(F.broadcast(starts), "range")
    return materialize(
        summed.select(
            "group",
            "salt",
            (F.col("range_bytes") + F.col("b_upto") - F.col("bytes")).alias("bytes0"),
            (F.col("range_rows") + F.col("r_upto") - F.col("rows")).alias("rows0"),
            (F.col("range_bytes") + F.col("b_upto")).alias("bytes1"),
            F.when(F.col("next").isNull() | (F.col("next") != F.col("group")), True).otherwise(False).alias("ends"),
        ),
        "shard-sums",
    )


def _furthest(ends: DataFrame, reach: list[int], largest: int) -> list[int]:
    """For each value the largest group end that is not beyond it."""
    near = ends.filter(F.col("bytes1").between(min(reach) - largest, max(reach)))
    found = near.agg(*[F.max(F.when(F.col("bytes1") <= t, F.col("bytes1"))) for t in reach]).first()
    return [v or 0 for v in found]


def greedy_cuts(ends: DataFrame, capacities: list[int], shards: int, total: int, largest: int) -> list[list[int]]:
    """For each capacity the ends of its shards, cut as late as possible."""
    at = [0] * len(capacities)
    cuts: list[list[int]] = [[] for _ in capacities]
    for _ in range(shards):
        going = [i for i, a in enumerate(at) if a < total]
        if going:
            for i, a in zip(going, _furthest(ends, [at[i] + capacities[i] for i in going], largest)):
                at[i] = max(a, at[i])
        for i, a in enumerate(at):
            cuts[i].append(a)
    return cuts


def minimax_cuts(cells: DataFrame, shards: int) -> list[int]:
    """The ends, in bytes, of the shards whose largest is smallest; empty for no rows."""
    ends = cells.filter("ends").select("bytes1")
    sizes = cells.groupBy("group").agg((F.max("bytes1") - F.min("bytes0")).alias("size"))
    bounds = sizes.agg(F.sum("size").alias("total"), F.max("size").alias("largest")).first()
    if bounds.total is None:
        return []
    total, largest = bounds.total, bounds.largest
    low = max(-(-total // shards), largest)
    # Greedy leaves less than the largest group unused in a shard, so this one is feasible.
    high = max(low, total // shards + largest)
    best: list[int] | None = None
    while best is None or low < high:
        step = max(1, (high - low) // PROBES)
        probes = sorted({*range(low, high, step), high})
        tried = greedy_cuts(ends, probes, shards, total, largest)
        first = next(i for i, c in enumerate(tried) if c[-1] == total)
        high, best = probes[first], tried[first]
        low = probes[first - 1] + 1 if first else high
    return best


def shard_documents(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``size``, ``text_crc32``, ``shard`` and ``slot``, the place in its shard from 0."""
    whole = whole_text(text)
    keyed = docs.select(
        F.col(key).alias(key),
        (F.octet_length(whole).cast("bigint") + 1).alias("size"),
        F.crc32(whole).alias("text_crc32"),
        F.sha2(whole, 256).alias("group"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(SALTS)).cast("int").alias("salt"),
    )
    cells = running_cells(keyed)
    cuts = minimax_cuts(cells, shards)
    inner = cuts[: shards - 1]

    def shard_of(start: Column) -> Column:
        return sum((F.when(start >= c, 1).otherwise(0) for c in inner), F.lit(0))

    first_rows = cells.groupBy(shard_of(F.col("bytes0")).alias("shard")).agg(F.min("rows0").alias("shard_rows0"))
    placed = cells.select(
        "group", "salt", "rows0", shard_of(F.col("bytes0")).cast("int").alias("shard")
    ).join(F.broadcast(first_rows), "shard")  # at most one row per shard
    in_cell = Window.partitionBy("group", "salt").orderBy(key)
    return (
        keyed.withColumn("nth", F.row_number().over(in_cell) - 1)
        .join(placed, ["group", "salt"])
        .select(
            key,
            "size",
            "text_crc32",
            "shard",
            (F.col("rows0") - F.col("shard_rows0") + F.col("nth")).cast("bigint").alias("slot"),
        )
    )


def op3_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
