"""Dense surrogate keys 1..n without pulling the data into one partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillroll.storage import materialize

# monotonically_increasing_id(): partition number above 33 bits of row position.
_ROW_BITS = 33


def surrogate_key(df: DataFrame, order: Sequence[str], into: str) -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` for any size.

    The rows are range-partitioned and sorted once, numbered inside their
    partition, and frozen in the shared folder, because a recomputed partition
    must keep its numbers. Each partition then starts where the ones before it
    end. Only the partition counts, one row per partition, meet in one task.
    ``order`` has to be unique for the numbers to be repeatable.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    frozen = materialize(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "keyed")
    numbered = frozen.withColumn("_range", F.shiftright("_at", _ROW_BITS))

    counts = numbered.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    position = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    # One row per range partition: bounded by the partition count, not the data.
    return numbered.join(F.broadcast(starts), "_range").select(
        (F.col("_start") + position + 1).alias(into), *df.columns
    )


_MARKS = "first BIGINT, last BIGINT, batch BIGINT"


def _marks(spark: SparkSession, out: str) -> DataFrame:
    try:
        return spark.read.schema(_MARKS).parquet(f"{out}/marks")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MARKS)


def number_batch(df: DataFrame, order: Sequence[str], into: str, out: str, batch: int) -> DataFrame:
    """Number a batch from where the batches before it ended: one dense range over all of them.

    The numbered rows and a mark with the batch's first and last number are kept
    below ``out``. A batch that has its mark is returned as it was numbered, whatever
    ``df`` holds now: nothing is ever renumbered. One that failed before its mark was
    written is numbered again. Batches are numbered one at a time, in the order of
    their ids, and an id below the last one that has no mark is refused.
    """
    spark = df.sparkSession
    rows = f"{out}/rows/batch={batch}"
    known = _marks(spark, out).agg(
        F.max("last").alias("last"), F.max("batch").alias("batch"), F.count_if(F.col("batch") == batch).alias("done")
    ).first()
    if not known.done:
        if known.batch is not None and known.batch > batch:
            raise ValueError(f"batch {batch} comes after batch {known.batch} was numbered")
        before = known.last or 0
        numbered = surrogate_key(df, order, into).withColumn(into, (F.col(into) + before).cast("bigint"))
        numbered.write.mode("overwrite").parquet(rows)
        n = spark.read.parquet(rows).count()
        mark = spark.range(1).select(F.lit(before + 1).cast("bigint").alias("first"), F.lit(before + n).cast("bigint").alias("last"))
        mark.write.mode("overwrite").parquet(f"{out}/marks/batch={batch}")
    return spark.read.parquet(rows)
