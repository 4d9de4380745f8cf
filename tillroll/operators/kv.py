"""Key/value pairs of a receipt: parse, long form, pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillroll import schemas
from tillroll.functions.binding import settled, without_gaps
from tillroll.functions.text import receipt_labels


def parse_kv(df: DataFrame, column: str = "kv_data", into: str = "kv") -> DataFrame:
    """JSON text to a struct of three lists; all NULL where the text is malformed."""
    return df.withColumn(into, F.from_json(F.col(column), f"STRUCT<{schemas.KV_BAG}>"))


def with_labels(df: DataFrame, kv: str = "kv", into: str = "labels") -> DataFrame:
    return df.withColumn(into, receipt_labels(F.col(f"{kv}.Type"), F.col(f"{kv}.Key")))


def kv_long(df: DataFrame, keys: Sequence[str], kv: str = "kv") -> DataFrame:
    """One row per labelled pair: keys, ``pos``, ``label``, ``value``.

    The position survives so that "first" stays defined after a shuffle. Pairs
    past the shorter of Type and Key have no label and are left out.
    """
    labelled = with_labels(df, kv, "_labels")
    pairs = F.arrays_zip(F.col("_labels").alias("label"), F.col(f"{kv}.Value").alias("value"))
    return (
        labelled.select(*keys, F.posexplode(pairs).alias("pos", "pair"))
        .select(*keys, "pos", F.col("pair.label").alias("label"), F.col("pair.value").alias("value"))
        .filter(F.col("label").isNotNull())
    )


def kv_pivot(long: DataFrame, keys: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Long pairs to one row per document and one column per label.

    The lowest position with a value wins; a document whose values are all NULL
    keeps its row. Every output is a mergeable aggregate, so map tasks reduce a
    hot document to one row before the shuffle.
    """

    def pick(name):
        live = (F.col("label") == name) & F.col("value").isNotNull()
        return F.min_by("value", F.when(live, F.col("pos"))).alias(name)

    return long.groupBy(*keys).agg(*[pick(name) for name in labels])


def kv_pivot_dynamic(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As ``kv_pivot`` with the labels found in the data, as one map ``labels`` per document.

    OCR labels are an open set, so they are keys of a map and not columns: any
    number of them, one shape, no job to find them. The pairs are first reduced
    to one per document and label.
    """
    live = F.when(F.col("value").isNotNull(), F.col("pos"))
    first = long.groupBy(*keys, "label").agg(F.min_by("value", live).alias("value"))
    entry = F.when(F.col("value").isNotNull(), F.struct("label", "value"))
    # collect_list leaves out NULLs; what it holds is one document's labels.
    return first.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("labels"))


def kv_join(wide: DataFrame, documents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pivoted rows beside the document they came from.

    Documents without any pair vanish. Both sides hold one row per document, so
    no key is hot. The standard plan does without this join: see ``kv_wide``.
    """
    return wide.join(documents, list(keys), "inner")


def kv_wide(
    df: DataFrame,
    keep: Sequence[str] = (),
    labels: Sequence[str] = tuple(schemas.RECEIPT_LABELS),
    column: str = "kv_data",
    readable_only: bool = False,
) -> DataFrame:
    """Row-local pivot: one output row per document, no shuffle at all.

    A bag that is no JSON or lacks a list gives a row of NULLs, or none with
    ``readable_only``.

    All pairs of a document sit in one row, so the explode, group and pivot of
    the long form reduce to a position lookup per label. A label nobody wrote
    gives a NULL column. Equal to ``kv_pivot(kv_long(..))`` for documents that
    have at least one labelled pair, with a value or without; a document without
    any pair has no rows in the long form and keeps its row here.
    """
    bag = F.from_json(F.col(column), f"STRUCT<{schemas.KV_BAG}>")
    return kv_wide_from_bag(df, bag, keep, labels, readable_only)


def kv_wide_from_bag(
    df: DataFrame,
    bag: Column,
    keep: Sequence[str] = (),
    labels: Sequence[str] = tuple(schemas.RECEIPT_LABELS),
    readable_only: bool = False,
) -> DataFrame:
    """``kv_wide`` for a bag that is a struct of Type, Key and Value lists already."""
    opened = settled(df, {"_kv": bag})
    if readable_only:
        lists = [F.col(f"_kv.{name}").isNotNull() for name in ("Type", "Key", "Value")]
        opened = opened.filter(lists[0] & lists[1] & lists[2])
    names = receipt_labels(F.col("_kv.Type"), F.col("_kv.Key"))
    named = opened.select(*keep, names.alias("_names"), F.col("_kv.Value").alias("_values"))
    # A pair without a value must not win over a later one that has a value.
    all_live = without_gaps(F.col("_values"), F.lit("\0")) & (F.size("_values") >= F.size("_names"))
    valued = F.zip_with("_names", "_values", lambda name, v: F.when(v.isNotNull(), name))
    located = named.select(*keep, F.when(all_live, F.col("_names")).otherwise(valued).alias("_labels"), "_values")

    def pick(name):
        at = F.array_position("_labels", F.lit(name)).cast("int") - 1
        return F.get("_values", at).alias(name)

    return located.select(*keep, *[pick(name) for name in labels])


def mobile_fix(df: DataFrame) -> DataFrame:
    """Where MOBILE has ten characters, take the first column named ``mobile…``/``MOBILE…``.

    Opt-in: the standard receipt plan does not use it.
    """
    candidates = [c for c in df.columns if c.startswith(("mobile", "MOBILE"))]
    if not candidates or "MOBILE" not in df.columns:
        return df
    fixed = F.when(F.length("MOBILE") == 10, F.col(f"`{candidates[0]}`")).otherwise(F.col("MOBILE"))
    return df.withColumn("MOBILE", fixed)


def pack_array(df: DataFrame, columns: Sequence[str], into: str) -> DataFrame:
    return df.withColumn(into, F.array(*columns))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop by name, in any case (under the session's case-insensitive resolution)."""
    return df.drop(*names)
