"""Line items of a receipt: raw lists, one row per item, typed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions.numbers import plain_notation, sanitize_price, sanitize_quantity
from tillroll.functions.text import clean_items, parse_list


def number_list(text: Column) -> Column:
    """List of price or quantity texts, whether the source wrote strings or numbers."""
    return F.transform(parse_list(text), plain_notation)


def lineitem_raw(wide: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The three lists and the session of each receipt, after the columns of ``keep``."""
    return wide.select(
        *keep,
        clean_items(F.col("ITEMS")).alias("ITEMS"),
        number_list(F.col("PRICE")).alias("PRICE"),
        number_list(F.col("QUANTITY")).alias("QUANTITY"),
        "SESSIONIDS",
    )


def array_lengths(raw: DataFrame, columns: Sequence[str] = ("ITEMS", "PRICE", "QUANTITY")) -> DataFrame:
    return raw.withColumns({f"{c}_LENGTH": F.size(c) for c in columns})


def explode_items(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per list position; shorter lists are padded with NULL.

    The session id exists once per ITEMS entry, so it is NULL at positions past
    them. A position goes only when nothing at all stands there.
    """
    lists = {
        c: F.coalesce(F.col(c), F.array().cast("array<string>"))
        for c in ("ITEMS", "PRICE", "QUANTITY")
    }
    # The item count is taken before the explode, so rows do not drag the list along.
    padded = raw.select(
        *keep,
        *[values.alias(c) for c, values in lists.items()],
        F.size(lists["ITEMS"]).alias("named"),
        "SESSIONIDS",
    )
    zipped = padded.select(
        *keep,
        F.posexplode(F.arrays_zip("ITEMS", "PRICE", "QUANTITY")).alias("pos", "item"),
        "named",
        "SESSIONIDS",
    )
    listed = F.col("pos") < F.col("named")
    flat = zipped.select(
        *keep,
        "item.*",
        F.when(listed, F.col("SESSIONIDS")).alias("SESSIONID"),
        listed.alias("listed"),
    )
    kept = flat.filter(
        F.col("listed")
        | F.col("ITEMS").isNotNull()
        | F.col("PRICE").isNotNull()
        | F.col("QUANTITY").isNotNull()
    )
    return kept.drop("listed")


def lineitem_final(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The ``lineitem`` table: unreadable prices and quantities are -1."""
    return explode_items(raw, keep).select(
        *keep,
        "ITEMS",
        sanitize_price(F.col("PRICE")).alias("PRICE"),
        sanitize_quantity(F.col("QUANTITY")).alias("QUANTITY"),
        "SESSIONID",
    )
