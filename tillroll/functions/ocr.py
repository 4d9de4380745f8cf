"""From OCR fields to columnar bags, inside one row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillroll.functions.binding import filled, let, without_gaps
from tillroll.functions.numbers import money


# A text and a price that hardly come, to look for.
_NO_TEXT = "\0"
_NO_PRICE = -1e-300


def _texts(fields: Column, part: str) -> Column:
    return filled(fields[part]["Text"], "", _NO_TEXT)


def _confidences(fields: Column, part: str) -> Column:
    return fields[part]["Confidence"]


def kv_bag(fields: Column) -> Column:
    """Five parallel arrays from the summary fields; missing text is ``""``."""
    return F.struct(
        _texts(fields, "Type").alias("Type"),
        _texts(fields, "LabelDetection").alias("Key"),
        _texts(fields, "ValueDetection").alias("Value"),
        _confidences(fields, "LabelDetection").alias("KeyConfidence"),
        _confidences(fields, "ValueDetection").alias("ValueConfidence"),
    )


def _picked(groups: Column) -> Column:
    """Detections of every line item; of fields of one type the last, as a later field overrides an earlier one."""
    lists = groups["LineItems"]
    # A list of lists is NULL as a whole when one of them is missing.
    items = F.coalesce(F.flatten(lists), F.flatten(F.filter(lists, lambda x: x.isNotNull())))

    def turned(item: Column) -> Column:
        fields = item["LineItemExpenseFields"]
        return F.struct(F.reverse(fields["Type"]["Text"]).alias("types"), F.reverse(fields["ValueDetection"]).alias("values"))

    def last(item: Column, name: str) -> Column:
        return F.get(item["values"], F.array_position(item["types"], F.lit(name)).cast("int") - 1)

    return F.transform(
        F.transform(items, turned),
        lambda item: F.struct(
            last(item, "ITEM").alias("item"),
            last(item, "PRICE").alias("price"),
            last(item, "QUANTITY").alias("quantity"),
        ),
    )


def lineitem_bag(groups: Column) -> Column:
    """Six parallel arrays, one entry per line item, plus ``bad_price``.

    Missing text is ``""`` and a missing or unreadable price 0.0; ``bad_price``
    tells that some price text was present but not a number. A missing or zero
    confidence is NULL.
    """

    def confidence(items, name):
        given, zero = items[name]["Confidence"], F.lit(0.0)
        return F.when(F.array_contains(given, zero), F.transform(given, lambda c: F.nullif(c, zero))).otherwise(given)

    def unreadable(price):
        return F.coalesce(price != "", F.lit(False)) & money(price).isNull()

    def bag(items, prices):
        some_bad = F.exists(items["price"]["Text"], unreadable)
        return F.struct(
            _texts(items, "item").alias("items"),
            filled(prices, 0.0, _NO_PRICE).alias("price"),
            _texts(items, "quantity").alias("quantity"),
            confidence(items, "item").alias("items_confidence"),
            confidence(items, "price").alias("price_confidence"),
            confidence(items, "quantity").alias("quantity_confidence"),
            F.when(without_gaps(prices, F.lit(_NO_PRICE)), F.lit(False)).otherwise(some_bad).alias("bad_price"),
        )

    return let(
        _picked(groups), lambda items: let(F.transform(items["price"]["Text"], money), lambda prices: bag(items, prices))
    )


def average_hash(pixels: Column) -> Column:
    """One bit per grey value, set where it lies above the mean; no bits for no pixels.

    NULL if a pixel is missing: a damaged page has no hash and repeats nothing.
    """

    def bits(px):
        mean = F.aggregate(px, F.lit(0.0), lambda s, v: s + v, lambda s: F.try_divide(s, F.size(px)))
        joined = let(
            mean,
            lambda m: F.array_join(
                F.transform(px, lambda v: F.when(v > m, "1").otherwise("0")), ""
            ),
        )
        return F.when(~F.exists(px, lambda v: v.isNull()), joined)

    return let(pixels, bits)
