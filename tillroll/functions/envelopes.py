"""JSON envelopes: build, extend, read."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillroll import schemas
from tillroll.functions.binding import let

_KEEP_NULLS = {"ignoreNullFields": "false"}
_PRETTY = {"pretty": "true", **_KEEP_NULLS}


def _blank_when_missing(values: Column) -> Column:
    # Numbers beside "" for a missing one: mixed JSON types need VARIANT.
    blank = F.lit("").cast("variant")
    return F.transform(values, lambda c: F.coalesce(c.cast("variant"), blank))


def _json(value: Column) -> Column:
    return F.coalesce(F.to_json(value, _KEEP_NULLS), F.lit("null"))


def _numbers_json(values: Column) -> Column:
    """A list of doubles as JSON text, ``""`` for a missing one, what is no finite number in quotes."""
    text = F.array_join(values.cast("array<string>"), ",", '""')
    quoted = F.regexp_replace(text, "(-?Infinity|NaN)", '"$1"')
    finite = ~(text.contains("N") | text.contains("I"))
    return F.coalesce(F.concat(F.lit("["), F.when(finite, text).otherwise(quoted), F.lit("]")), F.lit("null"))


def _object_json(fields: dict[str, Column]) -> Column:
    """The JSON object of fields whose values are JSON text, on one line."""
    parts = [F.concat(F.lit(f'"{name}":'), value) for name, value in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def kv_bag_json(bag: Column, pretty: bool = True) -> Column:
    if not pretty:
        texts = {name: _json(bag[name]) for name in ("Type", "Key", "Value")}
        return _object_json({**texts, **{name: _numbers_json(bag[name]) for name in ("KeyConfidence", "ValueConfidence")}})
    return F.to_json(
        F.struct(
            bag["Type"].alias("Type"),
            bag["Key"].alias("Key"),
            bag["Value"].alias("Value"),
            _blank_when_missing(bag["KeyConfidence"]).alias("KeyConfidence"),
            _blank_when_missing(bag["ValueConfidence"]).alias("ValueConfidence"),
        ),
        _PRETTY,
    )


def lineitem_bag_json(bag: Column, pretty: bool = True) -> Column:
    if not pretty:
        lists = {name: _json(bag[name]) for name in ("items", "price", "quantity")}
        confidences = {f"{name}_confidence": _numbers_json(bag[f"{name}_confidence"]) for name in lists}
        return _object_json({**lists, **confidences})
    return F.to_json(
        F.struct(
            bag["items"].alias("items"),
            bag["price"].alias("price"),
            bag["quantity"].alias("quantity"),
            _blank_when_missing(bag["items_confidence"]).alias("items_confidence"),
            _blank_when_missing(bag["price_confidence"]).alias("price_confidence"),
            _blank_when_missing(bag["quantity_confidence"]).alias("quantity_confidence"),
        ),
        _PRETTY,
    )


def to_envelope_json(record: Column, pretty: bool = True) -> Column:
    return F.to_json(record, _PRETTY if pretty else _KEEP_NULLS)


def canonical_date_type(types: Column) -> Column:
    """The first Type that contains DATE, in any case, becomes ``DATE``."""

    def first_hit(given):
        return F.array_position(
            F.transform(given, lambda t: F.upper(t).contains("DATE")), F.lit(True)
        )

    def renamed(given, first):
        at = first.cast("int")
        named = F.concat(F.slice(given, 1, at - 1), F.array(F.lit("DATE")), F.slice(given, at + 1, F.size(given)))
        return F.when(at > 0, named).otherwise(given)

    # Both are bound: the list is built once, the position found once per row.
    return let(types, lambda given: let(first_hit(given), lambda first: renamed(given, first)))


def append_names(names: Column) -> Column:
    return F.concat(names, F.array(*[F.lit(n) for n in schemas.APPENDED_ENTRIES]))


def append_values(values: Column, items: Column, ids: dict[str, Column], total: Column) -> Column:
    """``values`` and ``items`` hold VARIANT, so lists stay lists in the JSON."""
    extra = [
        items["items"],
        items["price"],
        items["quantity"],
        ids["tenant_id"].cast("variant"),
        ids["session_id"].cast("variant"),
        ids["store_id"].cast("variant"),
        total.cast("variant"),
    ]
    return F.concat(values, F.array(*extra))


def read_envelope(raw: Column) -> Column:
    """A JSON object as a map; NULL for anything else, text after the object included.

    Read as a list of one object: what follows the object then breaks the list,
    or makes it longer.
    """
    objects = F.from_json(F.concat(F.lit("["), raw, F.lit("]")), f"ARRAY<{schemas.ENVELOPE_MAP}>")
    return let(objects, lambda o: F.when(F.size(o) == 1, F.get(o, F.lit(0))))


def entry(envelope_map: Column, name: str) -> Column:
    """The value of a key; of a repeated key the last one."""
    at = F.array_position(F.reverse(F.map_keys(envelope_map)), F.lit(name)).cast("int") - 1
    return F.get(F.reverse(F.map_values(envelope_map)), at)


def total_amount(envelope_map: Column) -> Column:
    """Readers look for ``total_amount``, writers say ``Total_Amount``: take either."""
    found = F.coalesce(entry(envelope_map, "total_amount"), entry(envelope_map, "Total_Amount"))
    return found.try_cast("double")


def total_amount_from_text(raw: Column) -> Column:
    found = F.coalesce(
        F.get_json_object(raw, "$.total_amount"), F.get_json_object(raw, "$.Total_Amount")
    )
    return found.try_cast("double")
