"""Merged multi-page documents as JSON, whatever their length.

A document's JSON is written as lines that follow each other over tasks and
files: its opening, for every list a head, one line per element and a foot, and
its end. All lines carry their place, (document, section, list, part, page,
doc_no, pos), and one range sort by that place puts them in order, so a document
with millions of pages spreads over as many tasks as it needs and no row or task
holds it. Read in order of their names, the files are the documents one after the
other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.plans.receipts import _ITEM_BAGS, _KV_BAGS
from tillroll.storage import materialize

# Names of the sections of a combined document.
SUMMARY, ITEMS, TOTAL = "SummaryData", "LineItemsData", "TotalAmount"
_SECTIONS = [(SUMMARY, _KV_BAGS), (ITEMS, _ITEM_BAGS)]
PLACE = ["section", "list", "part", "page", "doc_no", "pos"]
_HEAD, _ELEMENT, _FOOT = 0, 1, 2


def _json(value: Column) -> Column:
    """A value as JSON; a missing one is an empty text."""
    listed = F.to_json(F.array(value))
    return F.when(value.isNull(), '""').otherwise(F.substring(listed, F.lit(2), F.length(listed) - 2))


def _frame_lines(totals: DataFrame, doc: str) -> DataFrame:
    """What stands around the elements, the same for every document but its total."""
    lines = []
    for section, (name, bags) in enumerate(_SECTIONS):
        for i, bag in enumerate(bags):
            opening = ("{" if section == 0 and i == 0 else "") + (f'"{name}": {{' if i == 0 else "")
            lines.append((section, i, _HEAD, F.lit(f'{opening}"{bag}": [')))
            lines.append((section, i, _FOOT, F.lit("]," if i < len(bags) - 1 else "]},")))
    # Half-up cents, as the total is rounded.
    total = F.coalesce(F.col("total_amount").cast("decimal(28,2)").cast("string"), F.lit("0.00"))
    lines.append((len(_SECTIONS), 0, _HEAD, F.concat(F.lit(f'"{TOTAL}": '), total, F.lit("}"))))
    structs = [
        F.struct(*[F.lit(v).alias(n) for v, n in zip(place, PLACE)], line.alias("line")) for *place, line in lines
    ]
    nowhere = [F.lit(0).cast("bigint").alias("page"), F.lit(0).alias("doc_no"), F.lit(0).alias("pos")]
    return totals.select(doc, F.explode(F.array(*structs)).alias("l"), "total_amount").select(
        doc, *[F.col(f"l.{n}").alias(n) for n in PLACE[:3]], *nowhere, F.col("l.line").alias("line")
    )


def _element_lines(rows: DataFrame, doc: str, page: str, section: int, bags: list[str], work: str | None) -> DataFrame:
    at = F.struct(F.col(page), F.col("doc_no"), F.col("pos"))
    # One row per document, written out: joined by measured size, a hot document's elements are split.
    first = materialize(rows.groupBy(doc).agg(F.min(at).alias("first_at")), "first-elements", work)
    texts = F.array(*[_json(F.col(b)) for b in bags])
    comma = F.when(at == F.col("first_at"), "").otherwise(",")
    opened = rows.join(first, doc).select(doc, page, "doc_no", "pos", comma.alias("comma"), F.posexplode(texts).alias("list", "text"))
    return opened.select(
        doc,
        F.lit(section).alias("section"),
        "list",
        F.lit(_ELEMENT).alias("part"),
        F.col(page).cast("bigint").alias("page"),
        "doc_no",
        "pos",
        F.concat("comma", "text").alias("line"),
    )


def combined_lines(
    fields: DataFrame, items: DataFrame, totals: DataFrame, doc: str, page: str, work: str | None = None
) -> DataFrame:
    """``doc``, the columns of ``PLACE`` and ``line``: the JSON of the documents of ``multipage_document``.

    Every document of ``totals`` has its frame, also one without elements. A
    missing value is an empty text, a missing total 0.00.
    """
    parts = [_frame_lines(totals, doc)]
    for section, (rows, (_, bags)) in enumerate(zip((fields, items), _SECTIONS)):
        parts.append(_element_lines(rows, doc, page, section, bags, work))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def write_combined(lines: DataFrame, path: str, doc: str) -> None:
    """The lines in order, as text files whose names are in that order too."""
    ordered = lines.repartitionByRange(doc, *PLACE).sortWithinPartitions(doc, *PLACE)
    ordered.select("line").write.mode("overwrite").text(path)
