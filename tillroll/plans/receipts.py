"""The pipelines users run, composed of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillroll import schemas
from tillroll.functions.dates import receipt_date
from tillroll.functions.envelopes import (
    append_names,
    append_values,
    canonical_date_type,
    entry,
    kv_bag_json,
    lineitem_bag_json,
    to_envelope_json,
    total_amount,
)
from tillroll.functions.numbers import array_total, format_duration, round_total
from tillroll.functions.ocr import kv_bag, lineitem_bag
from tillroll.functions.paths import is_receipt_key, path_ids
from tillroll.functions.text import clean_address
from tillroll.operators.kv import kv_wide, kv_wide_from_bag
from tillroll.operators.lineitems import lineitem_final, lineitem_raw
from tillroll.operators.mapping import apply_mapping
from tillroll.operators.pages import combine_pages, document_total, pages_before_duplicate
from tillroll.operators.quality import (
    accepted,
    check_envelopes,
    check_responses,
    good_envelopes,
    last_by_basename,
)
from tillroll.storage import materialize

# Which label becomes which column of the target table, and as what.
KEYVALUE_MAPPING = [
    ("TOTALAMOUNT", "string", "TOTAL_AMOUNT", "double"),
    ("STOREIDS", "string", "STOREID", "string"),
    ("TENANTIDS", "string", "TENANTIDS", "string"),
    ("SESSIONIDS", "string", "SESSIONID", "string"),
    ("USER", "string", "USER", "string"),
    ("DATE", "string", "date", "string"),
    ("ADDRESS", "string", "ADDRESS", "string"),
    ("MOBILE", "string", "MOBILE", "bigint"),
]


# --- OCR responses to envelopes ------------------------------------------------


def expense_documents(responses: DataFrame, keep: list[str], last_only: bool = False) -> DataFrame:
    """One row per expense document: ``keep``, ``doc_no``, ``fields``, ``groups``.

    ``last_only`` keeps what survives when all documents of a file are written
    to the same object.

    The outer form of explode, with the NULL rows filtered afterwards, keeps the
    optimizer from testing the list, parsed from JSON, once more below.
    """
    documents = F.col("ExpenseDocuments")
    exploded = responses.select(
        *keep, F.size(documents).alias("_n"), F.posexplode_outer(documents).alias("doc_no", "_doc")
    ).filter(F.col("_doc").isNotNull())
    if last_only:
        exploded = exploded.filter(F.col("doc_no") == F.col("_n") - 1)
    return exploded.select(
        *keep,
        "doc_no",
        F.col("_doc.SummaryFields").alias("fields"),
        F.col("_doc.LineItemGroups").alias("groups"),
    )


def with_bags(documents: DataFrame) -> DataFrame:
    """``fields`` and ``groups`` to ``kv``, ``li`` and the exact ``total``."""
    bags = documents.withColumns({"kv": kv_bag(F.col("fields")), "li": lineitem_bag(F.col("groups"))})
    return bags.drop("fields", "groups").withColumn("total", array_total(F.col("li.price")))


def ocr_to_envelope(
    responses: DataFrame, keep: list[str], seconds: str, pretty: bool = True
) -> DataFrame:
    """Envelope columns per expense document, bags already serialised.

    Documents without summary fields or line-item groups cannot be built and
    are left to ``incomplete_documents``.
    """
    documents = expense_documents(responses, [*keep, seconds])
    complete = documents.filter(F.col("fields").isNotNull() & F.col("groups").isNotNull())
    return with_bags(complete).select(
        *keep,
        "doc_no",
        lineitem_bag_json(F.col("li"), pretty).alias("lineitems"),
        kv_bag_json(F.col("kv"), pretty).alias("kv_data"),
        format_duration(F.col(seconds)).alias("time_taken"),
        round_total(F.col("total")).alias("Total_Amount"),
        F.col("li.bad_price").alias("bad_price"),
    )


def incomplete_documents(responses: DataFrame, keep: list[str]) -> DataFrame:
    documents = expense_documents(responses, keep)
    missing = F.when(F.col("fields").isNull(), "SummaryFields").when(
        F.col("groups").isNull(), "LineItemGroups"
    )
    return documents.select(
        *keep, "doc_no", F.lit("MissingField").alias("error_type"), missing.alias("error_message")
    ).filter(F.col("error_message").isNotNull())


def envelope_json(envelopes: DataFrame, keep: list[str], pretty: bool = True) -> DataFrame:
    record = F.struct("lineitems", "kv_data", "time_taken", "Total_Amount")
    return envelopes.select(*keep, to_envelope_json(record, pretty).alias("envelope_json"))


# --- envelopes to enriched envelopes -------------------------------------------


_KNOWN_KEYS = ["lineitems", "kv_data", "time_taken", "total_amount", "Total_Amount"]


def enrich_envelopes(
    envelopes: DataFrame, path: str = "path", raw: str = "raw", last_writer: bool = False
) -> DataFrame:
    """Enriched envelopes of all receipt keys, as columns. Narrow: no shuffle.

    Input rows are ``path, raw``; bad ones are left to ``quarantine``. Keys of an
    envelope that the enrichment does not know come through in the map ``extra``.
    ``last_writer`` keeps, of objects with equal file name, the one whose path
    comes last, as when all write to one folder.
    """
    receipts = envelopes.filter(is_receipt_key(F.col(path)))
    if last_writer:
        receipts = last_by_basename(receipts, path).drop("target")
    return enrich_checked(check_envelopes(receipts, raw), path)


def enrich_checked(checked: DataFrame, path: str = "path") -> DataFrame:
    """``enrich_envelopes`` for envelopes that were checked already."""
    return _enriched(good_envelopes(checked), path)


def _enriched(checked: DataFrame, path: str, keep: Sequence[str] = ()) -> DataFrame:
    parsed = checked.withColumns({"_total": total_amount(F.col("envelope")), **path_ids(F.col(path))})
    ids = {name: F.col(name) for name in ("tenant_id", "store_id", "session_id")}
    kv = F.struct(
        append_names(canonical_date_type(F.col("kv.Type"))).alias("Type"),
        append_names(F.col("kv.Key")).alias("Key"),
        append_values(F.col("kv.Value"), F.col("li"), ids, F.col("_total")).alias("Value"),
        F.col("kv.KeyConfidence").alias("KeyConfidence"),
        F.col("kv.ValueConfidence").alias("ValueConfidence"),
    )
    return parsed.select(
        path,
        *keep,
        "lineitems",
        F.to_json(kv, {"ignoreNullFields": "false"}).alias("kv_data"),
        entry(F.col("envelope"), "time_taken").alias("time_taken"),
        F.col("_total").alias("Total_Amount"),
        "session_id",
        "store_id",
        "tenant_id",
        F.map_filter("envelope", lambda key, _: ~key.isin(_KNOWN_KEYS)).alias("extra"),
    )


# --- enriched envelopes to tables ----------------------------------------------


def receipt_wide(enriched: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per readable receipt with the kept labels as text; addresses on one line."""
    return kv_wide(enriched, keep, readable_only=True).withColumn("ADDRESS", clean_address(F.col("ADDRESS")))


_REJECT = ["error_type", "error_message", "raw"]


def judge_receipts(checked: DataFrame, path: str = "path", raw: str = "raw") -> DataFrame:
    """Checked envelopes as wide receipt rows and rejects, one row for each, to be written once.

    ``path``, ``error_type``, ``error_message``, ``raw`` and the labels of ``receipt_wide``. A
    good row has no ``raw`` and no error, a bad row no labels.
    """
    error = F.col("error_type")
    rows = checked.withColumn("raw", F.when(error.isNotNull(), F.col(raw)))
    judged = _enriched(rows, path, _REJECT).withColumn("kv_data", F.when(error.isNull(), F.col("kv_data")))
    return kv_wide(judged, [path, *_REJECT]).withColumn("ADDRESS", clean_address(F.col("ADDRESS")))


def keyvalue_from_wide(wide: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The ``keyvalue`` columns of wide rows, after the text columns of ``keep``."""
    mapped = apply_mapping(wide, [*((name, "string", name, "string") for name in keep), *KEYVALUE_MAPPING])
    return (
        mapped.withColumn("DATES", receipt_date(F.col("date")))
        .drop("date")
        .withColumnRenamed("USER", "NAME")
        .select(*keep, "TOTAL_AMOUNT", "STOREID", "TENANTIDS", "SESSIONID", "NAME", "DATES", "ADDRESS", "MOBILE")
    )


def keyvalue_final(enriched: DataFrame) -> DataFrame:
    """The ``keyvalue`` table. One narrow stage from scan to sink.

    A bag that cannot be read gives no row; ``quality.check_bags`` names it.
    """
    return keyvalue_from_wide(receipt_wide(enriched))


def lineitems_from_wide(wide: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return lineitem_final(lineitem_raw(wide, keep), keep)


def lineitems(enriched: DataFrame) -> DataFrame:
    """The ``lineitem`` table. One narrow stage from scan to sink."""
    return lineitems_from_wide(kv_wide(enriched, readable_only=True))


def receipt_tables(enriched: DataFrame, work: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Both tables from one parse: the wide rows are written into ``work`` once and read twice."""
    wide = materialize(receipt_wide(enriched), "receipts-wide", work)
    return keyvalue_from_wide(wide), lineitems_from_wide(wide)


def wide_from_responses(responses: DataFrame, path: str = "path") -> DataFrame:
    """Wide receipt rows straight from OCR responses, in one narrow stage.

    Same rows as envelope, enrichment and ``receipt_wide`` one after the other,
    without writing the bags as JSON and parsing them again in between. For
    jobs that do not need the envelopes themselves.
    """
    receipts = responses.filter(is_receipt_key(F.col(path)))
    documents = expense_documents(receipts, [path])
    complete = documents.filter(F.col("fields").isNotNull() & F.col("groups").isNotNull())
    return wide_from_bags(with_bags(complete), path)


def wide_from_bags(bags: DataFrame, path: str = "path") -> DataFrame:
    """Wide receipt rows of documents whose bags (``kv``, ``li``, ``total``) are built."""
    ids = path_ids(F.col(path))
    appended = F.array(
        F.to_json("li.items"),
        F.to_json("li.price"),
        F.to_json("li.quantity"),
        ids["tenant_id"],
        ids["session_id"],
        ids["store_id"],
        round_total(F.col("total")).cast("string"),
    )
    bag = F.struct(
        append_names(canonical_date_type(F.col("kv.Type"))).alias("Type"),
        append_names(F.col("kv.Key")).alias("Key"),
        F.concat("kv.Value", appended).alias("Value"),
    )
    wide = kv_wide_from_bag(bags, bag)
    return wide.withColumn("ADDRESS", clean_address(F.col("ADDRESS")))


# --- multi-page documents --------------------------------------------------------

_KV_BAGS = ["Type", "Key", "Value", "KeyConfidence", "ValueConfidence"]
_ITEM_BAGS = [
    "items",
    "price",
    "quantity",
    "items_confidence",
    "price_confidence",
    "quantity_confidence",
]


def multipage_document(
    pages: DataFrame,
    doc: str,
    page: str,
    page_hash: str,
    response: str,
    work: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Documents from their pages before the first repeat: fields, items, totals, rejects.

    Fields and items are the merged lists in long form, one row per list element,
    in the order ``page``, ``doc_no``, ``pos``. Totals have a row per document
    with how many of its pages were rejected; a bad page takes nothing from the
    good ones. The pages are written out once, with their bags built and the
    text of bad ones only, and read three times.
    """
    kept = pages_before_duplicate(pages, doc, page, page_hash, work=work)
    judged = with_bags(check_responses(kept.select(doc, page, F.col(response).alias("raw"))))
    raw = F.when(F.col("error_type").isNotNull(), F.col("raw"))
    checked = materialize(
        judged.select(doc, page, "doc_no", "error_type", "error_message", raw.alias("raw"), "kv", "li", "total"),
        "pages-checked",
        work,
    )
    bags = accepted(checked)
    kv = bags.select(doc, page, "doc_no", *[F.col(f"kv.{b}").alias(b) for b in _KV_BAGS])
    li = bags.select(doc, page, "doc_no", *[F.col(f"li.{b}").alias(b) for b in _ITEM_BAGS])
    order = [page, "doc_no"]
    bad = F.col("error_type").isNotNull()
    counts = checked.groupBy(doc).agg(F.count_if(bad).alias("rejected"))
    totals = document_total(bags, doc, "total").drop("pages_without_total")
    return (
        combine_pages(kv, doc, order, _KV_BAGS),
        combine_pages(li, doc, order, _ITEM_BAGS),
        counts.join(totals, doc, "left"),
        checked.filter(bad).select(doc, page, "error_type", "error_message", "raw"),
    )
