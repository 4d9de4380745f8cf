"""Pages of multi-page documents: counting, cutting at repeats, merging.

A page table holds one row per page, ``page`` being unique within ``doc``. Any
document may hold a large share of all rows, so nothing here brings all pages
of a document into one task or one row: merged documents are in long form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tillroll.functions.paths import document_kind
from tillroll.storage import materialize

# Helper columns, named so that no input column is called the same.
_CUT, _CUT_DOC, _NTH = "tillroll_cut", "tillroll_cut_doc", "tillroll_nth"


def page_count(pages: DataFrame, doc: str) -> DataFrame:
    return pages.groupBy(doc).agg(F.count(F.lit(1)).alias("pages"))


def route_documents(files: DataFrame, counts: DataFrame, doc: str, key: str) -> DataFrame:
    """Adds ``kind`` and ``route``: multi, single, or quarantine for unreadable PDFs.

    ``files`` and ``counts`` both hold one row per document, so the join key is
    not skewed.
    """
    kind = document_kind(F.col(key))
    joined = files.withColumn("kind", kind).join(counts, doc, "left")
    pdf = F.col("kind") == "pdf"
    return joined.withColumn(
        "route",
        F.when(pdf & F.col("pages").isNull(), "quarantine")
        .when(pdf & (F.col("pages") > 1), "multi")
        .otherwise("single"),
    )


def unhashed_pages(pages: DataFrame, page_hash: str) -> DataFrame:
    """Pages whose hash is missing: they repeat nothing, and are worth a look."""
    return pages.filter(F.col(page_hash).isNull())


def first_occurrences(pages: DataFrame, doc: str, page: str, page_hash: str) -> DataFrame:
    """Only the first page of each hash; later distinct pages stay, and so do pages without a hash."""
    by_hash = Window.partitionBy(doc, page_hash).orderBy(page)
    ranked = pages.filter(F.col(page_hash).isNotNull()).withColumn(_NTH, F.row_number().over(by_hash))
    first = ranked.filter(F.col(_NTH) == 1).drop(_NTH)
    return first.unionByName(unhashed_pages(pages, page_hash))


def first_repeats(pages: DataFrame, doc: str, page: str, page_hash: str) -> DataFrame:
    """Per document with a repeated hash, the first page that repeats an earlier one.

    That page is the second of its hash. Spark keeps at most two rows per
    (doc, hash) in every map task before the shuffle (WindowGroupLimit), so a
    hash that fills a third of the table still shuffles next to nothing. A page
    without a hash repeats nothing.
    """
    by_hash = Window.partitionBy(doc, page_hash).orderBy(page)
    second = (
        pages.filter(F.col(page_hash).isNotNull())
        .select(doc, page_hash, page)
        .withColumn(_NTH, F.row_number().over(by_hash))
        .filter(F.col(_NTH) == 2)
    )
    return second.groupBy(doc).agg(F.min(page).alias(_CUT))


def pages_before_duplicate(
    pages: DataFrame,
    doc: str,
    page: str,
    page_hash: str,
    drop_only_duplicates: bool = False,
    work: str | None = None,
) -> DataFrame:
    """Pages up to, not including, the first page whose hash was seen before.

    ``drop_only_duplicates`` keeps later distinct pages as well.

    The cut list has one row per document and is written out first, into
    ``work`` or a new folder: the join then broadcasts it if it is small by
    measured size, and otherwise splits a hot document's pages over several
    tasks. Pages without a document id are one document.
    """
    if drop_only_duplicates:
        return first_occurrences(pages, doc, page, page_hash)
    cuts = materialize(first_repeats(pages, doc, page, page_hash), "page-cuts", work)
    cuts = cuts.withColumnRenamed(doc, _CUT_DOC)
    joined = pages.join(cuts, pages[doc].eqNullSafe(cuts[_CUT_DOC]), "left")
    return joined.filter(F.col(_CUT).isNull() | (F.col(page) < F.col(_CUT))).select(*pages.columns)


def combine_pages(
    pages: DataFrame, doc: str, order: Sequence[str], bags: Sequence[str]
) -> DataFrame:
    """The parallel lists of all pages as one list per document, in long form.

    One row per list element: ``doc``, the columns of ``order`` (the page number
    first), ``pos`` in its page's lists, and the element of every bag. Sorted by
    ``order`` and ``pos`` these are the document's merged lists. The shape does
    not depend on a document's size, and nothing is shuffled.
    """
    elements = F.posexplode(F.arrays_zip(*bags)).alias("pos", "_e")
    exploded = pages.select(doc, *order, elements)
    return exploded.select(doc, *order, "pos", *[F.col("_e")[b].alias(b) for b in bags])


def combine_fields(pages: DataFrame, doc: str, page: str, fields: str) -> DataFrame:
    """As ``combine_pages`` for a map of lists with arbitrary keys: doc, field, page, pos, value."""
    per_field = pages.select(doc, page, F.explode(fields).alias("field", "_values"))
    return per_field.select(doc, "field", page, F.posexplode("_values").alias("pos", "value"))


def document_total(pages: DataFrame, doc: str, total: str) -> DataFrame:
    """Sum of page totals, and how many pages had none.

    Decimal, so the result does not depend on the order; a document with a page
    total that no decimal holds gets the sum of the doubles.
    """
    exact = F.col(total).try_cast("decimal(28,6)")
    beyond = F.count_if(F.col(total).isNotNull() & exact.isNull())
    rounded = F.round(F.try_sum(exact), 2).cast("double")
    return pages.groupBy(doc).agg(
        F.when(beyond == 0, rounded).otherwise(F.sum(F.col(total).cast("double"))).alias("total_amount"),
        F.count_if(F.col(total).isNull()).alias("pages_without_total"),
    )
