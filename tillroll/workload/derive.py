"""Receipts, responses, envelopes and pages derived from the given tables.

One receipt per ``lineitem`` row, built from that row and the order, customer
and part it refers to. Deriving needs no grouping: the three joins are plain
equi-joins, so the adaptive planner broadcasts a side only by its measured size
and splits a hot order, customer or part. ``BASE_SQL`` states the same rows
relationally for the oracle, with no JSON in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll import schemas
from tillroll.functions.binding import let

# A receipt has its line number modulo this plus one many items, so no more than this.
MAX_ITEMS = 3

_FORMATS = [
    "dd-MM-yyyy",
    "dd/MM/yy",
    "yyyy-MM-dd",
    "MMM dd yyyy",
    "EEE MMM dd yyyy",
    "MMM dd yyyy HH:mm",
    "dd MMM yyyy",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalar columns of each receipt; what one table alone says is made before its rows are repeated by a join."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").cast("bigint").alias("ln"),
        F.col("l_partkey").alias("pk"),
        F.col("l_suppkey").alias("sk"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.col("l_quantity").cast("bigint").alias("qty"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("ck"), "o_orderdate"
    ).withColumn("date_text", date_text())
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ck"), "c_name", F.col("c_nationkey").cast("bigint").alias("nk"), _quoted(F.col("c_name")).alias("c_name_json")
    )
    marked = F.replace("p_name", F.lit(" "), F.lit("\n"))
    inside = F.substr(_quoted(marked), F.lit(2), F.length(_quoted(marked)) - 2)
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pk"),
        "p_name",
        marked.alias("p_name_marked"),
        _quoted(F.col("p_name")).alias("p_name_json"),
        inside.alias("p_marked_inside"),
    )
    joined = lines.join(orders, "k").join(customers, "ck").join(parts, "pk")
    session = F.concat_ws("-", F.concat(F.lit("S"), "k"), "ln", "pk", "sk", "cents")
    return joined.withColumns(
        {
            "session": session,
            "store": F.concat(F.lit("ST"), F.col("k") % 50),
            "tenant": F.concat(F.lit("T"), "nk"),
            "n_items": (F.col("ln") % (MAX_ITEMS + 1)).cast("int"),
            "address": F.concat((F.col("k") % 100), F.lit(" Road\nCity "), F.col("nk")),
            "mobile": F.when(F.col("k") % 13 == 0, "98 76").otherwise(
                F.concat(F.lit("9"), F.lpad(F.col("ck").cast("string"), 9, "0"))
            ),
            "seconds": (F.col("k") % 200000) + F.col("ln") / 4,
        }
    )


def date_text() -> Column:
    """The order date in one of seven formats, or absent, by order key."""
    text = F.when(F.lit(False), "")
    for i, pattern in enumerate(_FORMATS):
        text = text.when(F.col("k") % 8 == i, F.date_format("o_orderdate", pattern))
    return text


def receipt_path() -> Column:
    folder = F.when(F.col("k") % 17 == 0, "other").otherwise("textract")
    # The session without its first letter.
    name = F.substr("session", F.lit(2))
    return F.concat(
        F.lit("in/"), "tenant", F.lit("/a/"), "store", F.lit("/b/"), "session", F.lit("/c/"),
        folder, F.lit("/"), name, F.lit(".json"),
    )


def present(*elements: tuple[Column, Column]) -> Column:
    """The list of the elements whose condition holds, as (condition, element).

    Said without a lambda, which generated code can run; a lambda is interpreted node by node.
    """
    return F.concat(*[F.when(there, F.array(element)).otherwise(F.array()) for there, element in elements])


def per_item(build) -> Column:
    """``build(j)`` for j = 1..n_items; an empty list for none."""
    return present(*[(F.col("n_items") >= j, build(F.lit(j))) for j in range(1, MAX_ITEMS + 1)])


def item_text(j: Column) -> Column:
    marked = F.concat(F.col("p_name_marked"), F.lit(" "), j)
    return F.when((F.col("pk") + j) % 5 == 0, marked).otherwise(F.col("p_name"))


def bad_price(j: Column) -> Column:
    return (F.col("pk") + j) % 29 == 0


def price_text(j: Column) -> Column:
    amount = ((F.col("cents") + j * 100) / 100).cast("decimal(20,2)")
    return F.when(bad_price(j), "N/A").otherwise(F.format_number(amount, 2))


def price_number(j: Column) -> Column:
    return F.when(bad_price(j), 0.0).otherwise((F.col("cents") + j * 100) / 100.0)


def quantity_text(j: Column) -> Column:
    return F.when((F.col("pk") + j) % 31 == 0, "").otherwise((F.col("qty") + j).cast("string"))


def _entries() -> Column:
    """The summary entries, which are (type, key, value, confidence); optional ones may be absent."""

    def entry(kind, key, value, confidence):
        return F.struct(
            F.lit(kind).alias("type"),
            F.lit(key).alias("key"),
            value.alias("value"),
            F.lit(confidence).cast("double").alias("confidence"),
        )

    always = F.lit(True)
    entries = [
        (always, entry("NAME", "User", F.col("c_name"), 99.5)),
        (F.col("date_text").isNotNull(), entry("INVOICE_RECEIPT_DATE", "", F.col("date_text"), 91.25)),
        (always, entry("ADDRESS", "other", F.col("address"), None)),
        (always, entry("OTHER", " Mobile: ", F.col("mobile"), 88.0)),
        (F.col("k") % 7 == 0, entry("NAME", "User", F.lit("Guest"), 50.0)),
    ]
    return present(*entries)


def _quoted(text: Column) -> Column:
    """The JSON string of a text; NULL for none."""
    listed = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substr(listed, F.lit(2), F.length(listed) - 2))


def _if(there: Column, text: Column) -> Column:
    return F.when(there, text).otherwise(F.lit(""))


def responses(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """``session, path, seconds, response``: OCR output as JSON text; after them the columns of ``keep``.

    The text is put together from its pieces. Built as one structure, the generated code
    has a method of more than 8,000 bytes, which the JVM never compiles.
    """

    def text(value, rest=""):
        """The member ``Text`` of a detection, left out where there is none, before other members."""
        return F.coalesce(F.concat(F.lit('"Text":'), value, F.lit(rest)), F.lit(""))

    def plain(value, rest=""):
        return F.coalesce(F.concat(F.lit('"Text":"'), value, F.lit(f'"{rest}')), F.lit(""))

    def entry(kind, key, value, confidence=None):
        label = f'{{"Text":"{key}"' + (f',"Confidence":{confidence}}}' if confidence else "}")
        more = f'"Confidence":{confidence + 0.25}' if confidence else ""
        start = f'{{"Type":{{"Text":"{kind}"}},"LabelDetection":{label},"ValueDetection":{{'
        return F.concat(F.lit(start), value, F.lit(more + "}}"))

    def line(j):
        marked = F.concat(F.lit('"'), F.col("p_marked_inside"), F.lit(f' {j}"'))
        item = F.when((F.col("pk") + j) % 5 == 0, marked).otherwise(F.col("p_name_json"))
        start = (
            '{"LineItemExpenseFields":[{"Type":{"Text":"ITEM"},"ValueDetection":{"Text":"draft","Confidence":1.0}},'
            '{"Type":{"Text":"PRODUCT_CODE"},"ValueDetection":{"Text":"x","Confidence":9.0}},'
            '{"Type":{"Text":"ITEM"},"ValueDetection":{'
        )
        quantity = F.concat(
            F.lit(',{"Type":{"Text":"QUANTITY"},"ValueDetection":{'), plain((F.col("qty") + j).cast("string")), F.lit("}}")
        )
        return F.concat(
            F.lit(start),
            text(item, ","),
            F.lit('"Confidence":95.5}},{"Type":{"Text":"PRICE"},"ValueDetection":{'),
            plain(price_text(j), ","),
            F.lit('"Confidence":'),
            (90.0 + F.col("ln")).cast("string"),
            F.lit("}}"),
            _if((F.col("pk") + j) % 31 != 0, quantity),
            F.lit("]}"),
        )

    n, comma = F.col("n_items"), F.lit(",")
    name = entry("NAME", "User", text(F.col("c_name_json"), ","), 99.5)
    address = F.replace("address", F.lit("\n"), F.lit("\\n"))
    further = [_if(n >= j, F.concat(comma, line(j)) if j > 2 else line(j)) for j in range(2, MAX_ITEMS + 1)]
    response = F.concat(
        F.lit('{"ExpenseDocuments":[{"SummaryFields":['),
        name,
        _if(F.col("date_text").isNotNull(), F.concat(comma, entry("INVOICE_RECEIPT_DATE", "", plain(F.col("date_text"), ","), 91.25))),
        comma,
        entry("ADDRESS", "other", plain(address)),
        comma,
        entry("OTHER", " Mobile: ", plain(F.col("mobile"), ","), 88.0),
        _if(F.col("k") % 7 == 0, F.concat(comma, entry("NAME", "User", F.lit('"Text":"Guest",'), 50.0))),
        F.lit('],"LineItemGroups":[{"LineItems":['),
        _if(n >= 1, line(1)),
        F.lit("]},{"),
        # A receipt without a line number has no list of further items.
        _if(n.isNotNull(), F.concat(F.lit('"LineItems":['), *further, F.lit("]"))),
        F.lit("}]}"),
        _if(F.col("k") % 11 == 0, F.concat(F.lit(',{"SummaryFields":['), name, F.lit('],"LineItemGroups":[]}'))),
        F.lit("]}"),
    )
    return receipts(spark, sf_dir).select("session", receipt_path().alias("path"), "seconds", response.alias("response"), *keep)


def parsed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("response", f"STRUCT<{schemas.EXPENSE_RESPONSE}>")
    return (
        responses(spark, sf_dir)
        .withColumn("_r", parsed)
        .select("session", "path", "seconds", "_r.ExpenseDocuments")
    )


def _bag_texts(variant_values: bool) -> tuple[Column, Column, Column]:
    entries = F.col("_entries")
    types, keys, values = entries["type"], entries["key"], entries["value"]
    if variant_values:
        values = F.transform(values, lambda value: value.cast("variant"))
    return types, keys, values


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``session, path, raw``: first-stage envelopes; some are damaged on purpose.

    Damage by order key: k % 19 = 3 a broken key/value bag, k % 23 = 5 no line
    items, k % 29 = 7 a broken envelope.
    """
    types, keys, values = _bag_texts(False)
    base = receipts(spark, sf_dir).withColumn("_entries", _entries())
    kv = F.to_json(
        F.struct(
            types.alias("Type"),
            keys.alias("Key"),
            values.alias("Value"),
            F.col("_entries")["confidence"].alias("KeyConfidence"),
            F.col("_entries")["confidence"].alias("ValueConfidence"),
        )
    )
    items = F.to_json(
        F.struct(
            per_item(item_text).alias("items"),
            per_item(price_number).alias("price"),
            per_item(quantity_text).alias("quantity"),
        )
    )
    envelope = F.to_json(
        F.struct(
            F.when(F.col("k") % 23 != 5, items).alias("lineitems"),
            F.when(F.col("k") % 19 == 3, "{oops").otherwise(kv).alias("kv_data"),
            F.lit("0:00:02.500000").alias("time_taken"),
            F.round(F.aggregate(per_item(price_number), F.lit(0.0), lambda a, p: a + p), 2).alias(
                "Total_Amount"
            ),
        )
    )
    raw = F.when(F.col("k") % 29 == 7, "{oops").otherwise(envelope)
    return base.select("session", receipt_path().alias("path"), raw.alias("raw"))


def kv_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``session, kv_data`` and the ids: undamaged first-stage key/value bags."""
    types, keys, values = _bag_texts(False)
    base = receipts(spark, sf_dir).withColumn("_entries", _entries())
    bag = F.struct(types.alias("Type"), keys.alias("Key"), values.alias("Value"))
    return base.select("session", "store", "tenant", F.to_json(bag).alias("kv_data"))


def item_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``session, k`` and the item lists as JSON text, prices written both ways."""
    base = receipts(spark, sf_dir)
    return base.select(
        "session",
        "k",
        F.to_json(per_item(item_text)).alias("items"),
        F.when(F.col("k") % 2 == 0, F.to_json(per_item(price_text)))
        .otherwise(F.to_json(per_item(price_number)))
        .alias("price"),
        F.to_json(per_item(quantity_text)).alias("quantity"),
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``session, lineitems, kv_data``: what the receipt job reads.

    Prices are text with commas for even order keys and numbers for odd ones.
    """
    types, keys, values = _bag_texts(True)
    base = receipts(spark, sf_dir).withColumn("_entries", _entries())
    names = F.array(*[F.lit(n) for n in schemas.APPENDED_ENTRIES])
    prices = F.when(
        F.col("k") % 2 == 0, F.to_variant_object(per_item(price_text))
    ).otherwise(F.to_variant_object(per_item(price_number)))
    total = F.when(F.col("k") % 5 != 0, (F.col("cents") / 100.0).cast("variant"))
    extra = F.array(
        F.to_variant_object(per_item(item_text)),
        prices,
        F.to_variant_object(per_item(quantity_text)),
        F.col("tenant").cast("variant"),
        F.col("session").cast("variant"),
        F.col("store").cast("variant"),
        total,
    )
    dated = F.transform(types, lambda t: F.when(t == "INVOICE_RECEIPT_DATE", "DATE").otherwise(t))
    kv = F.struct(
        F.concat(dated, names).alias("Type"),
        F.concat(keys, names).alias("Key"),
        F.concat(values, extra).alias("Value"),
    )
    items = F.struct(
        per_item(item_text).alias("items"),
        per_item(price_number).alias("price"),
        per_item(quantity_text).alias("quantity"),
    )
    return base.select(
        "session", F.to_json(items).alias("lineitems"), F.to_json(kv).alias("kv_data")
    )


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page table: one page per order and line number, one document per order.

    Lines that share a number form one page; the aggregates merge in map tasks,
    so an order that owns a third of all lines costs one row per task and page.
    """
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").cast("bigint").alias("page_no")
    ).agg(
        (F.min("l_partkey") % 5).alias("page_hash"),
        F.min("l_partkey").alias("part"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
        F.count(F.lit(1)).alias("n"),
    )


def page_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order pages with an OCR response each: one summary field, one or two items.

    Some are damaged: page 2 of doc % 17 = 3 is broken text, page 1 of doc % 19 = 4
    has no summary fields.
    """

    def detection(text, confidence):
        return F.struct(text.alias("Text"), F.lit(confidence).alias("Confidence"))

    def field(name, text):
        return F.struct(
            F.struct(F.lit(name).alias("Text")).alias("Type"),
            detection(text, 90.0).alias("ValueDetection"),
        )

    def line(item, price, quantity):
        fields = F.array(field("ITEM", item), field("PRICE", price), field("QUANTITY", quantity))
        return F.struct(fields.alias("LineItemExpenseFields"))

    page = F.concat(F.lit("page "), F.col("page_no"))
    price = F.format_number((F.col("cents") / 100).cast("decimal(28,2)"), 2)
    lines = F.when(
        F.col("n") > 1,
        F.array(
            line(F.concat(F.lit("part "), F.col("part")), price, F.col("qty").cast("string")),
            line(F.lit("fee"), F.lit("1.50"), F.lit("")),
        ),
    ).otherwise(
        F.array(line(F.concat(F.lit("part "), F.col("part")), price, F.col("qty").cast("string")))
    )
    summary = F.struct(
        F.struct(F.lit("PAGE").alias("Text")).alias("Type"),
        detection(F.lit("Page"), 80.0).alias("LabelDetection"),
        detection(page, 81.0).alias("ValueDetection"),
    )
    document = F.struct(
        F.array(summary).alias("SummaryFields"),
        F.array(F.struct(lines.alias("LineItems"))).alias("LineItemGroups"),
    )
    whole = F.to_json(F.struct(F.array(document).alias("ExpenseDocuments")))
    headless = F.to_json(F.struct(F.array(document.dropFields("SummaryFields")).alias("ExpenseDocuments")))
    doc, page_no = F.col("doc"), F.col("page_no")
    damaged = (
        F.when((doc % 17 == 3) & (page_no == 2), "{oops").when((doc % 19 == 4) & (page_no == 1), headless).otherwise(whole)
    )
    return order_pages(spark, sf_dir).select("doc", "page_no", "page_hash", damaged.alias("response"))


def damaged_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``session, path, response``: OCR output of which some is broken on purpose.

    By order key: k % 29 = 7 broken text, k % 23 = 5 no documents, k % 19 = 3 a
    document without line-item groups.
    """
    no_groups = '{"ExpenseDocuments": [{"SummaryFields": []}]}'
    # Bound by a lambda, so that the projection is cut into methods short enough for the JVM to compile.
    broken = let(F.col("k"), lambda k: F.when(k % 29 == 7, "{oops").when(k % 23 == 5, "{}").when(k % 19 == 3, no_groups))
    return responses(spark, sf_dir, "k").select("session", "path", F.coalesce(broken, "response").alias("response"))


# --- the same rows for the oracle ---------------------------------------------------

BASE_SQL = """
base AS (
  SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS ln, l_partkey AS pk, l_suppkey AS sk,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(l_quantity AS BIGINT) AS qty,
         c_custkey AS ck, c_name, CAST(c_nationkey AS BIGINT) AS nk, p_name,
         CAST(o_orderdate AS DATE) AS odate, o_orderdate,
         'S' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
           || '-' || CAST(round(l_extendedprice * 100) AS BIGINT) AS session,
         'ST' || (l_orderkey % 50) AS store, 'T' || c_nationkey AS tenant,
         l_linenumber % 4 AS n_items,
         (l_orderkey % 100) || ' Road' || chr(10) || 'City ' || c_nationkey AS address,
         CASE WHEN l_orderkey % 13 = 0 THEN '98 76'
              ELSE '9' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS mobile,
         (l_orderkey % 200000) + l_linenumber / 4 AS seconds,
         CASE l_orderkey % 8
              WHEN 0 THEN strftime(o_orderdate, '%d-%m-%Y') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%y')
              WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 3 THEN strftime(o_orderdate, '%b %d %Y')
              WHEN 4 THEN strftime(o_orderdate, '%a %b %d %Y')
              WHEN 5 THEN strftime(o_orderdate, '%b %d %Y %H:%M')
              WHEN 6 THEN strftime(o_orderdate, '%d %b %Y') END AS date_text,
         CASE WHEN l_orderkey % 8 = 1 THEN make_date(
                  CAST(2000 + year(o_orderdate) % 100 AS BIGINT), month(o_orderdate), day(o_orderdate))
              WHEN l_orderkey % 8 < 6 THEN CAST(o_orderdate AS DATE) END AS receipt_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
), paths AS (
  SELECT *, 'in/' || tenant || '/a/' || store || '/b/' || session || '/c/' ||
         CASE WHEN k % 17 = 0 THEN 'other' ELSE 'textract' END || '/' ||
         k || '-' || ln || '-' || pk || '-' || sk || '-' || cents || '.json' AS path
  FROM base
), items AS (
  SELECT *, CASE WHEN (pk + j) % 5 = 0 THEN replace(p_name, ' ', chr(10)) || ' ' || j
                 ELSE p_name END AS item_text,
         CASE WHEN (pk + j) % 5 = 0 THEN upper(p_name) || ' ' ELSE upper(p_name) END AS item_clean,
         (pk + j) % 29 = 0 AS bad_price, (cents + j * 100) / 100.0 AS price,
         CASE WHEN (pk + j) % 31 = 0 THEN '' ELSE CAST(qty + j AS VARCHAR) END AS quantity_text,
         CASE WHEN (pk + j) % 31 = 0 THEN -1.0 ELSE CAST(qty + j AS DOUBLE) END AS quantity
  FROM base, LATERAL (SELECT unnest(generate_series(1, CAST(n_items AS BIGINT))) AS j)
)
"""

PAGES_SQL = """
pages_of AS (
  SELECT l_orderkey AS doc, CAST(l_linenumber AS BIGINT) AS page_no, min(l_partkey) % 5 AS page_hash,
         min(l_partkey) AS part, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents,
         sum(CAST(l_quantity AS BIGINT)) AS qty, count(*) AS n
  FROM lineitem GROUP BY l_orderkey, l_linenumber
), cuts AS (
  SELECT doc, min(page_no) AS cut FROM (
    SELECT doc, page_no, row_number() OVER (PARTITION BY doc, page_hash ORDER BY page_no) AS nth
    FROM pages_of) WHERE nth > 1 GROUP BY doc
), kept AS (
  SELECT p.* FROM pages_of p LEFT JOIN cuts c ON p.doc = c.doc WHERE c.cut IS NULL OR p.page_no < c.cut
), judged AS (
  SELECT *, CASE WHEN doc % 17 = 3 AND page_no = 2 THEN 'MalformedJson'
                 WHEN doc % 19 = 4 AND page_no = 1 THEN 'MissingField' END AS error_type FROM kept
)
"""


def for_puts(rows: DataFrame) -> DataFrame:
    """Rows with a ``key``, dealt out: a put takes long beside reading its row, and a small file is read by one task."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, "key")


def customer_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``wave, key, raw``: one receipt object per customer, some delivered again.

    Wave 0 has all customers. Wave 1 has every fifth again under the same file name
    in another folder, with other values, and every seventh under a new name.
    Damaged are k % 11 = 3 of wave 0 (no JSON), and k % 10 = 5 of what comes again.
    """
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        "*",
        F.explode(
            F.filter(
                F.array(
                    F.lit("first"),
                    F.when(k % 5 == 0, "again"),
                    F.when(k % 7 == 0, "late"),
                ),
                lambda kind: kind.isNotNull(),
            )
        ).alias("kind"),
    )
    again = F.col("kind") == "again"
    date = F.date_add(F.lit("2020-01-01").cast("date"), (k % 700).cast("int"))
    kv = F.struct(
        F.array(*map(F.lit, ("NAME", "INVOICE_RECEIPT_DATE", "ADDRESS", "OTHER"))).alias("Type"),
        F.array(*map(F.lit, ("User", "", "other", " Mobile: "))).alias("Key"),
        F.array(
            F.when(again, F.concat("c_name", F.lit(" again"))).otherwise(F.col("c_name")),
            F.date_format(date, "yyyy-MM-dd"),
            F.concat("c_mktsegment", F.lit("\nhouse "), k),
            (k + 9_000_000_000).cast("string"),
        ).alias("Value"),
    )
    items = F.struct(
        F.when(again, F.array(F.lower("c_mktsegment"))).otherwise(F.array("c_mktsegment", F.lit("bag"))).alias("items"),
        F.when(again, F.array(k + 0.5)).otherwise(F.array(k + 0.25, F.lit(1.0))).alias("price"),
        F.when(again, F.array(F.lit("3"))).otherwise(F.array(F.lit("1"), F.lit("2"))).alias("quantity"),
    )
    envelope = F.to_json(
        F.struct(
            F.to_json(items).alias("lineitems"),
            F.to_json(kv).alias("kv_data"),
            F.lit("0:00:01").alias("time_taken"),
            (k + F.when(again, 0.5).otherwise(1.25)).alias("total_amount"),
        )
    )
    broken = ((F.col("kind") == "first") & (k % 11 == 3)) | (again & (k % 10 == 5))
    folder = F.when(again, "second").otherwise("first")
    name = F.concat(F.when(F.col("kind") == "late", "late ").otherwise("c"), k, F.lit(".json"))
    key = F.concat(
        F.lit("T"), k % 3, F.lit("/"), folder, F.lit("/S"), F.col("c_nationkey"), F.lit("/b/X"), k, F.lit("/c/textract/"), name
    )
    objects = rows.select(
        F.when(F.col("kind") == "first", 0).otherwise(1).alias("wave"),
        key.alias("key"),
        F.when(broken, F.concat(F.lit("{oops "), k)).otherwise(envelope).alias("raw"),
    )
    return for_puts(objects)


# The same objects, and which of them count in the end.
CUSTOMER_OBJECTS_SQL = """d AS (
  SELECT c_custkey AS k, c_name, c_nationkey, c_mktsegment, 'first' AS kind FROM customer
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_mktsegment, 'again' FROM customer WHERE c_custkey % 5 = 0
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_mktsegment, 'late' FROM customer WHERE c_custkey % 7 = 0),
judged AS (
  SELECT *, (kind = 'first' AND k % 11 = 3) OR (kind = 'again' AND k % 10 = 5) AS broken,
         CASE WHEN kind = 'late' THEN 'late ' ELSE 'c' END || k || '.json' AS name,
         'T' || k % 3 || CASE WHEN kind = 'again' THEN '/second' ELSE '/first' END || '/S' || c_nationkey || '/b/X' || k
           || '/c/textract/' AS folder FROM d),
latest AS (
  SELECT * FROM judged WHERE NOT broken
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY kind = 'again' DESC) = 1)
"""
