"""Queries for row-changing operators, sinks, streams and whole pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions import paths
from tillroll.operators import keys, kv, lineitems, pages, quality
from tillroll.plans import combined, receipts as plans, responses
from tillroll.sources import readers, writers
from tillroll.storage import work_path
from tillroll.sources.objects import write_objects
from tillroll.streaming.ingest import envelope_stream, ingest_available, read_table
from tillroll.streaming.ledger import ledger_ingest as ingest_unlisted, notified_ingest as ingest_notified, read_rows
from tillroll.workload import derive
from tillroll.workload.derive import BASE_SQL, CUSTOMER_OBJECTS_SQL, PAGES_SQL
from tillroll.workload.registry import query
from tillroll.workload.scalar_queries import joined

WITH = "WITH " + BASE_SQL

# --- key/value pairs -------------------------------------------------------------------

_LONG_SQL = """, entries AS (
  SELECT session, k, e.label, e.value, CAST(row_number() OVER (PARTITION BY session ORDER BY e.n) - 1 AS BIGINT) AS pos
  FROM (SELECT session, k, date_text, unnest([
      {'n': 0, 'label': 'USER', 'value': c_name},
      {'n': 1, 'label': 'INVOICERECEIPTDATE', 'value': date_text},
      {'n': 2, 'label': 'ADDRESS', 'value': address},
      {'n': 3, 'label': 'MOBILE', 'value': mobile},
      {'n': 4, 'label': 'USER', 'value': CASE WHEN k % 7 = 0 THEN 'Guest' END}]) AS e FROM base)
  WHERE e.value IS NOT NULL)
"""


def _long(spark, sf_dir):
    return kv.kv_long(kv.parse_kv(derive.kv_texts(spark, sf_dir)), ["session"])


@query(
    WITH
    + """, entries AS (SELECT session, unnest([
        {'n': 0, 'type': 'NAME', 'key': 'User', 'value': c_name},
        {'n': 1, 'type': 'DATE', 'key': '', 'value': date_text},
        {'n': 2, 'type': 'ADDRESS', 'key': 'other', 'value': address},
        {'n': 3, 'type': 'OTHER', 'key': ' Mobile: ', 'value': mobile},
        {'n': 4, 'type': 'NAME', 'key': 'User', 'value': CASE WHEN k % 7 = 0 THEN 'Guest' END},
        {'n': 8, 'type': 'tenant_ids', 'key': 'tenant_ids', 'value': tenant},
        {'n': 9, 'type': 'session_ids', 'key': 'session_ids', 'value': session},
        {'n': 10, 'type': 'store_ids', 'key': 'store_ids', 'value': store}]) AS e FROM base)
    SELECT session, CAST(row_number() OVER (PARTITION BY session ORDER BY e.n) - 1 + CASE WHEN e.n > 4 THEN 3 ELSE 0 END AS BIGINT) AS pos,
           e.type AS type, e.key AS key, e.value AS value FROM entries WHERE e.value IS NOT NULL"""
)
def parse_kv_json(spark, sf_dir):
    """Every entry but the three item lists and the total, which other queries compare."""
    parsed = kv.parse_kv(derive.enriched(spark, sf_dir))
    zipped = F.arrays_zip(*[F.col(f"kv.{name}").alias(name) for name in ("Type", "Key", "Value")])
    pairs = parsed.select("session", F.posexplode(zipped).alias("pos", "e"))
    return pairs.filter(~F.col("e.Type").isin("items", "price", "quantity", "total_amount")).select(
        "session",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("e.Type").alias("type"),
        F.col("e.Key").alias("key"),
        F.col("e.Value").alias("value"),
    )


@query(WITH + _LONG_SQL + "SELECT session, pos, label, value FROM entries")
def kv_long(spark, sf_dir):
    return _long(spark, sf_dir).withColumn("pos", F.col("pos").cast("bigint"))


_PIVOT_SQL = """SELECT session, c_name AS "USER", date_text AS INVOICERECEIPTDATE, address AS ADDRESS, mobile AS MOBILE"""


@query(WITH + _PIVOT_SQL + ", CAST(NULL AS VARCHAR) AS GSTIN FROM base")
def kv_pivot(spark, sf_dir):
    labels = ["USER", "INVOICERECEIPTDATE", "ADDRESS", "MOBILE", "GSTIN"]
    return kv.kv_pivot(_long(spark, sf_dir), ["session"], labels)


@query(
    WITH
    + """, wide AS (SELECT session, unnest([{'label': 'USER', 'value': c_name}, {'label': 'INVOICERECEIPTDATE', 'value': date_text},
      {'label': 'ADDRESS', 'value': address}, {'label': 'MOBILE', 'value': mobile}]) AS e FROM base)
    SELECT session, e.label AS label, e.value AS value FROM wide WHERE e.value IS NOT NULL"""
)
def kv_pivot_dynamic(spark, sf_dir):
    pivoted = kv.kv_pivot_dynamic(_long(spark, sf_dir), ["session"])
    return pivoted.select("session", F.explode("labels").alias("label", "value"))


@query(WITH + """SELECT session, c_name AS "USER", mobile AS MOBILE, store, tenant FROM base""")
def kv_join(spark, sf_dir):
    documents = derive.kv_texts(spark, sf_dir)
    wide = kv.kv_pivot(
        kv.kv_long(kv.parse_kv(documents), ["session"]), ["session"], ["USER", "MOBILE"]
    )
    return kv.kv_join(wide, documents.drop("kv_data"), ["session"])


# --- OCR responses ------------------------------------------------------------------------

_DOCS_SQL = """, docs AS (
  SELECT session, k, CAST(0 AS BIGINT) AS doc_no FROM base
  UNION ALL SELECT session, k, CAST(1 AS BIGINT) FROM base WHERE k % 11 = 0)
"""


def _documents(spark, sf_dir, last_only=False):
    parsed = derive.parsed_responses(spark, sf_dir)
    documents = plans.expense_documents(parsed, ["session"], last_only)
    return plans.with_bags(documents).withColumn("doc_no", F.col("doc_no").cast("bigint"))


_KV_ROWS_SQL = (
    WITH
    + """, entries AS (
      SELECT session, e.*, k FROM (SELECT session, k, unnest([
        {'n': 0, 'type': 'NAME', 'key': 'User', 'value': c_name, 'conf': 99.5},
        {'n': 1, 'type': 'INVOICE_RECEIPT_DATE', 'key': '', 'value': date_text, 'conf': 91.25},
        {'n': 2, 'type': 'ADDRESS', 'key': 'other', 'value': address, 'conf': NULL},
        {'n': 3, 'type': 'OTHER', 'key': ' Mobile: ', 'value': mobile, 'conf': 88.0},
        {'n': 4, 'type': 'NAME', 'key': 'User', 'value': CASE WHEN k % 7 = 0 THEN 'Guest' END, 'conf': 50.0}]) AS e
        FROM base) WHERE e.value IS NOT NULL)
    SELECT session, CAST(0 AS BIGINT) AS doc_no,
           CAST(row_number() OVER (PARTITION BY session ORDER BY n) - 1 AS BIGINT) AS pos, type, key, value,
           CAST(conf AS DOUBLE) AS key_confidence, CAST(conf AS DOUBLE) + 0.25 AS value_confidence FROM entries
    UNION ALL SELECT session, 1, 0, 'NAME', 'User', c_name, 99.5, 99.75 FROM base WHERE k % 11 = 0"""
)


@query(_KV_ROWS_SQL)
def extract_kv(spark, sf_dir):
    bags = _documents(spark, sf_dir).select("session", "doc_no", "kv.*")
    zipped = F.arrays_zip("Type", "Key", "Value", "KeyConfidence", "ValueConfidence")
    return bags.select("session", "doc_no", F.posexplode(zipped).alias("pos", "e")).select(
        "session",
        "doc_no",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("e.Type").alias("type"),
        F.col("e.Key").alias("key"),
        F.col("e.Value").alias("value"),
        F.col("e.KeyConfidence").alias("key_confidence"),
        F.col("e.ValueConfidence").alias("value_confidence"),
    )


_ITEM_ROWS_SQL = (
    WITH
    + """SELECT session, CAST(j - 1 AS BIGINT) AS pos, item_text AS item,
         CASE WHEN bad_price THEN 0.0 ELSE price END AS price, quantity_text AS quantity,
         95.5::DOUBLE AS item_confidence, 90.0::DOUBLE + ln AS price_confidence,
         CAST(NULL AS DOUBLE) AS quantity_confidence,
         bool_or(bad_price) OVER (PARTITION BY session) AS bad_price FROM items"""
)


@query(_ITEM_ROWS_SQL)
def extract_lineitems(spark, sf_dir):
    bags = _documents(spark, sf_dir).select("session", "li.*")
    zipped = F.arrays_zip(
        "items", "price", "quantity", "items_confidence", "price_confidence", "quantity_confidence"
    )
    return bags.select("session", "bad_price", F.posexplode(zipped).alias("pos", "e")).select(
        "session",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("e.items").alias("item"),
        F.col("e.price").alias("price"),
        F.col("e.quantity").alias("quantity"),
        F.col("e.items_confidence").alias("item_confidence"),
        F.col("e.price_confidence").alias("price_confidence"),
        F.col("e.quantity_confidence").alias("quantity_confidence"),
        "bad_price",
    )


_TOTALS_SQL = (
    _DOCS_SQL
    + """, totals AS (
  SELECT session, sum(CASE WHEN bad_price THEN 0 ELSE cents + j * 100 END) / 100.0 AS total
  FROM items GROUP BY session), doc_totals AS (
  SELECT d.session, d.k, d.doc_no, CASE WHEN d.doc_no = 0 THEN coalesce(t.total, 0.0) ELSE 0.0 END AS total
  FROM docs d LEFT JOIN totals t ON d.session = t.session)
"""
)


@query(WITH + _TOTALS_SQL + "SELECT session, doc_no, CAST(total AS DOUBLE) AS total FROM doc_totals")
def receipt_total(spark, sf_dir):
    documents = _documents(spark, sf_dir)
    total = plans.round_total(F.col("total")).alias("total")
    return documents.select("session", "doc_no", total)


@query(
    WITH
    + _TOTALS_SQL
    + """SELECT session, max(doc_no) AS doc_no, CAST(max_by(total, doc_no) AS DOUBLE) AS total
         FROM doc_totals GROUP BY session"""
)
def last_document_of_file(spark, sf_dir):
    documents = _documents(spark, sf_dir, last_only=True)
    total = plans.round_total(F.col("total")).alias("total")
    return documents.select("session", "doc_no", total)


_ENVELOPE_SQL = (
    _TOTALS_SQL
    + """, durations AS (
  SELECT session, seconds, CAST(floor(seconds) AS BIGINT) AS s FROM base), texts AS (
  SELECT session, CASE WHEN s >= 172800 THEN (s // 86400) || ' days, ' WHEN s >= 86400 THEN '1 day, '
      ELSE '' END || ((s % 86400) // 3600) || ':' || lpad(CAST((s % 3600) // 60 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST(s % 60 AS VARCHAR), 2, '0') ||
      CASE WHEN seconds > s THEN '.' || CAST(round((seconds - s) * 1000000) AS BIGINT) ELSE '' END AS time_taken
  FROM durations)
"""
)


def _envelopes(spark, sf_dir, pretty=False):
    parsed = derive.parsed_responses(spark, sf_dir)
    return plans.ocr_to_envelope(parsed, ["session", "path"], "seconds", pretty)


@query(
    WITH
    + _ENVELOPE_SQL
    + """SELECT d.session, d.doc_no, b.c_name AS first_value, d.total AS total_amount, t.time_taken,
         CASE WHEN d.doc_no = 0 THEN i.item_text END AS first_item,
         CASE WHEN d.doc_no = 0 THEN CASE WHEN i.bad_price THEN 0.0 ELSE i.price END END AS first_price,
         CASE WHEN d.doc_no = 0 AND b.n_items > 0 THEN '' END AS first_quantity_confidence,
         CASE WHEN d.doc_no = 0 THEN coalesce(f.bad, FALSE) ELSE FALSE END AS bad_price
         FROM doc_totals d JOIN base b ON d.session = b.session JOIN texts t ON d.session = t.session
         LEFT JOIN items i ON i.session = d.session AND i.j = 1
         LEFT JOIN (SELECT session, bool_or(bad_price) AS bad FROM items GROUP BY session) f
           ON f.session = d.session"""
)
def ocr_to_envelope(spark, sf_dir):
    made = _envelopes(spark, sf_dir)
    return made.select(
        "session",
        F.col("doc_no").cast("bigint").alias("doc_no"),
        F.get_json_object("kv_data", "$.Value[0]").alias("first_value"),
        F.col("Total_Amount").alias("total_amount"),
        "time_taken",
        F.get_json_object("lineitems", "$.items[0]").alias("first_item"),
        F.get_json_object("lineitems", "$.price[0]").try_cast("double").alias("first_price"),
        F.get_json_object("lineitems", "$.quantity_confidence[0]").alias("first_quantity_confidence"),
        "bad_price",
    )


@query(
    WITH
    + _ENVELOPE_SQL
    + """SELECT d.session, d.total AS total_amount, t.time_taken,
         CASE WHEN d.doc_no = 0 THEN i.item_text END AS first_item, b.c_name AS first_value
         FROM doc_totals d JOIN base b ON d.session = b.session JOIN texts t ON d.session = t.session
         LEFT JOIN items i ON i.session = d.session AND i.j = 1"""
)
def envelope_json(spark, sf_dir):
    texts = plans.envelope_json(_envelopes(spark, sf_dir, pretty=True), ["session"])
    read = F.from_json("envelope_json", schemas.ENVELOPE_MAP)
    parsed = texts.select("session", read.alias("e"))
    return parsed.select(
        "session",
        F.col("e")["Total_Amount"].cast("double").alias("total_amount"),
        F.col("e")["time_taken"].alias("time_taken"),
        F.get_json_object(F.col("e")["lineitems"], "$.items[0]").alias("first_item"),
        F.get_json_object(F.col("e")["kv_data"], "$.Value[0]").alias("first_value"),
    )


_KV_TEXT_BAG = "STRUCT<Type: ARRAY<STRING>, Key: ARRAY<STRING>, Value: ARRAY<STRING>, KeyConfidence: ARRAY<STRING>, ValueConfidence: ARRAY<STRING>>"
_ITEM_TEXT_BAG = "STRUCT<items: ARRAY<STRING>, price: ARRAY<STRING>, quantity: ARRAY<STRING>, items_confidence: ARRAY<STRING>, price_confidence: ARRAY<STRING>, quantity_confidence: ARRAY<STRING>>"


def _opened(made, keep, column, bag, names):
    """A JSON bag of parallel lists as rows, everything as text; ``""`` stands for a missing confidence."""
    opened = made.select(*keep, F.from_json(column, bag).alias("b"))
    zipped = F.arrays_zip(*[F.col(f"b.{n}").alias(n) for n in names])
    rows = opened.select(*keep, F.posexplode(zipped).alias("pos", "e"))
    return rows.select(*keep, F.col("pos").cast("bigint").alias("pos"), *[F.col("e")[n].alias(n) for n in names])


@query(_KV_ROWS_SQL)
def ocr_to_envelope_kv(spark, sf_dir):
    """Every entry of the key/value bags, read back from the envelope's JSON."""
    made = _envelopes(spark, sf_dir).withColumn("doc_no", F.col("doc_no").cast("bigint"))
    names = ["Type", "Key", "Value", "KeyConfidence", "ValueConfidence"]
    rows = _opened(made, ["session", "doc_no"], "kv_data", _KV_TEXT_BAG, names)
    return rows.select(
        "session",
        "doc_no",
        "pos",
        F.col("Type").alias("type"),
        F.col("Key").alias("key"),
        F.col("Value").alias("value"),
        F.col("KeyConfidence").try_cast("double").alias("key_confidence"),
        F.col("ValueConfidence").try_cast("double").alias("value_confidence"),
    )


@query(_ITEM_ROWS_SQL)
def ocr_to_envelope_items(spark, sf_dir):
    """Every line item, read back from the envelope's JSON."""
    names = ["items", "price", "quantity", "items_confidence", "price_confidence", "quantity_confidence"]
    rows = _opened(_envelopes(spark, sf_dir), ["session", "bad_price"], "lineitems", _ITEM_TEXT_BAG, names)
    return rows.select(
        "session",
        "pos",
        F.col("items").alias("item"),
        F.col("price").try_cast("double").alias("price"),
        "quantity",
        F.col("items_confidence").try_cast("double").alias("item_confidence"),
        F.col("price_confidence").try_cast("double").alias("price_confidence"),
        F.col("quantity_confidence").try_cast("double").alias("quantity_confidence"),
        "bad_price",
    )


# --- files and tables -------------------------------------------------------------------------


def _envelope_files(spark, sf_dir):
    """Envelopes written as JSON lines below receipt-style folders; returns the root."""
    root = work_path(spark, "envelopes")
    made = _envelopes(spark, sf_dir).withColumn("tenant", F.split("path", "/")[1])
    writers.write_envelopes(
        made.select("tenant", "lineitems", "kv_data", "time_taken", "Total_Amount"), root, ["tenant"]
    )
    return root


@query(
    WITH
    + _TOTALS_SQL
    + """SELECT 'tenant=' || b.tenant AS folder, b.c_name AS first_value, d.total AS total_amount
         FROM doc_totals d JOIN base b ON d.session = b.session"""
)
def scan_envelopes(spark, sf_dir):
    scanned = readers.scan_envelopes(spark, _envelope_files(spark, sf_dir), one_per_file=False)
    parsed = scanned.select("path", F.from_json("raw", schemas.ENVELOPE_MAP).alias("e"))
    return parsed.select(
        F.try_element_at(F.split("path", "/"), F.lit(-2)).alias("folder"),
        F.get_json_object(F.col("e")["kv_data"], "$.Value[0]").alias("first_value"),
        F.col("e")["Total_Amount"].cast("double").alias("total_amount"),
    )


@query(
    WITH
    + """SELECT session, c_name AS first_value, tenant FROM base"""
)
def scan_catalog(spark, sf_dir):
    derive.enriched(spark, sf_dir).createOrReplaceTempView("tillroll_enriched")
    parsed = kv.parse_kv(readers.scan_catalog(spark, "tillroll_enriched"))
    return parsed.select(
        F.try_element_at("kv.Value", F.lit(-3)).alias("session"),
        F.get("kv.Value", F.lit(0)).alias("first_value"),
        F.try_element_at("kv.Value", F.lit(-4)).alias("tenant"),
    )


_RAW_SQL = """SELECT b.session, coalesce(items, '') AS items, coalesce(prices, '') AS prices,
         coalesce(quantities, '') AS quantities FROM base b LEFT JOIN (
  SELECT session, string_agg(item_clean, '|' ORDER BY j) AS items,
         string_agg(quantity_text, '|' ORDER BY j) AS quantities,
         string_agg(CASE WHEN k % 2 = 0 THEN CASE WHEN bad_price THEN 'N/A' ELSE format('{:,.2f}', price) END
                    ELSE CAST(CASE WHEN bad_price THEN 0.0 ELSE price END AS VARCHAR) END, '|' ORDER BY j) AS prices
  FROM items GROUP BY session) i ON b.session = i.session"""


def _raw_texts(raw):
    return raw.select(
        F.col("SESSIONIDS").alias("session"),
        joined(F.col("ITEMS")).alias("items"),
        joined(F.col("PRICE")).alias("prices"),
        joined(F.col("QUANTITY")).alias("quantities"),
    )


@query(WITH + _RAW_SQL)
def lineitem_raw(spark, sf_dir):
    wide = plans.receipt_wide(derive.enriched(spark, sf_dir))
    return _raw_texts(lineitems.lineitem_raw(wide))


@query(WITH + _RAW_SQL)
def sink_parquet_roundtrip(spark, sf_dir):
    path = work_path(spark, "lineitem-raw")
    wide = plans.receipt_wide(derive.enriched(spark, sf_dir))
    writers.write_parquet(lineitems.lineitem_raw(wide), path)
    return _raw_texts(readers.scan_lineitem_raw(spark, path))


_LINEITEM_SQL = """SELECT item_clean AS "ITEMS", CASE WHEN bad_price AND k % 2 = 0 THEN -1.0
         WHEN bad_price THEN 0.0 ELSE price END AS "PRICE", quantity AS "QUANTITY", session AS "SESSIONID" FROM items"""


@query(WITH + _LINEITEM_SQL)
def lineitem_final(spark, sf_dir):
    return plans.lineitems(derive.enriched(spark, sf_dir))


@query(WITH + _LINEITEM_SQL)
def sink_json_roundtrip(spark, sf_dir):
    path = work_path(spark, "lineitem-json")
    writers.write_json(plans.lineitems(derive.enriched(spark, sf_dir)), path)
    return spark.read.schema(schemas.LINEITEM).json(path)


_KEYVALUE_SQL = """SELECT CASE WHEN k % 5 <> 0 THEN cents / 100.0 END AS "TOTAL_AMOUNT", store AS "STOREID",
         tenant AS "TENANTIDS", session AS "SESSIONID", c_name AS "NAME", receipt_date AS "DATES",
         replace(address, chr(10), ' ') AS "ADDRESS",
         CASE WHEN k % 13 <> 0 THEN CAST(mobile AS BIGINT) END AS "MOBILE" FROM base"""


@query(WITH + _KEYVALUE_SQL)
def keyvalue_final(spark, sf_dir):
    return plans.keyvalue_final(derive.enriched(spark, sf_dir))


@query(WITH + _KEYVALUE_SQL)
def sink_table_append(spark, sf_dir):
    location = work_path(spark, "keyvalue-table")
    table = "tillroll_keyvalue_" + location[-12:]
    result = plans.keyvalue_final(derive.enriched(spark, sf_dir))
    writers.append_table(result, table, schemas.KEYVALUE, location)
    return spark.table(table)


@query(
    WITH
    + """SELECT session AS "SESSIONIDS", c_name AS "USER", date_text AS "DATE", replace(address, chr(10), ' ') AS "ADDRESS",
         mobile AS "MOBILE", CASE WHEN k % 5 <> 0 THEN CAST(cents / 100.0 AS VARCHAR) END AS "TOTALAMOUNT",
         store AS "STOREIDS", tenant AS "TENANTIDS" FROM base"""
)
def kv_wide(spark, sf_dir):
    wide = plans.receipt_wide(derive.enriched(spark, sf_dir))
    return wide.drop("ITEMS", "PRICE", "QUANTITY")


@query(
    WITH
    + """SELECT path, CASE WHEN k % 29 = 7 OR k % 23 <> 5 THEN 'MalformedJson' ELSE 'MissingField' END AS error_type,
         CASE WHEN k % 29 = 7 THEN 'envelope' WHEN k % 23 = 5 THEN 'lineitems' ELSE 'kv_data' END AS error_message
         FROM paths WHERE k % 29 = 7 OR k % 23 = 5 OR k % 19 = 3"""
)
def quarantine(spark, sf_dir):
    checked = quality.check_envelopes(derive.envelopes(spark, sf_dir))
    return quality.quarantine(checked).drop("raw")


@query(
    WITH
    + """, named AS (SELECT 'in/' || session || '/' || (k % 1000) || '.json' AS path, cents, c_name FROM base)
    SELECT split_part(path, '/', -1) AS target, max(path) AS path, max_by(cents, path) AS cents,
           max_by(c_name, path) AS c_name FROM named GROUP BY 1"""
)
def dedup_last_by_basename(spark, sf_dir):
    name = F.concat(
        F.lit("in/"), "session", F.lit("/"), F.col("k") % 1000, F.lit(".json")
    )
    objects = derive.receipts(spark, sf_dir).select(name.alias("path"), "cents", "c_name")
    return quality.last_by_basename(objects)


# --- line items ----------------------------------------------------------------------------


@query(
    WITH
    + """, lens AS (SELECT session, n_items AS ni, greatest(n_items - CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END, 0) AS np,
        n_items + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS nq FROM base), pos AS (
      SELECT *, unnest(generate_series(1, CAST(greatest(ni, np, nq) AS BIGINT))) AS j FROM lens)
    SELECT CASE WHEN j <= ni THEN 'i' || j END AS "ITEMS", CASE WHEN j <= np THEN 'p' || j END AS "PRICE",
           CASE WHEN j <= nq THEN 'q' || j END AS "QUANTITY", CASE WHEN j <= ni THEN session END AS "SESSIONID" FROM pos"""
)
def lineitem_explode(spark, sf_dir):
    def texts(prefix, n):
        numbered = F.transform(F.sequence(F.lit(1), n), lambda j: F.concat(F.lit(prefix), j))
        return F.when(n > 0, numbered).otherwise(F.array().cast("array<string>"))

    n = F.col("n_items")
    fewer = n - F.when(F.col("k") % 3 == 0, 1).otherwise(0)
    more = n + F.when(F.col("k") % 5 == 0, 1).otherwise(0)
    raw = derive.receipts(spark, sf_dir).select(
        texts("i", n).alias("ITEMS"),
        texts("p", fewer).alias("PRICE"),
        texts("q", more).alias("QUANTITY"),
        F.col("session").alias("SESSIONIDS"),
    )
    return lineitems.explode_items(raw)


# --- enrichment --------------------------------------------------------------------------------


@query(
    WITH
    + """SELECT path, session AS session_id, store AS store_id, tenant AS tenant_id,
         'NAME|' || CASE WHEN k % 8 <> 7 THEN 'DATE|' ELSE '' END || 'ADDRESS|OTHER|' ||
         CASE WHEN k % 7 = 0 THEN 'NAME|' ELSE '' END ||
         'items|price|quantity|tenant_ids|session_ids|store_ids|total_amount' AS types,
         c_name AS first_value, coalesce(i.items, '') AS items, coalesce(t.total, 0.0) AS total_amount
    FROM paths LEFT JOIN (SELECT session AS s1, string_agg(item_clean, '|' ORDER BY j) AS items FROM items GROUP BY session) i
           ON session = s1
    LEFT JOIN (SELECT session AS s2, sum(CASE WHEN bad_price THEN 0 ELSE cents + j * 100 END) / 100.0 AS total
           FROM items GROUP BY session) t ON session = s2
    WHERE k % 17 <> 0 AND k % 29 <> 7 AND k % 23 <> 5 AND k % 19 <> 3"""
)
def enrich_envelopes(spark, sf_dir):
    made = plans.enrich_envelopes(derive.envelopes(spark, sf_dir))
    parsed = kv.parse_kv(made)
    return parsed.select(
        "path",
        "session_id",
        "store_id",
        "tenant_id",
        joined(F.col("kv.Type")).alias("types"),
        F.get("kv.Value", F.lit(0)).alias("first_value"),
        joined(lineitems.clean_items(F.try_element_at("kv.Value", F.lit(-7)))).alias("items"),
        F.try_element_at("kv.Value", F.lit(-1)).try_cast("double").alias("total_amount"),
    )


@query(
    WITH
    + """, entries AS (SELECT path, k, unnest([
        {'n': 0, 'type': 'NAME', 'key': 'User', 'value': c_name},
        {'n': 1, 'type': 'DATE', 'key': '', 'value': date_text},
        {'n': 2, 'type': 'ADDRESS', 'key': 'other', 'value': address},
        {'n': 3, 'type': 'OTHER', 'key': ' Mobile: ', 'value': mobile},
        {'n': 4, 'type': 'NAME', 'key': 'User', 'value': CASE WHEN k % 7 = 0 THEN 'Guest' END},
        {'n': 8, 'type': 'tenant_ids', 'key': 'tenant_ids', 'value': tenant},
        {'n': 9, 'type': 'session_ids', 'key': 'session_ids', 'value': session},
        {'n': 10, 'type': 'store_ids', 'key': 'store_ids', 'value': store}]) AS e FROM paths
      WHERE k % 17 <> 0 AND k % 29 <> 7 AND k % 23 <> 5 AND k % 19 <> 3)
    SELECT path, CAST(row_number() OVER (PARTITION BY path ORDER BY e.n) - 1 + CASE WHEN e.n > 4 THEN 3 ELSE 0 END AS BIGINT) AS pos,
           e.type AS type, e.key AS key, e.value AS value FROM entries WHERE e.value IS NOT NULL"""
)
def enrich_envelopes_kv(spark, sf_dir):
    """Every entry of the enriched bags but the item lists and the total."""
    made = plans.enrich_envelopes(derive.envelopes(spark, sf_dir))
    rows = _opened(made, ["path"], "kv_data", _KV_TEXT_BAG, ["Type", "Key", "Value"])
    kept = rows.filter(~F.col("Type").isin("items", "price", "quantity", "total_amount"))
    return kept.select("path", "pos", F.col("Type").alias("type"), F.col("Key").alias("key"), F.col("Value").alias("value"))


@query(
    WITH
    + """SELECT path, CAST(j - 1 AS BIGINT) AS pos, item_text AS item, CASE WHEN bad_price THEN 0.0 ELSE price END AS price,
         quantity_text AS quantity FROM items JOIN paths USING (session)
         WHERE paths.k % 17 <> 0 AND paths.k % 29 <> 7 AND paths.k % 23 <> 5 AND paths.k % 19 <> 3"""
)
def enrich_envelopes_items(spark, sf_dir):
    """Every line item of the enriched envelopes."""
    made = plans.enrich_envelopes(derive.envelopes(spark, sf_dir))
    rows = _opened(made, ["path"], "lineitems", _ITEM_TEXT_BAG, ["items", "price", "quantity"])
    price = F.col("price").try_cast("double").alias("price")
    return rows.select("path", "pos", F.col("items").alias("item"), price, "quantity")


_CHAIN_SQL = (
    _TOTALS_SQL
    + """SELECT CAST(d.total AS DOUBLE) AS "TOTAL_AMOUNT", b.store AS "STOREID", b.tenant AS "TENANTIDS",
         b.session AS "SESSIONID", b.c_name AS "NAME",
         CASE WHEN d.doc_no = 0 THEN b.receipt_date END AS "DATES",
         CASE WHEN d.doc_no = 0 THEN replace(b.address, chr(10), ' ') END AS "ADDRESS",
         CASE WHEN d.doc_no = 0 AND b.k % 13 <> 0 THEN CAST(b.mobile AS BIGINT) END AS "MOBILE"
         FROM doc_totals d JOIN base b ON d.session = b.session WHERE b.k % 17 <> 0"""
)


def _raw_envelopes(spark, sf_dir):
    made = _envelopes(spark, sf_dir)
    raw = F.to_json(F.struct("lineitems", "kv_data", "time_taken", "Total_Amount"))
    return made.select("path", raw.alias("raw"))


@query(WITH + _CHAIN_SQL)
def responses_to_keyvalue(spark, sf_dir):
    """The whole chain: OCR response, envelope, enrichment, typed table."""
    return plans.keyvalue_final(plans.enrich_envelopes(_raw_envelopes(spark, sf_dir)))


_CHAIN_ITEMS_SQL = """SELECT item_clean AS "ITEMS", CASE WHEN bad_price THEN 0.0 ELSE price END AS "PRICE",
         quantity AS "QUANTITY", session AS "SESSIONID" FROM items WHERE k % 17 <> 0"""


@query(WITH + _CHAIN_SQL)
def responses_to_keyvalue_direct(spark, sf_dir):
    """The same rows without envelope JSON between the stages."""
    return plans.keyvalue_from_wide(plans.wide_from_responses(derive.parsed_responses(spark, sf_dir)))


@query(WITH + _CHAIN_ITEMS_SQL)
def responses_to_lineitem_direct(spark, sf_dir):
    return plans.lineitems_from_wide(plans.wide_from_responses(derive.parsed_responses(spark, sf_dir)))


@query(WITH + _CHAIN_ITEMS_SQL)
def responses_to_lineitem(spark, sf_dir):
    return plans.lineitems(plans.enrich_envelopes(_raw_envelopes(spark, sf_dir)))


_UNDAMAGED = "b.k % 29 <> 7 AND b.k % 23 <> 5 AND b.k % 19 <> 3"


def _response_tables(spark, sf_dir):
    return responses.response_tables(derive.damaged_responses(spark, sf_dir), raw="response")


@query(WITH + _CHAIN_SQL + " AND " + _UNDAMAGED)
def response_tables(spark, sf_dir):
    """``keyvalue`` of responses some of which are broken."""
    return _response_tables(spark, sf_dir).keyvalue


@query(WITH + _CHAIN_ITEMS_SQL + " AND " + _UNDAMAGED.replace("b.k", "k"))
def response_tables_items(spark, sf_dir):
    return _response_tables(spark, sf_dir).lineitem


@query(
    WITH
    + """SELECT path, CASE WHEN k % 29 <> 7 AND k % 23 <> 5 THEN 0 END AS doc_no, 'response' AS stage,
         CASE WHEN k % 29 = 7 THEN 'MalformedJson' ELSE 'MissingField' END AS error_type,
         CASE WHEN k % 29 = 7 THEN 'response' WHEN k % 23 = 5 THEN 'ExpenseDocuments' ELSE 'LineItemGroups' END AS error_message,
         CASE WHEN k % 29 = 7 THEN '{oops' WHEN k % 23 = 5 THEN '{}'
              ELSE '{"ExpenseDocuments": [{"SummaryFields": []}]}' END AS raw
         FROM paths WHERE k % 17 <> 0 AND (k % 29 = 7 OR k % 23 = 5 OR k % 19 = 3)"""
)
def response_rejects(spark, sf_dir):
    """Every response that gave no document, with its text."""
    return _response_tables(spark, sf_dir).rejects


@query(
    WITH
    + """SELECT DISTINCT path, 'BadPrice' AS error_type, 'price' AS error_message FROM items JOIN paths USING (session)
         WHERE bad_price AND paths.k % 17 <> 0 AND """
    + _UNDAMAGED.replace("b.k", "paths.k")
)
def response_warnings(spark, sf_dir):
    """Responses with a price that counts as 0.0."""
    return _response_tables(spark, sf_dir).warnings.select("path", "error_type", "error_message").distinct()


@query(
    WITH
    + """, judged AS (SELECT *, k % 29 = 7 OR k % 23 = 5 OR k % 19 = 3 AS damaged FROM base)
    SELECT session, CASE WHEN damaged THEN 'rejected' ELSE 'built' END AS way FROM judged"""
)
def response_envelopes(spark, sf_dir):
    """Every response goes exactly one way."""
    made = responses.response_envelopes(
        derive.damaged_responses(spark, sf_dir).withColumn("seconds", F.lit(1.5)), ["session"], "seconds", raw="response"
    )
    built = made.documents.select("session", F.lit("built").alias("way"))
    return built.unionAll(made.rejects.select("session", F.lit("rejected").alias("way"))).distinct()


@query(WITH + _KEYVALUE_SQL)
def receipt_tables(spark, sf_dir):
    """The first of both tables from one parse."""
    return plans.receipt_tables(derive.enriched(spark, sf_dir))[0]


@query(WITH + _LINEITEM_SQL)
def receipt_tables_items(spark, sf_dir):
    """The second of both tables from one parse."""
    return plans.receipt_tables(derive.enriched(spark, sf_dir))[1]


def _streamed(spark, sf_dir, name):
    """Envelope files, some damaged, through the file stream.

    Files hold many envelopes each, so the ids a path carries are per file and
    are left out. Damage by order key: k % 23 = 5 no line items, k % 19 = 3 a
    broken key/value bag.
    """
    root, out = work_path(spark, "incoming"), work_path(spark, "streamed")
    k = F.regexp_extract("session", "^S([0-9]+)-", 1).cast("bigint")
    damaged = _envelopes(spark, sf_dir).select(
        F.when(k % 23 != 5, F.col("lineitems")).alias("lineitems"),
        F.when(k % 19 == 3, "{oops").otherwise(F.col("kv_data")).alias("kv_data"),
        "time_taken",
        "Total_Amount",
    )
    writers.write_envelopes(damaged, f"{root}/textract")
    incoming = envelope_stream(spark, root, one_per_file=False)
    ingest_available(incoming, out, work_path(spark, "stream-checkpoints"))
    return read_table(spark, out, name)


_STREAM_GOOD = "k % 23 <> 5 AND k % 19 <> 3"


@query(
    WITH
    + _TOTALS_SQL
    + """SELECT CAST(d.total AS DOUBLE) AS "TOTAL_AMOUNT", b.c_name AS "NAME",
         CASE WHEN d.doc_no = 0 THEN b.receipt_date END AS "DATES",
         CASE WHEN d.doc_no = 0 THEN replace(b.address, chr(10), ' ') END AS "ADDRESS",
         CASE WHEN d.doc_no = 0 AND b.k % 13 <> 0 THEN CAST(b.mobile AS BIGINT) END AS "MOBILE"
         FROM doc_totals d JOIN base b ON d.session = b.session WHERE b."""
    + _STREAM_GOOD.replace("AND k", "AND b.k")
)
def stream_ingest(spark, sf_dir):
    rows = _streamed(spark, sf_dir, "keyvalue")
    return rows.select("TOTAL_AMOUNT", "NAME", "DATES", "ADDRESS", "MOBILE")


@query(
    WITH
    + """SELECT item_clean AS "ITEMS", CASE WHEN bad_price THEN 0.0 ELSE price END AS "PRICE", quantity AS "QUANTITY"
         FROM items WHERE """
    + _STREAM_GOOD
)
def stream_lineitem(spark, sf_dir):
    return _streamed(spark, sf_dir, "lineitem").drop("SESSIONID")


@query(
    WITH
    + _DOCS_SQL
    + """SELECT CASE WHEN k % 23 = 5 THEN 'MissingField' ELSE 'MalformedJson' END AS error_type,
         CASE WHEN k % 23 = 5 THEN 'lineitems' ELSE 'kv_data' END AS error_message
         FROM docs WHERE NOT ("""
    + _STREAM_GOOD
    + ")"
)
def stream_quarantine(spark, sf_dir):
    return _streamed(spark, sf_dir, "quarantine").select("error_type", "error_message")


# --- objects, ledger, last writer ------------------------------------------------------------


def _delivered(spark, sf_dir, name):
    """Two waves of objects, each taken in by a run of its own, and a run that finds nothing new."""
    root, out = work_path(spark, "objects"), work_path(spark, "merged")
    objects = derive.customer_objects(spark, sf_dir)
    for wave in (0, 1, 2):
        write_objects(objects.filter(F.col("wave") == wave), root, "key", "raw")
        ingest_unlisted(spark, root, out, buckets=16)
    rows = read_rows(spark, out, name)
    if "path" in rows.columns:
        # What lies below the folder of this run.
        key = F.regexp_extract("path", "(T[0-9]+/(?:first|second)/.*)$", 1)
        rows = rows.withColumn("path", key)
    return rows


_LATEST_KEYVALUE_SQL = (
    "WITH "
    + CUSTOMER_OBJECTS_SQL
    + """SELECT k + CASE WHEN kind = 'again' THEN 0.5 ELSE 1.25 END::DOUBLE AS "TOTAL_AMOUNT", 'S' || c_nationkey AS "STOREID",
         'T' || k % 3 AS "TENANTIDS", 'X' || k AS "SESSIONID", c_name || CASE WHEN kind = 'again' THEN ' again' ELSE '' END AS "NAME",
         DATE '2020-01-01' + CAST(k % 700 AS INTEGER) AS "DATES", c_mktsegment || ' house ' || k AS "ADDRESS",
         k + 9000000000 AS "MOBILE" FROM latest"""
)


@query(_LATEST_KEYVALUE_SQL)
def ledger_ingest(spark, sf_dir):
    """All columns of ``keyvalue`` from per-receipt folders, the last delivery of each file name."""
    return _delivered(spark, sf_dir, "keyvalue")


@query(
    "WITH "
    + CUSTOMER_OBJECTS_SQL
    + """SELECT upper(c_mktsegment) AS "ITEMS", (k + CASE WHEN kind = 'again' THEN 0.5 ELSE 0.25 END)::DOUBLE AS "PRICE",
         CASE WHEN kind = 'again' THEN 3 ELSE 1 END::DOUBLE AS "QUANTITY", 'X' || k AS "SESSIONID" FROM latest
       UNION ALL SELECT 'BAG', 1.0::DOUBLE, 2.0::DOUBLE, 'X' || k FROM latest WHERE kind <> 'again'"""
)
def ledger_last_writer(spark, sf_dir):
    """All columns of ``lineitem``: a redelivered receipt's items replace the earlier ones."""
    return _delivered(spark, sf_dir, "lineitem")


@query(
    "WITH "
    + CUSTOMER_OBJECTS_SQL
    + """SELECT folder || name AS path, 'MalformedJson' AS error_type, 'envelope' AS error_message, '{oops ' || k AS raw
         FROM judged WHERE broken"""
)
def ledger_quarantine(spark, sf_dir):
    return _delivered(spark, sf_dir, "quarantine")


@query(
    "WITH "
    + CUSTOMER_OBJECTS_SQL
    + """, counted AS (SELECT CASE WHEN kind = 'first' THEN 0 ELSE 1 END::BIGINT AS batch, * FROM judged)
    SELECT batch, count(*) AS objects, 0::BIGINT AS superseded, count_if(NOT broken)::BIGINT AS accepted,
           count_if(broken)::BIGINT AS malformed, 0::BIGINT AS missing_field, 0::BIGINT AS missing_object,
           0::BIGINT AS missing_text, 0::BIGINT AS missing_date FROM counted GROUP BY batch"""
)
def ledger_metrics(spark, sf_dir):
    """What was observed on the way, one row per batch."""
    return _delivered(spark, sf_dir, "metrics")


@query(_LATEST_KEYVALUE_SQL)
def notified_ingest(spark, sf_dir):
    """Objects read because notifications name them, every notification delivered twice."""
    root, out = work_path(spark, "objects"), work_path(spark, "notified")
    objects = derive.customer_objects(spark, sf_dir)
    for wave in (0, 1):
        part = objects.filter(F.col("wave") == wave)
        write_objects(part, f"{root}/bills", "key", "raw")
        escaped = F.replace("key", F.lit(" "), F.lit("+"))
        one = F.struct(
            F.struct(
                F.struct(F.lit("bills").alias("name")).alias("bucket"),
                F.struct(escaped.alias("key"), F.lit(f"v{wave}").alias("versionId")).alias("object"),
            ).alias("s3")
        )
        events = part.select(F.to_json(F.struct(F.array(one).alias("Records"))).alias("event"))
        ingest_notified(events.unionAll(events), root, out, buckets=16)
    return read_rows(spark, out, "keyvalue")


def _streamed_objects(spark, sf_dir, name):
    """The first wave of objects, in per-receipt folders, through the file stream."""
    root, out = work_path(spark, "objects"), work_path(spark, "streamed")
    write_objects(derive.customer_objects(spark, sf_dir).filter("wave = 0"), root, "key", "raw")
    ingest_available(envelope_stream(spark, root), out, work_path(spark, "stream-checkpoints"))
    return read_table(spark, out, name)


@query(_LATEST_KEYVALUE_SQL.replace("FROM latest", "FROM judged WHERE kind = 'first' AND NOT broken"))
def stream_objects(spark, sf_dir):
    """All columns of ``keyvalue``, ids from the paths, through the stream."""
    return _streamed_objects(spark, sf_dir, "keyvalue")


@query(
    "WITH "
    + CUSTOMER_OBJECTS_SQL
    + """SELECT upper(c_mktsegment) AS "ITEMS", (k + 0.25)::DOUBLE AS "PRICE", 1.0::DOUBLE AS "QUANTITY", 'X' || k AS "SESSIONID"
         FROM judged WHERE kind = 'first' AND NOT broken
       UNION ALL SELECT 'BAG', 1.0::DOUBLE, 2.0::DOUBLE, 'X' || k FROM judged WHERE kind = 'first' AND NOT broken"""
)
def stream_objects_items(spark, sf_dir):
    return _streamed_objects(spark, sf_dir, "lineitem")


@query(
    "WITH "
    + CUSTOMER_OBJECTS_SQL
    + """SELECT folder || name AS path, 'MalformedJson' AS error_type, 'envelope' AS error_message, '{oops ' || k AS raw
         FROM judged WHERE kind = 'first' AND broken"""
)
def stream_objects_quarantine(spark, sf_dir):
    rows = _streamed_objects(spark, sf_dir, "quarantine")
    return rows.withColumn("path", F.regexp_extract("path", "(T[0-9]+/first/.*)$", 1))


@query(
    """SELECT 'analyze-expense-output/' || c_name || '-' || strftime(TIMESTAMP '2024-02-28 23:00:00' + to_seconds(c_custkey),
         '%Y-%m-%d-%H-%M-%S') || '-extracted.json' AS key, 'total ' || c_custkey || chr(10) || c_mktsegment AS content FROM customer"""
)
def object_sink(spark, sf_dir):
    """One object per row under its output key; names and contents as they lie in the store."""
    root = work_path(spark, "objects")
    k = F.col("c_custkey")
    created = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-02-28 23:00:00")) + k)
    key = paths.extracted_key(F.concat(F.lit("in/"), "c_name", F.lit(".v1.pdf")), created)
    content = F.concat(F.lit("total "), k, F.lit("\n"), "c_mktsegment")
    rows = derive.table(spark, sf_dir, "customer").select(key.alias("key"), content.alias("content"))
    write_objects(derive.for_puts(rows), root, "key", "content")
    stored = readers.scan_envelopes(spark, root)
    return stored.select(F.regexp_extract("path", "(analyze-expense-output/.*)$", 1).alias("key"), F.col("raw").alias("content"))


# --- pages -------------------------------------------------------------------------------------


@query("WITH " + PAGES_SQL + "SELECT doc, count(*) AS pages FROM pages_of GROUP BY doc")
def page_count(spark, sf_dir):
    return pages.page_count(derive.order_pages(spark, sf_dir), "doc")


@query(
    "WITH "
    + PAGES_SQL
    + """, n AS (SELECT doc, count(*) AS pages FROM pages_of GROUP BY doc)
    SELECT o_orderkey AS doc, CASE WHEN o_orderkey % 2 = 0 THEN 'pdf' ELSE 'image' END AS kind, pages,
           CASE WHEN o_orderkey % 2 = 1 THEN 'single' WHEN pages IS NULL THEN 'quarantine'
                WHEN pages > 1 THEN 'multi' ELSE 'single' END AS route
    FROM orders LEFT JOIN n ON o_orderkey = doc"""
)
def route_documents(spark, sf_dir):
    k = F.col("o_orderkey")
    suffix = F.when(k % 2 == 0, ".v1.PDF").otherwise(".jpg")
    files = derive.table(spark, sf_dir, "orders").select(
        k.alias("doc"), F.concat(F.lit("in box/"), k, suffix).alias("key")
    )
    counts = pages.page_count(derive.order_pages(spark, sf_dir), "doc")
    return pages.route_documents(files, counts, "doc", "key").drop("key")


@query("WITH " + PAGES_SQL + "SELECT doc, page_no, page_hash FROM kept")
def pages_before_duplicate(spark, sf_dir):
    table = derive.order_pages(spark, sf_dir).select("doc", "page_no", "page_hash")
    return pages.pages_before_duplicate(table, "doc", "page_no", "page_hash")


_DOCUMENT_PAGES_SQL = """WITH p AS (
  SELECT source AS doc, doc_id AS page_no, md5(text) AS page_hash FROM documents), r AS (
  SELECT *, row_number() OVER (PARTITION BY doc, page_hash ORDER BY page_no) AS nth FROM p)
"""


def _document_pages(spark, sf_dir):
    return derive.table(spark, sf_dir, "documents").select(
        F.col("source").alias("doc"), F.col("doc_id").alias("page_no"), F.md5("text").alias("page_hash")
    )


@query(
    _DOCUMENT_PAGES_SQL
    + """, c AS (SELECT doc, min(page_no) AS cut FROM r WHERE nth > 1 GROUP BY doc)
    SELECT r.doc, page_no, page_hash FROM r LEFT JOIN c ON r.doc = c.doc WHERE cut IS NULL OR page_no < cut"""
)
def pages_before_duplicate_by_source(spark, sf_dir):
    """Few documents with very many pages each: every document is a hot key."""
    return pages.pages_before_duplicate(_document_pages(spark, sf_dir), "doc", "page_no", "page_hash")


@query(_DOCUMENT_PAGES_SQL + "SELECT doc, page_no, page_hash FROM r WHERE nth = 1")
def pages_without_duplicates(spark, sf_dir):
    return pages.pages_before_duplicate(
        _document_pages(spark, sf_dir), "doc", "page_no", "page_hash", drop_only_duplicates=True
    )


@query(
    "WITH "
    + PAGES_SQL
    + """SELECT doc, CAST(sum(CASE WHEN page_no % 5 <> 3 THEN cents END) / 100.0 AS DOUBLE) AS total_amount,
         count_if(page_no % 5 = 3)::BIGINT AS pages_without_total FROM pages_of GROUP BY doc"""
)
def document_total(spark, sf_dir):
    known = F.when(F.col("page_no") % 5 != 3, F.col("cents") / 100.0)
    table = derive.order_pages(spark, sf_dir).withColumn("total", known)
    return pages.document_total(table, "doc", "total")


@query(
    "WITH "
    + PAGES_SQL
    + """SELECT doc, page_no, 0 AS pos, 'part ' || part AS items, CAST(qty AS VARCHAR) AS quantity FROM pages_of
         UNION ALL SELECT doc, page_no, 1, 'fee', '' FROM pages_of WHERE n > 1"""
)
def combine_pages(spark, sf_dir):
    def with_fee(first, second):
        return F.when(F.col("n") > 1, F.array(first, second)).otherwise(F.array(first))

    table = derive.order_pages(spark, sf_dir).select(
        "doc",
        "page_no",
        with_fee(F.concat(F.lit("part "), "part"), F.lit("fee")).alias("items"),
        with_fee(F.col("qty").cast("string"), F.lit("")).alias("quantity"),
    )
    return pages.combine_pages(table, "doc", ["page_no"], ["items", "quantity"])


@query(
    """SELECT event_type AS doc, event_id AS page_no, 0 AS pos, props AS items, user_id AS users FROM events
       UNION ALL SELECT event_type, event_id, 1, event_type, event_id FROM events WHERE event_id % 3 = 0"""
)
def combine_pages_by_event_type(spark, sf_dir):
    """A handful of documents with thousands of pages each."""
    third = F.col("event_id") % 3 == 0
    table = derive.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("doc"),
        F.col("event_id").alias("page_no"),
        F.when(third, F.array("props", "event_type")).otherwise(F.array("props")).alias("items"),
        F.when(third, F.array("user_id", "event_id")).otherwise(F.array("user_id")).alias("users"),
    )
    return pages.combine_pages(table, "doc", ["page_no"], ["items", "users"])


@query(
    "WITH "
    + PAGES_SQL
    + """, f AS (SELECT doc, 'part' || page_hash AS field, page_no, part, qty FROM pages_of)
    SELECT doc, field, page_no, 0 AS pos, CAST(part AS VARCHAR) AS value FROM f
    UNION ALL SELECT doc, field, page_no, 1, CAST(qty AS VARCHAR) FROM f"""
)
def combine_fields(spark, sf_dir):
    fields = F.create_map(
        F.concat(F.lit("part"), "page_hash"),
        F.array(F.col("part").cast("string"), F.col("qty").cast("string")),
    )
    table = derive.order_pages(spark, sf_dir).select("doc", "page_no", fields.alias("fields"))
    return pages.combine_fields(table, "doc", "page_no", "fields")


def _multipage(spark, sf_dir):
    responses = derive.page_responses(spark, sf_dir)
    return plans.multipage_document(responses, "doc", "page_no", "page_hash", "response")


@query(
    "WITH "
    + PAGES_SQL
    + """SELECT doc, page_no, 0 AS doc_no, 0 AS pos, 'PAGE' AS "Type", 'Page' AS "Key", 'page ' || page_no AS "Value",
         80.0::DOUBLE AS "KeyConfidence", 81.0::DOUBLE AS "ValueConfidence" FROM judged WHERE error_type IS NULL"""
)
def multipage_document(spark, sf_dir):
    """The merged fields of every document."""
    return _multipage(spark, sf_dir)[0]


@query(
    "WITH "
    + PAGES_SQL
    + """, lines AS (
      SELECT doc, page_no, 0 AS pos, 'part ' || part AS items, cents / 100.0 AS price, CAST(qty AS VARCHAR) AS quantity
      FROM judged WHERE error_type IS NULL
      UNION ALL SELECT doc, page_no, 1, 'fee', 1.5, '' FROM judged WHERE error_type IS NULL AND n > 1)
    SELECT doc, page_no, 0 AS doc_no, pos, items, CAST(price AS DOUBLE) AS price, quantity,
           90.0::DOUBLE AS items_confidence, 90.0::DOUBLE AS price_confidence, 90.0::DOUBLE AS quantity_confidence
    FROM lines"""
)
def multipage_items(spark, sf_dir):
    return _multipage(spark, sf_dir)[1]


@query(
    "WITH "
    + PAGES_SQL
    + """SELECT doc, count_if(error_type IS NOT NULL)::BIGINT AS rejected,
         CAST(sum(CASE WHEN error_type IS NULL THEN cents + CASE WHEN n > 1 THEN 150 ELSE 0 END END) / 100.0 AS DOUBLE)
           AS total_amount FROM judged GROUP BY doc"""
)
def multipage_totals(spark, sf_dir):
    return _multipage(spark, sf_dir)[2]


def _bag_sql(source, section, bags):
    """Element lines of a section: one row per list, in the order of ``bags``."""
    texts = ", ".join(f"{{'list': {i}, 'text': {text}}}" for i, text in enumerate(bags))
    first = "row_number() OVER (PARTITION BY doc ORDER BY page_no, pos) = 1"
    return f"""SELECT doc, {section} AS section, l.list AS list, 1 AS part, page_no AS page, 0 AS doc_no, pos,
      CASE WHEN nth THEN '' ELSE ',' END || l.text AS line
      FROM (SELECT doc, page_no, pos, {first} AS nth, unnest([{texts}]) AS l FROM {source})"""


_FRAME = [
    '{"SummaryData": {"Type": [', "],", '"Key": [', "],", '"Value": [', "],", '"KeyConfidence": [', "],", '"ValueConfidence": [', "]},",
    '"LineItemsData": {"items": [', "],", '"price": [', "],", '"quantity": [', "],", '"items_confidence": [', "],",
    '"price_confidence": [', "],", '"quantity_confidence": [', "]},",
]
_FRAME_SQL = ", ".join(
    f"{{'section': {i // 10 if i < 10 else 1}, 'list': {(i if i < 10 else i - 10) // 2}, 'part': {i % 2 * 2}, 'line': '{line}'}}"
    for i, line in enumerate(_FRAME)
)


@query(
    "WITH "
    + PAGES_SQL
    + """, good AS (SELECT * FROM judged WHERE error_type IS NULL), f AS (SELECT doc, page_no, 0 AS pos FROM good), i AS (
      SELECT doc, page_no, 0 AS pos, 'part ' || part AS items, CAST(cents / 100.0 AS DOUBLE) AS price, CAST(qty AS VARCHAR) AS quantity FROM good
      UNION ALL SELECT doc, page_no, 1, 'fee', 1.5, '' FROM good WHERE n > 1),
    t AS (SELECT doc, coalesce(sum(CASE WHEN error_type IS NULL THEN cents + CASE WHEN n > 1 THEN 150 ELSE 0 END END), 0) AS cents
          FROM judged GROUP BY doc)
    """
    + _bag_sql("f", 0, ["'\"PAGE\"'", "'\"Page\"'", "'\"page ' || page_no || '\"'", "'80.0'", "'81.0'"])
    + " UNION ALL "
    + _bag_sql("i", 1, ["'\"' || items || '\"'", "CAST(price AS VARCHAR)", "'\"' || quantity || '\"'", "'90.0'", "'90.0'", "'90.0'"])
    + """ UNION ALL SELECT doc, l.section, l.list, l.part, 0, 0, 0, l.line FROM (SELECT doc, unnest(["""
    + _FRAME_SQL
    + """]) AS l FROM t)
    UNION ALL SELECT doc, 2, 0, 0, 0, 0, 0, '"TotalAmount": ' || CAST(CAST(cents / 100.0 AS DECIMAL(28, 2)) AS VARCHAR) || '}' FROM t"""
)
def combined_document(spark, sf_dir):
    """The JSON of every merged document, line by line with its place."""
    fields, items, totals, _ = _multipage(spark, sf_dir)
    return combined.combined_lines(fields, items, totals, "doc", "page_no")


@query(
    "WITH "
    + PAGES_SQL
    + """SELECT doc, page_no, error_type, CASE WHEN error_type = 'MalformedJson' THEN 'response' ELSE 'SummaryFields' END
         AS error_message FROM judged WHERE error_type IS NOT NULL"""
)
def quarantine_pages(spark, sf_dir):
    return _multipage(spark, sf_dir)[3].drop("raw")


_DAMAGE_SQL = """, damaged AS (SELECT session, path, CASE WHEN k % 29 = 7 THEN 'response' WHEN k % 23 = 5 THEN 'ExpenseDocuments'
      WHEN k % 19 = 3 THEN 'LineItemGroups' END AS error_message FROM paths)
"""


@query(
    WITH
    + _DAMAGE_SQL
    + """SELECT session, 'response' AS stage, CASE WHEN error_message = 'response' THEN 'MalformedJson' ELSE 'MissingField' END
         AS error_type, error_message,
         CASE error_message WHEN 'response' THEN '{oops' WHEN 'ExpenseDocuments' THEN '{}'
              ELSE '{"ExpenseDocuments": [{"SummaryFields": []}]}' END AS raw FROM damaged WHERE error_message IS NOT NULL"""
)
def quarantine_responses(spark, sf_dir):
    checked = quality.check_responses(derive.damaged_responses(spark, sf_dir), "response")
    return quality.rejected(checked, "response", ["session"], "response")


@query(
    """SELECT o_orderkey AS k, 'notification' AS stage,
         CASE WHEN o_orderkey % 7 = 1 THEN 'MalformedJson' ELSE 'MissingField' END AS error_type,
         CASE WHEN o_orderkey % 7 = 1 THEN 'notification' WHEN o_orderkey % 7 = 2 THEN 'Records' ELSE 'key' END AS error_message,
         CASE WHEN o_orderkey % 7 = 1 THEN '{oops' WHEN o_orderkey % 7 = 2 THEN '{"Records": []}'
              ELSE '{"Records": [{"s3": {"bucket": {"name": "b"}, "object": {}}}]}' END AS raw
       FROM orders WHERE o_orderkey % 7 IN (1, 2, 3)"""
)
def quarantine_notifications(spark, sf_dir):
    k = F.col("o_orderkey")
    good = F.concat(F.lit('{"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "'), k, F.lit('.pdf"}}}]}'))
    event = (
        F.when(k % 7 == 1, "{oops")
        .when(k % 7 == 2, '{"Records": []}')
        .when(k % 7 == 3, '{"Records": [{"s3": {"bucket": {"name": "b"}, "object": {}}}]}')
        .otherwise(good)
    )
    events = derive.table(spark, sf_dir, "orders").select(k.alias("k"), event.alias("event"))
    return quality.rejected(quality.check_notifications(events), "notification", ["k"], "event")


# --- keys ---------------------------------------------------------------------------------------


@query(
    """SELECT row_number() OVER (ORDER BY o_custkey, o_orderkey) AS id, o_custkey, o_orderkey FROM orders"""
)
def surrogate_key(spark, sf_dir):
    orders = derive.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return keys.surrogate_key(orders, ["o_custkey", "o_orderkey"], "id")


@query(
    """SELECT row_number() OVER (ORDER BY o_orderkey % 3, o_orderkey) AS id, o_orderkey % 3 AS batch, o_orderkey FROM orders"""
)
def number_batches(spark, sf_dir):
    """Three batches, the last delivered twice: one dense range."""
    out = work_path(spark, "numbered")
    orders = derive.table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 3).alias("batch"), "o_orderkey")
    parts = []
    for batch in (0, 1, 2, 2):
        parts.append(keys.number_batch(orders.filter(F.col("batch") == batch), ["o_orderkey"], "id", out, batch))
    return parts[0].unionByName(parts[1]).unionByName(parts[3])
