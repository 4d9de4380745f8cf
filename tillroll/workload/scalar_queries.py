"""Queries for single functions and small projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions import dates, envelopes, numbers, ocr, paths, text
from tillroll.functions.registry import CLEAN_ITEMS, register_sql_functions
from tillroll.operators import kv, lineitems, mapping, quality
from tillroll.sources import readers
from tillroll.workload import derive
from tillroll.workload.derive import BASE_SQL
from tillroll.workload.registry import query

WITH = "WITH " + BASE_SQL


def joined(values):
    return F.array_join(values, "|", "~")


# --- paths -------------------------------------------------------------------------


def _object_keys(spark, sf_dir):
    k = F.col("o_orderkey")
    suffix = F.when(k % 2 == 0, ".v1.PDF").otherwise(".jpg")
    return derive.table(spark, sf_dir, "orders").select(
        k.alias("k"), F.concat(F.lit("in+box%2F"), k, suffix).alias("key"), "o_orderdate"
    )


_KEYS_SQL = """WITH keys AS (
  SELECT o_orderkey AS k, o_orderdate,
         'in box/' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN '.v1.PDF' ELSE '.jpg' END AS key
  FROM orders)
"""


@query(_KEYS_SQL + "SELECT k, key FROM keys")
def decode_key(spark, sf_dir):
    return _object_keys(spark, sf_dir).select("k", paths.decode_key(F.col("key")).alias("key"))


@query(_KEYS_SQL + "SELECT k, CAST(k AS VARCHAR) AS stem FROM keys")
def file_stem(spark, sf_dir):
    key = paths.decode_key(F.col("key"))
    return _object_keys(spark, sf_dir).select("k", paths.file_stem(key).alias("stem"))


@query(
    _KEYS_SQL
    + """SELECT k, 'analyze-expense-output/' || k || '-' || strftime(o_orderdate, '%Y-%m-%d-%H-%M-%S')
         || '-extracted.json' AS extracted, 'analyze-expense-output/' || key || '-combined.json' AS combined
         FROM keys"""
)
def output_key(spark, sf_dir):
    key = paths.decode_key(F.col("key"))
    return _object_keys(spark, sf_dir).select(
        "k",
        paths.extracted_key(key, F.col("o_orderdate")).alias("extracted"),
        paths.combined_key(key).alias("combined"),
    )


@query(
    """SELECT 'inbox' AS bucket, 'in box/' || o_orderkey ||
              CASE WHEN o_orderkey % 2 = 0 THEN '.v1.PDF' ELSE '.jpg' END AS key FROM orders
       UNION ALL SELECT 'second', 'a b/' || o_orderkey || '.png' FROM orders WHERE o_orderkey % 3 = 0"""
)
def parse_notifications(spark, sf_dir):
    def record(bucket, key):
        s3 = F.struct(
            F.struct(F.lit(bucket).alias("name")).alias("bucket"),
            F.struct(key.alias("key")).alias("object"),
        )
        return F.struct(s3.alias("s3"))

    keys = _object_keys(spark, sf_dir)
    one = record("inbox", F.col("key"))
    two = record("second", F.concat(F.lit("a%20b%2F"), "k", F.lit(".png")))
    records = F.when(F.col("k") % 3 == 0, F.array(one, two)).otherwise(F.array(one))
    events = keys.select(F.to_json(F.struct(records.alias("Records"))).alias("event"))
    return readers.parse_notifications(events)


@query(
    WITH
    + """SELECT session, CASE WHEN k % 9 <> 0 THEN tenant END AS tenant_id,
         CASE WHEN k % 9 <> 0 THEN store END AS store_id,
         CASE WHEN k % 9 <> 0 THEN session END AS session_id FROM base"""
)
def path_ids(spark, sf_dir):
    base = derive.receipts(spark, sf_dir)
    path = F.when(F.col("k") % 9 == 0, F.lit("textract/short.json")).otherwise(
        derive.receipt_path()
    )
    located = base.select("session", path.alias("path"))
    return located.withColumns(paths.path_ids(F.col("path"))).drop("path")


@query(
    WITH
    + """, listed AS (
      SELECT CASE WHEN k % 10 = 0 THEN replace(p, '.json', '.JSON') ELSE p END AS path
      FROM (SELECT k, CASE WHEN k % 6 = 0 THEN replace(path, '/textract/', '/Textract/') ELSE path END AS p
            FROM paths))
    SELECT path FROM listed WHERE path LIKE '%.json' AND lower(split_part(path, '/', -2)) = 'textract'"""
)
def filter_receipt_keys(spark, sf_dir):
    path = F.col("path")
    folder = F.when(
        F.col("k") % 6 == 0, F.replace(path, F.lit("/textract/"), F.lit("/Textract/"))
    ).otherwise(path)
    listed = (
        derive.receipts(spark, sf_dir)
        .select("k", derive.receipt_path().alias("path"))
        .withColumn("path", folder)
        .select(
            F.when(F.col("k") % 10 == 0, F.replace(path, F.lit(".json"), F.lit(".JSON")))
            .otherwise(path)
            .alias("path")
        )
    )
    return listed.filter(paths.is_receipt_key(path))


# --- labels and text -----------------------------------------------------------------


@query(
    WITH
    + """SELECT session, 'USER|' || CASE WHEN k % 8 <> 7 THEN 'INVOICE_RECEIPT_DATE|' ELSE '' END ||
         'ADDRESS| MOBILE: ' || CASE WHEN k % 7 = 0 THEN '|USER' ELSE '' END AS labels FROM base"""
)
def merge_labels(spark, sf_dir):
    parsed = kv.parse_kv(derive.kv_texts(spark, sf_dir))
    merged = text.merge_labels(F.col("kv.Type"), F.col("kv.Key"))
    return parsed.select("session", joined(merged).alias("labels"))


@query(
    WITH
    + """SELECT session, p_name || ' no 1|TOTAL' || ln || 'x|' AS labels FROM base"""
)
def clean_labels(spark, sf_dir):
    labels = F.array(
        F.concat(F.lit("  "), "p_name", F.lit("\n no.:\t#1 ")),
        F.concat(F.lit("TOTAL_"), "ln", F.lit("-x%")),
        F.lit(" -- "),
    )
    base = derive.receipts(spark, sf_dir)
    return base.select("session", joined(text.clean_labels(labels)).alias("labels"))


_ITEM_LISTS = """SELECT b.session, coalesce(i.items, '') AS items FROM base b LEFT JOIN (
  SELECT session, string_agg(item_clean, '|' ORDER BY j) AS items FROM items GROUP BY session) i
  ON b.session = i.session"""


@query(WITH + _ITEM_LISTS)
def clean_items(spark, sf_dir):
    lists = derive.item_texts(spark, sf_dir)
    return lists.select("session", joined(text.clean_items(F.col("items"))).alias("items"))


@query(WITH + _ITEM_LISTS)
def sql_udf_clean_items(spark, sf_dir):
    register_sql_functions(spark)
    lists = derive.item_texts(spark, sf_dir)
    return lists.selectExpr("session", f"array_join({CLEAN_ITEMS}(items), '|', '~') AS items")


@query(
    WITH
    + """SELECT b.session, coalesce(i.prices, '') AS prices, coalesce(i.quantities, '') AS quantities
    FROM base b LEFT JOIN (
      SELECT session, string_agg(quantity_text, '|' ORDER BY j) AS quantities,
             string_agg(CASE WHEN k % 2 = 1 THEN NULL WHEN bad_price THEN 'N/A'
                        ELSE format('{:,.2f}', price) END, '|' ORDER BY j) AS prices
      FROM items GROUP BY session) i ON b.session = i.session"""
)
def extract_quoted(spark, sf_dir):
    lists = derive.item_texts(spark, sf_dir)
    return lists.select(
        "session",
        joined(text.quoted_values(F.col("price"))).alias("prices"),
        joined(text.quoted_values(F.col("quantity"))).alias("quantities"),
    )


@query(WITH + "SELECT session, (k % 100) || ' Road City ' || nk AS address FROM base")
def clean_address(spark, sf_dir):
    base = derive.receipts(spark, sf_dir)
    return base.select("session", text.clean_address(F.col("address")).alias("address"))


@query(
    WITH
    + """SELECT session, CAST(n_items AS BIGINT) AS items_length, CAST(n_items AS BIGINT) AS price_length,
         CAST(n_items AS BIGINT) AS quantity_length FROM base"""
)
def array_lengths(spark, sf_dir):
    lists = derive.item_texts(spark, sf_dir).select(
        "session",
        text.parse_list(F.col("items")).alias("ITEMS"),
        text.parse_list(F.col("price")).alias("PRICE"),
        text.parse_list(F.col("quantity")).alias("QUANTITY"),
    )
    return lineitems.array_lengths(lists).select(
        "session",
        *[F.col(f"{c}_LENGTH").cast("bigint").alias(f"{c.lower()}_length")
          for c in ("ITEMS", "PRICE", "QUANTITY")],
    )


# --- dates -----------------------------------------------------------------------------


@query(
    WITH
    + """SELECT session, CASE WHEN k % 8 = 6 THEN strftime(o_orderdate, '%d-%b-%Y')
         ELSE strftime(receipt_date, '%d-%m-%Y') END AS normalized, receipt_date AS dates FROM base"""
)
def normalize_date(spark, sf_dir):
    base = derive.receipts(spark, sf_dir)
    ordered = base.select("session", dates.normalize_date(F.col("date_text")).alias("normalized"))
    return ordered.withColumn("dates", dates.parse_date(F.col("normalized")))


@query(
    WITH
    + """SELECT session, CASE WHEN k % 5 < 3 THEN odate WHEN k % 5 = 3 AND day(odate) > 9
         AND month(odate) > 9 THEN odate END AS dates FROM base"""
)
def parse_date(spark, sf_dir):
    written = (
        F.when(F.col("k") % 5 < 3, F.date_format("o_orderdate", "dd-MM-yyyy"))
        .when(F.col("k") % 5 == 3, F.date_format("o_orderdate", "d-M-yyyy"))
        .otherwise("31-02-2023")
    )
    base = derive.receipts(spark, sf_dir)
    return base.select("session", dates.parse_date(written).alias("dates"))


@query(
    WITH
    + """SELECT CAST(count_if(k % 8 = 7) AS BIGINT) AS missing_text,
         CAST(count_if(k % 8 >= 6) AS BIGINT) AS missing_date FROM base"""
)
def missing_counts(spark, sf_dir):
    return quality.missing_counts(derive.receipts(spark, sf_dir), "date_text")


# --- numbers -----------------------------------------------------------------------------


def _number_texts(spark, sf_dir):
    amount = (F.col("cents") / 100).cast("decimal(20,2)")
    written = (
        F.when(F.col("k") % 8 == 0, amount.cast("string"))
        .when(F.col("k") % 8 == 1, F.format_number(amount, 2))
        .when(F.col("k") % 8 == 2, F.concat(amount.cast("string"), F.lit("5")))
        .when(F.col("k") % 8 == 3, F.concat(F.lit("$"), amount.cast("string")))
        .when(F.col("k") % 8 == 4, F.concat(F.lit("-"), amount.cast("string")))
        .when(F.col("k") % 8 == 5, F.lit(""))
        .when(F.col("k") % 8 == 6, F.col("qty").cast("string"))
    )
    return derive.receipts(spark, sf_dir).select("session", written.alias("written"))


@query(
    WITH
    + """SELECT session, CASE WHEN k % 8 IN (0, 1) THEN cents / 100.0
         WHEN k % 8 = 6 THEN CAST(qty AS DOUBLE) ELSE -1.0 END AS price FROM base"""
)
def sanitize_price(spark, sf_dir):
    texts = _number_texts(spark, sf_dir)
    return texts.select("session", numbers.sanitize_price(F.col("written")).alias("price"))


@query(
    WITH
    + """SELECT session, CASE WHEN k % 8 = 0 OR (k % 8 = 1 AND cents < 100000) THEN cents / 100.0
         WHEN k % 8 = 6 THEN CAST(qty AS DOUBLE) ELSE -1.0 END AS quantity FROM base"""
)
def sanitize_quantity(spark, sf_dir):
    texts = _number_texts(spark, sf_dir)
    return texts.select("session", numbers.sanitize_quantity(F.col("written")).alias("quantity"))


@query(
    WITH
    + """, t AS (SELECT session, seconds, CAST(floor(seconds) AS BIGINT) AS s FROM base)
    SELECT session, CASE WHEN s >= 172800 THEN (s // 86400) || ' days, ' WHEN s >= 86400 THEN '1 day, '
      ELSE '' END || ((s % 86400) // 3600) || ':' || lpad(CAST((s % 3600) // 60 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST(s % 60 AS VARCHAR), 2, '0') ||
      CASE WHEN seconds > s THEN '.' || CAST(round((seconds - s) * 1000000) AS BIGINT) ELSE '' END AS time_taken
    FROM t"""
)
def format_duration(spark, sf_dir):
    base = derive.receipts(spark, sf_dir)
    return base.select("session", numbers.format_duration(F.col("seconds")).alias("time_taken"))


@query(
    """SELECT event_id, CASE WHEN event_id % 3 < 2 THEN value END AS total_amount FROM events"""
)
def total_amount_lookup(spark, sf_dir):
    key = (
        F.when(F.col("event_id") % 3 == 0, "total_amount")
        .when(F.col("event_id") % 3 == 1, "Total_Amount")
        .otherwise("TOTAL_AMOUNT")
    )
    raw = F.concat(F.lit('{"props":'), "props", F.lit(',"'), key, F.lit('":'), "value", F.lit("}"))
    events = derive.table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return events.select(
        "event_id", envelopes.total_amount_from_text(F.col("raw")).alias("total_amount")
    )


@query(
    """SELECT vec_id, array_to_string(list_transform(embedding,
         lambda x: CASE WHEN CAST(x AS DOUBLE) > list_avg(embedding) THEN '1' ELSE '0' END), '') AS page_hash
       FROM embeddings"""
)
def average_hash(spark, sf_dir):
    pixels = F.col("embedding").cast("array<double>")
    vectors = derive.table(spark, sf_dir, "embeddings")
    return vectors.select("vec_id", ocr.average_hash(pixels).alias("page_hash"))


# --- bags ----------------------------------------------------------------------------------


@query(
    WITH
    + """SELECT session, CASE k % 4 WHEN 0 THEN 'NAME|DATE|DUE_DATE' WHEN 1 THEN 'DATE|NAME|Date'
         WHEN 2 THEN 'NAME|TOTAL' ELSE 'NAME|DATE' END AS types FROM base"""
)
def canonical_date_type(spark, sf_dir):
    def types(*names):
        return F.array(*[F.lit(n) for n in names])

    given = (
        F.when(F.col("k") % 4 == 0, types("NAME", "INVOICE_RECEIPT_DATE", "DUE_DATE"))
        .when(F.col("k") % 4 == 1, types("date", "NAME", "Date"))
        .when(F.col("k") % 4 == 2, types("NAME", "TOTAL"))
        .otherwise(types("NAME", "Updated"))
    )
    base = derive.receipts(spark, sf_dir).select("session", given.alias("types"))
    return base.select("session", joined(envelopes.canonical_date_type(F.col("types"))).alias("types"))


@query(
    WITH
    + """SELECT session, 'NAME|items|price|quantity|tenant_ids|session_ids|store_ids|total_amount' AS types,
         'User|items|price|quantity|tenant_ids|session_ids|store_ids|total_amount' AS keys,
         c_name || '|["' || p_name || '","x"]|[' || CAST(cents / 100.0 AS VARCHAR) || ']|["' || qty || '"]|' || tenant
         || '|' || session || '|' || store || '|' ||
         CASE WHEN k % 5 <> 0 THEN CAST(cents / 100.0 AS VARCHAR) ELSE '~' END AS vals FROM base"""
)
def append_kv(spark, sf_dir):
    items = F.struct(
        F.to_variant_object(F.array("p_name", F.lit("x"))).alias("items"),
        F.to_variant_object(F.array(F.col("cents") / 100.0)).alias("price"),
        F.to_variant_object(F.array(F.col("qty").cast("string"))).alias("quantity"),
    )
    ids = {"tenant_id": F.col("tenant"), "session_id": F.col("session"), "store_id": F.col("store")}
    total = F.when(F.col("k") % 5 != 0, F.col("cents") / 100.0)
    bag = F.struct(
        envelopes.append_names(F.array(F.lit("NAME"))).alias("Type"),
        envelopes.append_names(F.array(F.lit("User"))).alias("Key"),
        envelopes.append_values(
            F.array(F.col("c_name").cast("variant")), items, ids, total
        ).alias("Value"),
    )
    written = derive.receipts(spark, sf_dir).select("session", F.to_json(bag).alias("kv_data"))
    return kv.parse_kv(written).select(
        "session",
        joined(F.col("kv.Type")).alias("types"),
        joined(F.col("kv.Key")).alias("keys"),
        joined(F.col("kv.Value")).alias("vals"),
    )


@query(
    WITH
    + """SELECT session, CASE WHEN k % 13 <> 0 THEN CAST(mobile AS BIGINT) END AS phone,
         cents / 100.0 AS amount, CASE WHEN ln % 2 = 0 THEN ln // 2 END AS half, store AS shop FROM base"""
)
def apply_mapping(spark, sf_dir):
    half = F.when(F.col("ln") % 2 == 0, (F.col("ln") / 2).cast("bigint").cast("string")).otherwise(
        (F.col("ln") / 2).cast("string")
    )
    source = derive.receipts(spark, sf_dir).select(
        "session", "mobile", (F.col("cents") / 100).cast("string").alias("amount"),
        half.alias("half"), "store",
    )
    return mapping.apply_mapping(
        source,
        [
            ("session", "string", "session", "string"),
            ("mobile", "string", "phone", "bigint"),
            ("amount", "string", "amount", "double"),
            ("half", "string", "half", "bigint"),
            ("store", "string", "shop", "string"),
        ],
    )


@query(WITH + "SELECT session, c_name FROM base")
def drop_ci(spark, sf_dir):
    wide = derive.receipts(spark, sf_dir).select(
        "session", "c_name", F.col("store").alias("VALUE"), F.col("tenant").alias("Key")
    )
    return kv.drop_columns(wide, ["value", "KEY"])


@query(WITH + "SELECT session, session || '|' || store || '|' || coalesce(date_text, '~') AS packed FROM base")
def pack_array(spark, sf_dir):
    base = derive.receipts(spark, sf_dir)
    packed = kv.pack_array(base, ["session", "store", "date_text"], "packed")
    return packed.select("session", joined(F.col("packed")).alias("packed"))


@query(
    WITH
    + """SELECT session, 'alt' || ck AS mobile_alt,
         CASE WHEN k % 13 <> 0 THEN 'alt' || ck ELSE mobile END AS mobile FROM base"""
)
def mobile_fix(spark, sf_dir):
    base = derive.receipts(spark, sf_dir).select(
        "session", F.concat(F.lit("alt"), "ck").alias("mobile_alt"), F.col("mobile").alias("MOBILE")
    )
    return kv.mobile_fix(base).select("session", "mobile_alt", F.col("MOBILE").alias("mobile"))


@query(WITH + "SELECT session, c_name, odate FROM base ORDER BY session LIMIT 10")
def preview_limit(spark, sf_dir):
    """The preview is a limit by definition; sorting makes it repeatable."""
    base = derive.receipts(spark, sf_dir)
    return base.select(
        "session", "c_name", F.col("o_orderdate").cast("date").alias("odate")
    ).orderBy("session").limit(10)


@query(
    """SELECT event_id, '[' || to_json(trim(regexp_replace(event_type || ' ' || event_id, '[^a-zA-Z0-9 ]', '', 'g'))) || ', [1.5, ['
         || to_json(event_type || ' k' || (event_id % 7)) || ', null, true], []], ' || props || ']' AS labels FROM events"""
)
def clean_nested_labels(spark, sf_dir):
    """Strings at every depth are cleaned; numbers, nulls and objects stay."""
    noisy = F.concat(F.lit(" * "), "event_type", F.lit("  !! "), F.col("event_id"), F.lit("? "))
    inner = F.concat("event_type", F.lit("\n\t k"), F.col("event_id") % 7, F.lit("%"))

    def quoted(value):
        listed = F.to_json(F.array(value))
        return F.substring(listed, F.lit(2), F.length(listed) - 2)

    nested = F.concat(
        F.lit("["), quoted(noisy), F.lit(", [1.5, ["), quoted(inner), F.lit(", null, true], []], "), "props", F.lit("]")
    )
    return derive.table(spark, sf_dir, "events").select("event_id", text.clean_nested_labels(nested).alias("labels"))
