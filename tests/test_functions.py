"""Literal vectors for single functions."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tillroll.functions import dates, envelopes, numbers, ocr, paths, text
from tillroll.functions.registry import CLEAN_ITEMS, register_sql_functions


def apply(spark, fn, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


D = datetime.date(2023, 1, 5)
DATES = {
    "05-01-2023": D,
    "05/01/23": D,
    "2023-01-05": D,
    "Jan 05 2023": D,
    "Thu Jan 05 2023": D,
    "Jan 05 2023 10:30": D,
    "weal 05-01-2023": D,
    "JAN/05/2023": D,
    "Jan 5 2023": None,
    "Jan 05, 2023": None,
    "05 Jan 2023": None,
    "Jan  5 2023": None,
    "thu, Jan 05 2023": None,
    "31-02-2023": None,
    "5/1/23": None,
    "2023": None,
    "Mon Tue": None,
    "September 05 2023": None,
    "1-2-3-4-5": None,
    "": None,
    None: None,
    "05 01 2023 10:30": None,
}


def test_receipt_dates(spark):
    assert apply(spark, dates.receipt_date, list(DATES)) == list(DATES.values())


def test_normalized_date_text_keeps_unreadable_three_tokens(spark):
    got = apply(spark, dates.normalize_date, ["05 Jan 2023", "a b", "5-1-23", "23-1-2-4"])
    assert got == ["05-Jan-2023", None, "5-1-23", None]


@pytest.mark.parametrize(
    "kind, key, label",
    [
        ("DATE", "Bill Dt", "BILL DT"),
        ("OTHER", " other ", "OTHER"),
        ("x", "", "X"),
        ("x", None, "X"),
        ("x", " OtHeR\n", "X"),
        ("x", "another", "ANOTHER"),
        (None, "other", None),
    ],
)
def test_merge_label(spark, kind, key, label):
    df = spark.createDataFrame([(kind, key)], "t string, k string")
    assert df.select(text.merge_label(F.col("t"), F.col("k"))).first()[0] == label


def test_label_lists_stop_at_the_shorter(spark):
    df = spark.createDataFrame([(["a", "b"], ["x"]), (["a"], ["x", "y"]), ([], [])],
                               "t array<string>, k array<string>")
    got = [r[0] for r in df.select(text.merge_labels(F.col("t"), F.col("k"))).collect()]
    assert got == [["X"], ["X"], []]


def test_clean_label(spark):
    given = [" MOBILE \n NO.: ", "TOTAL_AMOUNT", "A \x0bB\x1cC", "ÉTÉ", " -- ", None]
    assert apply(spark, text.clean_label, given) == ["MOBILE NO", "TOTALAMOUNT", "A B C", "T", "", None]


def test_clean_item(spark):
    given = [" Milk\n2% 500ml (A&B) ", "a　b", "straße", "12"]
    assert apply(spark, text.clean_item, given) == [" MILK ML AB ", "A B", "STRAE", ""]


def test_item_list_functions_agree(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([('[" Milk\\n2% ","b"]',), ("[1.5]",), ("oops",), (None,)], "v string")
    rows = df.select(text.clean_items(F.col("v")).alias("a"), F.expr(f"{CLEAN_ITEMS}(v)").alias("b"))
    got = [(r.a, r.b) for r in rows.collect()]
    assert got == [([" MILK ", "B"],) * 2, ([""],) * 2, (None, None), (None, None)]


def test_quoted_values(spark):
    given = ['["1",""]', "[1.5,2.0]", '["a\rb","c\nd"]', None]
    assert apply(spark, text.quoted_values, given) == [["1", ""], [], ["a\rb"], None]


def test_prices_and_quantities(spark):
    given = ["12", "12.5", "12.34\n", "12.345", "", "-3", "$5", None, "1,200.50", "١", "1e3"]
    price = [12.0, 12.5, 12.34, -1.0, -1.0, -1.0, -1.0, -1.0, 1200.5, -1.0, -1.0]
    assert apply(spark, numbers.sanitize_price, given) == price
    quantity = [-1.0 if v == "1,200.50" else p for v, p in zip(given, price)]
    assert apply(spark, numbers.sanitize_quantity, given) == quantity


def test_money(spark):
    given = ["1,200.50", " 7 ", "1e2", ".5", "5.", "$5", "1.5d", "", None]
    assert apply(spark, numbers.money, given) == [1200.5, 7.0, 100.0, 0.5, 5.0, None, None, None, None]


def test_large_numbers_lose_the_exponent(spark):
    given = ["1.0E7", "1.234567891E7", "1.0E10", "5.0E-4", "12.5", "N/A", "E"]
    got = apply(spark, numbers.plain_notation, given)
    assert got == ["10000000", "12345678.91", "10000000000", "0.0005", "12.5", "N/A", "E"]


def test_round_total(spark):
    assert apply(spark, numbers.round_total, [2.675, 1.005, 0.1 + 0.2, None], "double") == [2.68, 1.01, 0.3, None]


def test_durations(spark):
    given = [0.0, 2.5, 59.9999999, 3661.0, 86400.0, 200000.25, None]
    expected = [str(datetime.timedelta(seconds=s)) if s is not None else None for s in given]
    assert apply(spark, numbers.format_duration, given, "double") == expected


def test_object_keys(spark):
    given = ["a+b%2Fc", "bad%zz+x", "plain"]
    assert apply(spark, paths.decode_key, given) == ["a b/c", "bad%zz x", "plain"]
    assert apply(spark, paths.file_stem, ["a/b.c.pdf", "x", "d/"]) == ["b", "x", ""]
    assert apply(spark, paths.document_kind, ["a.PDF", "a.pdf.png"]) == ["pdf", "image"]


def test_short_paths_have_no_ids(spark):
    df = spark.createDataFrame([("T/a/S/b/X/c/textract/f.json",), ("c/f.json",)], "p string")
    rows = df.select(*[c.alias(n) for n, c in paths.path_ids(F.col("p")).items()]).collect()
    assert [tuple(r) for r in rows] == [("T", "S", "X"), (None, None, None)]


def test_receipt_keys(spark):
    given = ["a/textract/f.json", "a/TEXTRACT/f.json", "a/textract/f.JSON", "textract/x/f.json", "f.json"]
    assert apply(spark, paths.is_receipt_key, given) == [True, True, False, False, False]


def test_average_hash(spark):
    got = apply(spark, ocr.average_hash, [[1.0, 2.0, 9.0, 0.0], [3.0, 3.0]], "array<double>")
    assert got == ["0010", "00"]


def test_first_date_type(spark):
    given = [["NAME", "INVOICE_RECEIPT_DATE", "DUE_DATE"], ["update"], ["A"], [], [None, "date"]]
    got = apply(spark, envelopes.canonical_date_type, given, "array<string>")
    assert got == [["NAME", "DATE", "DUE_DATE"], ["DATE"], ["A"], [], [None, "DATE"]]


def test_total_amount_is_case_sensitive(spark):
    given = ['{"total_amount":1}', '{"Total_Amount":2.5}', '{"TOTAL_AMOUNT":3}', "{}", "oops"]
    assert apply(spark, envelopes.total_amount_from_text, given) == [1.0, 2.5, None, None, None]


FIELDS = "array<struct<Type:struct<Text:string>,ValueDetection:struct<Text:string,Confidence:double>>>"


def _line(*fields):
    return ([((kind,), (value, conf)) for kind, value, conf in fields],)


def test_lineitem_bag(spark):
    groups = [
        ([_line(("ITEM", "a", 1.0), ("ITEM", "b", 2.0), ("PRICE", "1,200.50", 3.0), ("QUANTITY", "2", 0.0))],),
        ([_line(("ITEM", "c", 4.0)), _line(("PRICE", "$5", 5.0))],),
        (None,),
    ]
    kind = f"array<struct<LineItems:array<struct<LineItemExpenseFields:{FIELDS}>>>>"
    bag, empty = apply(spark, ocr.lineitem_bag, [groups, []], kind)
    assert bag["items"] == ["b", "c", ""]
    assert bag["price"] == [1200.5, 0.0, 0.0]
    assert bag["quantity"] == ["2", "", ""]
    assert bag["items_confidence"] == [2.0, 4.0, None]
    assert bag["price_confidence"] == [3.0, None, 5.0]
    assert bag["quantity_confidence"] == [None, None, None]
    assert bag["bad_price"] is True
    assert empty["items"] == [] and empty["bad_price"] is False


def test_kv_bag_fills_missing_text(spark):
    kind = (
        "array<struct<Type:struct<Text:string>,LabelDetection:struct<Text:string,Confidence:double>,"
        "ValueDetection:struct<Text:string,Confidence:double>>>"
    )
    fields = [(("NAME",), ("User", 9.0), ("x", 8.0)), (None, None, ("y", None))]
    (bag,) = apply(spark, ocr.kv_bag, [fields], kind)
    assert bag["Type"] == ["NAME", ""] and bag["Key"] == ["User", ""] and bag["Value"] == ["x", "y"]
    assert bag["KeyConfidence"] == [9.0, None] and bag["ValueConfidence"] == [8.0, None]


def test_a_clean_label_is_not_searched_for_replacements(spark):
    """Labels of letters and digits are taken as they are; all others are cleaned as by the two replacements."""
    labels = ["DATE", "d4", "", None, " MOBILE: ", "TENANT_IDS", "A  B", "ÉTÉ", "a\nb", "x\x85y", "١", "A\n", "_", " "]
    space = text.SPACE

    def plainly(label):
        return F.trim(F.regexp_replace(F.regexp_replace(label, f"[^a-zA-Z0-9{space}]+", ""), f"[{space}]+", " "))

    assert apply(spark, text.clean_label, labels) == apply(spark, plainly, labels)
    cleaned = spark.createDataFrame([("A",)], "v string").select(text.clean_label(F.col("v")))
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN NOT RLIKE(" in plan


def test_words_joined_by_underscores_need_no_pattern(spark):
    labels = ["INVOICE_RECEIPT_DATE", "_", "A_ B", " _A", "É_T", "A_\x1c_B", "A__1", "\x01_\x02"]
    assert apply(spark, text.clean_label, labels) == ["INVOICERECEIPTDATE", "", "A B", "A", "T", "A B", "A1", ""]
    cleaned = spark.createDataFrame([("A",)], "v string").select(text.clean_label(F.col("v")))
    assert "replace(v" in cleaned._jdf.queryExecution().optimizedPlan().toString()


def test_seconds_are_rounded_once_for_all_parts_of_a_duration(spark):
    given = [1e20, float("nan"), 90061.000001, 172799.9999999]
    expected = [None, None, "1 day, 1:01:01.000001", "2 days, 0:00:00"]
    assert apply(spark, numbers.format_duration, given, "double") == expected
    duration = spark.createDataFrame([(1.0,)], "v double").select(numbers.format_duration(F.col("v")).alias("d"))
    assert duration._jdf.queryExecution().optimizedPlan().toString().count("bround(") == 1


def test_lists_without_gaps_and_with_gaps_give_the_same_bags(spark):
    """Lists are only walked by a lambda where something is missing, zero or unreadable (F7, F8, F16, F18, F20)."""
    kind = (
        "array<struct<LineItems:array<struct<LineItemExpenseFields:array<struct<Type:struct<Text:string>,"
        "ValueDetection:struct<Text:string,Confidence:double>>>>>>>"
    )

    def item(*fields):
        return ([((name,), detection) for name, detection in fields],)

    whole = item(("ITEM", ("a", 1.0)), ("ITEM", ("b", 2.0)), ("PRICE", ("1,234.5", 3.0)), ("QUANTITY", ("2", 4.0)))
    gaps = item(("PRICE", ("N/A", 0.0)), ("QUANTITY", None), (None, ("c", 5.0)))
    fine, mixed = apply(spark, ocr.lineitem_bag, [[([whole],)], [None, (None,), ([whole, gaps, None, (None,)],)]], kind)
    assert fine.asDict() == {
        "items": ["b"], "price": [1234.5], "quantity": ["2"], "items_confidence": [2.0], "price_confidence": [3.0],
        "quantity_confidence": [4.0], "bad_price": False,
    }
    assert mixed.asDict() == {
        "items": ["b", "", "", ""], "price": [1234.5, 0.0, 0.0, 0.0], "quantity": ["2", "", "", ""],
        "items_confidence": [2.0, None, None, None], "price_confidence": [3.0, None, None, None],
        "quantity_confidence": [4.0, None, None, None], "bad_price": True,
    }


def test_bags_as_json_need_no_lambda(spark):
    columns = "Type array<string>, Key array<string>, Value array<string>, KeyConfidence array<double>, ValueConfidence array<double>"
    bags = [(["a\n"], ['"'], [None], [1e7, None, float("nan"), -float("inf")], []), (None, [], ["N"], None, [99.75])]
    made = spark.createDataFrame([(b,) for b in bags], f"bag struct<{columns.replace(' array', ':array')}>")
    made = made.select(envelopes.kv_bag_json(F.col("bag"), pretty=False).alias("j"), envelopes.kv_bag_json(F.col("bag")).alias("p"))
    rows = made.collect()
    assert rows[0].j == (
        '{"Type":["a\\n"],"Key":["\\""],"Value":[null],"KeyConfidence":[1.0E7,"","NaN","-Infinity"],"ValueConfidence":[]}'
    )
    assert rows[1].j == '{"Type":null,"Key":[],"Value":["N"],"KeyConfidence":null,"ValueConfidence":[99.75]}'
    assert [json.loads(r.j) for r in rows] == [json.loads(r.p) for r in rows]
    short = made.select("j")._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in short


def test_the_entry_of_an_envelope_is_found_without_a_lambda(spark):
    raw = ['{"a": 1, "b": null, "a": "2"}', "{}", "x", None]
    read = spark.createDataFrame([(r,) for r in raw], "raw string").select(envelopes.read_envelope(F.col("raw")).alias("e"))
    found = read.select(envelopes.entry(F.col("e"), "a").alias("a"), envelopes.entry(F.col("e"), "b").alias("b"))
    assert [tuple(r) for r in found.collect()] == [("2", None), (None, None), (None, None), (None, None)]
    mapped = spark.createDataFrame([({"a": "1"},)], "e map<string,string>").select(envelopes.entry(F.col("e"), "a").alias("a"))
    assert "lambda" not in mapped._jdf.queryExecution().optimizedPlan().toString()
