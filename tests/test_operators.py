"""Row-changing operators on small tables, some against brute force."""

import collections
import json
import random

import pytest
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions.ocr import average_hash
from tillroll.operators import keys, kv, lineitems, mapping, pages, quality
from tillroll.plans import receipts as plans

RAW = "ITEMS array<string>, PRICE array<string>, QUANTITY array<string>, SESSIONIDS string"


def explode(spark, *row):
    df = spark.createDataFrame([row], RAW)
    return sorted(map(tuple, lineitems.explode_items(df).collect()), key=str)


def test_explode_pads_and_drops_nothing(spark):
    assert explode(spark, ["x", "y"], ["1"], ["2", "3"], "s") == [("x", "1", "2", "s"), ("y", None, "3", "s")]
    assert explode(spark, ["x"], ["1", "2"], ["3"], "s") == [("x", "1", "3", "s"), (None, "2", None, None)]
    assert explode(spark, [], [], [], "s") == []
    assert explode(spark, None, ["1"], None, "s") == [(None, "1", None, None)]
    assert explode(spark, [None], [None], [None], "s") == [(None, None, None, "s")]
    assert explode(spark, [], [None, "1"], [], "s") == [(None, "1", None, None)]


def test_explode_row_counts_on_random_lists(spark):
    rng = random.Random(1)

    def values():
        return [rng.choice(["v", None]) for _ in range(rng.randrange(6))]

    rows = [(values(), values(), values(), f"s{i}") for i in range(300)]
    expected = 0
    for items, prices, quantities, _ in rows:
        for pos in range(max(map(len, (items, prices, quantities)), default=0)):
            at = [x[pos] if pos < len(x) else None for x in (items, prices, quantities)]
            expected += pos < len(items) or any(v is not None for v in at)
    assert lineitems.explode_items(spark.createDataFrame(rows, RAW)).count() == expected


def test_apply_mapping_gives_null_for_unreadable(spark):
    df = spark.createDataFrame([("98 76",), (" 9876543210 ",), ("12.5",)], "m string")
    mapped = mapping.apply_mapping(df, [("m", "string", "n", "bigint")])
    assert [r.n for r in mapped.collect()] == [None, 9876543210, None]


KV = "id int, kv_data string"


def test_wide_equals_pivot_of_long(spark):
    rng = random.Random(2)
    names = ["User", "user ", "DATE", "other", "", "Mobile:", "Total_Amount"]
    rows = []
    for i in range(200):
        n = rng.randrange(1, 6)
        texts = [
            "[" + ",".join(rng.choice(['"a"', '"b"', "null"]) for _ in range(n)) + "]" for _ in range(1)
        ]
        types = "[" + ",".join(f'"{rng.choice(names)}"' for _ in range(rng.randrange(n, n + 2))) + "]"
        given = "[" + ",".join(f'"{rng.choice(names)}"' for _ in range(rng.randrange(n, n + 2))) + "]"
        rows.append((i, f'{{"Type":{types},"Key":{given},"Value":{texts[0]}}}'))
    df = spark.createDataFrame(rows, KV)
    labels = ["USER", "DATE", "MOBILE", "TOTALAMOUNT", "NOBODY"]
    long = kv.kv_long(kv.parse_kv(df), ["id"])
    pivoted = {r.id: r for r in kv.kv_pivot(long, ["id"], labels).collect()}
    for row in kv.kv_wide(df, ["id"], labels).collect():
        assert tuple(row) == tuple(pivoted[row.id])
    dynamic = {r.id: r.labels for r in kv.kv_pivot_dynamic(long, ["id"]).collect()}
    assert set(dynamic) == set(pivoted)
    for i, row in pivoted.items():
        assert all(dynamic[i].get(name) == row[name] for name in labels)


def test_document_of_null_values_keeps_its_row(spark):
    df = spark.createDataFrame([(1, '{"Type":["A"],"Key":[""],"Value":[null]}')], KV)
    long = kv.kv_long(kv.parse_kv(df), ["id"])
    assert [tuple(r) for r in kv.kv_pivot(long, ["id"], ["A"]).collect()] == [(1, None)]
    assert [tuple(r) for r in kv.kv_pivot_dynamic(long, ["id"]).collect()] == [(1, {})]


def test_any_number_of_labels(spark):
    long = spark.range(10_001).select(
        F.lit(1).alias("id"), F.concat(F.lit("L"), "id").alias("label"), F.col("id").alias("pos"), F.lit("v").alias("value")
    )
    assert len(kv.kv_pivot_dynamic(long, ["id"]).first().labels) == 10_001


def test_first_value_wins_but_null_does_not(spark):
    df = spark.createDataFrame([(1, '{"Type":["A","A","A"],"Key":["","",""],"Value":[null,"x","y"]}')], KV)
    assert kv.kv_wide(df, labels=["A"]).first().A == "x"


def test_malformed_bag_gives_null_columns(spark):
    df = spark.createDataFrame([(1, "{oops"), (2, None)], KV)
    assert [tuple(r) for r in kv.kv_wide(df, ["id"], ["A"]).orderBy("id").collect()] == [(1, None), (2, None)]


def test_mobile_fix_takes_first_candidate(spark):
    df = spark.createDataFrame([("1234567890", "x"), ("12", "y")], "MOBILE string, `MOBILE NO` string")
    assert [r.MOBILE for r in kv.mobile_fix(df).collect()] == ["1234567890", "12"]
    moved = df.select("MOBILE NO", "MOBILE")
    assert [r.MOBILE for r in kv.mobile_fix(moved).collect()] == ["x", "12"]
    assert kv.mobile_fix(df.select("MOBILE NO")).columns == ["MOBILE NO"]


def test_drop_is_case_insensitive(spark):
    df = spark.createDataFrame([(1, 2, 3)], "VALUE int, Key int, keep int")
    assert kv.drop_columns(df, ["value", "KEY", "absent"]).columns == ["keep"]


# --- large numbers ------------------------------------------------------------------


def test_ten_million_survives_the_number_list(spark):
    wide = spark.createDataFrame(
        [('["a","b"]', "[10000000.0,12345678.91]", '["1","2"]', "s")],
        "ITEMS string, PRICE string, QUANTITY string, SESSIONIDS string",
    )
    rows = plans.lineitems_from_wide(wide).collect()
    assert sorted(r.PRICE for r in rows) == [10000000.0, 12345678.91]


# --- pages ---------------------------------------------------------------------------


def kept_by_hand(rows):
    kept = set()
    by_doc = collections.defaultdict(list)
    for doc, page, page_hash in rows:
        by_doc[doc].append((page, page_hash))
    for doc, doc_pages in by_doc.items():
        seen = set()
        for page, page_hash in sorted(doc_pages):
            if page_hash in seen:
                break
            seen.add(page_hash)
            kept.add((doc, page))
    return kept


@pytest.mark.parametrize("hashes", [3, 40, 4000])
def test_cut_at_first_repeat_with_a_hot_document(spark, hashes):
    rng = random.Random(hashes)
    rows = [("hot", p, rng.randrange(hashes)) for p in range(1, 1001)]
    rows += [(f"d{d}", p, rng.randrange(hashes)) for d in range(100) for p in range(1, 12)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc string, page int, hash int")
    got = pages.pages_before_duplicate(df, "doc", "page", "hash").select("doc", "page").collect()
    assert {tuple(r) for r in got} == kept_by_hand(rows) and len(got) == len(kept_by_hand(rows))


def test_cut_examples(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (1, 3, "a"), (1, 4, "c"), (2, 1, "a")]
    df = spark.createDataFrame(rows, "doc int, page int, hash string")
    cut = pages.pages_before_duplicate(df, "doc", "page", "hash").collect()
    assert sorted((r.doc, r.page) for r in cut) == [(1, 1), (1, 2), (2, 1)]
    distinct = pages.pages_before_duplicate(df, "doc", "page", "hash", drop_only_duplicates=True)
    assert sorted((r.doc, r.page) for r in distinct.collect()) == [(1, 1), (1, 2), (1, 4), (2, 1)]


def test_page_without_a_hash_repeats_nothing(spark):
    rows = [(1, 1, None), (1, 2, None), (1, 3, "a"), (1, 4, "a")]
    df = spark.createDataFrame(rows, "doc int, page int, hash string")
    cut = pages.pages_before_duplicate(df, "doc", "page", "hash").collect()
    assert sorted(r.page for r in cut) == [1, 2, 3]
    distinct = pages.pages_before_duplicate(df, "doc", "page", "hash", drop_only_duplicates=True)
    assert sorted(r.page for r in distinct.collect()) == [1, 2, 3]
    assert pages.unhashed_pages(df, "hash").count() == 2


def test_combine_has_one_shape_at_any_length(spark):
    rows = [(1, 2, ["c"]), (1, 1500, ["a", "b"]), (3, 1, None), (3, 2, [])] + [(2, p, [str(p)]) for p in range(1, 2502)]
    df = spark.createDataFrame(rows, "doc int, page int, v array<string>")
    merged = pages.combine_pages(df, "doc", ["page"], ["v"]).orderBy("doc", "page", "pos").collect()
    assert [tuple(r) for r in merged[:3]] == [(1, 2, 0, "c"), (1, 1500, 0, "a"), (1, 1500, 1, "b")]
    assert [r.v for r in merged[3:]] == [str(p) for p in range(1, 2502)]


def test_document_total_is_exact(spark):
    rows = [(1, 0.1)] * 10 + [(2, None), (3, 1e23), (3, 1.0), (4, 5.0), (4, None)]
    df = spark.createDataFrame(rows, "doc int, total double")
    got = {r.doc: (r.total_amount, r.pages_without_total) for r in pages.document_total(df, "doc", "total").collect()}
    assert got == {1: (1.0, 0), 2: (None, 1), 3: (1e23, 0), 4: (5.0, 1)}


def _page(doc, n, response=None):
    item = '{"LineItemExpenseFields":[{"Type":{"Text":"PRICE"},"ValueDetection":{"Text":"1.00"}}]}'
    field = '{"Type":{"Text":"T%d"},"ValueDetection":{"Text":"v"}}' % n
    whole = '{"ExpenseDocuments":[{"SummaryFields":[%s],"LineItemGroups":[{"LineItems":[%s]}]}]}' % (field, item)
    return (doc, n, f"{doc}-{n}", response or whole)


def test_a_bad_page_takes_nothing_from_the_good_ones(spark):
    no_fields = '{"ExpenseDocuments":[{"LineItemGroups":[]}]}'
    no_groups = '{"ExpenseDocuments":[{"SummaryFields":[]}]}'
    rows = [_page(1, n) for n in range(1, 1502)]
    rows += [_page(2, 1), _page(2, 2, "{oops"), _page(2, 3, no_fields), _page(2, 4, no_groups), _page(2, 5, "{}"), _page(2, 6)]
    df = spark.createDataFrame(rows, "doc int, page int, hash string, r string")
    fields, items, totals, rejects = plans.multipage_document(df, "doc", "page", "hash", "r")
    assert {r.doc: (r.total_amount, r.rejected) for r in totals.collect()} == {1: (1501.0, 0), 2: (2.0, 4)}
    assert [(r.page, r.Type) for r in fields.filter("doc = 2").orderBy("page").collect()] == [(1, "T1"), (6, "T6")]
    assert items.filter("doc = 2").count() == 2
    got = {r.page: (r.error_type, r.error_message) for r in rejects.collect()}
    assert got == {
        2: ("MalformedJson", "response"),
        3: ("MissingField", "SummaryFields"),
        4: ("MissingField", "LineItemGroups"),
        5: ("MissingField", "ExpenseDocuments"),
    }


def test_pixels_to_totals(spark):
    pixels = [[10.0, 200.0], [200.0, 10.0], [10.0, 200.0], [], []]
    rows = [(1, n + 1, px, _page(1, n)[3]) for n, px in enumerate(pixels)]
    df = spark.createDataFrame(rows, "doc int, page int, px array<double>, r string")
    hashed = df.withColumn("hash", average_hash(F.col("px")))
    assert hashed.filter("page = 4").first().hash == ""
    totals = plans.multipage_document(hashed, "doc", "page", "hash", "r")[2].first()
    assert (totals.total_amount, totals.rejected) == (2.0, 0)  # the third page repeats the first


# --- rows in, rows out -----------------------------------------------------------------


def test_every_row_is_accepted_or_rejected(spark):
    good = _page(1, 1)[3]
    responses = spark.createDataFrame([(i, r) for i, r in enumerate([good, "{oops", "{}", "", None, "[]", good])], "id int, raw string")
    checked = quality.check_responses(responses)
    assert checked.count() == 7 and quality.accepted(checked).count() == 2
    bad = quality.rejected(checked, "response", ["id"], "raw")
    assert bad.columns == ["id", "stage", "error_type", "error_message", "raw"] and bad.count() == 5
    two = '{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"a+b%2Fc"}}},{"s3":{}}]}'
    events = spark.createDataFrame([(1, two), (2, "{oops"), (3, '{"Records":[]}'), (4, None)], "id int, event string")
    notes = quality.check_notifications(events)
    assert [tuple(r) for r in quality.accepted(notes).select("id", "bucket", "key").collect()] == [(1, "b", "a b/c")]
    assert sorted(r.id for r in quality.rejected(notes, "notification", ["id"], "event").collect()) == [1, 2, 3, 4]
    bags = spark.createDataFrame([(1, '{"Type":[],"Key":[],"Value":[]}'), (2, "{oops"), (3, None), (4, "{}")], "id int, kv_data string")
    named = quality.check_bags(bags)
    assert sorted(r.id for r in quality.rejected(named, "bag", ["id"], "kv_data").collect()) == [2, 3, 4]
    assert plans.keyvalue_final(bags).count() == 1


def _envelope(**more):
    bag = json.dumps({"Type": [], "Key": [], "Value": []})
    return {"lineitems": json.dumps({"items": [], "price": [], "quantity": []}), "kv_data": bag, **more}


def test_envelope_text_rules(spark):
    whole = json.dumps(_envelope(Total_Amount=2, shop="x"))
    twice = whole[:-1] + ', "Total_Amount": 3}'
    path = "in/T/a/S/b/X/c/textract/%s.json"
    rows = [(path % "a", whole), (path % "b", whole + " tail"), (path % "c", whole + whole), (path % "d", twice), (path % "e", f"{whole},{whole}")]
    df = spark.createDataFrame(rows, "path string, raw string")
    made = {r.path[-6]: r for r in plans.enrich_envelopes(df).collect()}
    assert {k: (r.Total_Amount, r.extra) for k, r in made.items()} == {"a": (2.0, {"shop": "x"}), "d": (3.0, {"shop": "x"})}
    assert quality.quarantine(quality.check_envelopes(df)).count() == 3


def test_last_writer_wins_inside_enrichment(spark):
    raw = json.dumps(_envelope())
    rows = [(f"in/T/a/S/b/{s}/c/textract/{n}.json", raw) for s, n in (("X1", "a"), ("X2", "a"), ("X1", "b"))]
    df = spark.createDataFrame(rows, "path string, raw string")
    assert plans.enrich_envelopes(df).count() == 3
    kept = plans.enrich_envelopes(df, last_writer=True).collect()
    assert sorted(r.path for r in kept) == ["in/T/a/S/b/X1/c/textract/b.json", "in/T/a/S/b/X2/c/textract/a.json"]


def test_no_number_kills_a_job(spark):
    def line(price):
        return '{"LineItemExpenseFields":[{"Type":{"Text":"PRICE"},"ValueDetection":{"Text":"%s"}}]}' % price

    text = '{"ExpenseDocuments":[{"SummaryFields":[],"LineItemGroups":[{"LineItems":[%s]}]}]}'
    rows = [(p, text % line(p), 1e25) for p in ("1e30", "1e308", "NaN", "2.5")]
    df = spark.createDataFrame(rows, "id string, raw string, seconds double")
    parsed = df.withColumn("ExpenseDocuments", F.from_json("raw", f"STRUCT<{schemas.EXPENSE_RESPONSE}>")["ExpenseDocuments"])
    made = {r.id: r for r in plans.ocr_to_envelope(parsed, ["id"], "seconds").collect()}
    assert {k: r.Total_Amount for k, r in made.items()} == {"1e30": 1e30, "1e308": 1e308, "NaN": 0.0, "2.5": 2.5}
    assert all(r.time_taken is None for r in made.values())


# --- keys, quality --------------------------------------------------------------------


def test_surrogate_keys_are_dense_and_ordered(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k"), F.lit("x").alias("v"))
    got = keys.surrogate_key(df, ["k"], "pk").orderBy("k").collect()
    assert [r.pk for r in got] == list(range(1, 5001))
    assert [r.k for r in got] == list(range(5000))


GOOD_KV = '{\\"Type\\":[],\\"Key\\":[],\\"Value\\":[]}'
GOOD_LI = '{\\"items\\":[],\\"price\\":[],\\"quantity\\":[]}'


def test_bad_envelopes_are_named_one_by_one(spark):
    texts = {
        "good": f'{{"lineitems":"{GOOD_LI}","kv_data":"{GOOD_KV}"}}',
        "broken": "{oops",
        "empty": "",
        "no_items": f'{{"kv_data":"{GOOD_KV}"}}',
        "no_kv": f'{{"lineitems":"{GOOD_LI}"}}',
        "bad_kv": f'{{"lineitems":"{GOOD_LI}","kv_data":"{{oops"}}',
        "bad_items": f'{{"lineitems":"[","kv_data":"{GOOD_KV}"}}',
        "no_price": f'{{"lineitems":"{{\\"items\\":[]}}","kv_data":"{GOOD_KV}"}}',
    }
    df = spark.createDataFrame([(f"a/textract/{n}.json", t) for n, t in texts.items()], "path string, raw string")
    checked = quality.check_envelopes(df)
    bad = {r.path.split("/")[-1][:-5]: (r.error_type, r.error_message) for r in quality.quarantine(checked).collect()}
    assert bad == {
        "broken": ("MalformedJson", "envelope"),
        "empty": ("MalformedJson", "envelope"),
        "no_items": ("MissingField", "lineitems"),
        "no_kv": ("MissingField", "kv_data"),
        "bad_kv": ("MalformedJson", "kv_data"),
        "bad_items": ("MalformedJson", "lineitems"),
        "no_price": ("MissingField", "lineitems"),
    }
    assert quality.good_envelopes(checked).count() == 1


def test_enriched_bag_keeps_lists_as_lists(spark):
    raw = (
        '{"lineitems":"{\\"items\\":[\\"a\\"],\\"price\\":[1.5],\\"quantity\\":[\\"2\\"]}",'
        '"kv_data":"{\\"Type\\":[\\"DUE_DATE\\"],\\"Key\\":[\\"k\\"],\\"Value\\":[\\"v\\"],'
        '\\"KeyConfidence\\":[\\"\\"],\\"ValueConfidence\\":[9.5]}","total_amount":3}'
    )
    df = spark.createDataFrame([("T/_/S/_/X/_/textract/f.json", raw)], "path string, raw string")
    row = plans.enrich_envelopes(df).first()
    assert row.kv_data == (
        '{"Type":["DATE","items","price","quantity","tenant_ids","session_ids","store_ids","total_amount"],'
        '"Key":["k","items","price","quantity","tenant_ids","session_ids","store_ids","total_amount"],'
        '"Value":["v",["a"],[1.5],["2"],"T","X","S",3.0],"KeyConfidence":[""],"ValueConfidence":[9.5]}'
    )
    assert (row.tenant_id, row.store_id, row.session_id, row.Total_Amount) == ("T", "S", "X", 3.0)


def test_incomplete_documents_go_to_quarantine(spark):
    text = (
        '{"ExpenseDocuments":[{"SummaryFields":[]},{"LineItemGroups":[]},'
        '{"SummaryFields":[],"LineItemGroups":[]}]}'
    )
    from tillroll import schemas

    df = spark.createDataFrame([("f", 1.0, text)], "path string, seconds double, r string")
    parsed = df.select("path", "seconds", F.from_json("r", f"STRUCT<{schemas.EXPENSE_RESPONSE}>").alias("e")).select(
        "path", "seconds", "e.ExpenseDocuments"
    )
    assert plans.ocr_to_envelope(parsed, ["path"], "seconds").count() == 1
    bad = plans.incomplete_documents(parsed, ["path"]).collect()
    assert sorted((r.doc_no, r.error_message) for r in bad) == [(0, "LineItemGroups"), (1, "SummaryFields")]


def test_last_writer_wins(spark):
    df = spark.createDataFrame([("a/x.json", 1), ("b/x.json", 2), ("a/y.json", 3)], "path string, v int")
    got = quality.last_by_basename(df).collect()
    assert sorted((r.target, r.path, r.v) for r in got) == [("x.json", "b/x.json", 2), ("y.json", "a/y.json", 3)]


def test_pages_without_a_document_id_and_clashing_columns(spark):
    rows = [(None, 1, "h", "x"), (None, 2, "h", "y"), (None, 3, "i", "z"), (1, 1, "h", "x"), (1, 2, "g", "x")]
    df = spark.createDataFrame(rows, "doc INT, page INT, hash STRING, _cut STRING")
    kept = pages.pages_before_duplicate(df, "doc", "page", "hash")
    assert kept.columns == df.columns
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted([rows[0], rows[3], rows[4]], key=repr)


def test_a_page_with_a_missing_pixel_has_no_hash(spark):
    df = spark.createDataFrame([([1.0, None, 3.0],), ([1.0, 2.0, 6.0],), ([],), (None,)], "px ARRAY<DOUBLE>")
    assert [r[0] for r in df.select(average_hash(F.col("px"))).collect()] == [None, "001", "", None]


def test_numbers_go_on_over_batches_and_stay(spark):
    import tempfile

    out = tempfile.mkdtemp(prefix="run-")

    def batch(number, values):
        rows = spark.createDataFrame([(v,) for v in values], "v INT").repartition(3)
        return sorted((r.id, r.v) for r in keys.number_batch(rows, ["v"], "id", out, number).collect())

    first = batch(0, [30, 10, 20])
    assert first == [(1, 10), (2, 20), (3, 30)]
    assert batch(1, []) == []
    assert batch(2, [5, 15]) == [(4, 5), (5, 15)]
    # A rerun keeps its numbers, whatever it is given; what comes next goes on.
    assert batch(0, [1, 2]) == first and batch(2, [5, 15]) == [(4, 5), (5, 15)]
    assert batch(7, [99]) == [(6, 99)]
    with pytest.raises(ValueError, match="batch 5 comes after"):
        batch(5, [1])


def test_nested_labels_are_cleaned_at_any_depth(spark):
    from tillroll.functions.text import clean_nested_labels

    def plain(value):
        if isinstance(value, list):
            return [plain(v) for v in value]
        return " ".join("".join(c for c in value if (c.isascii() and c.isalnum()) or c.isspace()).split()) if isinstance(value, str) else value

    deep = ["a  b!", 1, None, True, {"k \"{ y": ["x  y!"], "z": {"q": "  !"}}, "after  it?"]
    for _ in range(40):
        deep = [deep, "n\u00e9st  \"ed\" {x}", []]
    cases = [[], ["*"], deep, ["{", "}", "\\"], [[["\n A\t\tB "]]]]
    texts = [json.dumps(c) for c in cases] + ["{}", '"x"', "[oops", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    got = [r[1] for r in sorted(df.select("i", clean_nested_labels(F.col("t"))).collect())]
    assert [json.loads(g) for g in got[: len(cases)]] == [plain(c) for c in cases]
    assert got[len(cases) :] == [None] * 4
