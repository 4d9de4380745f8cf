"""The physical plans have the shape the jobs rely on at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tillroll.operators import keys, kv, pages, quality
from tillroll.plans import receipts as plans
from tillroll.storage import work_path
from tillroll.workload import derive, pipeline_queries  # noqa: F401  (it registers)
from tillroll.workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def enriched(spark):
    path = work_path(spark, "plan-enriched")
    derive.enriched(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("pipeline", [plans.keyvalue_final, plans.lineitems])
def test_receipt_pipelines_are_one_narrow_stage(enriched, pipeline):
    plan = plan_of(pipeline(enriched))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<kv_data:string>" in plan


def test_bag_is_parsed_once_even_below_a_filter(enriched):
    keyvalue = plans.keyvalue_final(enriched).filter((F.col("STOREID") == "ST1") & F.col("DATES").isNotNull())
    assert plan_of(keyvalue).count("from_json(") == 1


def test_envelopes_are_parsed_once_for_check_and_enrichment(spark):
    raw = spark.createDataFrame([("a/textract/b.json", "{}")], "path string, raw string")
    checked = quality.good_envelopes(quality.check_envelopes(raw))
    # One for the envelope, one for each bag.
    assert plan_of(checked).count("from_json(") == 3


def test_filters_and_columns_reach_the_scan(spark):
    orders = derive.table(spark, SF_DIR, "orders").filter(F.col("o_custkey") == 1).select("o_orderkey")
    plan = plan_of(orders)
    assert "EqualTo(o_custkey,1)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_pivot_merges_before_the_shuffle(spark):
    long = spark.createDataFrame([(1, 0, "A", "x")], "id int, pos int, label string, value string")
    plan = plan_of(kv.kv_pivot(long, ["id"], ["A", "B"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_min_by")


def test_repeat_search_keeps_two_rows_per_hash_before_the_shuffle(spark):
    rows = spark.createDataFrame([(1, 1, 1)], "doc int, page int, hash int")
    plan = plan_of(pages.first_repeats(rows, "doc", "page", "hash"))
    below = plan[plan.index("Exchange hashpartitioning(doc#", plan.index("WindowGroupLimit")):]
    assert re.search(r"WindowGroupLimit .* 2, Partial", below)


def test_last_writer_shuffles_paths_only(spark):
    rows = spark.createDataFrame([("a/x", 1)], "path string, v int")
    plan = plan_of(quality.last_by_basename(rows))
    assert "partial_max(path" in plan and "max_by(" not in plan


def test_surrogate_keys_never_gather_rows(spark):
    rows = spark.range(100).withColumnRenamed("id", "k")
    plan = plan_of(keys.surrogate_key(rows, ["k"], "pk"))
    assert plan.count("Exchange SinglePartition") == 1
    single = plan[plan.index("Exchange SinglePartition"):].splitlines()
    # What meets in one task is the aggregated count per range partition.
    assert "HashAggregate(keys=[_range" in single[1]


def test_hot_document_is_split_in_the_cut_join(spark):
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 9000).alias("doc"),
            (F.col("id") + 1).alias("page"),
            F.md5(F.col("id").cast("string")).alias("hash"),
        )
        repeated = rows.filter("doc = 4").limit(2).select("doc", (F.col("page") + 70000).alias("page"), "hash")
        kept = pages.pages_before_duplicate(rows.union(repeated), "doc", "page", "hash")
        kept.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(kept)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_document_of_many_pages_is_written_as_json_over_many_files(spark):
    """The JSON of a 10,000-page document, of one without elements and of others equals the plain build."""
    import glob
    import json
    import tempfile

    from tillroll.plans import combined, receipts

    pages = {"long": 10_000, "none": 0, "two": 2}
    fields, items = [], []
    for doc, n in pages.items():
        for page in range(1, n + 1):
            fields += [(doc, page, 0, pos, "T", f'k "{pos}"', f"v{page}\n", None if pos else 99.5, 1.0) for pos in range(2)]
            items += [(doc, page, d, 0, f"item {page}", page / 4, "1", 90.0, None, 90.0) for d in range(2)]
    kv_columns = "doc STRING, page INT, doc_no INT, pos INT, " + ", ".join(
        f"{b} {'DOUBLE' if 'Confidence' in b else 'STRING'}" for b in receipts._KV_BAGS
    )
    li_columns = "doc STRING, page INT, doc_no INT, pos INT, items STRING, price DOUBLE, quantity STRING, " + ", ".join(
        f"{b} DOUBLE" for b in receipts._ITEM_BAGS[3:]
    )
    totals = [("long", 12.345), ("none", None), ("two", 7.0)]
    lines = combined.combined_lines(
        spark.createDataFrame(fields, kv_columns).repartition(8),
        spark.createDataFrame(items, li_columns).repartition(8),
        spark.createDataFrame(totals, "doc STRING, total_amount DOUBLE"),
        "doc",
        "page",
    )
    path = tempfile.mkdtemp(prefix="run-") + "/combined"
    combined.write_combined(lines, path, "doc")
    files = sorted(glob.glob(f"{path}/part-*"))
    sizes = [sum(1 for _ in open(f)) for f in files]
    assert len(files) >= 2 and max(sizes) < 0.9 * sum(sizes)
    text = "".join(open(f).read() for f in files)
    decoder, at, found = json.JSONDecoder(), 0, []
    while at < len(text):
        value, at = decoder.raw_decode(text, at)
        found.append(value)
        at += len(text[at:]) - len(text[at:].lstrip())

    def plain(doc):
        own_fields, own_items = [[r for r in rows if r[0] == doc] for rows in (fields, items)]
        bags = lambda rows, names: {b: ["" if r[4 + i] is None else r[4 + i] for r in rows] for i, b in enumerate(names)}
        return {"SummaryData": bags(own_fields, receipts._KV_BAGS), "LineItemsData": bags(own_items, receipts._ITEM_BAGS)}

    assert [f.pop("TotalAmount") for f in found] == [12.35, 0.0, 7.0]
    assert found == [plain(doc) for doc in ("long", "none", "two")]


def test_responses_are_derived_without_interpreted_lists(spark):
    plan = plan_of(derive.responses(spark, SF_DIR))
    assert "lambda" not in plan and "transform(" not in plan


def test_derived_lists_have_as_many_elements_as_the_line_number_says(spark):
    counts = [(0,), (1,), (2,), (3,), (-1,), (None,)]
    lists = spark.createDataFrame(counts, "n_items int").select(derive.per_item(lambda j: j * 10).alias("l")).collect()
    assert [r.l for r in lists] == [[], [10], [10, 20], [10, 20, 30], [], []]
    cases = spark.createDataFrame([(True, None), (None, "a"), (False, "b"), (True, "c")], "there boolean, e string")
    one = derive.present((F.col("there"), F.struct("e")), (F.lit(True), F.struct(F.lit("z").alias("e"))))
    got = [[x.e for x in r.l] for r in cases.select(one.alias("l")).collect()]
    assert got == [[None, "z"], ["z"], ["z"], ["c", "z"]]


def test_the_bags_of_merged_pages_are_built_once(spark):
    """What reads the checked pages reads built bags, and the text of bad pages only is kept (F20)."""
    item = '{"LineItemExpenseFields":[{"Type":{"Text":"PRICE"},"ValueDetection":{"Text":"1.25"}}]}'
    good = '{"ExpenseDocuments":[{"SummaryFields":[{"Type":{"Text":"T"}}],"LineItemGroups":[{"LineItems":[%s]}]}]}' % item
    rows = [(1, 1, "a", good), (1, 2, "b", "{oops"), (2, 1, "a", good)]
    pages_of = spark.createDataFrame(rows, "doc int, page int, hash string, r string")
    fields, items, totals, rejects = plans.multipage_document(pages_of, "doc", "page", "hash", "r")
    for read in (fields, items, totals):
        assert "lambdafunction" not in plan_of(read)
    assert {(r.doc, r.page, r.price) for r in items.collect()} == {(1, 1, 1.25), (2, 1, 1.25)}
    assert {(r.doc, r.total_amount, r.rejected) for r in totals.collect()} == {(1, 1.25, 1), (2, 1.25, 0)}
    assert [(r.page, r.raw) for r in rejects.collect()] == [(2, "{oops")]
    stored = spark.read.parquet(*rejects.inputFiles())
    assert stored.filter("raw is not null").count() == 1 and stored.count() == 3


def test_deriving_responses_leaves_no_method_too_long_to_compile(spark):
    """The JVM never compiles a method of more than 8,000 bytes, so every row would be interpreted (F7, F8, F16, F18, F20)."""
    package = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    adaptive, broadcast = "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"
    before = {name: spark.conf.get(name, None) for name in (adaptive, broadcast)}
    spark.conf.set(adaptive, "false")
    spark.conf.set(broadcast, "-1")
    try:
        made = {name: QUERIES[name] for name in ("responses_to_keyvalue", "responses_to_lineitem_direct", "ocr_to_envelope", "extract_kv")}
        for query, make in {**made, "damaged": derive.damaged_responses}.items():
            plan = make(spark, SF_DIR)._jdf.queryExecution().executedPlan()
            stages = package.codegenStringSeq(plan)
            sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
            assert sizes and max(sizes) < 8000, (query, sizes)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_texts_of_responses_are_escaped_and_missing_members_left_out(spark):
    """The text of a response, put together from pieces, says what the tables say, whatever their names hold."""
    import datetime
    import json
    import tempfile

    folder = tempfile.mkdtemp(prefix="run-")
    day = datetime.datetime(2020, 2, 3)
    tables = {
        "lineitem": ("l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_suppkey BIGINT, l_extendedprice DOUBLE, l_quantity DOUBLE",
                     [(154, 3, 4, 1, 1234.5, 2.0), (154, None, 4, 1, 1.0, None), (2, 2, 5, None, None, None), (2, 1, 30, 1, 2.0, 5.0)]),
        "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP", [(154, 1, day), (2, 2, None)]),
        "customer": ("c_custkey BIGINT, c_name STRING, c_nationkey INT", [(1, 'a "b"\\\t\n/', 3), (2, None, None)]),
        "part": ("p_partkey BIGINT, p_name STRING", [(4, 'x "y" \\z'), (5, None), (30, "é\x01 u")]),
    }
    for name, (columns, rows) in tables.items():
        spark.createDataFrame(rows, columns).write.parquet(f"{folder}/{name}.parquet")
    got = {r.session: json.loads(r.response)["ExpenseDocuments"] for r in derive.responses(spark, folder).collect()}
    assert sorted(got) == ["S154-3-4-1-123450", "S154-4-1-100", "S2-1-30-1-200", "S2-2-5"]
    one, two = got["S154-3-4-1-123450"]
    assert [f["Type"]["Text"] for f in one["SummaryFields"]] == ["NAME", "INVOICE_RECEIPT_DATE", "ADDRESS", "OTHER", "NAME"]
    assert one["SummaryFields"][0]["ValueDetection"] == {"Text": 'a "b"\\\t\n/', "Confidence": 99.75} and two["SummaryFields"] == one["SummaryFields"][:1]
    assert one["SummaryFields"][2]["ValueDetection"] == {"Text": "54 Road\nCity 3"} and two["LineItemGroups"] == []
    items = [i["LineItemExpenseFields"] for g in one["LineItemGroups"] for i in g["LineItems"]]
    assert [len(g["LineItems"]) for g in one["LineItemGroups"]] == [1, 2] and items[0][2]["ValueDetection"]["Text"] == 'x\n"y"\n\\z 1'
    assert items[1][2]["ValueDetection"] == {"Text": 'x "y" \\z', "Confidence": 95.5}
    assert items[0][3]["ValueDetection"] == {"Text": "1,235.50", "Confidence": 93.0} and items[0][4]["ValueDetection"] == {"Text": "3"}
    assert got["S154-4-1-100"][0]["LineItemGroups"] == [{"LineItems": []}, {}]
    none = got["S2-2-5"][0]
    assert none["SummaryFields"][0]["ValueDetection"] == {"Confidence": 99.75} and none["SummaryFields"][1]["ValueDetection"] == {}
    fields = none["LineItemGroups"][1]["LineItems"][0]["LineItemExpenseFields"]
    assert [f["ValueDetection"] for f in fields[2:]] == [{"Confidence": 95.5}, {"Confidence": 92.0}, {}]
    assert [len(i["LineItemExpenseFields"]) for i in got["S2-1-30-1-200"][0]["LineItemGroups"][0]["LineItems"]] == [4]
