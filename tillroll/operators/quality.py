"""Missing values, bad inputs, repeated targets."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, functions as F

from tillroll import schemas
from tillroll.functions.binding import settled
from tillroll.functions.dates import receipt_date
from tillroll.functions.envelopes import entry, read_envelope
from tillroll.functions.paths import basename, decode_key


def missing_counts(df: DataFrame, column: str) -> DataFrame:
    """Missing date texts and missing dates, in one pass."""
    return df.agg(
        F.count_if(F.col(column).isNull()).alias("missing_text"),
        F.count_if(receipt_date(F.col(column)).isNull()).alias("missing_date"),
    )


def _parsed(text: str, schema: str):
    # Empty text gives no struct at all, broken text one with the corrupt field set.
    return F.from_json(
        F.col(text),
        f"STRUCT<{schema}, {schemas.CORRUPT}: STRING>",
        {"columnNameOfCorruptRecord": schemas.CORRUPT},
    )


def _judged(checks) -> dict:
    """``error_type`` and ``error_message`` of the first check that fails; NULL where none does."""
    kind = message = F.when(F.lit(False), "")
    for failed, name, where in checks:
        kind, message = kind.when(failed, name), message.when(failed, where)
    return {"error_type": kind, "error_message": message}


def rejected(checked: DataFrame, stage: str, keep: list[str], raw: str) -> DataFrame:
    """The bad rows of any stage in one shape: ``keep``, stage, error_type, error_message, raw."""
    return checked.filter(F.col("error_type").isNotNull()).select(
        *keep, F.lit(stage).alias("stage"), "error_type", "error_message", F.col(raw).alias("raw")
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("error_type").isNull()).drop("error_type", "error_message")


def check_notifications(df: DataFrame, column: str = "event") -> DataFrame:
    """One row per record of a notification, or one for a notification without any.

    Adds ``bucket``, ``key`` (decoded) and ``object_version`` (what the notification has to
    tell versions of an object apart, or NULL) and says what is wrong.
    """
    opened = settled(df, {"_n": _parsed(column, schemas.NOTIFICATION)})
    records = opened.select("*", F.explode_outer("_n.Records").alias("_record"))
    bucket, key = F.col("_record.s3.bucket.name"), F.col("_record.s3.object.key")
    checks = [
        (F.col("_n").isNull() | F.col(f"_n.{schemas.CORRUPT}").isNotNull(), "MalformedJson", "notification"),
        (F.col("_record").isNull(), "MissingField", "Records"),
        (bucket.isNull(), "MissingField", "bucket"),
        (key.isNull(), "MissingField", "key"),
    ]
    version = F.coalesce(*[F.col(f"_record.s3.object.{name}") for name in ("versionId", "sequencer", "eTag")])
    named = {"bucket": bucket, "key": decode_key(key), "object_version": version}
    return records.withColumns({**named, **_judged(checks)}).drop("_n", "_record")


def check_responses(df: DataFrame, raw: str = "raw") -> DataFrame:
    """One row per expense document of a response, or one for a response without any.

    Adds ``doc_no``, ``last`` (is it the file's last document), ``fields`` and
    ``groups`` and says what is wrong. A response is parsed once.
    """
    opened = settled(df, {"_r": _parsed(raw, schemas.EXPENSE_RESPONSE)})
    documents = F.col("_r.ExpenseDocuments")
    exploded = opened.select("*", F.size(documents).alias("_n"), F.posexplode_outer(documents).alias("doc_no", "_doc"))
    checks = [
        (F.col("_r").isNull() | F.col(f"_r.{schemas.CORRUPT}").isNotNull(), "MalformedJson", "response"),
        (F.col("_doc").isNull(), "MissingField", "ExpenseDocuments"),
        (F.col("_doc.SummaryFields").isNull(), "MissingField", "SummaryFields"),
        (F.col("_doc.LineItemGroups").isNull(), "MissingField", "LineItemGroups"),
    ]
    return exploded.withColumns(
        {
            "last": F.col("doc_no") == F.col("_n") - 1,
            "fields": F.col("_doc.SummaryFields"),
            "groups": F.col("_doc.LineItemGroups"),
            **_judged(checks),
        }
    ).drop("_r", "_doc", "_n")


def check_bags(df: DataFrame, column: str = "kv_data") -> DataFrame:
    """Rows of the receipt table: a bag that is no JSON, or has no lists, is wrong."""
    opened = settled(df, {"_b": _parsed(column, schemas.KV_BAG)})
    lists = F.col("_b.Type").isNull() | F.col("_b.Key").isNull() | F.col("_b.Value").isNull()
    checks = [
        (F.col("_b").isNull() | F.col(f"_b.{schemas.CORRUPT}").isNotNull(), "MalformedJson", column),
        (lists, "MissingField", column),
    ]
    return opened.withColumns(_judged(checks)).drop("_b")


def check_envelopes(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Parse envelopes once and say what is wrong with each.

    Adds ``envelope`` (map), the two bag texts ``lineitems`` and ``kv_data``,
    the parsed bags ``li`` and ``kv``, ``error_type`` and ``error_message``. A
    good row has a NULL ``error_type``. One bad document never touches the
    others: rows are routed, nothing is raised and nothing is carried over.
    """
    opened = settled(df, {"envelope": read_envelope(F.col(raw))}).withColumns(
        {name: entry(F.col("envelope"), name) for name in ("lineitems", "kv_data")}
    )
    parsed = settled(
        opened,
        {
            "li": _parsed("lineitems", schemas.LINEITEM_BAG_VARIANT),
            "kv": _parsed("kv_data", schemas.KV_BAG_VARIANT),
        },
    )

    def malformed(bag):
        return F.col(bag).isNull() | F.col(f"{bag}.{schemas.CORRUPT}").isNotNull()

    def lacks(bag, *fields):
        return functools.reduce(
            lambda a, b: a | b, [F.col(f"{bag}.{field}").isNull() for field in fields]
        )

    checks = [
        (F.col("envelope").isNull(), "MalformedJson", "envelope"),
        (F.col("lineitems").isNull(), "MissingField", "lineitems"),
        (F.col("kv_data").isNull(), "MissingField", "kv_data"),
        (malformed("li"), "MalformedJson", "lineitems"),
        (malformed("kv"), "MalformedJson", "kv_data"),
        (lacks("li", "items", "price", "quantity"), "MissingField", "lineitems"),
        (lacks("kv", "Type", "Key", "Value"), "MissingField", "kv_data"),
    ]
    return parsed.withColumns(_judged(checks))


def quarantine(checked: DataFrame, path: str = "path", raw: str = "raw") -> DataFrame:
    return checked.filter(F.col("error_type").isNotNull()).select(
        path, "error_type", "error_message", raw
    )


def good_envelopes(checked: DataFrame) -> DataFrame:
    return accepted(checked)


def last_by_basename(df: DataFrame, path: str = "path") -> DataFrame:
    """Objects with equal file name write to the same key: the last path wins.

    A path names one object; rows that repeat the winning path are all kept.

    The winners are found from the paths alone, each map task sending one path
    per name; the documents themselves then only meet the list of winners.
    """
    names = df.select(path).groupBy(basename(F.col(path)).alias("target"))
    winners = names.agg(F.max(path).alias("_winner"))
    return winners.join(df, winners["_winner"] == df[path]).drop("_winner")
