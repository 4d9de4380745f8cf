"""Secret scan by an incremental blob ledger.

A version is a path and the text it had. Texts are content-addressed: the blob
id is the SHA-256 of the UTF-8 bytes, so a text that lies under many paths, or
comes back in a later run, is one blob. The ledger is a Parquet folder with one
row per scan of a blob: which rule versions it applied and what they found. A
run scans only pairs of blob and rule version that the ledger lacks, appends
them, and joins the findings of all blobs back to all paths.

Defined results: a null text is an empty one; an empty table gives an empty
result and an empty ledger batch; repeated rows each get their findings, also
under a null path or with several texts under one path; extra columns are
ignored. Texts are scanned whole; offsets are code points, ends
exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm.common import table, utf8_rows, whole_text, work_path


@dataclass(frozen=True)
class Rule:
    """``hints``: a text without any of them, lower-cased or not, cannot match."""

    kind: str
    version: int
    pattern: str
    hints: tuple[bytes, ...] = ()
    any_case: bool = False
    secret_group: int = 0
    least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# A run of 24 or more is the run that the pattern without a length finds; same for 4 + 16.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        (b"passw", b"secret", b"token", b"api"),
        any_case=True,
        secret_group=2,
        least=6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", (b"AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", (b"PRIVATE KEY",)),
    Rule("web_token", 1, r"eyJ[\w-]{10,}\.eyJ[\w-]{10,}\.[\w-]{10,}", (b"eyJ",)),
    Rule("forge_token", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", (b"gh",)),
)
RULES = BASE_RULES + MORE_RULES

LEDGER = "blob STRING, rules ARRAY<STRING>, findings ARRAY<STRUCT<kind: STRING, start: INT, stop: INT>>"
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))


def with_blob(versions: DataFrame, text: str = "text") -> DataFrame:
    return versions.withColumn("blob", F.sha2(whole_text(text), 256))


def _scanner(rules: Sequence[Rule]):
    """Arrow batches of (blob, text, seen) to ledger rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on_text = {
            r.key: re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0)) for r in rules
        }
        on_bytes = {
            r.key: re.compile(r.pattern.encode(), re.IGNORECASE if r.any_case else 0) for r in rules
        }
        for batch in batches:
            data, at = utf8_rows(batch.column("text"))
            out: dict[str, list] = {"blob": batch.column("blob"), "rules": [], "findings": []}
            for i, seen in enumerate(batch.column("seen").to_pylist()):
                todo = [r for r in rules if r.key not in (seen or ())]
                raw = data[at[i] : at[i + 1]].tobytes()
                lower, text, found = None, None, []
                for r in todo:
                    where = raw
                    if r.any_case:
                        where = lower = raw.lower() if lower is None else lower
                    if r.hints and not any(h in where for h in r.hints):
                        continue
                    # ASCII patterns match the same runs in bytes; a hit is then placed in code points.
                    if not on_bytes[r.key].search(raw):
                        continue
                    text = raw.decode() if text is None else text
                    for m in on_text[r.key].finditer(text):
                        if m.end(r.secret_group) - m.start(r.secret_group) >= r.least:
                            found.append({"kind": r.kind, "start": m.start(), "stop": m.end()})
                out["rules"].append([r.key for r in todo])
                out["findings"].append(found)
            yield pa.RecordBatch.from_arrays(
                [out["blob"], pa.array(out["rules"], pa.list_(pa.string())), pa.array(out["findings"], _FOUND)],
                names=["blob", "rules", "findings"],
            )

    return scan


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; none if nothing was written there yet."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def unseen_blobs(
    versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, path: str = "path", text: str = "text"
) -> DataFrame:
    """blob, text and seen rules of each blob that some rule version has not scanned, one row per blob."""
    spark = versions.sparkSession
    # One text per blob, whatever paths it lies under; equal texts merge in the map tasks already.
    texts = with_blob(versions.select(whole_text(text).alias("text"))).groupBy("blob").agg(F.first("text").alias("text"))
    done = (
        read_ledger(spark, ledger)
        .select("blob", F.explode("rules").alias("rule"))
        .filter(F.col("rule").isin([r.key for r in rules]))
        .groupBy("blob")
        .agg(F.collect_set("rule").alias("seen"))  # at most one entry per rule version
    )
    todo = texts.join(done, "blob", "left").filter(
        F.col("seen").isNull() | (F.size("seen") < len(rules))
    )
    return todo.select("blob", "text", "seen")


def scan_unseen(
    versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, path: str = "path", text: str = "text"
) -> None:
    """Scan what the ledger lacks and append it. Paths may be null or repeated; only texts count here."""
    todo = unseen_blobs(versions, ledger, rules, path, text)
    todo.mapInArrow(_scanner(rules), LEDGER).write.mode("append").parquet(ledger)


def findings_of_paths(
    versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, path: str = "path", text: str = "text"
) -> DataFrame:
    """path, blob and all findings of the given rule versions, one row per version."""
    spark = versions.sparkSession
    wanted = [(r.key, r.kind) for r in rules]
    # A blob scanned in several runs has a row for each; every rule version is in exactly one.
    scans = read_ledger(spark, ledger)
    kinds = F.array_distinct(
        F.flatten(F.array(*[F.when(F.array_contains("rules", k), F.array(F.lit(n))).otherwise(F.array().cast("array<string>")) for k, n in wanted]))
    )
    per_blob = (
        scans.select("blob", F.filter("findings", lambda f: F.array_contains(kinds, f["kind"])).alias("findings"))
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("findings")).alias("findings"))  # one list per run of one blob
    )
    named = with_blob(versions.select(F.col(path).alias("path"), F.col(text).alias("text"))).drop("text")
    return named.join(per_blob, "blob", "left").select(
        "path", "blob", F.coalesce("findings", F.array().cast(per_blob.schema["findings"].dataType)).alias("findings")
    )


def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document a version whose path is its doc_id, scanned into a new ledger."""
    versions = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    ledger = work_path(spark, "secret-ledger")
    scan_unseen(versions, ledger)
    found = findings_of_paths(versions, ledger)

    order = [r.kind for r in RULES]
    base = [r.kind for r in BASE_RULES]

    def listed(kinds: list[str]):
        chosen = F.filter("findings", lambda f: f["kind"].isin(kinds))
        placed = F.array_sort(
            F.transform(
                chosen,
                lambda f: F.struct(
                    f["start"].alias("start"),
                    F.array_position(F.array(*map(F.lit, order)), f["kind"]).alias("nth"),
                    F.concat_ws(":", f["kind"], f["start"], f["stop"]).alias("said"),
                ),
            )
        )
        return F.array_join(F.transform(placed, lambda f: f["said"]), ",")

    def count(kind: str):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint")

    return found.select(
        F.col("path").alias("doc_id"),
        *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(order).alias("spans"),
        "blob",
    )
