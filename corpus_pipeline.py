"""The corpus pipeline: documents in, packed token sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``.

1. toxicity: documents that the grammar rejects go.
2. near duplicates: one document of each group of similar ones stays.
3. decontamination: documents that hold a benchmark item go.
4. personal data: entities get surrogates.
5. packing: the token pieces of every document and their places.

No stage samples or caps documents. Stage 1 learns from at most
``toxic_grammar.MAX_TRAINING_DOCS`` labelled documents outside the held-out
fifth. A stage depends on trained weights or greedy tiling, so no SQL states
``run``'s rows; tests hold each stage against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import packing, shingle_join, string_tiling, surrogates, toxic_grammar
from tillroll.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxic_grammar.fit(docs, table(spark, sf_dir, "labels")).keep_clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shingle_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return string_tiling.Benchmark(table(spark, sf_dir, "benchmark")).clean(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return surrogates.masked(docs).drop("n_entities")


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", replace_personal_data),
    ("packing", pack_windows),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
