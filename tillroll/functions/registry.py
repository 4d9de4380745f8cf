"""SQL names for functions that SQL users call."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillroll.functions.text import SPACE

# Fixed value: the name existing SQL calls.
CLEAN_ITEMS = "clean_item_list_udf"


def register_sql_functions(spark: SparkSession) -> None:
    """Define SQL functions the optimizer inlines; no Python runs when they are called."""
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {CLEAN_ITEMS}(items STRING)
        RETURNS ARRAY<STRING>
        RETURN transform(
            from_json(items, 'ARRAY<STRING>'),
            item -> regexp_replace(
                upper(regexp_replace(item, r'[^a-zA-Z{SPACE}]+', '')), r'[{SPACE}]+', ' '))
        """
    )
