"""Select, rename and cast in one declaration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

Mapping = tuple[str, str, str, str]


def apply_mapping(df: DataFrame, mappings: Sequence[Mapping]) -> DataFrame:
    """``(source, source type, target, target type)`` rows as one projection.

    A value the target type cannot hold is NULL, also under ANSI mode.
    """
    columns = []
    for source, source_type, target, target_type in mappings:
        value = F.col(source)
        if source_type != target_type:
            value = value.try_cast(target_type)
        columns.append(value.alias(target))
    return df.select(*columns)
