"""Compute an expensive value once, whatever is built on top of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A Column used ten times in an expression is evaluated ten times when it
    cannot be shared by generated code; a one-element ``transform`` binds it to
    a lambda variable instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def without_gaps(values: Column, other: Column) -> Column:
    """Whether a list holds no NULL, told without a lambda; also false or NULL for no list and where it holds ``other``.

    A lambda is interpreted node by node, so lists that need none are told apart from those that do.
    """
    return F.array_contains(values, other) == F.lit(False)


def filled(values: Column, blank, other) -> Column:
    """``values`` with ``blank`` for every NULL; ``other`` is a value of the type that hardly comes."""
    return F.when(without_gaps(values, F.lit(other)), values).otherwise(F.transform(values, lambda v: F.coalesce(v, F.lit(blank))))


def settled(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add ``columns`` so that later filters use their values, not their expressions.

    The optimizer moves a filter below the projection it reads from and puts a
    copy of the expression into it; for JSON parsing that doubles the work at
    every level. It does not move filters below a generator, so the columns
    pass through a one-element ``explode``.
    """
    packed = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.explode_outer(F.array(packed)).alias("_settled")).select(
        *kept, "_settled.*"
    )
