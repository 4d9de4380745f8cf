"""Money, counts and durations held as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillroll.functions.binding import let

# The accepted number format and the value that marks anything else.
PLAIN_NUMBER = r"\A[0-9]+(\.[0-9]{1,2})?\n?\z"
NOT_A_NUMBER = -1.0

_FLOAT = r"\A\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"


def strip_commas(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def number_or_minus_one(text: Column) -> Column:
    """Digits with at most two decimals; everything else, NULL too, is -1."""
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double")).otherwise(F.lit(NOT_A_NUMBER))


def sanitize_price(text: Column) -> Column:
    return number_or_minus_one(strip_commas(text))


def sanitize_quantity(text: Column) -> Column:
    """Thousands commas are not removed here, so ``1,000`` is -1."""
    return number_or_minus_one(text)


def money(text: Column) -> Column:
    """OCR price text to DOUBLE, NULL where it is no number."""
    plain = strip_commas(text)
    return F.when(plain.rlike(_FLOAT), plain.try_cast("double"))


def plain_notation(text: Column) -> Column:
    """``1.0E7`` as ``10000000``; other text unchanged.

    JSON numbers of ten million and more read into text use an exponent, which
    the plain-number rule would turn into -1.
    """
    digits = F.regexp_replace(text.try_cast("decimal(38,10)").cast("string"), r"\.?0+\z", "")
    return F.when(text.rlike(r"\A[0-9.]+E[0-9-]+\z"), digits).otherwise(text)


def array_total(prices: Column) -> Column:
    return F.aggregate(prices, F.lit(0.0), lambda total, p: total + p)


def round_total(total: Column) -> Column:
    """Two decimals, half up on the decimal value; what no decimal holds has no decimals to round."""
    return F.coalesce(F.round(total.try_cast("decimal(38,10)"), 2).cast("double"), total)


def format_duration(seconds: Column) -> Column:
    """``H:MM:SS[.ffffff]`` with an ``N day(s), `` prefix from one day on."""
    # Seconds beyond 64 bits of microseconds have no text.
    micros = F.bround(seconds.try_cast("decimal(30,8)") * 1000000, 0).try_cast("bigint")

    def text(given):
        return let(F.floor(given / 1000000).cast("bigint"), lambda whole: _clock(whole, given - whole * 1000000))

    # Both are bound: every part of the text is built on them, and a decimal costs more than the rest.
    return let(micros, lambda given: F.when(given.isNotNull(), text(given)))


def _clock(whole: Column, fraction: Column) -> Column:
    days = F.floor(whole / 86400).cast("bigint")
    rest = whole - days * 86400
    hours = F.floor(rest / 3600).cast("bigint")
    minutes = F.floor((rest - hours * 3600) / 60).cast("bigint")

    def two_digits(value):
        return F.lpad(value.cast("string"), 2, "0")

    prefix = F.when(days == 1, "1 day, ").when(days > 1, F.concat(days, F.lit(" days, "))).otherwise("")
    clock = F.concat_ws(
        ":", hours, two_digits(minutes), two_digits(rest - hours * 3600 - minutes * 60)
    )
    tail = F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))
    return F.concat(prefix, clock, F.when(fraction > 0, tail).otherwise(""))
