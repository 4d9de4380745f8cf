"""Receipt dates: free text to ``dd-MM-yyyy`` to DATE."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillroll.functions.binding import let

# Three-letter month names and their numbers.
MONTHS = {
    "jan": "01",
    "feb": "02",
    "mar": "03",
    "apr": "04",
    "may": "05",
    "jun": "06",
    "jul": "07",
    "aug": "08",
    "sep": "09",
    "oct": "10",
    "nov": "11",
    "dec": "12",
}
# Tokens that carry no date.
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
NOISE = ["weal"]

DATE_FORMAT = "dd-MM-yyyy"


def date_tokens(text: Column) -> Column:
    """Parts of a date text without weekday names and noise words."""
    tokens = F.split(F.translate(text, "/-", "  "), " ")
    words = F.filter(tokens, lambda t: ~F.lower(t).isin(WEEKDAYS + NOISE))
    return F.when(text.rlike(r"\p{L}"), words).otherwise(tokens)


def _month(token: Column) -> Column:
    pairs = [F.lit(x) for pair in MONTHS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.lower(token))


def _ordered(tokens: Column) -> Column:
    n = F.size(tokens)
    a, b, c = (F.get(tokens, F.lit(i)) for i in range(3))
    month = _month(a)
    numeric = F.forall(tokens, lambda t: t.rlike(r"\A[0-9]+\z"))
    three_numbers = (n == 3) & numeric & (F.length(c) == 2)
    return (
        F.when(n.isin(3, 4) & month.isNotNull(), F.concat_ws("-", b, month, c))
        .when(three_numbers & (F.length(a) == 2), F.concat(a, F.lit("-"), b, F.lit("-20"), c))
        .when(three_numbers & (F.length(a) == 4), F.concat_ws("-", c, b, a))
        .when(n == 3, F.concat_ws("-", tokens))
    )


def normalize_date(text: Column) -> Column:
    """Date text in ``dd-MM-yyyy`` order; NULL where no rule reads it."""
    return let(date_tokens(text), _ordered)


def parse_date(text: Column) -> Column:
    """``dd-MM-yyyy`` to DATE; anything else is NULL, also under ANSI mode."""
    # A text with letters is no such date; to look for one is cheaper than to fail.
    return F.when(~text.rlike("[A-Za-z]"), F.try_to_date(text, DATE_FORMAT))


def receipt_date(text: Column) -> Column:
    return let(normalize_date(text), parse_date)
