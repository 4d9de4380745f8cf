"""Label and item-name cleaning, as built-in string expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillroll.functions.binding import let

# Fixed value: regex class members that equal Unicode-aware ``\s``. Java's own
# ``\s`` covers ASCII only, so separators and the four control separators are added.
SPACE = r"\s\p{Z}\x1c-\x1f\x85"


def squeeze(text: Column) -> Column:
    """Every run of whitespace becomes one space."""
    return F.regexp_replace(text, f"[{SPACE}]+", " ")


def merge_label(type_text: Column, key_text: Column) -> Column:
    """Upper-cased Key, or Type where Key is missing, empty or the word ``other``."""
    # A look for two letters is cheaper than the pattern, which most keys don't match.
    other = (key_text.contains("th") | key_text.contains("TH") | key_text.contains("Th") | key_text.contains("tH")) & key_text.rlike(
        rf"(?i)\A[{SPACE}]*other[{SPACE}]*\z"
    )
    blank = key_text.isNull() | (key_text == "") | other
    return F.upper(F.when(blank, type_text).otherwise(key_text))


def clean_label(label: Column) -> Column:
    """ASCII letters, digits and single inner spaces only."""

    joined = F.replace(label, F.lit("_"), F.lit(""))
    rest = F.trim(squeeze(F.regexp_replace(label, rf"[^\p{{Alnum}}{SPACE}]+", "")))
    # Most labels are words, or words joined by underscores; to see that is cheaper than two patterns.
    return F.when(~label.rlike(r"[^\p{Alnum}_]"), joined).otherwise(rest)


def _paired(types: Column, keys: Column, label) -> Column:
    # zip_with pads the shorter list; pairs beyond it do not exist here.
    shared = F.least(F.size(types), F.size(keys))
    return F.slice(F.zip_with(types, keys, label), F.lit(1), shared)


def merge_labels(types: Column, keys: Column) -> Column:
    """One label per (Type, Key) pair; stops at the shorter list."""
    return _paired(types, keys, merge_label)


def clean_labels(labels: Column) -> Column:
    return F.transform(labels, clean_label)


def receipt_labels(types: Column, keys: Column) -> Column:
    """The cleaned label of every pair; a merged label is computed once, before it is cleaned."""
    return clean_labels(merge_labels(types, keys))


def clean_item(item: Column) -> Column:
    """Upper-case letters and single spaces; digits go, outer spaces stay."""
    letters = F.regexp_replace(item, f"[^a-zA-Z{SPACE}]+", "")
    return squeeze(F.upper(letters))


def parse_list(text: Column) -> Column:
    """A list held as text; NULL where the text is no list."""
    return F.from_json(text, "ARRAY<STRING>")


def clean_items(text: Column) -> Column:
    """Item names from a list held as text."""
    return F.transform(parse_list(text), clean_item)


def quoted_values(text: Column) -> Column:
    """Everything between double quotes. Numbers are not quoted, so they yield nothing.

    ``(?d)``: only a newline ends a line, as in the usual meaning of ``.``.
    """
    return F.regexp_extract_all(text, F.lit('(?d)"(.*?)"'), F.lit(1))


def clean_address(address: Column) -> Column:
    return F.regexp_replace(address, "\n", " ")


# A string of JSON text; an object's brace; whatever lies between.
_JSON_TOKENS = r'"(?:[^"\\]|\\.)*"|[{}]|[^"{}]+'


def clean_nested_labels(nested: Column) -> Column:
    """``clean_label`` on every string of a JSON list, at any depth of lists.

    Takes and returns JSON text; a list stays as it is but for its strings. What
    lies inside an object is left alone, and so are numbers, booleans and nulls.
    NULL where the text is no JSON list. The text is cut into tokens once, so
    depth costs nothing and needs no recursion.
    """

    def cleaned(token: Column) -> Column:
        text = F.from_json(F.concat(F.lit("["), token, F.lit("]")), "ARRAY<STRING>")
        listed = F.to_json(F.array(let(F.get(text, 0), clean_label)))
        return F.substring(listed, F.lit(2), F.length(listed) - 2)

    def token_kind(token: Column) -> Column:
        return F.when(token == "{", 1).when(token == "}", -1).otherwise(0)

    def rewritten(tokens: Column) -> Column:
        # Objects are rare in lists of labels; only where there is one is its depth followed.
        flat = F.transform(tokens, lambda t: F.when(t.startswith('"'), cleaned(t)).otherwise(t))
        start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("out"))

        def step(state: Column, t: Column) -> Column:
            kept = F.when(t.startswith('"') & (state["depth"] == 0), cleaned(t)).otherwise(t)
            return F.struct((state["depth"] + token_kind(t)).alias("depth"), F.concat(state["out"], F.array(kept)).alias("out"))

        followed = F.aggregate(tokens, start, step, lambda state: state["out"])
        return F.array_join(F.when(F.array_contains(tokens, "{"), followed).otherwise(flat), "")

    is_list = F.try_parse_json(nested).isNotNull() & nested.rlike(r"\A\s*\[")
    return F.when(is_list, let(F.regexp_extract_all(nested, F.lit(_JSON_TOKENS), F.lit(0)), rewritten))
