"""Document fingerprints by order MinHash.

A text is a sequence of units: runs of up to ``UNIT`` code points without white
space, an ideograph or kana each by itself. Its k-mers are the ``K`` units from
each place on, every one numbered by how often the same k-mer stood before it, so
that repetition counts. The hashes of these numbered k-mers are cut into
``SLOTS`` equal ranges. In each range the ``TUPLE`` smallest are taken, put back
into their order in the text, and hashed together: that is the slot's value. Two
texts agree in a slot if they share the k-mers that are smallest there and have
them in the same order, which is what an edit or a moved passage breaks and a
plain MinHash does not notice.

One hash of all k-mers, cut into ranges, takes the place of one hash function per
slot: a text is hashed once whatever the number of slots. A range without k-mers
leaves its slot empty, as short texts do; the likeness of two fingerprints is the
share of equal slots among those that are not empty on both sides, and 1 for two
empty fingerprints.

All of it is one Column expression per text, without a shuffle: sorting the
packed pairs (hash, place) brings equal k-mers together, which numbers them, and
sorting the numbered ones brings the ranges together. No step looks at more than
one text, and every step is linear in it or sorts it.

The edited texts of ``edited_fingerprints`` need a document's successor. Only
keys are sorted and numbered for that; of the successor's text only as many code
points travel as are used.

Defined results: a null text is an empty one and has no k-mers; a text of a single
unit has that unit as its k-mer; a text without white space is cut into units, so
any length works. Rows that repeat id and text are one document with as many rows
in the result. Documents follow each other by descending id, null last, texts
with one id by their checksum; the last is followed by the first, a single one by
itself. An empty table gives no rows; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll.llm.common import materialize, table, whole_text
from tillroll.operators.keys import surrogate_key

SLOTS_BITS = 6
SLOTS = 1 << SLOTS_BITS
TUPLE = 2
K = 2
UNIT = 16
_HASH_BITS = 32
_HASH = (1 << _HASH_BITS) - 1
# No text has more code points than 2**31, so a pair (hash, place) fits a long.
_PLACE_BITS = 31
_PLACE = (1 << _PLACE_BITS) - 1
_DIGITS = 8
# Characters that are units by themselves, as their scripts put no space between words.
_ALONE = r"\p{IsIdeographic}\p{IsHiragana}\p{IsKatakana}"
_EMPTY = "0" * _DIGITS


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), then)[0]


def kmer_hashes(text: Column, k: int = K, unit: int = UNIT) -> Column:
    """One 64-bit hash per k-mer, in text order."""
    units = F.regexp_extract_all(text, F.lit(rf"[{_ALONE}]|[^\s{_ALONE}]{{1,{unit}}}"), F.lit(0))

    def grams(hashes: Column) -> Column:
        n = F.size(hashes)
        joined = hashes
        for j in range(1, k):
            rest = F.slice(hashes, j + 1, F.greatest(n - (k - 1), F.lit(0)))
            joined = F.zip_with(F.slice(joined, 1, F.greatest(n - (k - 1), F.lit(0))), rest, lambda a, b: F.xxhash64(a, b))
        return F.when(n < k, F.when(n == 0, hashes).otherwise(F.array(F.xxhash64(hashes)))).otherwise(joined)

    return _let(F.transform(units, lambda u: F.xxhash64(u)), grams)


def _pack(high: Column, low: Column) -> Column:
    return F.shiftleft(high.bitwiseAND(F.lit(_HASH)), _PLACE_BITS).bitwiseOR(low.cast("bigint"))


def _follows(pairs: Column, i: Column) -> Column:
    """Whether the pair at a place of a sorted array has the same hash as the one before."""
    return (i > 0) & (F.shiftright(F.get(pairs, i), _PLACE_BITS) == F.shiftright(F.get(pairs, i - 1), _PLACE_BITS))


def _renumbered(again: Column) -> Column:
    """Pairs of k-mers that stood in the text before, with hashes that depend on how often."""

    def runs(first: Column) -> Column:
        after = F.concat(F.slice(first, 2, F.greatest(F.size(first) - 1, F.lit(0))), F.array(F.size(again)))
        each = F.zip_with(
            first,
            after,
            lambda a, b: F.transform(
                F.slice(again, a + 1, b - a),
                lambda p, nth: _pack(F.xxhash64(F.shiftright(p, _PLACE_BITS), nth), p.bitwiseAND(F.lit(_PLACE))),
            ),
        )
        return F.flatten(each)

    places = F.sequence(F.lit(0), F.size(again) - 1)
    return F.when(F.size(again) == 0, again).otherwise(_let(F.filter(places, lambda i: ~_follows(again, i)), runs))


def numbered(kmers: Column) -> Column:
    """Sorted pairs (hash of k-mer and number of its occurrence, place); the first occurrence keeps its hash."""

    def number(pairs: Column) -> Column:
        first = F.filter(pairs, lambda _, i: ~_follows(pairs, i))
        again = F.filter(pairs, lambda _, i: _follows(pairs, i))
        # Two sorted runs and few numbers between: the sort merges them.
        return F.sort_array(F.concat(first, _let(again, _renumbered)))

    return _let(F.sort_array(F.transform(kmers, _pack)), number)


def fingerprint(text: Column, k: int = K, tuple_size: int = TUPLE, unit: int = UNIT) -> Column:
    """``SLOTS`` values of eight hexadecimal digits each; zeros where a slot is empty."""

    def slot(pair: Column) -> Column:
        return F.shiftright(pair, _PLACE_BITS + _HASH_BITS - SLOTS_BITS).cast("int")

    def value(least: Column) -> Column:
        in_order = F.sort_array(
            F.transform(
                least,
                lambda p: F.shiftleft(p.bitwiseAND(F.lit(_PLACE)), _HASH_BITS).bitwiseOR(F.shiftright(p, _PLACE_BITS)),
            )
        )
        tuple_hash = F.xxhash64(F.transform(in_order, lambda p: p.bitwiseAND(F.lit(_HASH))))
        return F.lpad(F.hex(F.greatest(tuple_hash.bitwiseAND(F.lit(_HASH)), F.lit(1))), _DIGITS, "0")

    def slots(least: Column) -> Column:
        def entry(i: Column) -> Column:
            own = slot(F.get(least, i))
            return F.struct(own, value(F.filter(F.slice(least, i + 1, tuple_size), lambda p: slot(p) == own)))

        places = F.when(F.size(least) > 0, F.sequence(F.lit(0), F.size(least) - 1)).otherwise(F.array().cast("array<int>"))
        first = F.filter(places, lambda i: (i == 0) | (slot(F.get(least, i)) != slot(F.get(least, i - 1))))
        every = F.sequence(F.lit(0), F.lit(SLOTS - 1))
        return _let(
            F.map_from_entries(F.transform(first, entry)),
            lambda found: F.array_join(F.transform(every, lambda s: F.coalesce(found[s], F.lit(_EMPTY))), ""),
        )

    def smallest(pairs: Column) -> Column:
        return F.filter(
            pairs, lambda p, i: (i < tuple_size) | (slot(F.get(pairs, i - tuple_size)) != slot(p))
        )

    return _let(_let(numbered(kmer_hashes(text, k, unit)), smallest), slots)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal slots among those that are not empty in both."""

    def pairs(prints: Column) -> Column:
        def at(i: int, s: Column) -> Column:
            return F.substring(prints[i], s * _DIGITS + 1, F.lit(_DIGITS))

        return F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda s: F.array(at(0, s), at(1, s)))

    both = F.transform(F.array(F.array(a, b)), pairs)[0]
    used = F.filter(both, lambda p: (p[0] != _EMPTY) | (p[1] != _EMPTY))

    def share(slots: Column) -> Column:
        equal = F.size(F.filter(slots, lambda p: p[0] == p[1]))
        return F.when(F.size(slots) == 0, 1.0).otherwise(equal / F.size(slots))

    return _let(used, share)


def _successors(documents: DataFrame, work: str | None) -> DataFrame:
    """``doc, half, next``: each document's key and half length, and the key of the one that follows."""
    order = [F.col("id").desc_nulls_last(), F.col("doc")]
    ranked = materialize(surrogate_key(documents, order, "rank"), "order", work)
    last = ranked.agg(F.max("rank").alias("n")).first().n or 0
    before = F.when(F.col("rank") == 1, last).otherwise(F.col("rank") - 1)
    following = ranked.select(before.alias("rank"), F.col("doc").alias("next"))
    return materialize(ranked.join(following, "rank").select("doc", "half", "next"), "successors", work)


def edited_fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", work: str | None = None
) -> DataFrame:
    """Fingerprints of all documents and of their edited texts.

    An edited text has, in place of its last ``n_chars // 2`` code points, as many
    from the start of the next document (all, if that has fewer). Returns key,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next.
    """
    whole = whole_text(text)
    named = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("-")), F.lit(":"), whole)
    rows = docs.select(F.unhex(F.sha2(named, 256)).alias("doc"), F.col(key).alias("id"), whole.alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    pairs = _successors(rows.select("doc", "id", half.alias("half")).distinct(), work)

    # The same columns of every document go both ways, so the texts are exchanged once.
    once = (
        rows.groupBy("doc")
        .agg(F.first(F.struct("id", "text")).alias("own"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 0")
    )
    starts = once.withColumnRenamed("doc", "next").join(pairs, "next")
    start = F.substring(F.col("own.text"), F.lit(1), F.col("half"))
    received = starts.select("doc", "half", start.alias("start"), "next")
    n_chars = F.length("own.text")
    edited = F.concat(F.substring(F.col("own.text"), F.lit(1), n_chars - F.col("half")), F.col("start"))
    both = once.join(received, "doc").select(
        "doc", "next", "copies", F.col("own.id").alias("id"), F.array("own.text", edited).alias("texts")
    )
    found = materialize(
        both.select(
            "doc",
            "next",
            "copies",
            "id",
            F.length(F.col("texts")[0]).cast("bigint").alias("n_chars"),
            F.unhex(F.sha2(F.col("texts")[1], 256)).alias("edited_sha256"),
            F.transform("texts", lambda t: F.unhex(fingerprint(t))).alias("prints"),
        ),
        "fingerprints",
        work,
    )
    next_ = found.select(F.col("doc").alias("next"), F.col("prints")[0].alias("next_print"))
    own, changed = F.col("prints")[0], F.col("prints")[1]
    return (
        found.join(next_, "next")
        .select(
            F.col("id").alias(key),
            "n_chars",
            F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
            F.hex(own).alias("fingerprint"),
            F.hex(changed).alias("edited_fingerprint"),
            likeness(F.hex(own), F.hex(changed)).alias("near_edited"),
            likeness(F.hex(own), F.hex("next_print")).alias("near_next"),
            F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
        )
        .drop("copy")
    )


def op12_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
