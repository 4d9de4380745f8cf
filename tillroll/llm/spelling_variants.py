"""Spelling variants: a dictionary of pairs of trie nodes.

The words of the corpus form two tries, one read forwards and one read
backwards. Every node has an integer number that its parent's number and the
letter of its edge determine, so all tasks number alike without a shared table
and no join meets at the root. A word of ``L`` letters passes ``L + 1`` nodes of
each trie. It is entered in the dictionary under pairs (prefix node, suffix
node): ``L`` pairs that skip one letter, and ``L + 1`` that skip none, the places
where a letter may be inserted.

* Two words under one pair that both skip a letter differ by a replacement.
* One that skips a letter under a pair where another skips none is that word
  with a letter more. In a run of equal letters only the last is skipped for
  this, so each neighbour comes up once.

A pair fixes all letters but the skipped one: an entry holds at most one word per
letter of the alphabet and one without, whatever the corpus. No pairs of words
become rows: within an entry each word takes the number of its neighbours and
the most frequent one, and both merge per word by a count and a maximum.

Words are counted per task before they are shuffled, so a frequent word costs
one row per task. After that all work is on dense integers in code-point order,
and on words without their texts.

Numbers have 64 bits, a pair 128: that two different pairs of a corpus with
10**10 of them agree is less likely than 10**-18.

Defined results: a null text has no words; a null id counts as an empty one; rows
that repeat an id and a text count as often as they stand there; a run may be as
long as its text; an empty table has no words; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm.common import materialize, mixed, table
from tillroll.operators.keys import surrogate_key

LEAST_LETTERS = 7
LEAST_TIMES = 2
# A word is a variant of a neighbour that is so many times as frequent.
FACTOR = 10
# One in so many runs of letters loses one of them.
ONE_IN = 31

_LETTERS = "A-Za-zÀ-ÿ"
# Distinct words, and their letters, that a task holds before it sends its counts.
_HELD_WORDS = 200_000
_HELD_LETTERS = 1 << 24
# Letters whose dictionary entries are made at once.
_AT_ONCE = 1 << 18
_WORDS_A_TASK = 50_000


def thinned(run: str, crc_of_id: int, one_in: int) -> str:
    """The run without one letter if its checksum says so."""
    h = zlib.crc32(run.encode(), crc_of_id)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(least: int, one_in: int):
    runs = re.compile(f"[{_LETTERS}]{{{max(least, 1)},}}")

    def send(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        letters = 0
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text")):
                # Lower-casing bytes touches A to Z alone.
                lowered = text.as_py().encode().lower().decode()
                crc_of_id = zlib.crc32(f"{key.as_py()}:".encode())
                for word, times in Counter(runs.findall(lowered)).items():
                    word = thinned(word, crc_of_id, one_in)
                    if len(word) >= least:
                        if word not in counts:
                            letters += len(word)
                        counts[word] += times
                if len(counts) >= _HELD_WORDS or letters >= _HELD_LETTERS:
                    yield send(counts)
                    counts, letters = Counter(), 0
        if counts:
            yield send(counts)

    return run


def word_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_times: int = LEAST_TIMES,
    one_in: int = ONE_IN,
) -> DataFrame:
    """``word, n``: the words of all texts and how often they occur."""
    rows = docs.filter(F.col(text).isNotNull()).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text")
    )
    found = rows.mapInArrow(_count(least_letters, one_in), "word STRING, n BIGINT")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_times)


# --- the dictionary -------------------------------------------------------------

_EDGE = np.random.default_rng(11).integers(0, 1 << 63, (2, 256), dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def node_numbers(letters: np.ndarray, at: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Numbers of the nodes on the paths of words; word ``w`` has them from ``at[w] + w`` on, the root first."""
    lengths = np.diff(at)
    numbers = np.empty(len(letters) + len(lengths), np.uint64)
    longest_first = np.argsort(-lengths, kind="stable")
    node, letter = (at[:-1] + np.arange(len(lengths)))[longest_first], at[:-1][longest_first]
    below = -lengths[longest_first]
    numbers[node] = 1
    for depth in range(int(lengths.max(initial=0))):
        n = int(np.searchsorted(below, -depth, "left"))
        numbers[node[:n] + depth + 1] = mixed(numbers[node[:n] + depth] * _STEP + edges[letters[letter[:n] + depth]])
    return numbers


def entries_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per dictionary entry: which word, prefix node, suffix node, and what is skipped.

    0: nothing; 1: a letter; 2: a letter that the next one does not repeat.
    """
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    letters = np.frombuffer(b"".join(words), np.uint8)
    back = np.frombuffer(b"".join(w[::-1] for w in words), np.uint8)
    prefixes, reversed_ = node_numbers(letters, at, _EDGE[0]), node_numbers(back, at, _EDGE[1])
    word = np.repeat(np.arange(len(words)), np.diff(at) + 1)
    place = np.arange(len(prefixes)) - (at[:-1] + np.arange(len(words)))[word]
    left = np.diff(at)[word] - place
    # The suffix of that many letters is a node of the reversed trie at that depth.
    suffix = (at[:-1] + np.arange(len(words)))[word]
    has = left > 0
    letter = (at[:-1][word] + place)[has]
    next_ = np.where(left[has] > 1, letters[np.minimum(letter + 1, len(letters) - 1)], 256)
    skips = np.where(letters[letter] != next_, 2, 1)
    return (
        np.concatenate([word, word[has]]),
        np.concatenate([prefixes, prefixes[has]]),
        np.concatenate([reversed_[suffix + left], reversed_[(suffix + left)[has] - 1]]),
        np.concatenate([np.zeros(len(word), np.int8), skips.astype(np.int8)]),
    )


_ENTRY = "p BIGINT, s BIGINT, id BIGINT, n BIGINT, skips TINYINT"


def _enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, times = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "n"))
        # No letter of a word is beyond U+00FF: one byte each.
        words = [w.as_py().encode("latin-1") for w in batch.column("word")]
        start = 0
        while start < len(words):
            end, letters = start, 0
            while end < len(words) and (end == start or letters + len(words[end]) <= _AT_ONCE):
                letters += len(words[end])
                end += 1
            word, p, s, skips = entries_of(words[start:end])
            columns = [p.view(np.int64), s.view(np.int64), ids[start:end][word], times[start:end][word], skips]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["p", "s", "id", "n", "skips"])
            start = end


def neighbours(words: DataFrame) -> DataFrame:
    """``id``, ``n_near`` and ``best`` (n and -id of the most frequent) of all words with a near word.

    ``words`` has ``id, word, n``, the ids in the order that decides ties.
    """
    # A word makes some twenty entries, so tasks are cut by words, not by the size of their file.
    tasks = 1 + words.count() // _WORDS_A_TASK
    entries = words.select("id", "word", "n").repartition(tasks, "id").mapInArrow(_enter, _ENTRY)
    members = F.collect_list(F.struct("id", "n", "skips")).alias("members")
    # Hardly any pair comes up twice in a task: they are not put together before the shuffle.
    shared = entries.repartition("p", "s").groupBy("p", "s").agg(members)

    def near(me, other):
        replaced = (me.skips > 0) & (other.skips > 0)
        longer = (me.skips == 0) & (other.skips == 2)
        shorter = (me.skips == 2) & (other.skips == 0)
        return (me.id != other.id) & (replaced | longer | shorter)

    def found(me):
        others = F.filter("members", lambda other: near(me, other))
        best = F.array_max(F.transform(others, lambda o: F.struct(o.n.alias("n"), (-o.id).alias("minus_id"))))
        return F.struct(me.id.alias("id"), F.size(others).cast("bigint").alias("n_near"), best.alias("best"))

    each = shared.filter(F.size("members") > 1).select(F.explode(F.transform("members", found)).alias("e")).select("e.*")
    return each.filter("n_near > 0").groupBy("id").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))


def variants(counts: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``word, n``.

    A word's form is its most frequent near word if that occurs ``factor`` times
    as often; its root is where following the forms ends. As frequencies grow by
    ``factor`` at each step, paths are short: their length is at most the
    logarithm of the largest count, and following them takes the logarithm of
    that in rounds.
    """
    words = materialize(surrogate_key(counts, ["word"], "id"), "words")
    found = materialize(neighbours(words), "neighbours")
    known = words.join(found, "id", "left").select(
        "id",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("best.n") >= factor * F.col("n"), F.col("best")).alias("form"),
    )
    steps = materialize(
        known.select("id", "n", "n_near", (-F.col("form.minus_id")).alias("form_id"), F.col("form.n").alias("form_n")),
        "forms",
    )
    links = steps.filter("form_id IS NOT NULL").select("id", F.col("form_id").alias("root_id"))
    while True:
        on = links.select(F.col("id").alias("root_id"), F.col("root_id").alias("further"))
        further = links.join(on, "root_id")
        if further.isEmpty():
            break
        links = materialize(
            links.join(on, "root_id", "left").select("id", F.coalesce("further", "root_id").alias("root_id")), "roots"
        )
    form = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    root = words.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    return (
        words.select("id", "word")
        .join(steps, "id")
        .join(links, "id", "left")
        .join(form, "form_id", "left")
        .join(root, "root_id", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(word_counts(table(spark, sf_dir, "documents")))
