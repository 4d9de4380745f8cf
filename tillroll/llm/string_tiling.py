"""Benchmark decontamination by greedy string tiling.

A benchmark item is in a document if tiles cover enough of the item's words. A
tile is a run of at least ``LEAST`` words that stands in both, and no word
belongs to two tiles. Tiles are laid greedily: the Karp-Rabin hashes of all runs
of ``LEAST`` words give the seeds, seeds that follow each other grow into
maximal matches, and again and again the longest match is marked; what a marked
tile overlaps is cut back to its unmarked part and waits its turn again. As
tiles may lie in any order, a passage whose sentences were moved is found too.

Documents meet the items by shared seeds. While the items are small, by their
measured bytes, their seeds go to every task and a document is read once;
beyond that seeds are joined by a shuffle and texts are fetched for the pairs
found. Both ways give the same rows.

Words are runs of letters, digits and underscores, compared in lower case.
Items with fewer than ``LEAST`` words have to occur whole; items without words
never match.

Defined results: null texts are empty and match nothing; empty tables give an
empty result; repeated rows are reported each; extra columns are ignored; ties
between equally long matches go to the earlier one.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm.common import WordHashes, materialize, separators, table, utf8_rows, whole_text

LEAST = 5
COVERAGE = 0.5
# Bytes of item texts whose seeds may go to every task.
BROADCAST_BYTES = 4 << 20
# Pairs of equal seeds looked at in one go; texts that repeat themselves have very many.
PAIRS = 1 << 22

_NOT_WORD = re.compile(r"[^\w\x00-\x7f]+")
_WORDS = WordHashes(separators(lambda b: b >= 128 or chr(b).isalnum() or b == ord("_")))


def folded(text: str) -> bytes:
    low = text.lower()
    return (low if low.isascii() else _NOT_WORD.sub(" ", low)).encode()


def _buffer(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    return utf8_rows(pa.array([folded(t or "") for t in texts], pa.large_binary()))


def text_words(text: str | None) -> np.ndarray:
    data, at = _buffer([text])
    return np.concatenate([w for _, w, _ in _WORDS.rows(data, at)])


# --- tiling -----------------------------------------------------------------------------


def tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(place in doc, place in item, words) of the greedily laid tiles."""
    left, right = _WORDS.grams(doc, least), _WORDS.grams(item, least)
    order = np.argsort(right, kind="stable")
    ranked = right[order]
    low, high = np.searchsorted(ranked, left, "left"), np.searchsorted(ranked, left, "right")
    before = np.r_[0, np.cumsum(high - low)]
    if not before[-1]:
        return []
    heads, tails, s = [], [], 0
    while s < len(left):
        # Of the pairs only the first and the last of each maximal match are kept.
        e = max(s + 1, int(np.searchsorted(before, before[s] + PAIRS, "right")) - 1)
        count = high[s:e] - low[s:e]
        d = np.repeat(np.arange(s, e), count)
        i = order[np.repeat(low[s:e] - (before[s:e] - before[s]), count) + np.arange(len(d))]
        new = (d == 0) | (i == 0) | (left[d - 1] != right[i - 1])
        after = (d + 1 == len(left)) | (i + 1 == len(right))
        after |= left[(d + 1) % len(left)] != right[(i + 1) % len(right)]
        heads.append((d[new], i[new]))
        tails.append((d[after], i[after]))
        s = e
    (d, i), (d_end, i_end) = (tuple(map(np.concatenate, zip(*p))) for p in (heads, tails))
    line, line_end = np.lexsort((d, d - i)), np.lexsort((d_end, d_end - i_end))
    d, i = d[line], i[line]
    sizes = d_end[line_end] - d + least
    line = np.lexsort((i, d, -sizes))
    d, i, sizes = d[line], i[line], sizes[line]
    waiting: list[tuple[int, int, int]] = []  # what is left of matches that were cut back
    k = 0
    in_doc, in_item = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    out, free = [], len(item)
    while (waiting or k < len(d)) and free >= least:
        whole = (-int(sizes[k]), int(d[k]), int(i[k])) if k < len(d) else None
        if waiting and (whole is None or waiting[0] < whole):
            n, a, b = heapq.heappop(waiting)
        else:
            n, a, b = whole
            k += 1
        taken = in_doc[a : a - n] | in_item[b : b - n]
        if not taken.any():
            in_doc[a : a - n] = in_item[b : b - n] = True
            out.append((a, b, -n))
            free += n
            continue
        edges = np.diff(np.r_[True, taken, True].astype(np.int8))
        for s, e in zip(np.nonzero(edges == -1)[0], np.nonzero(edges == 1)[0]):
            if e - s >= least:
                heapq.heappush(waiting, (-int(e - s), a + int(s), b + int(s)))
    return out


class Items:
    """Benchmark items ready to be looked for."""

    def __init__(self, keys: list, words: list[np.ndarray], least: int, coverage: float):
        self.coverage = coverage
        kept = [(k, w) for k, w in zip(keys, words) if len(w)]
        self.keys, self.words = [k for k, _ in kept], [w for _, w in kept]
        self.least = [min(least, len(w)) for w in self.words]
        # By run length: seed, item, and at how many places of the item the seed stands.
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in sorted(set(self.least)):
            mine = [j for j, m in enumerate(self.least) if m == n]
            grams = [np.unique(_WORDS.grams(self.words[j], n), return_counts=True) for j in mine]
            flat, owner = np.concatenate([g for g, _ in grams]), np.repeat(mine, [len(g) for g, _ in grams])
            order = np.argsort(flat, kind="stable")
            self.seeds[n] = flat[order], owner[order], np.concatenate([t for _, t in grams])[order]

    def candidates(self, doc: np.ndarray) -> list[int]:
        """Items of which enough places hold a seed that is there: n places cover at most n * least words."""
        out: list[int] = []
        for n, (seeds, owner, places) in self.seeds.items():
            grams = np.unique(_WORDS.grams(doc, n))
            low, high = np.searchsorted(seeds, grams, "left"), np.searchsorted(seeds, grams, "right")
            hit = np.nonzero(high > low)[0]
            if len(hit):
                found = np.concatenate([owner[low[h] : high[h]] for h in hit])
                items, nth = np.unique(found, return_inverse=True)
                times = np.bincount(nth, np.concatenate([places[low[h] : high[h]] for h in hit]))
                out += [int(j) for j, t in zip(items, times) if t * n >= self.coverage * len(self.words[j])]
        return sorted(out)

    def matches(self, doc: np.ndarray) -> list[tuple]:
        """(item key, coverage, covered words, tiles) of the items that are in the document."""
        out = []
        for j in self.candidates(doc):
            laid = tiles(doc, self.words[j], self.least[j])
            covered = sum(n for _, _, n in laid)
            if laid and covered >= self.coverage * len(self.words[j]):
                out.append((self.keys[j], covered / len(self.words[j]), covered, len(laid)))
        return out

    def rows(self, texts: pa.Array) -> Iterator[tuple[int, list[tuple]]]:
        data, at = _buffer(texts.to_pylist())
        for first, words, offsets in _WORDS.rows(data, at):
            any_hit = np.zeros(len(words) + 1, np.int64)
            for n, (seeds, _, _) in self.seeds.items():
                grams = _WORDS.grams(words, n)
                near = np.searchsorted(seeds, grams)
                any_hit[1 : len(grams) + 1] += seeds[np.minimum(near, len(seeds) - 1)] == grams
            before = np.cumsum(any_hit)
            # Most documents share no seed at all; runs across two rows only add a look.
            for r in np.nonzero(before[offsets[1:]] > before[offsets[:-1]])[0]:
                found = self.matches(words[offsets[r] : offsets[r + 1]])
                if found:
                    yield first + int(r), found


def _columns(rows: list[tuple], kinds: list[pa.DataType]) -> list[pa.Array]:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return [pa.array(list(c), k) for c, k in zip(columns, kinds)]


_MATCH = "item STRING, coverage DOUBLE, covered_words INT, n_tiles INT"
_KINDS = [pa.string(), pa.float64(), pa.int32(), pa.int32()]


def _find(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for r, found in items.rows(batch.column("text")):
                at += [r] * len(found)
                rows += found
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(at, pa.int32())), *_columns(rows, _KINDS)],
                names=["key", "item", "coverage", "covered_words", "n_tiles"],
            )

    return run


def _keep_clean(items: Items, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[r for r, _ in items.rows(batch.column(text))]] = False
            yield batch.filter(pa.array(keep))

    return run


# --- the way for items of any size -----------------------------------------------------


def _seed_rows(least: int):
    """(id, text) to distinct (seed, n, id, words), with the number of its places, for the run lengths that items may have."""

    def run(batches: Iterator[pa.RecordBatch], sizes: range | None = None) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = _buffer(batch.column("text").to_pylist())
            ids = batch.column("id")
            for first, words, offsets in _WORDS.rows(data, at):
                for r in range(len(offsets) - 1):
                    mine = words[offsets[r] : offsets[r + 1]]
                    for n in sizes or [min(least, len(mine))]:
                        grams, places = np.unique(_WORDS.grams(mine, n) if n else np.zeros(0, np.uint64), return_counts=True)
                        if len(grams):
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(grams.view(np.int64)),
                                    pa.array(np.full(len(grams), n, np.int32)),
                                    pa.array([ids[first + r].as_py()] * len(grams), pa.string()),
                                    pa.array(np.full(len(grams), len(mine), np.int32)),
                                    pa.array(places.astype(np.int32)),
                                ],
                                names=["seed", "n", "id", "words", "places"],
                            )

    return run


_SEEDS = "seed BIGINT, n INT, id STRING, words INT, places INT"


def _tile_pairs(least: int, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at = [], []
            texts = zip(batch.column("text"), batch.column("item_text"), batch.column("item"))
            for i, (text, item_text, item) in enumerate(texts):
                one = Items([item.as_py()], [text_words(item_text.as_py())], least, coverage)
                found = one.matches(text_words(text.as_py()))
                rows += found
                at += [i] * len(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_id").take(pa.array(at, pa.int32())), *_columns(rows, _KINDS)],
                names=["text_id", "item", "coverage", "covered_words", "n_tiles"],
            )

    return run


def _found_by_shuffle(rows: DataFrame, items: DataFrame, least: int, coverage: float) -> DataFrame:
    """Matches by text id, from seeds joined by a shuffle; each distinct text is tiled once."""
    named = items.select(F.col("item").alias("id"), "text")
    seeds = named.mapInArrow(_seed_rows(least), _SEEDS).withColumnsRenamed({"id": "item", "words": "item_words"})
    texts = rows.groupBy("text_id").agg(F.first("text").alias("text"))
    lengths = [r.n for r in seeds.select("n").distinct().collect()]  # at most ``least`` numbers
    run = _seed_rows(least)
    of_docs = texts.select(F.col("text_id").alias("id"), "text").mapInArrow(lambda b: run(b, lengths), _SEEDS).drop("words", "places")
    pairs = (
        of_docs.join(seeds, ["seed", "n"])
        .groupBy(F.col("id").alias("text_id"), "item", "n", "item_words")
        .agg(F.sum("places").alias("shared"))
        .filter(F.col("shared") * F.col("n") >= F.lit(coverage) * F.col("item_words"))
        .select("text_id", "item")
    )
    both = pairs.join(texts, "text_id").join(items.select("item", F.col("text").alias("item_text")), "item")
    return both.mapInArrow(_tile_pairs(least, coverage), f"text_id STRING, {_MATCH}")


class Benchmark:
    """Benchmark items and how documents meet them. Item keys have to be unique."""

    def __init__(
        self,
        benchmark: DataFrame,
        key: str = "item_id",
        text: str = "text",
        least: int = LEAST,
        coverage: float = COVERAGE,
        broadcast_bytes: int = BROADCAST_BYTES,
    ):
        self.least, self.coverage = least, coverage
        self.kind = benchmark.schema[key].dataType.simpleString()
        self.items = benchmark.select(F.col(key).cast("string").alias("item"), whole_text(text).alias("text"))
        size = self.items.agg(F.sum(F.octet_length("text") + 64).alias("b")).first().b or 0
        self.small: Items | None = None
        if size <= broadcast_bytes:
            rows = self.items.collect()  # at most broadcast_bytes
            self.small = Items([r["item"] for r in rows], [text_words(r.text) for r in rows], least, coverage)

    def matches(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """One row per document and item in it: key, item_id, coverage, covered_words, n_tiles."""
        if self.small is not None:
            kind = docs.schema[key].dataType.simpleString()
            rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            found = rows.mapInArrow(_find(self.small), f"key {kind}, {_MATCH}")
        else:
            rows = docs.select(F.col(key).alias("key"), F.sha2(whole_text(text), 256).alias("text_id"), whole_text(text).alias("text"))
            found = rows.select("key", "text_id").join(
                _found_by_shuffle(rows, self.items, self.least, self.coverage), "text_id"
            )
        return found.select(
            F.col("key").alias(key), F.col("item").cast(self.kind).alias("item_id"), "coverage", "covered_words", "n_tiles"
        )

    def clean(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """The documents without any item, all columns as they are."""
        if self.small is not None:
            return docs.mapInArrow(_keep_clean(self.small, text), docs.schema)
        text_id = F.sha2(whole_text(text), 256)
        rows = docs.select(text_id.alias("text_id"), whole_text(text).alias("text"))
        bad = _found_by_shuffle(rows, self.items, self.least, self.coverage).select("text_id").distinct()
        return docs.join(materialize(bad, "contaminated"), text_id == F.col("text_id"), "left_anti")


def op9_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Benchmark(table(spark, sf_dir, "benchmark")).matches(table(spark, sf_dir, "documents"))
