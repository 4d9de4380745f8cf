"""Packing token sequences into fixed windows by non-negative least squares.

A document is cut into full windows and one shorter rest. All pieces of one
length are alike, so only the histogram of lengths matters, at most ``window``
numbers whatever the input. The driver enumerates shallow combinations of one,
two or three lengths that fill a window exactly, solves for how often each
should be repeated, ``min |A x - h|`` with ``x >= 0``, rounds down, and takes
what still fits greedily. What is left over is packed greedily, the largest
piece first and then ever the largest that fits; sequences that come out full
stand. The pieces of the others follow each other by length in one stream that
is cut every window, so every residual sequence but the last is full as well.

The plan is a list of runs: the i-th to j-th piece of length l go to
consecutive sequences at one offset, or to consecutive places of the stream. A
piece finds its run from its length and its number among pieces of that length,
so placing pieces is arithmetic in each task. Pieces are numbered in ``SALTS``
cells per length: one length may belong to a third of all pieces.

Only pieces that the stream's cuts go through are tokenised a second time.

Defined results: a null text is empty and, like an empty one, is the end id
alone; an empty table gives an empty result; repeated rows are packed each;
extra columns are ignored; texts are tokenised whole.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillroll.llm.common import materialize, table, whole_text

WINDOW = 2048
END_ID = 1
SALTS = 64
_WORD_BORDER = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")
_FREQUENT = 64  # lengths whose triples are enumerated


# --- tokens -----------------------------------------------------------------------


class Tokens:
    """Ids of whole texts by a byte-level tokenizer file.

    The merges of the file are run by a second library, which is several times
    as fast and gives the same ids: a byte-level vocabulary lists its merges in
    the order of their ids. A text that contains a special token's string goes
    to the file's own tokenizer.
    """

    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    PIECE = 1 << 20

    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        letters = self._byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if i not in added}
        self.merges = tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _byte_letters() -> dict[str, int]:
        """Vocabularies write a byte as its Latin-1 letter, or, if that is not printable, from U+0100 on."""
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}

    def pieces(self, text: str) -> Iterator[str]:
        """The text, cut between words where it is very long."""
        start = 0
        while len(text) - start > self.PIECE:
            # A space between two letters always starts a word.
            cut = _WORD_BORDER.search(text, start + self.PIECE)
            if not cut:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def encode(self, text: str) -> np.ndarray:
        """The ids and the end id."""
        if any(s in text for s in self.special):
            parts = [self.tokenizer.encode(text, add_special_tokens=False).ids]
        else:
            parts = [self.merges.encode_ordinary(p) for p in self.pieces(text)]
        return np.concatenate([*(np.array(p, "<u4") for p in parts), np.array([END_ID], "<u4")])


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_PIECES = "key {key}, text_id STRING, doc_tokens BIGINT, start BIGINT, length INT, ids_crc32 BIGINT"


def _cut(file: str | None, window: int):
    """Arrow batches of (key, text_id, text) to pieces of at most a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(file or tokenizer_file())
        for batch in batches:
            rows, total, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                ids = tokens.encode(text.as_py())
                for a in range(0, len(ids), window):
                    piece = ids[a : a + window]
                    rows.append(i)
                    total.append(len(ids))
                    start.append(a)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(at),
                    batch.column("text_id").take(at),
                    pa.array(total, pa.int64()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int32()),
                    pa.array(crc, pa.int64()),
                ],
                names=["key", "text_id", "doc_tokens", "start", "length", "ids_crc32"],
            )

    return run


# --- plan --------------------------------------------------------------------------


def combinations(histogram: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Lengths that fill a window: itself, pairs, and triples of the frequent ones."""
    here = histogram > 0
    out: list[tuple[int, ...]] = [(window,)] if here[window] else []
    out += [(a, window - a) for a in range(1, window // 2 + 1) if here[a] and here[window - a]]
    frequent = sorted(np.argsort(-histogram[:window], kind="stable")[:_FREQUENT].tolist())
    frequent = [a for a in frequent if here[a]]
    for i, a in enumerate(frequent):
        for b in frequent[i:]:
            c = window - a - b
            if c >= b and here[c]:
                out.append((a, b, c))
    return out


def solve_repeats(combos: list[tuple[int, ...]], histogram: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """Non-negative least squares by coordinate descent; columns have at most three entries."""
    columns = [np.unique(c, return_counts=True) for c in combos]
    norms = [float((m * m).sum()) for _, m in columns]
    rest, x = histogram.astype(float), np.zeros(len(combos))
    for _ in range(sweeps):
        moved = 0.0
        for j, (lengths, times) in enumerate(columns):
            new = max(0.0, x[j] + float(times @ rest[lengths]) / norms[j])
            if new != x[j]:
                rest[lengths] -= times * (new - x[j])
                moved = max(moved, abs(new - x[j]))
                x[j] = new
        if moved < 0.05:
            break
    return x


@dataclass
class Plan:
    """Runs by (length, first number): ``sequence`` and ``offset`` of the first, or its place in the stream."""

    keys: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    stream: np.ndarray  # -1, or the place of the run's first piece in the stream
    stream_sequence: int
    sequences: int

    NUMBERS = 1 << 45

    def place(self, length: np.ndarray, number: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset; a piece that does not fit continues in the next sequence at 0."""
        key = length.astype(np.int64) * self.NUMBERS + number
        run = np.searchsorted(self.keys, key, "right") - 1
        nth = key - self.keys[run]
        at = self.stream[run] + nth * length
        flows = self.stream[run] >= 0
        sequence = np.where(flows, self.stream_sequence + at // window, self.sequence[run] + nth)
        return sequence, np.where(flows, at % window, self.offset[run])


def greedy_fill(histogram: np.ndarray, first: int, window: int) -> tuple[int, ...]:
    """``first`` and then ever the largest length that is left and fits."""
    filled, room = [first], window - first
    for length in np.flatnonzero(histogram[: room + 1])[::-1].tolist():
        if length <= room:
            times = min(int(histogram[length]) - (length == first), room // length)
            filled += [length] * times
            room -= length * times
    return tuple(filled)


def make_plan(histogram: np.ndarray, window: int) -> Plan:
    left = histogram.astype(np.int64).copy()
    combos = combinations(left, window)
    runs: list[tuple[int, int, int, int, int]] = []
    used, sequence = np.zeros(window + 1, np.int64), 0

    def take(combo: tuple[int, ...], wanted: int) -> None:
        nonlocal sequence
        lengths, times = np.unique(combo, return_counts=True)
        n = min(wanted, int((left[lengths] // times).min()))
        if n <= 0:
            return
        offset = 0
        for length in combo:
            runs.append((length, int(used[length]), sequence, offset, -1))
            used[length] += n
            left[length] -= n
            offset += length
        sequence += n

    for combo, x in zip(combos, solve_repeats(combos, left)):
        take(combo, int(x + 1e-9))
    for combo in combos:
        take(combo, 1 << 62)
    for length in range(window, 0, -1):
        while left[length]:
            filled = greedy_fill(left, length, window)
            if sum(filled) < window:
                break
            take(filled, 1 << 62)
    stream = 0
    for length in range(window, 0, -1):
        if left[length]:
            runs.append((length, int(used[length]), 0, 0, stream))
            stream += length * int(left[length])
    runs.sort()
    columns = np.array(runs, np.int64).reshape(-1, 5).T
    keys = columns[0] * Plan.NUMBERS + columns[1]
    return Plan(keys, columns[2], columns[3], columns[4], sequence, sequence + -(-stream // window))


# --- placing -----------------------------------------------------------------------

_PLACED = _PIECES + ", sequence_id BIGINT, offset INT"


def _placer(plan: Plan, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = plan.place(length, number, window)
            kept = batch.select(["key", "text_id", "doc_tokens", "start", "length", "ids_crc32"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int32())],
                names=[*kept.schema.names, "sequence_id", "offset"],
            )

    return run


def _recut(file: str | None):
    """Texts with the cuts asked for them to the checksums on both sides of each cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(file or tokenizer_file())
        for batch in batches:
            out: list[tuple] = []
            for text, text_id, cuts in zip(*(batch.column(c) for c in ("text", "text_id", "cuts"))):
                ids, text_id = tokens.encode(text.as_py()), text_id.as_py()
                for c in cuts.as_py():
                    a, b, z = c["start"], c["start"] + c["fits"], c["start"] + c["length"]
                    out.append((text_id, a, c["fits"], zlib.crc32(ids[a:b].tobytes()), zlib.crc32(ids[b:z].tobytes())))
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["text_id", "start", "fits", "crc1", "crc2"]
            )

    return run


def pack(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, tokenizer: str | None = None
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = docs.select(
        F.col(key).alias("key"), F.sha2(whole_text(text), 256).alias("text_id"), whole_text(text).alias("text")
    )
    kind = docs.schema[key].dataType.simpleString()
    pieces = materialize(rows.mapInArrow(_cut(tokenizer, window), _PIECES.format(key=kind)), "pack-pieces")
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("key", "start"), F.lit(SALTS)))

    cells = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))  # at most window x SALTS
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = cells.select("length", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    histogram = np.zeros(window + 1, np.int64)
    for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row per length
        histogram[r.length] = r.n
    plan = make_plan(histogram, window)

    in_cell = Window.partitionBy("length", "salt").orderBy("key", "start", "text_id")
    numbered = (
        salted.withColumn("nth", F.row_number().over(in_cell) - 1)
        .join(firsts, ["length", "salt"])
        .withColumn("number", F.col("first") + F.col("nth"))
        .drop("salt", "nth", "first")
    )
    placed = materialize(numbered.mapInArrow(_placer(plan, window), _PLACED.format(key=kind)), "pack-placed")

    out = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    fits = (F.lit(window) - F.col("offset")).alias("fits")
    split = placed.filter(F.col("offset") + F.col("length") > window).select("*", fits)
    # A text's rest starts at one place, so it has fewer different cuts than a window has places.
    asked = split.groupBy("text_id").agg(F.collect_set(F.struct("start", "length", "fits")).alias("cuts"))
    texts = rows.groupBy("text_id").agg(F.first("text").alias("text"))
    sums = texts.join(asked, "text_id").mapInArrow(
        _recut(tokenizer), "text_id STRING, start BIGINT, fits INT, crc1 BIGINT, crc2 BIGINT"
    )
    both = materialize(split.join(sums, ["text_id", "start", "fits"]), "pack-split")
    head = both.select("key", "start", F.col("fits").alias("length"), F.col("crc1").alias("ids_crc32"), *out[4:])
    tail = both.select(
        "key",
        (F.col("start") + F.col("fits")).alias("start"),
        (F.col("length") - F.col("fits")).alias("length"),
        F.col("crc2").alias("ids_crc32"),
        "doc_tokens",
        (F.col("sequence_id") + 1).alias("sequence_id"),
        F.lit(0).alias("offset"),
    )
    whole = placed.filter(F.col("offset") + F.col("length") <= window).select(out)
    return whole.unionAll(head).unionAll(tail).withColumnRenamed("key", key)


def _fill(file: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(file or tokenizer_file())
        for batch in batches:
            out: list[tuple] = []
            for text, pieces in zip(batch.column("text"), batch.column("pieces")):
                ids = tokens.encode(text.as_py()).astype(np.int32)
                for p in pieces.as_py():
                    out.append((p["sequence_id"], p["offset"], ids[p["start"] : p["start"] + p["length"]].tolist()))
            columns = list(zip(*out)) or [[]] * 3
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["sequence_id", "offset", "ids"]
            )

    return run


def fill_sequences(
    pieces: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """sequence_id and its ids, unpadded. ``key`` has to be unique in ``docs``."""
    of_doc = pieces.groupBy(key).agg(
        F.collect_list(F.struct("sequence_id", "offset", "start", "length")).alias("pieces")
    )
    texts = docs.select(key, whole_text(text).alias("text")).join(of_doc, key).select("text", "pieces")
    parts = texts.mapInArrow(_fill(tokenizer), "sequence_id BIGINT, offset INT, ids ARRAY<INT>")
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # a window at most
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(in_order, lambda p: p["ids"])).alias("ids"))


def op6_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "start",
        F.col("length").cast("bigint").alias("length"),
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        F.col("offset").cast("bigint").alias("offset"),
    )
