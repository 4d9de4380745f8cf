"""Exact substring deduplication by distributed prefix doubling.

A byte is removed if it lies in a string of ``length`` bytes that also starts
anywhere else, in the same or another text. Sorting all suffixes would move every
position; instead the suffixes at *anchors* are ranked. An anchor is a position
whose next 16 bytes hash lowest in some window of ``length / 4`` positions. Equal
strings have equal anchors inside, and every string of ``length`` bytes has one
among its first ``length / 4`` positions, so whatever repeats shows at an anchor.

Ranking is prefix doubling: positions start with the rank of a first block, are
sorted as pairs of that rank and the rank of what follows at a growing offset,
and are ranked anew; a position whose rank is unique is out. Three rounds reach
the threshold: half of what any repeat must share from its anchor on, all of it,
and the whole surroundings of the anchor. If the surroundings repeat, so does
every string that has the anchor early in it. For the others of such a rank group the
single strings are ranked by themselves, once per different surroundings.

A position comes with the fingerprints of its blocks, so Spark shuffles once by
the first rank and the later rounds sort inside a bucket. Equal texts are
ranked once: all of a text that has a copy is removed. So a group of copies
weighs no more than one text, and a bucket holds positions of distinct texts. Of
the positions of one text that agree in all blocks and surroundings, as in a run of
one byte, two are sent for all; the others take over what is found for them.

Ranks are 64-bit fingerprints; two different strings of a corpus of n positions
fall together with a chance of n**2 / 2**65.

Defined results: a null text is an empty one; texts shorter than ``length`` keep
all bytes; repeated rows are copies of each other; an empty table gives an empty
result; extra columns are ignored; texts are read whole. In the remaining text,
where a cut goes through a character, what is left of it reads as U+FFFD; the
checksum is that of the exact bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm.common import RollingHash, materialize, mixed, table, whole_text

LENGTH = 400
PIECE = 1 << 19
BUCKET_BYTES = 100_000_000

_POSITION = np.dtype([("rank", "<u8"), ("around", "<u8"), ("next", "<u4"), ("at", "<u4")])
_STRING = np.dtype([("rank", "<u8"), ("at", "<u4")])
_FOUND = np.dtype([("at", "<u4"), ("flags", "u1")])
_REPEATED, _ASKED = 1, 2


class Anchors:
    """Anchors of texts for one length."""

    def __init__(self, length: int):
        self.length = length
        self.window = max(1, length // 4)
        self.seed = max(1, min(16, length // 4))
        self.sure = length - self.window + 1  # what repeats from an anchor on
        self.half = max(1, self.sure // 2)
        self.margin = self.window + length
        self.hash = RollingHash(PIECE + 2 * self.margin + self.seed, seed=3)

    def _lowest(self, h: np.ndarray) -> np.ndarray:
        """Whether a position is lowest in some window of consecutive positions."""
        n, w = len(h), self.window
        if n < w:
            return np.zeros(n, bool)
        low = _sliding(h, w, np.minimum)
        # The highest of the lows of all windows that contain the position.
        high = _sliding(np.r_[np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)], w, np.maximum)
        return high == h

    def pieces(self, data: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For pieces of a text: their first byte's place, hash prefixes, and the anchors that are theirs."""
        for a in range(0, len(data), PIECE):
            start, end = max(0, a - self.margin), min(len(data), a + PIECE + self.margin)
            prefixes = self.hash.prefixes(data[start:end])
            n = end - start - self.seed + 1
            if n <= 0:
                continue
            at = np.arange(n)
            picked = np.nonzero(self._lowest(self.hash.windows(prefixes, at, at + self.seed)))[0]
            mine = picked[(picked + start >= a) & (picked + start < a + PIECE)]
            yield start, prefixes, mine

    def places(self, data: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *(start + mine for start, _, mine in self.pieces(data))])

    def positions(self, data: np.ndarray) -> np.ndarray:
        """The records of the anchors at which something may repeat."""
        out = [np.zeros(0, _POSITION)]
        for start, prefixes, p in self.pieces(data):
            size = len(prefixes) - 1
            p = p[p + start + self.sure <= len(data)]
            if not len(p):
                continue
            records = np.zeros(len(p), _POSITION)
            records["at"] = p + start
            records["rank"] = self.hash.windows(prefixes, p, p + self.half)
            records["next"] = self.hash.windows(prefixes, p + self.half, p + self.sure)
            left = np.maximum(p - self.window + 1, 0)
            right = np.minimum(p + self.length, size)
            # Cut at the text's ends; surroundings cut differently are different.
            cut = ((p - left) * (self.length + 1) + right - p).astype(np.uint64)
            records["around"] = mixed(self.hash.windows(prefixes, left, right) + cut)
            out.append(records)
        return np.concatenate(out)

    def strings(self, data: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Ranks of the strings that have one of the ``asked`` anchors early in them."""
        asked = np.sort(asked.astype(np.int64))
        first = np.maximum(asked - self.window + 1, 0)
        # A start that two anchors share is ranked once.
        first[1:] = np.maximum(first[1:], asked[:-1] + 1)
        last = np.minimum(asked, len(data) - self.length)
        counts = np.maximum(last - first + 1, 0)
        starts = np.repeat(first - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
        out = np.zeros(len(starts), _STRING)
        out["at"] = starts
        for a in range(0, len(data), PIECE):
            mine = (starts >= a) & (starts < a + PIECE)
            if mine.any():
                prefixes = self.hash.prefixes(data[a : a + PIECE + self.length])
                s = starts[mine] - a
                out["rank"][mine] = self.hash.windows(prefixes, s, s + self.length)
        return out


def _sliding(x: np.ndarray, w: int, best: np.ufunc) -> np.ndarray:
    """Best of each window of w, by running bests from both ends of blocks of w."""
    n = len(x)
    full = -(-n // w) * w
    padded = np.concatenate([x, np.full(full - n, x[-1])]).reshape(-1, w)
    forward = best.accumulate(padded, axis=1).ravel()
    backward = best.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(backward[: n - w + 1], forward[w - 1 : n])


@lru_cache(maxsize=2)
def anchors(length: int) -> Anchors:
    return Anchors(length)


def ranked(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort by the pairs (or more) and rank: equal ones share a rank. Ranks, and how many have each."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank, np.bincount(rank, minlength=1)[rank] if len(rank) else rank


# --- packed rows: many records of many texts in one row ----------------------------------

_PACKED = "part INT, ids BINARY, counts BINARY, records BINARY"
_ID = 16


def _packed(ids: list[bytes], records: list[np.ndarray], parts: int) -> pa.RecordBatch:
    owner = np.repeat(np.arange(len(ids)), [len(r) for r in records])
    flat = np.concatenate(records) if records else np.zeros(0, _STRING)
    part = (flat["rank"] % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    rows: list[tuple] = []
    for p in range(parts):
        mine = order[edges[p] : edges[p + 1]]
        if len(mine):
            who, counts = np.unique(owner[mine], return_counts=True)
            rows.append((p, b"".join(ids[w] for w in who), counts.astype("<u4").tobytes(), flat[mine].tobytes()))
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "ids", "counts", "records"])


def _unpacked(group: pa.Table, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct records with a number for their text, and the texts' ids."""
    raw = np.frombuffer(b"".join(group.column("ids").to_pylist()), np.uint64).reshape(-1, 2)
    counts = np.frombuffer(b"".join(group.column("counts").to_pylist()), "<u4")
    records = np.frombuffer(b"".join(group.column("records").to_pylist()), kind)
    text, _ = ranked(raw[:, 0], raw[:, 1])
    owner = np.repeat(text, counts)
    # A text that lies in several input batches was sent by each of them.
    once = np.unique(owner * (1 << 32) + records["at"], return_index=True)[1]
    ids = np.zeros((int(text.max()) + 1 if len(text) else 0, 2), np.uint64)
    ids[text] = raw
    return records[once], owner[once], ids


def _by_text(owner: np.ndarray, ids: np.ndarray, found: np.ndarray) -> pa.Table:
    order = np.argsort(owner, kind="stable")
    owner, found = owner[order], found[order]
    who, first = np.unique(owner, return_index=True)
    ends = np.r_[first[1:], len(owner)]
    return pa.Table.from_arrays(
        [
            pa.array([ids[w].tobytes() for w in who], pa.binary()),
            pa.array([found[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
        ],
        names=["text_id", "found"],
    )


_BY_TEXT = "text_id BINARY, found BINARY"


def _send_positions(length: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = anchors(length)
        for batch in batches:
            ids, records, size = [], [], 0
            texts = dict(zip(batch.column("text_id").to_pylist(), range(batch.num_rows)))  # equal texts once
            for text_id, row in texts.items():
                ids.append(text_id)
                records.append(_two_of_each(tool.positions(_bytes(batch.column("text")[row]))))
                size += records[-1].nbytes
                if size > 8 << 20:
                    yield _packed(ids, records, parts)
                    ids, records, size = [], [], 0
            yield _packed(ids, records, parts)

    return run


def _bytes(text: pa.Scalar) -> np.ndarray:
    return np.frombuffer(text.as_py().encode(), np.uint8)


def _unzipped(text: pa.Scalar) -> bytes:
    return zstandard.decompress(text.as_py())


def _classes(positions: np.ndarray) -> np.ndarray:
    """Positions of a text that agree in everything share a number."""
    return ranked(positions["rank"], positions["next"], positions["around"])[0]


def _two_of_each(positions: np.ndarray) -> np.ndarray:
    """Two are enough to see that a class repeats."""
    if len(positions) < 3:
        return positions
    classes = _classes(positions)
    order = np.argsort(classes, kind="stable")
    third = np.zeros(len(order), bool)
    third[2:] = classes[order][2:] == classes[order][:-2]
    return positions[np.sort(order[~third])]


def _all_of_each(positions: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places of all positions whose class has one of the places ``at``."""
    classes = _classes(positions)
    told = np.zeros(int(classes.max(initial=-1)) + 1, bool)
    told[classes[np.isin(positions["at"], at)]] = True
    return positions["at"][told[classes]]


def _double(group: pa.Table) -> pa.Table:
    """The rounds of one bucket: what repeats around an anchor, and whose strings are to be ranked."""
    records, owner, ids = _unpacked(group, _POSITION)
    keep, rank = np.arange(len(records)), np.zeros(len(records), np.int64)
    for name in ("rank", "next"):  # first block, then the pair with what follows it
        rank, times = ranked(rank, records[name][keep])
        alive = times > 1
        keep, rank = keep[alive], rank[alive]
    around, times = ranked(rank, records["around"][keep])
    flags = np.where(times > 1, _REPEATED, 0).astype(np.uint8)
    # Strings of a rank group are asked for where some surroundings are unique: one text speaks for equal ones.
    open_ranks = np.unique(rank[times == 1])
    speaker = np.zeros(len(keep), bool)
    speaker[np.unique(around, return_index=True)[1]] = True
    flags[speaker & np.isin(rank, open_ranks)] |= _ASKED
    told = np.nonzero(flags)[0]
    found = np.zeros(len(told), _FOUND)
    found["at"], found["flags"] = records["at"][keep[told]], flags[told]
    return _by_text(owner[keep[told]], ids, found)


def _send_strings(length: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = anchors(length)
        for batch in batches:
            ids, records, size = [], [], 0
            for text_id, text, found in zip(*(batch.column(c) for c in ("text_id", "text", "found"))):
                told = _joined(found, _FOUND)
                asked = told["at"][(told["flags"] & _ASKED) > 0]
                if len(asked):
                    ids.append(text_id.as_py())
                    records.append(tool.strings(np.frombuffer(_unzipped(text), np.uint8), asked))
                    size += records[-1].nbytes
                if size > 8 << 20:
                    yield _packed(ids, records, parts)
                    ids, records, size = [], [], 0
            yield _packed(ids, records, parts)

    return run


def _joined(lists: pa.Scalar, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(lists.as_py() or ()), kind)


def _repeated_strings(group: pa.Table) -> pa.Table:
    records, owner, ids = _unpacked(group, _STRING)
    _, times = ranked(records["rank"])
    again = times > 1
    return _by_text(owner[again], ids, np.ascontiguousarray(records["at"][again]))


def spans_of(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs that ranges cover."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > reach[:-1]]
    return list(zip(starts[new].tolist(), np.r_[reach[:-1][new[1:]], reach[-1]].tolist()))


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = anchors(length)
        window = tool.window
        for batch in batches:
            spans, removed, kept = [], [], []
            for text, found, strings in zip(*(batch.column(c) for c in ("text", "found", "strings"))):
                data = _unzipped(text)
                told = _joined(found, _FOUND)
                at = told["at"][(told["flags"] & _REPEATED) > 0]
                if len(at):
                    at = _all_of_each(tool.positions(np.frombuffer(data, np.uint8)), at)
                at = at.astype(np.int64)
                own = _joined(strings, np.dtype("<u4")).astype(np.int64)
                starts = np.r_[np.maximum(at - window + 1, 0), own]
                ends = np.r_[np.minimum(at, len(data) - length), own] + length
                runs = spans_of(starts, ends)
                digest, last = hashlib.sha256(), 0
                for a, b in runs:
                    digest.update(data[last:a])
                    last = b
                digest.update(data[last:])
                spans.append([{"start": a, "stop": b} for a, b in runs])
                removed.append(sum(b - a for a, b in runs))
                kept.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("text_id"),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                names=["text_id", "spans", "n_removed", "kept_sha256"],
            )

    return run


_REMOVED = "text_id BINARY, spans ARRAY<STRUCT<start: BIGINT, stop: BIGINT>>, n_removed BIGINT, kept_sha256 STRING"


_ROW = "n_bytes BIGINT, sha STRING, text_id BINARY, zipped BINARY"


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as they travel: compressed, half of what a shuffle would make of them."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = [t.as_py().encode() for t in batch.column("text")]
        digests = [hashlib.sha256(t) for t in texts]
        columns = [
            batch.column("key"),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([d.hexdigest() for d in digests], pa.string()),
            pa.array([d.digest()[:_ID] for d in digests], pa.binary()),
            pa.array([squeeze(t) for t in texts], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "n_bytes", "sha", "text_id", "zipped"])


def _keep_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for zipped, spans, n_bytes in zip(batch.column("zipped"), batch.column("spans").to_pylist(), batch.column("n_bytes").to_pylist()):
            if spans and spans[0]["start"] == 0 and spans[0]["stop"] == n_bytes:
                texts.append("")
                continue
            data, last, kept = _unzipped(zipped), 0, []
            for span in spans:
                kept.append(data[last : span["start"]])
                last = span["stop"]
            kept.append(data[last:])
            texts.append(b"".join(kept).decode(errors="replace"))
        names = ["key", "n_bytes", "n_removed", "spans", "kept_sha256"]
        columns = [*(batch.column(n) for n in names), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=[*names, "text"])


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """key, n_bytes, n_removed, spans (byte ranges to remove), kept_sha256 and the remaining text of every row."""
    whole = whole_text(text)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), whole.alias("text")).mapInArrow(_zip, f"key {kind}, {_ROW}")
    text_id = F.substring(F.unhex(F.sha2(whole, 256)), 1, _ID)
    texts = docs.select(whole.alias("text"), text_id.alias("text_id")).filter(F.octet_length("text") >= length)
    size = docs.agg(F.sum(F.octet_length(whole)).alias("n")).first().n or 0
    parts = max(1, -(-size // BUCKET_BYTES)) * 2

    sent = texts.mapInArrow(_send_positions(length, parts), _PACKED)
    told = sent.groupBy("part").applyInArrow(_double, _BY_TEXT)
    per_text = told.groupBy("text_id").agg(F.collect_list("found").alias("found"))  # at most one entry per bucket
    once = rows.filter(F.col("n_bytes") >= length).groupBy("text_id").agg(F.first("zipped").alias("text"))
    near = materialize(once.join(per_text, "text_id"), "repeating-texts")

    strings = near.mapInArrow(_send_strings(length, parts), _PACKED)
    again = strings.groupBy("part").applyInArrow(_repeated_strings, _BY_TEXT)
    own = again.groupBy("text_id").agg(F.collect_list("found").alias("strings"))
    removed = near.join(own, "text_id", "left").mapInArrow(_remove(length), _REMOVED)

    # A text with a copy goes whole; only counts of copies are needed for that.
    copies = docs.select(text_id.alias("text_id")).groupBy("text_id").agg(F.count(F.lit(1)).alias("copies"))
    facts = materialize(copies.join(removed, "text_id", "left"), "text-facts")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    everything = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("stop")))
    none = F.array().cast("array<struct<start: bigint, stop: bigint>>")
    found = rows.join(facts, "text_id").select(
        "key",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, everything).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        "zipped",
    )
    spans = "ARRAY<STRUCT<start: BIGINT, stop: BIGINT>>"
    schema = f"key {kind}, n_bytes BIGINT, n_removed BIGINT, spans {spans}, kept_sha256 STRING, text STRING"
    return found.mapInArrow(_keep_text, schema).withColumnRenamed("key", key)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256", "text"
    )
