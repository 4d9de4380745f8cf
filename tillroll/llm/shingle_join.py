"""Jaccard join on word shingles: size-banded tiles, bitmap bounds, exact intersections.

A document's set holds the hashes of its distinct runs of five words. Equal sets
are one class from the start. Then:

1. Tokens are dealt into buckets, packed many to a row. A bucket counts in how
   many sets each token is and sends back those that are in two or more; the
   others cannot be part of any intersection. Tokens that very many sets hold,
   as a sample tells, are shared for certain: their occurrences are dealt by set
   as well, so no group grows with a token.
2. In the order rare tokens first, two sets that reach the similarity share one
   of the first ``n - ceil(t * n) + 1`` tokens (prefix filter). Unshared tokens
   come first, so a set of mostly unshared tokens has no candidates at all,
   whatever passages it has in common with others.
3. Sets that share a prefix token are joined into candidate groups. No pairs are
   emitted: each bucket sends a spanning forest of its own, and a set with a hot
   prefix token is linked with the token itself.
4. A candidate group is cut into tiles of bounded size: by size band, in which
   sizes differ by at most the similarity, and by hash within a band. Inside a
   tile the bit counts of hashed bitmap signatures bound each overlap from above;
   what passes is intersected exactly on sorted arrays. Pairs that are already
   connected are skipped, since classes, not pairs, are wanted.
5. Groups of more than one tile are first linked inside each tile and between
   representatives of tiles; then what is not in the group's largest class meets
   all tiles of its own and the neighbouring bands. So a group of very many near
   copies costs a pass over it, not a pass per pair of tiles.

Links are exact up to collisions: tokens are told apart by 40 bits and their
bucket (a pair of texts with 500 shingles each is off by one with a chance
below one in a million), sets by 128 bits.

Defined results: null and empty texts, and texts without words, have an empty
set, linked with nothing; with fewer than five words the whole sequence is the
only shingle; repeated rows are in one component; rows with a null id get their
component's smallest id, which is null only where all of its ids are; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillroll.llm.common import WordHashes, materialize, mixed, separators, table, utf8_rows, whole_text
from tillroll.llm.components import connected

WORDS = 5
PERCENT = 75
BUCKET_TOKENS = 8_000_000
# A token in about so many sets is hot. Looked for in one of ``SAMPLE`` texts; results do not depend on what is found.
HOT_SETS = 500_000
SAMPLE = 1024
# A tile holds at most about so many sets and tokens.
TILE_SETS = 256
TILE_TOKENS = 2_000_000
BITMAP_WORDS = 16  # of 64 bits

_SPACES = {0x20, *range(0x09, 0x0E)}
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)])
_HASHES = WordHashes(separators(lambda b: b not in _SPACES), _FOLD, seed=11)
_LOW40 = np.uint64((1 << 40) - 1)


# --- sets ---------------------------------------------------------------------------------


def shingle_sets(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted within each row, and where each row's begin and end."""
    n_rows = len(offsets) - 1
    row = np.repeat(np.arange(n_rows), np.diff(offsets))
    grams = _HASHES.grams(words, k)
    whole = row[: len(grams)] == row[k - 1 :] if len(grams) else np.zeros(0, bool)
    tokens, rows = grams[whole], row[: len(grams)][whole]
    sizes = np.diff(offsets)
    short = np.nonzero((sizes > 0) & (sizes < k))[0]
    if len(short):
        few = [_HASHES.grams(words[offsets[r] : offsets[r + 1]], int(sizes[r])) for r in short]
        tokens, rows = np.concatenate([tokens, *few]), np.concatenate([rows, short])
    order = np.lexsort((tokens, rows))
    tokens, rows = tokens[order], rows[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (rows[1:] != rows[:-1])
    return tokens[new], np.r_[0, np.cumsum(np.bincount(rows[new], minlength=n_rows))].astype(np.int64)


def set_ids(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """128 bits per set, as rows of two numbers."""
    low = np.r_[np.uint64(0), np.cumsum(tokens, dtype=np.uint64)]
    high = np.r_[np.uint64(0), np.cumsum(mixed(tokens + np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)]
    return np.stack([x[offsets[1:]] - x[offsets[:-1]] for x in (low, high)], 1)


def _ids(array: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(array)
    return pa.Array.from_buffers(pa.binary(16), len(raw), [None, pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def _sets_of(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    data, at = utf8_rows(column)
    for first, words, offsets in _HASHES.rows(data, at):
        tokens, ends = shingle_sets(words, offsets, k)
        yield first, tokens, ends, set_ids(tokens, ends)


def _describe(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids = [], []
            for _, _, ends, these in _sets_of(batch.column("text"), k):
                sizes.append(np.diff(ends))
                ids.append(these)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("text_id"),
                    pa.array(np.concatenate([np.zeros(0, np.int64), *sizes])),
                    _ids(np.concatenate([np.zeros((0, 2), np.uint64), *ids])),
                ],
                names=["key", "text_id", "n", "set_id"],
            )

    return run


# --- packed rows: (part, sets, sizes, counts, tokens, marks) ----------------------------------

_PACKED = "part INT, sets BINARY, sizes BINARY, counts BINARY, low BINARY, high BINARY, marks BINARY"


def _packed_row(part: int, ids, sizes, counts, tokens: np.ndarray, marks: np.ndarray) -> tuple:
    """40-bit tokens as four bytes and one."""
    return (
        int(part),
        np.ascontiguousarray(ids).tobytes(),
        sizes.astype(np.uint32).tobytes(),
        counts.astype(np.uint32).tobytes(),
        tokens.astype(np.uint32).tobytes(),
        (tokens >> np.uint64(32)).astype(np.uint8).tobytes(),
        marks.astype(np.uint8).tobytes(),
    )


def _packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 7
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
        names=["part", "sets", "sizes", "counts", "low", "high", "marks"],
    )


def _unpacked(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids (rows of two), sizes, owner of each token, tokens, marks; ids are distinct and sorted."""

    def flat(name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(group.column(name).to_pylist()), kind)

    ids = flat("sets", np.uint64).reshape(-1, 2)
    order = np.lexsort((ids[:, 0], ids[:, 1]))
    ranked = ids[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(1)
    nth = np.empty(len(ids), np.int32)
    nth[order] = np.cumsum(new) - 1
    sizes = flat("sizes", np.uint32)[order][new].astype(np.int64)
    owner = np.repeat(nth, flat("counts", np.uint32))
    tokens = flat("high", np.uint8).astype(np.uint64)
    tokens <<= np.uint64(32)
    np.bitwise_or(tokens, flat("low", np.uint32), out=tokens)
    return ranked[new], sizes, owner, tokens, flat("marks", np.uint8)


def _by_part(parts, ids, sizes, owner, tokens, marks) -> Iterator[tuple]:
    """Packed rows of tokens dealt to ``parts``, which holds a number per token; owners ascend."""
    order = np.argsort(parts, kind="stable")
    parts = parts[order]
    edges = np.r_[0, np.nonzero(np.diff(parts))[0] + 1, len(parts)]
    for a, b in zip(edges[:-1], edges[1:]):
        if a < b:
            mine = order[a:b]
            who, counts = np.unique(owner[mine], return_counts=True)
            yield _packed_row(parts[a], ids[who], sizes[who], counts, tokens[mine], marks[mine])


def _distinct_sets(column: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Tokens, the owner of each, sizes and ids, of the distinct sets of runs of rows."""
    for _, tokens, ends, ids in _sets_of(column, k):
        _, first = np.unique(ids, axis=0, return_index=True)
        kept = np.zeros(len(ids), bool)
        kept[first] = True
        owner = np.repeat(np.arange(len(ids)), np.diff(ends))
        mine = kept[owner]
        yield tokens[mine], owner[mine], np.diff(ends), ids


def _buckets_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return (tokens >> np.uint64(40)) % np.uint64(buckets)


def _places_in(sorted_: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the values stand in an ascending array, and whether they do."""
    if not len(sorted_):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return at, sorted_[at] == values


def _occurrences(k: int, buckets: int):
    """Texts to how many of their sets hold a token; tokens with their bucket, as ``named`` elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tokens, _, _, _ in _distinct_sets(batch.column("text"), k):
                named, times = np.unique((tokens & _LOW40) | (_buckets_of(tokens, buckets) << np.uint64(40)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(named.view(np.int64)), pa.array(times)], names=["named", "times"])

    return run


def _hot_tokens(texts: DataFrame, n_rows: int, k: int, buckets: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hot tokens, ascending, the mark of each, and in how many groups each bucket's occurrences of them go."""
    hot: list = []
    if n_rows >= HOT_SETS:
        sample = max(1, min(SAMPLE, HOT_SETS // 500))
        some = texts.filter(F.pmod(F.xxhash64("text"), F.lit(sample)) == 0).distinct()
        times = some.mapInArrow(_occurrences(k, buckets), "named BIGINT, times BIGINT").groupBy("named").agg(F.sum("times").alias("times"))
        # At most one for every HOT_SETS tokens of the corpus.
        hot = times.select("named", (F.col("times") * sample).alias("times")).filter(F.col("times") >= HOT_SETS).collect()
    named = np.array([r.named for r in hot], np.int64).view(np.uint64)
    times = np.array([r.times for r in hot], np.int64)
    order = np.argsort(named)
    named, times = named[order], times[order]
    marks = np.minimum(255, np.round(8 * np.log2(np.maximum(times, 1)))).astype(np.uint8)
    most = int(np.bincount((named >> np.uint64(40)).astype(np.int64), times).max()) if len(named) else 0
    return named, marks, -(-2 * most // BUCKET_TOKENS)


def _deal(k: int, buckets: int, hot: np.ndarray, hot_marks: np.ndarray, salts: int):
    """Texts to the tokens of their distinct sets, dealt by token; hot ones, marked already, by bucket and set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tokens, owner, sizes, ids in _distinct_sets(batch.column("text"), k):
                parts = _buckets_of(tokens, buckets)
                tokens = tokens & _LOW40
                marks = np.zeros(len(tokens), np.uint8)
                if len(hot):
                    at, is_hot = _places_in(hot, tokens | (parts << np.uint64(40)))
                    marks[is_hot] = hot_marks[at[is_hot]]
                    salt = ids[owner[is_hot], 1] % np.uint64(salts)
                    parts[is_hot] += np.uint64(buckets) * (salt + np.uint64(1))
                yield _packed_batch(list(_by_part(parts, ids, sizes, owner, tokens, marks)))

    return run


def _distinct_pairs(pair: list[np.ndarray], n_sets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (token, set) by token and set, without the tokens of one set only; takes the arrays out of ``pair``."""
    tokens, owner = pair.pop(), pair.pop()
    if n_sets <= 1 << 24:
        # A token in the upper 40 bits, its set below: one array to sort.
        both = tokens
        del tokens
        both <<= np.uint64(24)
        np.bitwise_or(both, owner.astype(np.uint32), out=both)
        del owner
        both.sort()
        new = np.ones(len(both), bool)
        np.not_equal(both[1:], both[:-1], out=new[1:])
        both = both[new]
        # Most tokens are in one set; only the others are kept before anything is counted.
        again = (both[1:] ^ both[:-1]) < np.uint64(1 << 24)
        shared = np.zeros(len(both), bool)
        shared[1:] = again
        shared[:-1] |= again
        both = both[shared]
        return both >> np.uint64(24), (both & np.uint64((1 << 24) - 1)).astype(np.int64)
    order = np.lexsort((owner, tokens))
    tokens, owner = tokens[order], owner[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    tokens, owner = tokens[new], owner[new]
    again = tokens[1:] == tokens[:-1]
    shared = np.zeros(len(tokens), bool)
    shared[1:] = again
    shared[:-1] |= again
    return tokens[shared], owner[shared].astype(np.int64)


def _count(parts: int):
    """A bucket's tokens to those in several sets, marked by how many, dealt by set."""

    def run(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        bucket = part % parts
        ids, sizes, *pair, marks = _unpacked(group)
        if part < parts:
            token, who = _distinct_pairs(pair, len(ids))
            first = np.nonzero(np.r_[True, token[1:] != token[:-1]])[0] if len(token) else np.zeros(0, int)
            times = np.diff(np.r_[first, len(token)])
            in_sets = np.repeat(times, times)
            marks = np.minimum(255, np.round(8 * np.log2(in_sets))).astype(np.uint8)
            order = np.argsort(who, kind="stable")
        else:
            # Hot tokens have their marks; a set sent by several batches counts once.
            owner, tokens = pair
            order = np.lexsort((tokens, owner))
            token, who = tokens[order], owner[order].astype(np.int64)
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (who[1:] != who[:-1])
            token, who, marks = token[new], who[new], marks[order][new]
            order = np.arange(len(token))
        token, who, marks = token[order], who[order], marks[order]
        target = (ids[who, 0] % np.uint64(parts)).astype(np.int64)
        rows = [(t, s, n, c, lo, hi, m, bucket) for t, s, n, c, lo, hi, m in _by_part(target, ids, sizes, who, token, marks)]
        batch = _packed_batch([r[:7] for r in rows])
        table_ = pa.Table.from_batches([batch])
        return table_.append_column("bucket", pa.array([bucket] * len(rows), pa.int32()))

    return run


_NEAR = "set_id BINARY, n BIGINT, picks INT, tokens BINARY"


def _short(named: np.ndarray) -> bytes:
    """Tokens and their bucket: four bytes of each, one more of each, then the buckets where they fit a byte."""
    bucket = (named >> np.uint64(40)).astype(np.uint32)
    wide = bool(len(bucket)) and int(bucket.max()) > 255
    parts = [np.array([wide], np.uint8), named.astype(np.uint32), (named >> np.uint64(32)).astype(np.uint8)]
    return b"".join(p.tobytes() for p in [*parts, bucket if wide else bucket.astype(np.uint8)])


def _long(raw: bytes) -> np.ndarray:
    wide = raw[0]
    n = (len(raw) - 1) // (9 if wide else 6)
    out = np.frombuffer(raw, np.uint8, n, 1 + 4 * n).astype(np.uint64) << np.uint64(32)
    out |= np.frombuffer(raw, np.uint32, n, 1)
    return out | np.frombuffer(raw, np.uint32 if wide else np.uint8, n, 1 + 5 * n).astype(np.uint64) << np.uint64(40)


def _choose(percent: int):
    """All shared tokens of the sets of one part to those sets that have candidates."""

    def run(group: pa.Table) -> pa.Table:
        lengths = [len(x) for x in group.column("high").to_pylist()]
        bucket = np.repeat(group.column("bucket").to_numpy(), lengths).astype(np.uint64)
        ids, sizes, owner, tokens, marks = _unpacked(group)
        named = tokens | (bucket << np.uint64(40))
        order = np.lexsort((named, marks, owner))
        named, owner = named[order], owner[order]
        edges = np.searchsorted(owner, np.arange(len(ids) + 1))
        shared = np.diff(edges)
        prefix = sizes - -(-percent * sizes // 100) + 1
        # One more than the filter asks for, should two tokens of a set fall together.
        picks = np.minimum(shared, np.maximum(0, prefix + 1 - (sizes - shared)))
        keep = np.nonzero(picks)[0]
        return pa.Table.from_arrays(
            [
                _ids(ids[keep].reshape(-1, 2)),
                pa.array(sizes[keep]),
                pa.array(picks[keep].astype(np.int32)),
                pa.array([_short(named[edges[j] : edges[j + 1]]) for j in keep], pa.binary()),
            ],
            names=["set_id", "n", "picks", "tokens"],
        )

    return run


def _prefixes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and numbers of picked tokens of the sets, the picked tokens with their bucket, and the owner of each."""
    ids = np.frombuffer(b"".join(batch.column("set_id").to_pylist()), np.uint64).reshape(-1, 2)
    picks = batch.column("picks").to_numpy()
    tokens = [_long(t)[:p] for t, p in zip(batch.column("tokens").to_pylist(), picks)]
    return ids, picks, np.concatenate([np.zeros(0, np.uint64), *tokens]), np.repeat(np.arange(len(ids)), picks)


def _deal_prefixes(hot: np.ndarray):
    """Picked tokens dealt by bucket, without the hot ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, picks, flat, owner = _prefixes(batch)
            cold = ~_places_in(hot, flat)[1]
            flat, owner = flat[cold], owner[cold]
            parts = (flat >> np.uint64(40)).astype(np.int64)
            marks = np.zeros(len(flat), np.uint8)
            yield _packed_batch(list(_by_part(parts, ids, picks, owner, flat & _LOW40, marks)))

    return run


def _hot_edges(hot: np.ndarray):
    """Each set with the hot tokens among its picked ones; a token's id looks like a set's and is no set's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, _, flat, owner = _prefixes(batch)
            is_hot = _places_in(hot, flat)[1]
            tokens = np.stack([mixed(flat[is_hot]), mixed(~flat[is_hot])], 1)
            yield pa.RecordBatch.from_arrays([_ids(tokens), _ids(ids[owner[is_hot]].reshape(-1, 2))], names=["a", "b"])

    return run


class Forest:
    """Disjoint classes of 0..n-1, each named by its least member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


_EDGES = "a BINARY, b BINARY"


def _edge_table(ids: np.ndarray, left, right) -> pa.Table:
    left, right = np.array(left, np.int64), np.array(right, np.int64)
    return pa.Table.from_arrays([_ids(ids[left].reshape(-1, 2)), _ids(ids[right].reshape(-1, 2))], names=["a", "b"])


def _candidates(group: pa.Table) -> pa.Table:
    """A spanning forest of the sets that share prefix tokens of one bucket."""
    ids, _, owner, tokens, _ = _unpacked(group)
    order = np.lexsort((owner, tokens))
    tokens, owner = tokens[order], owner[order]
    same = np.nonzero(tokens[1:] == tokens[:-1])[0]
    links = np.unique(np.stack([owner[same], owner[same + 1]], 1), axis=0)
    forest = Forest(len(ids))
    for x, y in links.tolist():
        forest.join(x, y)
    roots = np.array([forest.find(x) for x in range(len(ids))])
    left = np.nonzero(roots != np.arange(len(ids)))[0]
    return _edge_table(ids, left, roots[left])


# --- tiles --------------------------------------------------------------------------------------


def bitmaps(tokens: list[np.ndarray]) -> np.ndarray:
    """A parity bitmap per set: each token flips one bit."""
    out = np.zeros((len(tokens), BITMAP_WORDS), np.uint64)
    for i, t in enumerate(tokens):
        bits = mixed(t) % np.uint64(64 * BITMAP_WORDS)
        flips = np.bincount(bits.astype(np.int64), minlength=64 * BITMAP_WORDS) & 1
        out[i] = np.packbits(flips.astype(np.uint8), bitorder="little").view(np.uint64)
    return out


def _least_overlap(a, b, percent: int):
    """100 * o >= percent * (a + b - o), for whole o."""
    return -(-percent * (a + b) // (100 + percent))


def link(
    tokens: list[np.ndarray], sizes: np.ndarray, percent: int, labels: np.ndarray, side: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links that connect what similar pairs connect; members with equal labels are connected already.

    ``tokens`` are the sorted shared tokens of each set, ``sizes`` the sizes of
    the whole sets. With ``side`` only pairs of different sides are compared.
    """
    labels, out = labels.copy(), []
    maps = bitmaps(tokens)
    held = np.array([len(t) for t in tokens])
    order = np.argsort(-sizes, kind="stable")
    for place, i in enumerate(order):
        rest = order[place + 1 :]
        need = _least_overlap(sizes[i], sizes[rest], percent)
        ok = (labels[rest] != labels[i]) & (need <= np.minimum(held[i], held[rest]))
        if side is not None:
            ok &= side[rest] != side[i]
        rest, need = rest[ok], need[ok]
        if not len(rest):
            continue
        # Tokens of one only flip bits of the difference: overlap <= (|x| + |y| - bits) / 2.
        apart = np.bitwise_count(maps[rest] ^ maps[i]).sum(1)
        near = (held[i] + held[rest] - apart) // 2 >= need
        for j, o in zip(rest[near], need[near]):
            if labels[i] == labels[j]:
                continue
            x, y = (tokens[i], tokens[j]) if held[i] <= held[j] else (tokens[j], tokens[i])
            at = np.searchsorted(y, x)
            if int((y[np.minimum(at, len(y) - 1)] == x).sum()) >= o:
                out.append((int(i), int(j)))
                labels[labels == labels[j]] = labels[i]
    return out


def _tile_sets(group: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    ids = np.frombuffer(b"".join(group.column("set_id").to_pylist()), np.uint64).reshape(-1, 2)
    tokens = [np.sort(_long(t)) for t in group.column("tokens").to_pylist()]
    return ids, group.column("n").to_numpy(), tokens


def _link_inside(percent: int):
    """Links inside a tile, and each member's least connected one in it."""

    def run(group: pa.Table) -> pa.Table:
        ids, sizes, tokens = _tile_sets(group)
        links = link(tokens, sizes, percent, np.arange(len(ids)))
        forest = Forest(len(ids))
        for x, y in links:
            forest.join(x, y)
        roots = np.array([forest.find(x) for x in range(len(ids))], np.int64)
        return _edge_table(ids, np.arange(len(ids)), roots)

    return run


def _link_across(percent: int):
    """Links between rows of the left and of the right, of different classes."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _edge_table(np.zeros((0, 2), np.uint64), [], [])
        sides = [_tile_sets(t) for t in (left, right)]
        ids = np.concatenate([s[0] for s in sides])
        sizes = np.concatenate([s[1] for s in sides])
        tokens = sides[0][2] + sides[1][2]
        names = left.column("class").to_pylist() + right.column("class").to_pylist()
        number = {c: n for n, c in enumerate(dict.fromkeys(names))}
        labels = np.array([number[c] for c in names])
        side = np.repeat([0, 1], [len(s[0]) for s in sides])
        links = link(tokens, sizes, percent, labels, side)
        return _edge_table(ids, [x for x, _ in links], [y for _, y in links])

    return run


def _band(percent: int):
    return F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent)) + 1e-9).cast("int")


def _blocks(group_by: list[str], members: DataFrame, into: str) -> DataFrame:
    """Members with the number of their block: groups cut to tile size by hash."""
    sums = members.groupBy(*group_by).agg(F.count(F.lit(1)).alias("_c"), F.sum("n").alias("_t"))
    needed = F.greatest(F.ceil(F.col("_c") / TILE_SETS), F.ceil(F.col("_t") / TILE_TOKENS)).cast("int")
    # One row per group; members of a hot group are split by the adaptive planner.
    joined = members.join(sums.select(*group_by, needed.alias("_k")), group_by)
    return joined.withColumn(into, F.pmod(F.xxhash64("set_id", F.lit(into)), F.col("_k")).cast("int")).drop("_k")


def verified_links(near: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Edges that connect exactly the sets which similar pairs connect."""
    members = near.select("set_id", "n").join(groups.withColumnRenamed("a", "set_id"), "set_id")
    totals = members.groupBy("root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("t"))
    large = (F.col("c") > TILE_SETS) | (F.col("t") > TILE_TOKENS)
    sized = members.join(totals.select("root", large.alias("large")), "root")
    # A group that fits a tile is one; a larger one is cut by band and hash.
    banded = sized.withColumn("band", F.when(F.col("large"), _band(percent)).otherwise(-1))
    placed = materialize(_blocks(["root", "band"], banded, "block"), "tiles")
    arrays = near.select("set_id", "tokens")
    inside = materialize(
        placed.join(arrays, "set_id").groupBy("root", "band", "block").applyInArrow(_link_inside(percent), _EDGES),
        "links-inside",
    )
    links = inside.filter("a <> b")
    if placed.filter("large").isEmpty():
        return links

    # From here on only the large groups' arrays are read.
    big = placed.filter("large").select("set_id", "n", "root", "band", "block")
    arrays = materialize(arrays.join(big.select("set_id"), "set_id"), "large-groups")

    # One member per class and tile: linked among each other, in as many tiles as they need.
    heads = inside.select(F.col("b").alias("set_id")).distinct().join(big.select("set_id", "n", "root"), "set_id")
    among = materialize(_blocks(["root"], heads, "block"), "heads").join(arrays, "set_id")
    between = materialize(
        among.groupBy("root", "block").applyInArrow(_link_inside(percent), _EDGES).filter("a <> b"), "links-between"
    )
    links = links.unionAll(between)
    classes = connected(links)
    known = big.join(classes.withColumnRenamed("root", "class").withColumnRenamed("a", "set_id"), "set_id", "left")
    known = materialize(known.withColumn("class", F.coalesce("class", "set_id")), "classes")

    # What lies outside a group's largest class meets every tile of the bands next to its own.
    counts = known.groupBy("root", "class").agg(F.count(F.lit(1)).alias("c"))
    largest = counts.groupBy("root").agg(F.max(F.struct("c", "class")).alias("m")).select("root", F.col("m.class").alias("main"))
    outside = known.join(largest, "root").filter("class <> main").select("set_id", "n", "root", "band", "class")
    outside = materialize(_blocks(["root", "band"], outside, "oblock"), "outside")
    tiles = known.select("root", "band", "block").distinct()
    pairs = (
        outside.select("root", F.col("band").alias("oband"), "oblock").distinct()
        .join(tiles, "root")
        .filter(F.abs(F.col("band") - F.col("oband")) <= 1)
    )
    pairs = materialize(pairs, "tile-pairs")
    keys = ["root", "oband", "oblock", "band", "block"]
    renamed = outside.withColumnRenamed("band", "oband")
    left = materialize(renamed.join(pairs, ["root", "oband", "oblock"]), "left-tiles").join(arrays, "set_id")
    right = materialize(known.join(pairs, ["root", "band", "block"]), "right-tiles").join(arrays, "set_id")
    # Both sides read the same table, so one gets columns of its own.
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    across = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_link_across(percent), _EDGES)
    return links.unionAll(materialize(across, "links-across"))


# --- the join -------------------------------------------------------------------------------------


def similar_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """(key, text_id, n, set_id) of every row; (set_id, root) of every set that is linked with another."""
    whole = whole_text(text)
    rows = docs.select(F.col(key).alias("key"), F.sha2(whole, 256).alias("text_id"), whole.alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    described = materialize(rows.mapInArrow(_describe(words), f"key {kind}, text_id STRING, n BIGINT, set_id BINARY"), "described")
    facts = described.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).first()
    buckets = max(1, -(-(facts.n or 0) // BUCKET_TOKENS))
    hot, hot_marks, salts = _hot_tokens(rows.select("text"), facts.rows, words, buckets)

    dealt = rows.select("text").mapInArrow(_deal(words, buckets, hot, hot_marks, salts), _PACKED)
    counted = dealt.groupBy("part").applyInArrow(_count(buckets), _PACKED + ", bucket INT")
    near = materialize(counted.groupBy("part").applyInArrow(_choose(percent), _NEAR), "near")
    edges = near.mapInArrow(_deal_prefixes(hot), _PACKED).groupBy("part").applyInArrow(_candidates, _EDGES)
    if len(hot):
        edges = edges.unionAll(near.mapInArrow(_hot_edges(hot), _EDGES))
    groups = materialize(connected(edges), "candidate-groups")
    links = verified_links(near, groups, percent)
    return described, materialize(connected(links).withColumnRenamed("a", "set_id"), "set-classes")


def similar_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """key, n_shingles and component_id, the smallest key reachable by links, of every row."""
    described, classes = similar_classes(docs, key, text, words, percent)
    named = described.filter("n > 0").join(classes, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    least = named.groupBy("root").agg(F.min("key").alias("component_id"))
    alone = described.filter("n = 0").select("key", "n", F.col("key").alias("component_id"))
    linked = named.join(materialize(least, "class-names"), "root").select("key", "n", "component_id")
    return linked.unionAll(alone).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of similar ones, all columns as they are: the one with the smallest key.

    Of rows that repeat it one stays. Rows without a word are all kept.
    """
    described, classes = similar_classes(docs, key, text)
    named = described.filter("n > 0").join(classes, "set_id", "left")
    # A null key only where a group has no other.
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "text_id"))
    chosen = named.groupBy(F.coalesce("root", "set_id").alias("root")).agg(first.alias("c"))
    salt = F.pmod(F.xxhash64("_key"), F.lit(64)).alias("_salt")
    kept = materialize(chosen.select(F.col("c.key").alias("_key"), F.col("c.text_id").alias("_text_id")).select("*", salt), "kept")
    wordless = ~F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # The salt spreads a text that very many rows share; the key decides.
    marked = docs.filter(~wordless).withColumns({"_text_id": F.sha2(whole_text(text), 256), "_key": F.col(key)}).select("*", salt)
    same = (marked["_text_id"] == kept["_text_id"]) & (marked["_salt"] == kept["_salt"]) & marked["_key"].eqNullSafe(kept["_key"])
    nth = F.row_number().over(Window.partitionBy("_text_id", "_salt", "_key").orderBy(F.lit(0)))
    once = marked.join(kept, same, "left_semi").withColumn("_nth", nth).filter("_nth = 1")
    return once.select(docs.columns).unionAll(docs.filter(wordless))


def op5_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))
