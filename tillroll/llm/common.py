"""What several operators share: tables, working folders, text buffers, rolling hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll.storage import materialize, work_path

__all__ = ["materialize", "work_path"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text), F.lit(""))


# --- text buffers ----------------------------------------------------------------


def utf8_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row starts and ends in them."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    at = np.frombuffer(offsets, kind, count=n + 1, offset=column.offset * kind().itemsize)
    at = at.astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def chunks(at: np.ndarray, most: int, overlap: int) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of rows of about ``most`` bytes, and pieces of a longer row.

    Yields (first row, row after the last, first byte, byte after the last).
    Consecutive pieces of one long row share ``overlap`` bytes, so that each
    window of up to ``overlap + 1`` bytes lies whole in one of them.
    """
    rows, i = len(at) - 1, 0
    while i < rows:
        j = max(int(np.searchsorted(at, at[i] + most, "right")) - 1, i + 1)
        if at[j] - at[i] <= most:
            yield i, j, int(at[i]), int(at[j])
        else:
            for start in range(int(at[i]), int(at[j]), most):
                end = min(start + most + overlap, int(at[j]))
                yield i, i + 1, start, end
                if end == at[j]:
                    break
        i = j


class RollingHash:
    """Hashes of all windows of a byte array, modulo 2**64, for any window length."""

    def __init__(self, longest: int, seed: int = 1):
        random = np.random.default_rng(seed)
        base = int(random.integers(1 << 62)) | 1
        self.letters = random.integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        self.powers = self._powers(base, longest + 1)
        self.inverse = self._powers(pow(base, -1, 1 << 64), longest + 1)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.powers[: len(data)], dtype=np.uint64, out=out[1:])
        return out

    def windows(self, prefixes: np.ndarray, starts: np.ndarray, ends) -> np.ndarray:
        return mixed((prefixes[ends] - prefixes[starts]) * self.inverse[starts])


def mixed(x: np.ndarray) -> np.ndarray:
    """Every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# --- words -----------------------------------------------------------------------------


def separators(kept) -> np.ndarray:
    """Table of the bytes that no word contains: those for which ``kept`` is false."""
    return np.array([not kept(b) for b in range(256)])


class WordHashes:
    """Hashes of the words of UTF-8 rows, and of runs of consecutive words."""

    PIECE = 1 << 20
    _POWERS = 1 << 16

    def __init__(self, separator: np.ndarray, fold: np.ndarray | None = None, seed: int = 7):
        random = np.random.default_rng(seed)
        letters = random.integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        self.separator = separator
        self.letters = letters if fold is None else letters[fold]
        self.powers = RollingHash._powers(int(random.integers(1 << 62)) | 1, self._POWERS)
        self.gram = [int(x) | 1 for x in random.integers(0, 1 << 62, 64)]

    def _hash(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all rows, and the number of words before each row."""
        word = ~self.separator[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        begins = at[:-1][at[:-1] < at[1:]]
        first[begins] = word[begins]
        starts = np.nonzero(first)[0]
        if not len(starts):
            return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
        inside = np.nonzero(word)[0]
        head = first[inside]
        nth = np.cumsum(head) - 1
        value = self.letters[data[inside]] * self.powers[(inside - starts[nth]) & (self._POWERS - 1)]
        return mixed(np.add.reduceat(value, np.nonzero(head)[0])), np.searchsorted(starts, at)

    def rows(self, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For runs of rows: the first row, all their word hashes, and where each row's begin and end.

        A row longer than ``PIECE`` bytes is hashed in pieces cut at separators.
        """
        i, rows = 0, len(at) - 1
        while i < rows:
            j = max(int(np.searchsorted(at, at[i] + self.PIECE, "right")) - 1, i + 1)
            part = data[at[i] : at[j]]
            if len(part) <= self.PIECE:
                hashes, offsets = self._hash(part, at[i : j + 1] - at[i])
            else:
                pieces, start = [], 0
                while start < len(part):
                    end = start + self.PIECE
                    while end < len(part):
                        gap = np.nonzero(self.separator[part[end : end + self.PIECE]])[0]
                        if len(gap):
                            end += int(gap[0])
                            break
                        end += self.PIECE
                    end = min(end, len(part))
                    pieces.append(self._hash(part[start:end], np.array([0, end - start]))[0])
                    start = end
                hashes = np.concatenate(pieces)
                offsets = np.array([0, len(hashes)])
            yield i, hashes, offsets
            i = j

    def grams(self, words: np.ndarray, k: int) -> np.ndarray:
        """Hash of the k words from each word on; none where fewer are left."""
        n = len(words) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        total = words[:n] * np.uint64(self.gram[0])
        for j in range(1, k):
            total = total + words[j : n + j] * np.uint64(self.gram[j % 64])
        return mixed(total + np.uint64(k))
