"""What the operators of this package share: columns by position, word hashes, stages."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import materialize

__all__ = [
    "WORD", "Substrings", "Words", "fresh", "materialize", "materialize_few", "release", "slices", "table", "take", "words_of",
]

#: A word, as regular expression: anything but the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that are hashed at a time; bounds the memory of a task.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialize_few(df: DataFrame, label: str) -> DataFrame:
    """``materialize`` in a few files for each core: for tables that are small beside the corpus, and written often."""
    return materialize(df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism), label)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nobody refers to any more.

    It does so once the driver has collected its garbage, which with much
    memory there is hours later; meanwhile they take disk on all machines.
    """
    gc.collect()
    spark._jvm.System.gc()


def take(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns. Other columns never clash, not even by another case."""
    columns = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(columns))])
    return plain.select(*[F.col(f"c{columns.index(n)}").alias(n) for n in names])


def fresh(df: DataFrame, name: str) -> str:
    """A column name near ``name`` that ``df`` doesn't use."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name = f"_{name}"
    return name


def _is_separator(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


SPACES = _is_separator((0x20, 0x20), (0x09, 0x0D))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RAW = np.arange(256, dtype=np.uint8)

_rng = np.random.default_rng(20240607)
_VALUE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_BASE_INVERSE = pow(_BASE, -1, 2**64)


class _Powers:
    """Powers of the base and of its inverse, as many as were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up, self.down = (self._powers(b, size) for b in (_BASE, _BASE_INVERSE))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.empty(size, dtype=np.uint64)
        out[0], have = 1, 1
        while have < size:
            out[have : 2 * have] = out[:have] * np.uint64(pow(base, have, 2**64))
            have *= 2
        return out


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one-to-one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """The words of some texts, in order: their hashes, and places in ``data``."""

    n_docs: int
    hashes: np.ndarray
    #: of each text, its first word; one more at the end
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def slices(
    texts: pa.Array, size: int = SLICE_BYTES, rows: int = 1 << 14
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``size`` bytes and at most ``rows``: from, to, their UTF-8 bytes, their offsets in these.

    A null counts as an empty text. Texts are never cut: one that is longer
    makes a run of its own.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if n == 0:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(max(to, at + 1), at + rows, n)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


class Substrings:
    """Hashes of any substrings of some bytes.

    A hash is a polynomial over the bytes modulo 2**64, read off running sums,
    so that no substring is ever made into an object.
    """

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _POWERS.upto(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_VALUE[data] * up[: len(data)], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(out + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words_of(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES, lower: bool = True
) -> Words:
    """Split texts at separators and hash each word, for all texts at once."""
    n_docs, size = len(offsets) - 1, len(data)
    if size == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(n_docs, none.astype(np.uint64), np.zeros(n_docs + 1, np.int64), none, none, data)
    data = (_LOWER if lower else _RAW)[data]
    inside = np.zeros(size + 2, dtype=bool)
    inside[1:-1] = ~separators[data]
    edge = np.zeros(size + 1, dtype=bool)  # where a text begins
    edge[offsets] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    hashes = Substrings(data).hashes(start, end)
    return Words(n_docs, hashes, np.searchsorted(start, offsets), start, end, data)
