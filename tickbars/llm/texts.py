"""Texts as flat byte arrays inside tasks, and the hashes over them that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickbars.session import work_dir

CHUNK_BYTES = 1 << 20

_U = np.uint64
_ODD = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The rows, written below the shared checkpoint folder and read back: later steps survive lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def text_chunks(
    column: pa.Array, limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [first, last) as one byte array and its row bounds; a chunk holds about `limit` bytes, or one longer row.

    Null counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
        yield first, last, flat[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class Held(dict):
    """A cache that isn't sent to tasks."""

    def __reduce__(self):
        return Held, ()


class Prefix:
    """Polynomial hashes (mod 2**64) of any span of `letters`, from one pass of prefix sums."""

    _powers: Held = Held()

    def __init__(self, letters: np.ndarray, which: int = 0):
        n = len(letters)
        up, self.down = self._tables(n + 1, which)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(letters * up[:n], out=self.sums[1:])

    @classmethod
    def _tables(cls, n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
        held = cls._powers.get(which)
        if held is None or len(held[0]) < n:
            size = max(n, CHUNK_BYTES + 1)
            made = []
            for base in (_ODD[which], pow(_ODD[which], -1, 1 << 64)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                made.append(np.cumprod(steps, dtype=np.uint64))
            held = (made[0], made[1])
            if n <= 8 * CHUNK_BYTES:
                cls._powers[which] = held
        return held

    def span(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of letters[first:last], the same wherever the letters stand."""
        return mix((self.sums[last] - self.sums[first]) * self.down[first])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
BYTE_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xA0761D6478BD642F))


def word_spans(data: np.ndarray, bounds: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ of all rows, and for each row the index of its first word (one more at the end).

    `between` tells for each byte whether it stands between words.
    """
    n = len(data)
    inside = ~between[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, bounds)


def word_letters(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit value for each word, by its bytes and length; `which` chooses one of two functions."""
    spans = Prefix(BYTE_LETTERS[data], which).span(starts, ends)
    return mix(spans + (ends - starts).astype(np.uint64))
