"""Substring dedup by recompression: remove every word covered by a long word sequence that starts elsewhere too.

Recompression: rounds name equal runs of a symbol, then pairs of neighbours of which the left one's side bit is 0 and
the right one's is 1. A name is a function of the parts' names, so every task gives equal parts the same global name
and equal word sequences get the same symbols inside, up to two symbols a round at either end. Long symbols stand
back, so that a window always holds whole symbols.

A window's anchor is the least-named symbol among those whose bounds follow from the window's own words, or its least word
if there is none. Recompression serves for that alone, in `ROUNDS` rounds. Repeats meet on a hash of the `CONTEXT` words beside the
anchor (the rounds of `repeats` count them), and what shares it is verified window by window under a 128-bit name of its words.

Edge cases: null text has no words; a document with fewer than `LENGTH` words stays whole; repeated rows are each
other's copies; rows that share a doc_id keep their own results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import repeats
from tickbars.llm.repeats import covered, range_arrays
from tickbars.llm.texts import Prefix, mix, text_chunks, word_letters, word_spans

LENGTH = 35
ROUNDS = 2
CONTEXT = 12
LONGEST = 4

_U = np.uint64
_RUN, _PAIR, _SIDE = _U(0xA24BAED4963EE407), _U(0x9FB21C651E98DF25), _U(0xC2B2AE3D27D4EB4F)


def fold(names: np.ndarray, starts: np.ndarray, fixed: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One half round: merge runs of equal symbols. fixed: symbols that begin a document."""
    size = np.diff(np.append(starts, total))
    joined = np.zeros(len(names), bool)
    joined[1:] = (names[1:] == names[:-1]) & (size[1:] <= LONGEST) & (size[:-1] <= LONGEST) & ~fixed[1:]
    first = np.flatnonzero(~joined)
    count = np.diff(np.append(first, len(names))).astype(np.uint64)
    renamed = np.where(count > 1, mix(names[first] * _RUN + count), names[first])
    return renamed, starts[first], fixed[first]


def pair(names: np.ndarray, starts: np.ndarray, fixed: np.ndarray, total: int, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The other half: merge each left-sided symbol with a right-sided one that follows it."""
    size = np.diff(np.append(starts, total))
    right = (mix(mix(names ^ _SIDE) + _U(level)) >> _U(63)).astype(bool)
    short = size <= LONGEST
    joined = np.zeros(len(names), bool)
    joined[1:] = ~right[:-1] & right[1:] & short[1:] & short[:-1] & ~fixed[1:]
    first = np.flatnonzero(~joined)
    doubled = np.append(first[1:], len(names)) - first > 1
    renamed = names[first]
    left = first[doubled]
    renamed[doubled] = mix(names[left] * _PAIR + mix(names[left + 1] + _PAIR))
    return renamed, starts[first], fixed[first]


def _least(names: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Index of the least name in names[first:last], the first on ties; ranges aren't empty and at most LENGTH long."""
    table = [(mix(names) & _U(0xFFFFFFFF00000000)) | np.arange(len(names), dtype=np.uint64)]
    while 2 ** len(table) <= LENGTH:
        prior, step = table[-1], 2 ** (len(table) - 1)
        table.append(np.concatenate((np.minimum(prior[:-step], prior[step:]), prior[-step:])))
    length = last - first
    power = np.frexp(length)[1] - 1
    grid = np.stack(table)
    least = np.minimum(grid[power, first], grid[power, last - (1 << power)])
    return (least & _U(0xFFFFFFFF)).astype(np.int64)


def anchors(names: np.ndarray, offsets: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For the windows at `start` the first word of their anchor. names: of all words; offsets: of rows, one more at the end."""
    total = len(names)
    fixed = np.zeros(total + 1, bool)
    fixed[offsets] = True
    words, places, fixed = names, np.arange(total), fixed[:total]
    # A symbol's bounds follow from a window if they lie between these two, which move in by a symbol each half round.
    low, high = start, start + LENGTH
    for level in range(2 * ROUNDS):
        at = np.zeros(total + 1, np.int64)
        at[places] = 1
        at[total] = 1
        upto = np.cumsum(at)
        ends = np.append(places, total)
        low = np.minimum(ends[upto[low] - at[low]] + 1, total)
        high = np.maximum(ends[upto[high] - 1] - 1, 0)
        half = fold if level % 2 == 0 else pair
        names, places, fixed = half(names, places, fixed, total, *(() if half is fold else (level,)))
    ends = np.append(places, total)
    first = np.searchsorted(places, low)
    last = np.searchsorted(ends, high, "right") - 1
    found = np.empty(len(start), np.int64)
    whole = first < last
    found[whole] = places[_least(names, first[whole], last[whole])]
    # Inside a long run no symbol is whole: there the words themselves are the symbols.
    bare = start[~whole]
    found[~whole] = _least(words, bare, bare + LENGTH)
    return found, whole


def symbols(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows of all rows, by anchor: (row, lo, hi, around, whole)."""
    starts, ends, offsets = word_spans(data, bounds)
    room = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    total = int(room.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    names = word_letters(data, starts, ends)
    spans = Prefix(names)
    row = np.repeat(np.arange(len(room)), room)
    start = np.arange(total) + (offsets[:-1] - np.cumsum(room) + room)[row]
    anchor, compressed = anchors(names, offsets, start)
    # The words right of the anchor if the window holds enough of them, else those left of it.
    after = anchor + CONTEXT <= start + LENGTH
    kind = anchor * 4 + compressed * 2 + after
    first = np.flatnonzero(np.concatenate(([True], (kind[1:] != kind[:-1]) | (row[1:] != row[:-1]))))
    last = np.concatenate((first[1:], [total])) - 1
    row, lo, hi, anchor, kind = row[first], start[first], start[last], anchor[first], kind[first]
    near = anchor - np.where(kind & 1, 0, CONTEXT)
    around = mix(spans.span(near, near + CONTEXT) + (kind & 3).astype(np.uint64))
    whole = mix(spans.span(lo, hi + LENGTH) + ((anchor - lo) * 1024 + (hi - lo)).astype(np.uint64))
    return row, lo - offsets[row], hi - offsets[row], around, whole


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, offsets = word_spans(data, bounds)
    return word_letters(data, starts, ends), offsets[:-1]


def cut(rows: DataFrame) -> DataFrame:
    """Apply `ranges` to the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in text_chunks(batch.column(1)):
                row, lo, hi = range_arrays(batch.column(2).slice(first, last - first))
                starts, ends, offsets = word_spans(data, bounds)
                gone = covered(len(starts), offsets[:-1], row, lo, hi, LENGTH)
                total = np.concatenate(([0], np.cumsum(gone)))
                # Each kept word with one byte after it, made a space: a row's words are then one slice.
                begins, ends = starts[~gone], ends[~gone]
                size = ends - begins + 1
                place = np.concatenate(([0], np.cumsum(size)))
                source = np.arange(place[-1]) + np.repeat(begins - place[:-1], size)
                joined = np.append(data, np.uint8(32))[source] if len(begins) else np.zeros(0, np.uint8)
                joined[place[1:] - 1] = 32
                held, at = joined.tobytes(), place[offsets - total[offsets]].tolist()
                texts = [held[a : b - 1] if b > a else b"" for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(np.diff(offsets)),
                        pa.array(np.diff(total[offsets])),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
                )

    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (the remaining words, joined by a space)."""
    rows = repeats.keyed(docs.select(F.col("doc_id").cast("long"), "text"))
    copies, rims = repeats.classes_of(rows, symbols, "substring-dedup")
    spans = rims.groupBy("row_key").agg(F.collect_list(F.struct("lo", "hi", "open")).alias("spans"))
    windows = repeats.stored(repeats.window_names(rows.join(spans, "row_key"), words, LENGTH), "substring-dedup-windows")
    ranges = repeats.ranges_of(copies, repeats.repeated_names(windows, "substring-dedup"))
    return cut(rows.join(ranges, "row_key", "left").select("doc_id", "text", "ranges"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")
