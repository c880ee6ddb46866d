"""Exact long repeats over a corpus: the Spark rounds that the two substring operators share.

A document is a sequence of tokens (bytes, or words). A *window* is `length` consecutive tokens of one document.
The caller's parse gives every window an anchor by content alone, so equal windows get the same anchor at the same
place; the windows of one document that share an anchor form a *segment* `[lo, hi]` of starts, with

* `around`: a hash of tokens near the anchor that all its windows contain. Equal windows have equal `around`;
* `whole`: a hash of everything the segment's windows cover and of the anchor's place. Equal `whole` (and `around`):
  the segments hold the same windows.

Rounds: (1) count `around`; a segment whose `around` is unique has no repeated window. (2) Among the others, equal
`whole` means all windows repeat. (3) What is left, the rims of repeats, is compared window by window under a 128-bit
name. One member of each class of equal segments takes part, so copies do not multiply.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.texts import Prefix, stored, text_chunks

#: Keys with over one part in HOT_PARTS of the rows are hot.
HOT_PARTS = 1000
SEGMENTS = "around long, whole long, row_key long, lo int, hi int"
#: (chunk bytes, bounds) -> (row, lo, hi, around, whole); rows count within the chunk, lo and hi within the row.
Parse = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, ...]]
#: (chunk bytes, bounds) -> (letters, first letter of each row)
Letters = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and a key that tells apart rows which share a doc_id but not their text."""
    return docs.select(F.xxhash64("doc_id", "text").alias("row_key"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))


def segments(rows: DataFrame, parse: Parse) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for first, _, data, bounds in text_chunks(batch.column(1)):
                row, lo, hi, around, whole = parse(data, bounds)
                if len(row):
                    columns = [around.view(np.int64), whole.view(np.int64), keys[first + row], lo.astype(np.int32), hi.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["around", "whole", "row_key", "lo", "hi"])

    return rows.select("row_key", "text").mapInArrow(run, SEGMENTS)


def window_names(rows: DataFrame, letters: Letters, length: int) -> DataFrame:
    """(name, check, row_key, start, open) of each window of the segments in `spans`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for first, last, data, bounds in text_chunks(batch.column(1)):
                values, offsets = letters(data, bounds)
                names, checks = Prefix(values, 0), Prefix(values, 1)
                row, lo, hi, is_open = range_arrays(batch.column(2).slice(first, last - first))
                count = hi - lo + 1
                owner = np.repeat(np.arange(len(lo)), count)
                start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + lo[owner]
                at = start + offsets[row[owner]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names.span(at, at + length).view(np.int64)),
                        pa.array(checks.span(at, at + length).view(np.int64)),
                        pa.array(keys[first + row[owner]]),
                        pa.array(start.astype(np.int32)),
                        pa.array(is_open[owner].astype(bool)),
                    ],
                    ["name", "check", "row_key", "start", "open"],
                )

    return rows.select("row_key", "text", "spans").mapInArrow(run, "name long, check long, row_key long, start int, open boolean")


def having(rows: DataFrame, counted: DataFrame, *keys: str) -> DataFrame:
    """The rows whose keys are in `counted`. Both are stored tables; counted: the keys and n, how many of the rows have them.

    Fewer than `HOT_PARTS` keys can have over one part in `HOT_PARTS` of the counted rows each. Those are broadcast, so the rows of a hot
    key are found where they are; the others meet by shuffle, and no task gets more than that part for one key.
    """
    most = (counted.agg(F.sum("n")).first()[0] or 0) // HOT_PARTS
    hot = F.broadcast(counted.filter(F.col("n") > most).select(*keys))
    rest = counted.filter(F.col("n") <= most).select(*keys)
    on = list(keys)
    return rows.join(hot, on, "left_semi").unionByName(rows.join(hot, on, "left_anti").join(rest, on, "left_semi"))


def classes_of(rows: DataFrame, parse: Parse, name: str) -> tuple[DataFrame, DataFrame]:
    """Rounds 1 and 2: (row_key, lo, hi) of segments that have an equal, and one member of each class that may share only some windows.

    The second also has `around`, `open` (no equal segment was found) and `classes`, the size of its group.
    """
    found = stored(segments(rows, parse), f"{name}-segments")
    shared = stored(found.groupBy("around").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), f"{name}-counts")
    near = stored(having(found, shared, "around"), f"{name}-shared")
    classes = near.groupBy("around", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row_key", "lo", "hi")).alias("first"))
    classes = stored(classes, f"{name}-classes")
    groups = classes.groupBy("around").agg(F.count(F.lit(1)).alias("classes"), F.count_if(F.col("n") == 1).alias("open_classes"))
    groups = stored(groups.filter("classes > 1 and open_classes > 0").select("around", "classes"), f"{name}-groups")
    copies = having(near, classes.filter("n > 1"), "around", "whole").select("row_key", "lo", "hi")
    rims = classes.join(groups, "around").select("around", "classes", "first.*", (F.col("n") == 1).alias("open"))
    return copies, rims


def repeated_names(windows: DataFrame, name: str) -> DataFrame:
    """(row_key, lo, hi) of the open windows whose name another window has."""
    twice = stored(windows.groupBy("name", "check").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), f"{name}-names")
    return having(windows.filter("open"), twice, "name", "check").select("row_key", F.col("start").alias("lo"), F.col("start").alias("hi"))


def ranges_of(*starts: DataFrame) -> DataFrame:
    """(row_key, ranges): the ranges of starts of each document; no more of them than it has windows.

    Equal rows share a key and give the same ranges, which are merged map-side.
    """
    joined = starts[0]
    for more in starts[1:]:
        joined = joined.unionByName(more)
    return joined.groupBy("row_key").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))


def range_arrays(part: pa.Array) -> tuple[np.ndarray, ...]:
    """(row, fields...) of a list-of-struct column; null counts as an empty list."""
    part = part.combine_chunks() if isinstance(part, pa.ChunkedArray) else part
    counts = np.nan_to_num(pc.list_value_length(part).to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = part.flatten()
    row = np.repeat(np.arange(len(part)), counts)
    return row, *(flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(flat.type.num_fields))


def covered(n: int, offsets: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int) -> np.ndarray:
    """Mask over the letters of a chunk: those covered by a window that starts in a range."""
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, offsets[row] + lo, 1)
    np.add.at(depth, offsets[row] + hi + length, -1)
    return np.cumsum(depth[:-1]) > 0
