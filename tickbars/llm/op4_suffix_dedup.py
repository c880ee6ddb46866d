"""Suffix-array dedup by prefix-free parsing: remove every byte covered by a long string that starts elsewhere too.

Parsing: a rolling hash runs over each text; the place of the least value among `REACH` consecutive ones is a
trigger. Triggers cut the text into phrases, the same phrases wherever the same bytes stand, so a repeat of `LENGTH`
bytes holds whole phrases in common. The rounds of `repeats` name the dictionary (a window's trigger with the text
around it) and keep what occurs twice.

Order: at the rims of repeats, the windows at one trigger are put in suffix order. The parse's suffixes (the texts
from the trigger on) and the dictionary's phrase tails (the texts up to it, reversed) are sorted with their LCP arrays.
A window that starts `i` bytes before the trigger agrees with another exactly if the tails agree on `i` bytes and the
parse's suffixes on `LENGTH - i`: no break in either LCP array between them. No text is compared by hash there.
A trigger with more than `HOT` different surroundings isn't put into one task; its windows are compared by name.

Edge cases: null text counts as empty; a text shorter than `LENGTH` has no window and stays whole; repeated rows are
each other's copies; rows that share a doc_id keep their own results; other columns are ignored.
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
from tickbars.llm.texts import BYTE_LETTERS, Prefix, mix, text_chunks

LENGTH = 400
TRIGGER = 8
REACH = 192
HOT = 20_000
CONTEXTS = "around long, row_key long, lo int, hi int, open boolean, anchor int, bytes binary, classes long"

_U = np.uint64


def triggers(spans: Prefix, n: int) -> np.ndarray:
    """For each place the trigger of a window that starts there: the first least rolling hash of the next REACH."""
    rolled = (spans.sums[TRIGGER:] - spans.sums[:-TRIGGER]) * spans.down[: n - TRIGGER + 1]
    rolled = (rolled ^ (rolled >> _U(31))) * _U(0xD6E8FEB86659FD93)
    least = (rolled & _U(0xFFFFFFFF00000000)) | np.arange(len(rolled), dtype=np.uint64)
    width = 1
    while width * 2 <= REACH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < REACH:
        least = np.minimum(least[: width - REACH], least[REACH - width :])
    return (least & _U(0xFFFFFFFF)).astype(np.int64)


def phrases(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows of all rows, by trigger: (row, lo, hi, around, whole)."""
    room = np.maximum(np.diff(bounds) - LENGTH + 1, 0)
    total = int(room.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    spans = Prefix(BYTE_LETTERS[data])
    row = np.repeat(np.arange(len(room)), room)
    start = np.arange(total) + (bounds[:-1] - np.cumsum(room) + room)[row]
    anchor = triggers(spans, len(data))[start]
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    last = np.concatenate((first[1:], [total])) - 1
    row, lo, hi, anchor = row[first], start[first], start[last], anchor[first]
    around = spans.span(anchor, anchor + LENGTH - REACH + 1)
    whole = mix(spans.span(lo, hi + LENGTH) + ((anchor - lo) * 1024 + (hi - lo)).astype(np.uint64))
    return row, lo - bounds[row], hi - bounds[row], around, whole


def byte_letters(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_LETTERS[data], bounds[:-1]


def contexts(rows: DataFrame) -> DataFrame:
    """The bytes of each segment in `spans`, with the place of its trigger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for first, last, data, bounds in text_chunks(batch.column(1)):
                row, around, lo, hi, is_open, classes = range_arrays(batch.column(2).slice(first, last - first))
                base = bounds[row]
                anchor = triggers(Prefix(BYTE_LETTERS[data]), len(data))[base + lo] - base
                held = data.tobytes()
                texts = [held[a:b] for a, b in zip((base + lo).tolist(), (base + hi + LENGTH).tolist())]
                columns = [
                    around, keys[first + row], lo.astype(np.int32), hi.astype(np.int32), is_open.astype(bool),
                    (anchor - lo).astype(np.int32), pa.array(texts, pa.binary()), classes,
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in CONTEXTS.split(", ")])

    return rows.select("row_key", "text", "spans").mapInArrow(run, CONTEXTS)


def _breaks(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each text, and for each rank but the first the length on which it agrees with the one before."""
    order = np.array(sorted(range(len(texts)), key=texts.__getitem__))
    rank = np.empty(len(texts), np.int64)
    rank[order] = np.arange(len(texts))
    table = np.frombuffer(b"".join(texts), np.uint8).reshape(len(texts), width)
    agree = np.zeros(len(texts), np.int64)
    for at in range(1, len(order), 4096):
        differs = table[order[at : at + 4096]] != table[order[at - 1 : at - 1 + len(order[at : at + 4096])]]
        agree[at : at + 4096] = np.where(differs.any(1), differs.argmax(1), width)
    return rank, agree


def in_suffix_order(group: np.ndarray, lo: np.ndarray, hi: np.ndarray, anchor: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(member, start) of the windows that another window equals; a member's windows start at 0 to hi - lo of its text."""
    head = [int(g).to_bytes(8, "big", signed=True) for g in group]
    suffixes = [h + t[a:][:LENGTH].ljust(LENGTH, b"\0") for h, t, a in zip(head, texts, anchor.tolist())]
    tails = [h + t[:a][::-1][:REACH].ljust(REACH, b"\0") for h, t, a in zip(head, texts, anchor.tolist())]
    (right, right_agree), (left, left_agree) = _breaks(suffixes, 8 + LENGTH), _breaks(tails, 8 + REACH)
    member, start = [], []
    most, least = anchor, anchor - (hi - lo)
    for i in range(int(least.min()), int(most.max()) + 1):
        here = np.flatnonzero((least <= i) & (i <= most))
        if len(here) < 2:
            continue
        suffix_class = np.cumsum(right_agree < 8 + LENGTH - i)[right[here]]
        tail_class = np.cumsum(left_agree < 8 + i)[left[here]]
        _, at, count = np.unique(suffix_class * (len(texts) + 1) + tail_class, return_inverse=True, return_counts=True)
        same = here[count[at] > 1]
        member.append(same)
        start.append(anchor[same] - i)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *member]), np.concatenate([none, *start])


def rim_windows(rows: DataFrame) -> DataFrame:
    """(row_key, lo, hi) of repeated windows among the open contexts; rows come sorted by `around`."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        group, keys, lo, hi, is_open, anchor = (table.column(i).to_numpy().copy() for i in range(6))
        member, start = in_suffix_order(group, lo, hi, anchor, table.column(6).to_pylist())
        wanted = is_open[member]
        member, start = member[wanted], start[wanted]
        order = np.lexsort((start, member))
        member, start = member[order], start[order]
        fresh = np.concatenate(([True], (member[1:] != member[:-1]) | (start[1:] != start[:-1] + 1)))[: len(member)]
        first = np.flatnonzero(fresh)
        last = np.concatenate((first[1:], [len(member)])) - 1 if len(first) else first
        at = lo[member[first]]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[member[first]]), pa.array((at + start[first]).astype(np.int32)), pa.array((at + start[last]).astype(np.int32))],
            ["row_key", "lo", "hi"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                held.append(batch.slice(at, 4096))
                groups = held[-1].column(0)
                if sum(b.num_rows for b in held) < 4096 or held[0].column(0)[0] == groups[-1]:
                    continue
                table = pa.Table.from_batches(held)  # the last group may have begun in any of them
                values = table.column(0).to_numpy()
                cut = int(np.flatnonzero(values != values[-1])[-1]) + 1
                yield solve(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held and sum(b.num_rows for b in held):
            yield solve(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "row_key long, lo int, hi int")


def hot_names(rows: DataFrame) -> DataFrame:
    """Names of all windows of the contexts, for groups too large for one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lo, hi, is_open = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5))
            for first, last, data, bounds in text_chunks(batch.column(6)):
                count = np.diff(bounds) - LENGTH + 1
                owner = np.repeat(np.arange(last - first), count)
                start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                at = bounds[owner] + start
                letters = BYTE_LETTERS[data]
                names = [Prefix(letters, k).span(at, at + LENGTH).view(np.int64) for k in (0, 1)]
                columns = [*names, keys[first + owner], (lo[first + owner] + start).astype(np.int32), is_open[first + owner]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["name", "check", "row_key", "start", "open"])

    return rows.mapInArrow(run, "name long, check long, row_key long, start int, open boolean")


def cut(rows: DataFrame) -> DataFrame:
    """Apply `ranges` to the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, last, data, bounds in text_chunks(batch.column(1)):
                row, lo, hi = range_arrays(batch.column(2).slice(first, last - first))
                gone = covered(len(data), bounds[:-1], row, lo, hi, LENGTH)
                total = np.concatenate(([0], np.cumsum(gone)))
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                inner = bounds[1:-1][bounds[1:-1] < len(data)]
                begins[inner] = gone[inner]
                spans = np.concatenate(([0], np.cumsum(begins)))
                kept, at = data[~gone].tobytes(), bounds - total[bounds]
                texts = [kept[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, last - first),
                        pa.array(np.diff(bounds)),
                        pa.array(np.diff(total[bounds])),
                        pa.array(np.diff(spans[bounds])),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                        pa.array(texts, pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
                )

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes; a cut may fall inside a character)."""
    rows = repeats.keyed(docs.select(F.col("doc_id").cast("long"), "text"))
    copies, rims = repeats.classes_of(rows, phrases, "suffix-dedup")
    spans = rims.groupBy("row_key").agg(F.collect_list(F.struct("around", "lo", "hi", "open", "classes")).alias("spans"))
    found = repeats.stored(contexts(rows.join(spans, "row_key")), "suffix-dedup-contexts")
    cold = found.filter(F.col("classes") <= hot).drop("classes").repartition("around").sortWithinPartitions("around")
    named = repeats.stored(hot_names(found.filter(F.col("classes") > hot)), "suffix-dedup-names")
    ranges = repeats.ranges_of(copies, rim_windows(cold), repeats.repeated_names(named, "suffix-dedup"))
    return cut(rows.join(ranges, "row_key", "left").select("doc_id", "text", "ranges"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")
