"""Best-fit packing of token sequences.

Tasks tokenize their documents and cut the long ones. The pieces are dealt by hash to shards of about `SHARD_PIECES`,
and one task packs each shard best-fit decreasing: a segment tree over the remaining capacities finds the tightest
open sequence in logarithmic time. Only lengths travel to a shard, and shards grow in number, not in size. What
sharding loses is about one part-filled sequence for each shard, of some tens of thousands.

The vocabulary's pattern joins nothing over white space, so a text's ids are its words' ids; each distinct part of a word is
tokenized once per task while it is held.

Edge cases: null text counts as empty and gives the end id alone; rows that repeat a doc_id are packed each on its own;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm.texts import stored, text_chunks, word_spans

CAPACITY = 4096
END_ID = 1
SHARD_PIECES = 50_000
PARTS_HELD = 400_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# What a byte is within a word. White space is 0 and parts words; a word with an odd byte is left to the tokenizer.
_LETTER, _DIGIT, _MARK, _ODD = 1, 2, 3, 9
_KIND = np.full(256, _MARK, np.int8)
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[:32] = _KIND[127:] = _KIND[39] = _ODD
_KIND[[32, *range(9, 14)]] = 0
#: Second bytes of the letters U+00C0 to U+00FF, whose first byte is 0xC3.
_AFTER_C3 = np.zeros(256, bool)
_AFTER_C3[128:192] = True
_AFTER_C3[[0x97, 0xB7]] = False
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_CAPITAL_AFTER_C3 = _AFTER_C3 & (np.arange(256) < 0x9F)


def word_parts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, odd, offsets): what the tokenizer takes one by one, in lower case.

    Words of ASCII and of the letters U+00C0 to U+00FF part into runs of letters, single digits and runs of other marks, as
    the vocabulary's pattern has it. Words with anything else, with an apostrophe or a special token stay whole and as they are (odd).
    """
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[_AFTER_C3[data[lead + 1]]]
    kind[lead] = kind[lead + 1] = _LETTER
    special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))
    kind[special] = _ODD
    starts, ends, _ = word_spans(data, bounds)
    odd_upto = np.concatenate(([0], np.cumsum(kind == _ODD)))
    odd_word = odd_upto[ends] > odd_upto[starts]
    in_odd = np.zeros(len(data) + 1, np.int8)
    in_odd[starts[odd_word]] = 1
    in_odd[ends[odd_word]] -= 1
    in_odd = np.cumsum(in_odd[:-1], dtype=np.int8).astype(bool)
    lowered = data + 32 * (_CAPITAL[data] & ~in_odd).astype(np.uint8)
    after = lead[_CAPITAL_AFTER_C3[data[lead + 1]] & ~in_odd[lead]] + 1
    lowered[after] += 32
    begins = np.zeros(len(data), bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    begins &= (kind > 0) & ~in_odd
    begins[starts] = True
    part = np.flatnonzero(begins)
    # A part ends where the next begins or where its word ends.
    word_of = np.searchsorted(starts, part, "right") - 1
    stop = np.minimum(np.append(part[1:], len(data)), ends[word_of])
    return lowered, part, stop, odd_word[word_of], np.searchsorted(part, bounds)


class PartIds:
    """Token ids of word parts; each part is tokenized once while it is held."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = {}
        for point in [*range(33, 127), *range(0xC0, 0x100)]:
            for byte, letter in zip(chr(point).encode(), split.pre_tokenize_str(chr(point))[0][0]):
                self.spelling[byte] = letter
        self.forget()

    def forget(self) -> None:
        self.held: dict[bytes, int] = {}
        self.ids = array("I")
        self.ends = array("q", [0])

    def places(self, parts: list[bytes], odd: list[bool]) -> np.ndarray:
        """Index of each part; its ids are ids[ends[index]:ends[index + 1]]."""
        if len(self.held) + len(parts) > PARTS_HELD:
            self.forget()
        found = [self.held.get(p, -1) for p in parts]
        for k, place in enumerate(found):
            if place < 0:
                part = parts[k]
                if odd[k]:
                    self.ids.extend(self.tokenizer.encode(part.decode(), add_special_tokens=False).ids)
                else:
                    self.ids.extend([t.id for t in self.model.tokenize(part.decode("latin-1").translate(self.spelling))])
                found[k] = self.held[part] = len(self.held)
                self.ends.append(len(self.ids))
        return np.array(found, np.int64)


def token_ids(parts: PartIds, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows, bounds of the rows)."""
    lowered, begins, ends, odd, offsets = word_parts(data, bounds)
    size = ends - begins
    place = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    joined = lowered[np.arange(place[-1]) + np.repeat(begins - place[:-1], size)]
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(place), pa.py_buffer(joined.tobytes())])
    coded = pc.dictionary_encode(column)
    code = coded.indices.to_numpy(zero_copy_only=False)
    odd_code = np.zeros(len(coded.dictionary), bool)
    odd_code[code[odd]] = True
    at = parts.places(coded.dictionary.to_pylist(), odd_code.tolist())
    # Copies: a view would keep the arrays from growing.
    limits, flat = np.array(parts.ends, np.int64), np.array(parts.ids, "<u4")
    first, many = limits[at][code], (limits[at + 1] - limits[at])[code]
    upto = np.concatenate(([0], np.cumsum(many)))
    return flat[np.arange(upto[-1]) + np.repeat(first - upto[:-1], many)], upto[offsets]


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Token ids of each document, cut; the ids themselves stay in the task but for their checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = PartIds(path)
        end = np.array([END_ID], "<u4")
        for batch in batches:
            doc_ids = batch.column(0)
            for first, last, data, bounds in text_chunks(batch.column(1)):
                tokens, upto = token_ids(parts, data, bounds)
                rows = []
                for k, (a, b) in enumerate(zip(upto[:-1].tolist(), upto[1:].tolist())):
                    own = np.concatenate((tokens[a:b], end))
                    for n, at in enumerate(range(0, len(own), capacity)):
                        part = own[at : at + capacity]
                        rows.append((first + k, n, at, len(part), zlib.crc32(part)))
                row, piece, start, length, crc = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """(bin, offset) of each length; lengths fall. The tree counts, below each node, the open bins by what they have left."""
    leaves = 1
    while leaves <= capacity:
        leaves *= 2
    tree = [0] * (2 * leaves)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled: list[int] = []
    bins, offsets = [], []
    for length in lengths:
        # The least capacity >= length with an open bin: up from its leaf until a node to the right has one, then down.
        node = leaves + length
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node > 1:
                node += 1
                while node < leaves:
                    node *= 2
                    if not tree[node]:
                        node += 1
        if node > 1:
            left = node - leaves
            at = open_bins[left].pop()
            while node:
                tree[node] -= 1
                node >>= 1
        else:
            at, left = len(filled), capacity
            filled.append(0)
        bins.append(at)
        offsets.append(filled[at])
        filled[at] += length
        if left > length:
            open_bins[left - length].append(at)
            node = leaves + left - length
            while node:
                tree[node] += 1
                node >>= 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """The pieces with sequence_id and offset. pieces: a stored table."""
    shards = max(1, -(-pieces.count() // shard_pieces))

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        bins, offsets = best_fit(part["length"].tolist(), capacity)
        shard = int(part["shard"].iloc[0])
        return part.drop(columns="shard").assign(sequence_id=np.array(bins) * shards + shard, offset=offsets)

    # By place in the stored table, so that rows with one id, or none, are dealt like others.
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(solve, f"{PIECES}, sequence_id long, offset long")


def packed(docs: DataFrame, path: str | None = None) -> DataFrame:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return pack(stored(cut_pieces(docs, path), "packing"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the sequences' pieces."""
    return packed(docs)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
