"""SimHash near-dedup by pigeonhole blocks.

A fingerprint bit is 1 if set in over half the XXH64 hashes of the shingles. Fingerprints are cut into `BLOCKS`
blocks; of two that differ in at most `DISTANCE` bits at least `BLOCKS - DISTANCE` blocks are equal, so they share the
key made of some choice of that many blocks. Distinct fingerprints are joined on those keys, the Hamming distance is
verified within the join, and components of the links give the groups.

Copies share a fingerprint and enter the join as one row. More blocks make longer keys (here 26 bits) and more of them
(here 10 a fingerprint); raise `BLOCKS` with the corpus.

Edge cases: null text, and text without words, has fingerprint zero and is linked like any other; with fewer words than
a shingle the whole sequence is the shingle; repeated rows are listed each; a component's id is its smallest doc_id, null
if it has none; extra columns are carried by the pipeline stage, whatever their names (but `_near_*`).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm.components import components
from tickbars.llm.texts import stored

SHINGLE = 3
DISTANCE = 3
BLOCKS = 5
SEED = 42
_LOWER = bytes(range(256)).lower()


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of a text in UTF-8."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = np.concatenate(([0], ends[: n - 1])).tolist()
    ends = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(begins, ends)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(_near_row, doc_id, fingerprint)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).fill_null("").cast(pa.binary())
            found = [fingerprint(t.as_py(), shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["_near_row", "doc_id", "fingerprint"])

    return docs.select("_near_row", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "_near_row long, doc_id long, fingerprint long")


def choices(distance: int = DISTANCE, blocks: int = BLOCKS) -> list[int]:
    """The bits of each choice of blocks that a close pair must share one of, as signed numbers."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in map(sum, combinations(masks, blocks - distance))]


def block_keys(fingerprint: Column, distance: int = DISTANCE, blocks: int = BLOCKS) -> Column:
    """An array of (choice, bits) for all choices of the blocks that a close pair must share."""
    keys = [F.struct(F.lit(k).alias("choice"), fingerprint.bitwiseAND(F.lit(mask)).alias("bits")) for k, mask in enumerate(choices(distance, blocks))]
    return F.array(*keys)


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """(u, v) fingerprints at no more than `distance` bits. prints: distinct fingerprints.

    A pair may share several choices; it comes from the first of them alone, so each pair comes once.
    """
    keyed = prints.select("fingerprint", F.explode(block_keys(F.col("fingerprint"), distance, blocks)).alias("key"))
    keyed = keyed.select("fingerprint", "key.choice", "key.bits")
    left, right = keyed.withColumnRenamed("fingerprint", "u"), keyed.withColumnRenamed("fingerprint", "v")
    differing = F.col("u").bitwiseXOR(F.col("v"))
    close = (F.col("u") < F.col("v")) & (F.bit_count(differing) <= distance)
    first = F.coalesce(*(F.when(differing.bitwiseAND(F.lit(mask)) == 0, F.lit(k)) for k, mask in enumerate(choices(distance, blocks))))
    return left.join(right, (left["choice"] == right["choice"]) & (left["bits"] == right["bits"]) & close & (left["choice"] == first)).select("u", "v")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """(_near_row, doc_id, fingerprint, root, component_id) of docs that have a _near_row; root is the least fingerprint of the component."""
    prints = stored(fingerprints(docs, shingle), "simhash")
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes.select("fingerprint"), distance, blocks), "simhash")
    rooted = classes.join(roots, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    rooted = stored(rooted, "simhash-roots")
    least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-components")
    named = rooted.join(least, "root").select("fingerprint", "root", "component_id")
    return prints.join(named, "fingerprint").select("_near_row", "doc_id", "fingerprint", "root", "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near copies one row with the smallest doc_id stays."""
    # Stored, as ids made again from the source could differ: they hold the number of the scan's task.
    rows = stored(docs.withColumn("_near_row", F.monotonically_increasing_id()), "simhash-rows", "zstd")
    groups = near_groups(rows)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_near_row")).alias("first"))
    kept = stored(first.select("first._near_row"), "simhash-kept")
    # By the dropped rows, as they are far fewer than the kept ones: Spark broadcasts them while it can, and then shuffles no text.
    dropped = stored(rows.select("_near_row").join(kept, "_near_row", "left_anti"), "simhash-dropped")
    return rows.join(dropped, "_near_row", "left_anti").select(*docs.columns)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("_near_row", F.monotonically_increasing_id())
    return near_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
