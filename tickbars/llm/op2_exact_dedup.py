"""Exact dedup by skew-safe combining.

Texts are equal when identical after deleting every character of `[\\x20\\x09-\\x0D]`; null counts as empty. Copies are
combined three times: each map task combines its own (the partial aggregate), then the copies under one digest and
salt meet, then the salts' winners meet. Every stage groups by the digest *and the full content*, so a digest that
two contents share joins nothing. A hot group is spread over `SALTS` tasks and reaches the last stage as that many rows.

The row with the most code points in its original text stays, then the smallest doc_id (null last), then the first row.

Edge cases: an empty table gives no rows; repeated rows are copies of each other, and one of them stays; an empty or
null text is a copy of any text of white space alone; extra columns are carried, whatever their names (but `_dedup_*`).
The rows are stored once with their ids: ids made again from the source could differ, since they hold the number of the scan's
task, and that changes with the executors alive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm.texts import stored

SALTS = 16
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """The rows with _dedup_keep_id, _dedup_size, _dedup_kept and _dedup_digest."""
    content = F.translate(F.coalesce("text", F.lit("")), _SPACE, "")
    rows = stored(docs.withColumn("_dedup_row", F.monotonically_increasing_id()).withColumn("_dedup_digest", digest(content)), "exact-dedup-rows", "zstd")
    # Rows are ranked by the smallest of these.
    order = F.struct(
        (-F.length(F.coalesce("text", F.lit("")))).alias("length"),
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id").alias("id"),
        F.col("_dedup_row").alias("row"),
    )
    texts = rows.select(
        F.col("_dedup_digest").alias("digest"), content.alias("content"), order.alias("best"), F.pmod(F.xxhash64("_dedup_row"), F.lit(salts)).alias("salt"), F.lit(1).alias("n")
    )

    def combine(parts: DataFrame, *keys: str) -> DataFrame:
        return parts.groupBy(*keys).agg(F.min("best").alias("best"), F.sum("n").alias("n"))

    salted = combine(texts, "digest", "salt", "content")
    winners = combine(salted, "digest", "content")
    winners = stored(
        winners.select(
            F.col("digest").alias("_dedup_digest"), F.col("best.id").alias("_dedup_keep_id"), F.col("best.row").alias("_dedup_first"), F.col("n").alias("_dedup_size")
        ),
        "exact-dedup",
    )
    members = rows.withColumn("_dedup_content", content)
    clashes = winners.groupBy("_dedup_digest").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1").select("_dedup_digest")
    if clashes.isEmpty():
        found = members.join(winners, "_dedup_digest")
    else:
        # A digest of several contents: there the winners' contents decide, too.
        clashes = stored(clashes, "exact-dedup-clashes")
        named = members.select(F.col("_dedup_row").alias("_dedup_first"), "_dedup_content")
        contents = winners.join(clashes, "_dedup_digest", "left_semi").join(named, "_dedup_first")
        alone = winners.join(clashes, "_dedup_digest", "left_anti")
        found = members.join(alone, "_dedup_digest").unionByName(members.join(contents, ["_dedup_digest", "_dedup_content"]))
    return found.withColumn("_dedup_kept", F.col("_dedup_row") == F.col("_dedup_first")).select(
        *[F.col(f"`{c}`") for c in docs.columns], "_dedup_keep_id", "_dedup_size", "_dedup_kept", "_dedup_digest"
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of equal texts stays."""
    return exact_dedup(docs).filter("_dedup_kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return exact_dedup(docs).select(
        "doc_id",
        F.col("_dedup_keep_id").alias("keep_id"),
        F.col("_dedup_size").cast("long").alias("group_size"),
        F.col("_dedup_kept").alias("kept"),
        F.col("_dedup_digest").alias("text_sha256"),
    )


OP2_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS whole, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content FROM documents
), best AS (
    SELECT *, first_value(doc_id) OVER (PARTITION BY content ORDER BY length(whole) DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY content) AS group_size
    FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM best
"""
