"""Bounded samples for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARES = 32


def least_by_hash(rows: DataFrame, label: str, sample: int) -> DataFrame:
    """The `sample` rows of each label whose doc_id has the least hash; rows: doc_id and the label, no texts.

    Each label's rows are first cut to the sample in `SHARES` shares, dealt by another hash, so what meets in one task at
    the end is `SHARES` samples at most, however long the table is. A repeated row counts once.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    dealt = rows.distinct().withColumn("_share", F.pmod(F.hash("doc_id"), F.lit(SHARES)))
    in_share = Window.partitionBy(label, "_share").orderBy(*order)
    cut = dealt.withColumn("_place", F.row_number().over(in_share)).filter(F.col("_place") <= sample).drop("_share", "_place")
    in_label = Window.partitionBy(label).orderBy(*order)
    return cut.withColumn("_place", F.row_number().over(in_label)).filter(F.col("_place") <= sample).drop("_place")


def slice_by_hash(text: str, key: str, chars: int) -> Column:
    """`chars` characters of a text from a place chosen by a hash of the key and the length; all of a shorter one."""
    size = F.length(text)
    begin = F.pmod(F.xxhash64(key, size), F.greatest(size - chars, F.lit(0)) + 1)
    return F.substring(text, (begin + 1).cast("int"), F.lit(chars))
