"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, packing; each stage is stored and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import op1_quality, op2_exact_dedup, op3_packing, op7_simhash, op10_mixing
from tickbars.llm.texts import stored

STAGES = [
    ("quality rules", op1_quality.stage),
    ("exact dedup", op2_exact_dedup.stage),
    ("SimHash near-dedup", op7_simhash.stage),
    ("mixing sources to target weights", op10_mixing.stage),
    ("best-fit packing", op3_packing.stage),
]

#: Neither trained decoding nor token ids can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), f"pipeline-{name.split()[0]}")
    return STAGES[-1][1](spark, rows, sf_dir)
