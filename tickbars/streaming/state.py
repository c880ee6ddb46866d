"""A stream's state as data: what a checkpoint holds, without starting its query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """(symbol, candle_start, candle_end, state_partition) of the windows that a candle stream still holds, after its last batch or an earlier one.

    Windows behind the watermark have left the state; a window in it is one that a restart goes on with.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    # The grouping columns in their order.
    window, symbol = (F.col("key")[f.name] for f in state.schema["key"].dataType.fields)
    return state.select(
        symbol.alias("symbol"),
        window["start"].alias("candle_start"),
        window["end"].alias("candle_end"),
        F.col("partition_id").alias("state_partition"),
    )


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint, their number of partitions and the batches whose state is there."""
    return spark.read.format("state-metadata").load(checkpoint).select("operatorName", "numPartitions", "minBatchId", "maxBatchId")
