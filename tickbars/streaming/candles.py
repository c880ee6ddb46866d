"""The live job: tick messages -> one-minute candles -> tables, as one Structured Streaming query."""

from __future__ import annotations

import time
from datetime import datetime, timezone
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickbars.functions import instant, lookback_start
from tickbars.operators.candles import tick_candles
from tickbars.operators.quality import accepted, check_ticks, rejected
from tickbars.plans.hours import rebuild_hours, refresh_hours, span_of
from tickbars.plans.summary import refresh_summary
from tickbars.schemas import TRIGGER_INTERVAL, WATERMARK
from tickbars.sources.tables import MarketTables, RunFiles
from tickbars.sources.ticks import decode_ticks
from tickbars.streaming.counts import counted_ticks

FUTURE_TOLERANCE = "10 minutes"
# A micro-batch changes few candles per state partition; one file each would flood the table. The session behind a
# micro-batch has adaptive execution off, so files are counted here and not sized at run time.
CANDLES_PER_FILE = 500_000
# Micro-batches between merges of the stream's files: about half an hour of the 10 s trigger.
MERGE_EVERY = 200
# Seconds that merged files stay for readers that have listed them: more than the longest report takes.
KEEP_MERGED = 3600


def checked_ticks(messages: DataFrame, tolerance: str = FUTURE_TOLERANCE) -> DataFrame:
    """Decoded ticks with `reject_reason`; times more than `tolerance` ahead of the message's arrival are refused.

    The arrival belongs to the message, so the candle query and the reject query agree on every tick. Messages without
    one are held against the clock.
    """
    ticks = decode_ticks(messages)
    clock = F.current_timestamp()
    arrived = F.coalesce("arrived", clock) if "arrived" in ticks.columns else clock
    return check_ticks(ticks, arrived + F.expr(f"INTERVAL {tolerance}")).drop("arrived")


def streaming_candles(messages: DataFrame, watermark: str = WATERMARK, tolerance: str = FUTURE_TOLERANCE) -> DataFrame:
    """The same candle definition as the batch one, on ticks with an event-time watermark.

    A tick is dropped once its whole window lies behind the watermark, so a finished candle is
    never replaced by a partial one.
    """
    return tick_candles(accepted(counted_ticks(checked_ticks(messages, tolerance))).withWatermark("event_time", watermark))


def writer_run(spark: SparkSession, checkpoint: str) -> int:
    """Start time of the writer that owns this checkpoint, kept inside it and reused on restart.

    A new checkpoint counts batches from 0 again, so it must come with a newer run.
    """
    path = f"{checkpoint.rstrip('/')}/writer_run"
    now = int(time.time() * 1000)
    first = spark.range(1).select(F.lit(now).cast("bigint").alias("run"))
    first.write.mode("ignore").parquet(path)
    kept = spark.read.schema("run BIGINT").parquet(path).first()
    if kept is None:
        # An earlier start made the folder and died before its row was in it.
        first.write.mode("append").parquet(path)
        kept = spark.read.schema("run BIGINT").parquet(path).first()
    return kept.run


def start_candles(
    messages: DataFrame,
    tables: MarketTables,
    checkpoint: str,
    available_now: bool = False,
    refresh: bool = True,
    as_of: Column | datetime | str | None = None,
    watermark: str = WATERMARK,
    trigger: str = TRIGGER_INTERVAL,
    state_partitions: int | None = None,
    tolerance: str = FUTURE_TOLERANCE,
    candles_per_file: int = CANDLES_PER_FILE,
    merge_every: int = MERGE_EVERY,
    keep_merged: float = KEEP_MERGED,
) -> StreamingQuery:
    """Start the job: upsert every changed candle, make the states of the changed hours anew, then refresh the 24h summary.

    Update mode emits the whole current candle, never a delta, so the newest row per key is right.
    Summary bounds follow the clock unless `as_of` is given. `state_partitions` is the shuffle width
    of the stream alone; it counts at the first start of a checkpoint and stays fixed after that. Every `merge_every`
    batches the files that the stream wrote are merged, so a refresh reads a bounded number of them; merged files stay for
    `keep_merged` seconds. A start makes the hours of the trailing window anew, for what others have written since.
    """
    # Tables are read with this session: the one behind a micro-batch has adaptive execution off.
    spark = messages.sparkSession
    if refresh:
        tables.create(spark)
    else:
        tables.candles.create(spark)
    run = writer_run(spark, checkpoint)
    written = [RunFiles(table, run, keep_merged) for table in ((tables.candles, tables.hours, tables.summary) if refresh else (tables.candles,))]
    counted = count()
    if refresh:
        now = instant(datetime.now(timezone.utc) if as_of is None else as_of)
        rebuild_hours(spark, tables, run, 0, lookback_start(now), now)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # Without this, each action would run the stateful plan again.
        batch.persist()
        try:
            now = instant(datetime.now(timezone.utc) if as_of is None else as_of)
            span = span_of(batch, lookback_start(now))
            if span.rows == 0:
                return
            tables.candles.upsert(batch, run, batch_id, files=-(-span.rows // candles_per_file), unique=True)
            if refresh:
                refresh_hours(spark, tables, batch, run, batch_id, span)
                refresh_summary(spark, tables, run, batch_id, now, from_states=True)
            for files in written:
                files.wrote(span.dates)
            # The first batch of a start merges what an earlier start has left.
            if next(counted) % merge_every == 0:
                for files in written:
                    files.merge(spark)
        finally:
            batch.unpersist()

    writer = (
        streaming_candles(messages, watermark, tolerance)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    if state_partitions is None:
        return writer.start()
    # A query keeps the settings of the moment it starts.
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", state_partitions)
    try:
        return writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def start_rejects(
    messages: DataFrame, path: str, checkpoint: str, available_now: bool = False, tolerance: str = FUTURE_TOLERANCE
) -> StreamingQuery:
    """Keep refused ticks, with the reason, in a Parquet folder. Use the tolerance of the candle query."""
    writer = (
        rejected(checked_ticks(messages, tolerance))
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER_INTERVAL)).start()
