"""Tick -> minute candle and minute -> hour candle aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.functions import pair_order
from tickbars.schemas import CANDLE_WIDTH, PRICE


def tick_candles(ticks: DataFrame, width: str = CANDLE_WIDTH) -> DataFrame:
    """Open/high/low/close, volume, trade count and VWAP per symbol and tumbling window.

    Works on a table or on a watermarked stream. Ticks: symbol, event_time TIMESTAMP,
    price DECIMAL(18,6), volume BIGINT, seq BIGINT (order among equal times, may be null).
    A sum too large for its type is null, which the table rejects: one absurd volume must not stop
    the stream. Every aggregate has a fixed-width buffer, so a hot symbol is collapsed map-side by a hash
    aggregate and the shuffle carries one row per task, window and symbol.
    """
    price, volume = F.col("price"), F.col("volume")
    total = F.try_sum(volume)
    close = F.max_by("price", "arrival")
    arrival = pair_order(F.unix_micros("event_time"), F.coalesce(F.col("seq"), F.lit(0)))
    return (
        ticks.withColumn("arrival", arrival)
        .groupBy(F.window("event_time", width), "symbol")
        .agg(
            F.min_by("price", "arrival").alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            close.alias("close_price"),
            total.alias("volume"),
            F.count(F.lit(1)).cast("int").alias("trade_count"),
            F.when(total > 0, F.try_sum(price * volume) / total)
            .otherwise(close)
            .try_cast(PRICE)
            .alias("vwap"),
        )
        .select(
            "symbol",
            F.col("window.start").alias("candle_start"),
            F.col("window.end").alias("candle_end"),
            "open_price",
            "high_price",
            "low_price",
            "close_price",
            "volume",
            "trade_count",
            "vwap",
        )
    )


def hourly_candles(candles: DataFrame) -> DataFrame:
    """Minute candles -> hour candles. The end is always start + 1 hour, also for a partial hour."""
    return (
        candles.groupBy("symbol", F.window("candle_start", "1 hour"))
        .agg(
            F.min_by("open_price", "candle_start").alias("open_price"),
            F.max("high_price").alias("high_price"),
            F.min("low_price").alias("low_price"),
            F.max_by("close_price", "candle_start").alias("close_price"),
            F.try_sum("volume").alias("volume"),
        )
        .select(
            "symbol",
            F.col("window.start").alias("candle_start"),
            F.col("window.end").alias("candle_end"),
            "open_price",
            "high_price",
            "low_price",
            "close_price",
            "volume",
        )
    )
