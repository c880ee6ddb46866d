"""Per-symbol summary of the combined hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.schemas import PERCENT, PRICE, RATE

_MICROS_PER_MINUTE = 60_000_000


def symbol_rollup(hours: DataFrame) -> DataFrame:
    """One row per symbol: first open, extremes, last close, total and per-minute volume, mean close."""
    covered_micros = F.sum(F.unix_micros("candle_end") - F.unix_micros("candle_start"))
    total = F.try_sum("volume")
    per_minute = (
        total.cast("decimal(20,0)")
        * F.lit(_MICROS_PER_MINUTE).cast("decimal(8,0)")
        / F.nullif(covered_micros, F.lit(0)).cast("decimal(20,0)")
    )
    return hours.groupBy("symbol").agg(
        F.min("candle_start").alias("window_start"),
        F.max("candle_end").alias("window_end"),
        F.min_by("open_price", "candle_start").alias("open_24h"),
        F.max("high_price").alias("high_24h"),
        F.min("low_price").alias("low_24h"),
        F.max_by("close_price", "candle_start").alias("close_24h"),
        total.alias("total_volume"),
        per_minute.try_cast(RATE).alias("avg_volume_per_min"),
        F.avg("close_price").cast(PRICE).alias("avg_price"),
    )


def with_price_change(rollup: DataFrame) -> DataFrame:
    """Absolute and percent change; a zero open gives a null percent, which the table rejects."""
    change = F.col("close_24h") - F.col("open_24h")
    percent = F.round(change / F.nullif(F.col("open_24h"), F.lit(0).cast(PRICE)) * 100, 4)
    return rollup.select(
        "symbol",
        "window_start",
        "window_end",
        "open_24h",
        "high_24h",
        "low_24h",
        "close_24h",
        change.try_cast(PRICE).alias("price_change"),
        percent.try_cast(PERCENT).alias("price_change_pct"),
        "total_volume",
        "avg_volume_per_min",
        "avg_price",
    )
