"""Filling hours that have no live coverage from backfill bars.

Two rules exist and differ for a bar that starts off the hour:
the summary compares bar starts with live hours as they are, the chart first cuts them to the hour.
Coverage is a mask of hours for each symbol and date, joined to the bars on that key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.functions import hour_of

HOURLY_COLUMNS = [
    "symbol",
    "candle_start",
    "candle_end",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "volume",
]


def hour_masks(rows: DataFrame) -> DataFrame:
    """(symbol, candle_date, hours): one bit for each hour of the day in which a row starts.

    A bitwise or is merged map-side, so what is shuffled is one row per task, symbol and date, and no minute.
    """
    start = F.col("candle_start")
    bit = F.call_function("shiftleft", F.lit(1), F.hour(start))
    return rows.groupBy("symbol", F.to_date(start).alias("candle_date")).agg(F.bit_or(bit).alias("hours"))


def _uncovered(bars: DataFrame, masks: DataFrame, on_the_hour: bool) -> DataFrame:
    """Bars whose hour has no bit; `on_the_hour`: a bar that starts off the hour is never covered."""
    start = F.col("candle_start")
    bit = F.call_function("shiftright", F.coalesce("hours", F.lit(0)), F.hour(start)).bitwiseAND(1)
    covered = bit == 1
    if on_the_hour:
        covered = covered & (start == hour_of(start))
    dated = bars.withColumn("candle_date", F.to_date(start))
    return dated.join(masks, ["symbol", "candle_date"], "left").filter(~covered).select(*bars.columns)


def uncovered_bars(backfill: DataFrame, live_hourly: DataFrame) -> DataFrame:
    """Summary rule: drop a bar if a live hour has its symbol and exactly its start."""
    return _uncovered(backfill, hour_masks(live_hourly), on_the_hour=True)


def combined_hourly(live_hourly: DataFrame, backfill: DataFrame) -> DataFrame:
    """Live hours plus the bars of uncovered hours."""
    bars = backfill.select(*HOURLY_COLUMNS)
    return live_hourly.select(*HOURLY_COLUMNS).unionByName(uncovered_bars(bars, live_hourly))


def live_hours(candles: DataFrame) -> DataFrame:
    """Distinct (symbol, hour) with at least one live minute."""
    hours = F.expr("filter(sequence(0, 23), h -> (shiftright(hours, h) & 1) = 1)")
    found = hour_masks(candles).select("symbol", "candle_date", F.explode(hours).alias("hour"))
    return found.select("symbol", (F.col("candle_date").cast("timestamp") + F.make_dt_interval(hours=F.col("hour"))).alias("candle_hour"))


def live_and_uncovered(candles: DataFrame, backfill: DataFrame, coverage: DataFrame | None = None) -> DataFrame:
    """Chart rule: all live minutes, and the bars in whose hour no live minute lies. Both have the same columns.

    `coverage` has the live rows' symbols and starts, if they are cheaper to get than the candles: versions of a minute that were
    replaced cover its hour just as well.
    """
    masks = hour_masks(candles if coverage is None else coverage)
    return candles.unionByName(_uncovered(backfill, masks, on_the_hour=False))
