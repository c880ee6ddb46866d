"""Dashboard reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions import hour_of
from tickbars.operators.coverage import live_and_uncovered
from tickbars.operators.filters import starting_between, starting_in

REPORT_COLUMNS = [
    "symbol",
    "open_24h",
    "high_24h",
    "low_24h",
    "close_24h",
    "price_change",
    "price_change_pct",
    "total_volume",
    "avg_volume_per_min",
    "avg_price",
    "updated_at",
]


def scan_range(from_epoch: int, to_epoch: int) -> tuple[Column, Column]:
    """Bounds of the stored rows that a series over the closed range can need: its whole hours."""
    start, end = F.timestamp_seconds(F.lit(from_epoch)), F.timestamp_seconds(F.lit(to_epoch))
    return hour_of(start), hour_of(end) + F.expr("INTERVAL 1 HOUR")


def _selected_candles(
    candles: DataFrame, backfill: DataFrame, symbol: str, from_epoch: int, to_epoch: int, columns: list[str], coverage: DataFrame | None
) -> DataFrame:
    """Live minutes of a symbol plus its backfill hours without any live minute, both ends included.

    Live coverage is not limited to the range, but only hours that a bar of the range starts in
    matter, so it is read over the whole hours around the range.
    """
    start, end = F.timestamp_seconds(F.lit(from_epoch)), F.timestamp_seconds(F.lit(to_epoch))
    live, bars = (
        starting_between(rows.filter(F.col("symbol") == symbol), start, end).select("symbol", "candle_start", *columns)
        for rows in (candles, backfill)
    )
    covering = (candles if coverage is None else coverage).filter(F.col("symbol") == symbol)
    covering = starting_in(covering, *scan_range(from_epoch, to_epoch)).select("symbol", "candle_start")
    return live_and_uncovered(live, bars, covering)


def candlestick_series(
    candles: DataFrame, backfill: DataFrame, symbol: str, from_epoch: int, to_epoch: int, coverage: DataFrame | None = None
) -> DataFrame:
    """`coverage`: any versions of the live minutes, from which covered hours are read instead."""
    prices = ["open_price", "high_price", "low_price", "close_price"]
    time: list[Column] = [F.col("candle_start").alias("time")]
    return (
        _selected_candles(candles, backfill, symbol, from_epoch, to_epoch, prices, coverage)
        .select(*time, *(F.col(p).alias(p.removesuffix("_price")) for p in prices))
        .orderBy("time")
    )


def volume_series(
    candles: DataFrame, backfill: DataFrame, symbol: str, from_epoch: int, to_epoch: int, coverage: DataFrame | None = None
) -> DataFrame:
    return (
        _selected_candles(candles, backfill, symbol, from_epoch, to_epoch, ["volume"], coverage)
        .select(F.col("candle_start").alias("time"), F.col("volume").alias("value"))
        .orderBy("time")
    )


def pair_report(summary: DataFrame) -> DataFrame:
    """Largest percent change first; equal changes are ordered by symbol."""
    return summary.select(*REPORT_COLUMNS).orderBy(F.desc("price_change_pct"), "symbol")


def symbol_list(candles: DataFrame, backfill: DataFrame) -> DataFrame:
    # Distinct on each side first: a partial aggregate then leaves one row per task and symbol.
    return candles.select("symbol").union(backfill.select("symbol")).distinct().orderBy("symbol")
