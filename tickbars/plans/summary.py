"""The trailing-24h summary: live hours, backfill for the rest, one row per symbol."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.functions import instant, lookback_start
from tickbars.operators.candles import hourly_candles
from tickbars.operators.coverage import HOURLY_COLUMNS, combined_hourly
from tickbars.operators.filters import trailing_24h
from tickbars.operators.rollup import symbol_rollup, with_price_change
from tickbars.plans.hours import stored_hourly_24h
from tickbars.sources.tables import MarketTables


def live_hourly_24h(candles: DataFrame, as_of: Column) -> DataFrame:
    return hourly_candles(trailing_24h(candles, as_of))


def backfill_hourly_24h(backfill: DataFrame, as_of: Column) -> DataFrame:
    return trailing_24h(backfill, as_of).select(*HOURLY_COLUMNS)


def combined_hourly_24h(candles: DataFrame, backfill: DataFrame, as_of: Column) -> DataFrame:
    return combined_hourly(live_hourly_24h(candles, as_of), backfill_hourly_24h(backfill, as_of))


def pair_analysis_24h(candles: DataFrame, backfill: DataFrame, as_of: Column) -> DataFrame:
    return with_price_change(symbol_rollup(combined_hourly_24h(candles, backfill, as_of)))


def refresh_summary(
    spark: SparkSession,
    tables: MarketTables,
    run: int,
    batch_id: int,
    as_of: Column | datetime | str | None = None,
    from_states: bool = False,
) -> None:
    """Recompute the summary from the stored tables and upsert it by symbol.

    Reads the two dates of the window from each table; with `from_states`, the stored hours in place of a day of minutes.
    Symbols without data in the window keep their row. A row that breaks a table rule (a zero open has no percent change) is
    stored as a reject; the others are still written.
    """
    # One time for all parts of the refresh, and a literal that prunes dates.
    as_of = instant(datetime.now(timezone.utc) if as_of is None else as_of)
    since = lookback_start(as_of)
    # Read twice by the coverage join; one row per symbol and hour, so it is small next to its input.
    live = (stored_hourly_24h(spark, tables, as_of) if from_states else live_hourly_24h(tables.candles.read(spark, since, as_of), as_of)).persist()
    try:
        bars = backfill_hourly_24h(tables.backfill.read(spark, since, as_of), as_of)
        summary = with_price_change(symbol_rollup(combined_hourly(live, bars)))
        tables.summary.upsert(summary.withColumn("updated_at", F.current_timestamp()), run, batch_id, unique=True)
    finally:
        live.unpersist()
