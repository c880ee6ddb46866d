"""Row filters shared by the plans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions import lookback_start


def in_universe(rows: DataFrame, universe: DataFrame | Iterable[str]) -> DataFrame:
    """Keep rows of the configured symbols, given as a short list or as a table with `symbol`."""
    if isinstance(universe, DataFrame):
        return rows.join(universe.select("symbol"), "symbol", "left_semi")
    return rows.filter(F.col("symbol").isin(list(universe)))


def trailing_24h(candles: DataFrame, as_of: Column) -> DataFrame:
    """Candles that start in [as_of - 24h, as_of)."""
    start = F.col("candle_start")
    return candles.filter((start >= lookback_start(as_of)) & (start < as_of))


def starting_in(rows: DataFrame, start: Column, end: Column) -> DataFrame:
    """Half-open: `start` is kept, `end` is not."""
    return rows.filter((F.col("candle_start") >= start) & (F.col("candle_start") < end))


def starting_between(rows: DataFrame, start: Column, end: Column) -> DataFrame:
    """Closed: both ends are kept."""
    return rows.filter(F.col("candle_start").between(start, end))
