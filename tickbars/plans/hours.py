"""Hourly states of the live minutes, so that the 24h summary needn't read a day of minutes for each micro-batch.

A state is the hour's candle. It isn't added to but made anew from the hour's stored minutes whenever one of them changes: a late or
corrected minute then counts once. Only hours that a batch changed are made anew. The hours at both ends of the
trailing window are cut by it, and are read from the minutes themselves.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.functions import hour_of, lookback_start
from tickbars.operators.candles import hourly_candles
from tickbars.operators.coverage import HOURLY_COLUMNS
from tickbars.operators.filters import starting_in, trailing_24h
from tickbars.sources.tables import MarketTables


def changed_hours(candles: DataFrame) -> DataFrame:
    """(symbol, hour) of some minute candles."""
    return candles.select("symbol", hour_of(F.col("candle_start")).alias("hour")).distinct()


def minutes_of_hours(spark: SparkSession, tables: MarketTables, changed: DataFrame, days: Collection[date], since: Column, until: Column) -> DataFrame:
    """Current minutes of the changed hours, which start in [since, until]. Other versions are left out before any are merged."""
    versions = tables.candles.versions(spark, since, until, days)
    matches = (versions["symbol"] == changed["symbol"]) & (hour_of(versions["candle_start"]) == changed["hour"])
    return tables.candles.current(versions.join(changed, matches, "left_semi"))


@dataclass(frozen=True)
class Span:
    """What a batch of minutes touches: its rows and their dates, and the dates and the first and last minute of those that count."""

    rows: int
    dates: list[date]
    days: list[date]
    first: datetime | None
    last: datetime | None


def span_of(candles: DataFrame, since: Column | None = None) -> Span:
    """With `since`, hours that ended before it don't count: a window that only moves on never needs them.

    The dates are brought to the driver; a micro-batch has few, and a year's catching up 365.
    """
    start = F.col("candle_start")
    counting = start if since is None else F.when(start >= hour_of(since), start)
    seen = candles.agg(
        F.count(F.lit(1)).alias("n"),
        F.collect_set(F.to_date(start)).alias("dates"),
        F.collect_set(F.to_date(counting)).alias("days"),
        F.min(counting).alias("first"),
        F.max(counting).alias("last"),
    ).first()
    return Span(seen["n"], sorted(seen["dates"]), sorted(seen["days"]), seen["first"], seen["last"])


def refresh_hours(
    spark: SparkSession, tables: MarketTables, candles: DataFrame, run: int, batch_id: int, span: Span | None = None
) -> list[date]:
    """Make the states of these candles' hours anew from the stored minutes; the dates written.

    `candles` are those just stored, `span` is what they touch. Call it after they are: the state's version is the time before the
    minutes are read, so of two writers the one whose read saw more wins.
    """
    read_at = F.lit(datetime.now(timezone.utc))
    span = span_of(candles) if span is None else span
    if not span.days:
        return []
    first, last = hour_of(F.lit(span.first)), hour_of(F.lit(span.last)) + F.expr("INTERVAL 1 HOUR")
    counting = candles.filter(F.col("candle_start") >= first)
    minutes = minutes_of_hours(spark, tables, changed_hours(counting), span.days, first, last)
    tables.hours.upsert(hourly_candles(minutes).withColumn("updated_at", read_at), run, batch_id, files=1 if len(span.days) == 1 else None, unique=True)
    return span.days


def rebuild_hours(spark: SparkSession, tables: MarketTables, run: int, batch_id: int, since: Column, until: Column) -> None:
    """States of all hours that touch [since, until]: for a start after other writers, or a lost table."""
    ends = spark.sql("SELECT 1").select(F.to_date(hour_of(since)), F.to_date(until)).first()
    if not tables.candles.folders(spark, days=[ends[0] + timedelta(n) for n in range((ends[1] - ends[0]).days + 1)]):
        return
    read_at = F.lit(datetime.now(timezone.utc))
    minutes = tables.candles.read(spark, hour_of(since), hour_of(until) + F.expr("INTERVAL 1 HOUR"))
    whole = starting_in(minutes, hour_of(since), hour_of(until) + F.expr("INTERVAL 1 HOUR"))
    tables.hours.upsert(hourly_candles(whole).withColumn("updated_at", read_at), run, batch_id, unique=True)


def stored_hourly_24h(spark: SparkSession, tables: MarketTables, as_of: Column) -> DataFrame:
    """The live hours of the trailing window: states of its whole hours, and minutes of the cut ones at its ends."""
    hour = F.expr("INTERVAL 1 HOUR")
    since = lookback_start(as_of)
    first, last = F.when(since == hour_of(since), since).otherwise(hour_of(since) + hour), hour_of(as_of)
    whole = starting_in(tables.hours.read(spark, first, last), first, last).select(*HOURLY_COLUMNS)
    if spark.sql("SELECT 1").select(as_of == last).first()[0]:
        # The window is a day long: if one end is on the hour, so is the other.
        return whole
    ends = [trailing_24h(starting_in(tables.candles.read(spark, a, b), a, b), as_of) for a, b in ((since, first), (last, as_of))]
    return whole.unionByName(hourly_candles(ends[0].unionByName(ends[1])))
