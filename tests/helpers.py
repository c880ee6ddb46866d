"""Small builders for hand-written rows. All times are UTC."""

from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from tickbars.functions import to_ntz


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def wall(text):
    return datetime.fromisoformat(text)


def ticks(spark, rows):
    """Rows of (symbol, time text, price, volume, seq)."""
    return spark.createDataFrame(
        rows, "symbol STRING, event_time STRING, price STRING, volume BIGINT, seq BIGINT"
    ).select(
        "symbol",
        F.to_timestamp("event_time").alias("event_time"),
        F.col("price").cast("decimal(18,6)").alias("price"),
        "volume",
        "seq",
    )


def candles(spark, rows, minutes=1):
    """Rows of (symbol, start text, open, high, low, close, volume)."""
    return spark.createDataFrame(
        rows, "symbol STRING, start STRING, o STRING, h STRING, l STRING, c STRING, volume BIGINT"
    ).select(
        "symbol",
        F.to_timestamp("start").alias("candle_start"),
        (F.to_timestamp("start") + F.make_dt_interval(mins=F.lit(minutes))).alias("candle_end"),
        *(F.col(c).cast("decimal(18,6)").alias(f"{n}_price") for c, n in zip("ohlc", ("open", "high", "low", "close"))),
        "volume",
        F.lit(1).alias("trade_count"),
        F.col("c").cast("decimal(18,6)").alias("vwap"),
    )


def rows(df, *columns):
    """Rows as plain tuples; instants shown as UTC wall time, whole decimals as int or float."""
    shown = to_ntz(df.select(*columns) if columns else df)

    def plain(value):
        if isinstance(value, Decimal):
            return int(value) if value == int(value) else float(value)
        return value

    return [tuple(plain(v) for v in row) for row in shown.collect()]
