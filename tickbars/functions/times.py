"""Instants, hours and lookback bounds."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.schemas import LOOKBACK_HOURS


def instant(value: Column | datetime | str | None) -> Column:
    """A TIMESTAMP column from a column, datetime or ISO text (no zone means UTC); None is now."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return F.lit(value)


def lookback_start(as_of: Column, hours: int = LOOKBACK_HOURS) -> Column:
    return as_of - F.expr(f"INTERVAL {hours} HOURS")


def hour_of(ts: Column) -> Column:
    return F.date_trunc("HOUR", ts)


def to_ntz(df: DataFrame) -> DataFrame:
    """Show instants as plain UTC date-times."""
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        )
    )
