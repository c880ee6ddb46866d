"""The driver's `events` table read as ticks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.schemas import LIVE_SOURCE, PRICE


def events_as_ticks(
    spark: SparkSession, sf_dir: str, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Each event is a tick: its type is the symbol, `props.k` the volume, its id the order among ties.

    `since` / `until` (half-open, UTC) are applied to the stored column, so they reach the scan.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if since is not None:
        events = events.filter(F.col("ts") >= F.lit(since.isoformat()).cast("timestamp_ntz"))
    if until is not None:
        events = events.filter(F.col("ts") < F.lit(until.isoformat()).cast("timestamp_ntz"))
    return as_ticks(events)


def as_ticks(events: DataFrame) -> DataFrame:
    # Nearly all `props` are `{"k": n}`; matching that shape is about five times cheaper than the JSON
    # parser, which handles the rest.
    plain = F.nullif(F.regexp_extract("props", r'^\{"k": ?(-?[0-9]{1,18})\}$', 1), F.lit(""))
    volume = F.coalesce(plain, F.get_json_object("props", "$.k"))
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("value").cast(PRICE).alias("price"),
        volume.cast("bigint").alias("volume"),
        F.lit(LIVE_SOURCE).alias("source"),
        F.col("event_id").alias("seq"),
    )
