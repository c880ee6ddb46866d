"""Tick messages: topic and file sources, JSON encoding and decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.schemas import LIVE_SOURCE, MESSAGE, PRICE, TICK_JSON, TICK_TOPIC

# ISO-8601 in UTC with microseconds and a numeric offset.
_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"

# When a message arrived is a fact of the message, the same for every query that reads it.
_FILE_TIME = "_metadata.file_modification_time AS arrived"


def topic_options(servers: str, topic: str = TICK_TOPIC, starting_offsets: str = "latest", max_per_batch: int | None = None) -> dict[str, str]:
    """What the reader of a topic is told."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if max_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def topic_columns(records: DataFrame) -> DataFrame:
    """A topic's records as messages; they arrived when the topic says."""
    return records.select("key", "value", "offset", F.col("timestamp").alias("arrived"))


def topic_messages(
    spark: SparkSession,
    servers: str,
    topic: str = TICK_TOPIC,
    starting_offsets: str = "latest",
    max_per_batch: int | None = None,
) -> DataFrame:
    """Stream of a Kafka topic (needs the spark-sql-kafka package on the cluster).

    `max_per_batch` bounds a micro-batch when the stream has to catch up.
    """
    return topic_columns(spark.readStream.format("kafka").options(**topic_options(servers, topic, starting_offsets, max_per_batch)).load())


def landed_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of message files (Parquet: key, value, offset) landing in a folder."""
    reader = spark.readStream.schema(MESSAGE)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).selectExpr("*", _FILE_TIME)


def text_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of JSON-lines files, one message per line. Lines have no offset."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).selectExpr("*", _FILE_TIME)


def encode_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks -> messages keyed by symbol. `seq`, if present, becomes the offset."""
    body = F.struct(
        "symbol",
        "event_time",
        F.col("price").cast("double").alias("price"),
        "volume",
        F.col("source") if "source" in ticks.columns else F.lit(LIVE_SOURCE).alias("source"),
    )
    value = F.to_json(body, {"timestampFormat": _TIME_FORMAT})
    offset = [F.col("seq").alias("offset")] if "seq" in ticks.columns else []
    return ticks.select(F.col("symbol").cast("binary").alias("key"), value.cast("binary").alias("value"), *offset)


def decode_ticks(messages: DataFrame) -> DataFrame:
    """Messages -> ticks. Bad JSON or a wrong-typed field gives nulls, to be split off by `check_ticks`.

    The fields leave through a generator on purpose: a filter on them cannot be moved below it, where
    the optimizer would write out the JSON parse once per field that the filter looks at.
    """
    offset = F.col("offset").cast("bigint") if "offset" in messages.columns else F.lit(None).cast("bigint")
    arrived = ["arrived"] if "arrived" in messages.columns else []
    parsed = messages.select(F.from_json(F.col("value").cast("string"), TICK_JSON).alias("tick"), offset.alias("seq"), *arrived)
    fields = F.struct(
        "tick.symbol",
        "tick.event_time",
        F.col("tick.price").try_cast(PRICE).alias("price"),
        "tick.volume",
        F.coalesce("tick.source", F.lit(LIVE_SOURCE)).alias("source"),
    )
    return parsed.select(F.inline(F.array(fields)), "seq", *arrived)
