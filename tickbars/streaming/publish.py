"""Trade envelopes -> tick messages, to a topic or a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickbars.operators.filters import in_universe
from tickbars.operators.quality import accepted, rejected
from tickbars.schemas import TICK_TOPIC, TRIGGER_INTERVAL
from tickbars.sources.ticks import encode_ticks
from tickbars.sources.trades import decode_envelopes


def tick_messages(envelopes: DataFrame, symbols: list[str] | None = None) -> DataFrame:
    ticks = accepted(decode_envelopes(envelopes))
    if symbols is not None:
        ticks = in_universe(ticks, symbols)
    return encode_ticks(ticks)


def sink_options(servers: str, topic: str = TICK_TOPIC) -> dict[str, str]:
    """What the writer to a topic is told."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def start_publish(
    envelopes: DataFrame,
    checkpoint: str,
    servers: str | None = None,
    topic: str = TICK_TOPIC,
    path: str | None = None,
    symbols: list[str] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Publish to a Kafka topic (`servers`) or as message files (`path`).

    The key is the symbol, so one symbol stays in one topic partition and in order.
    """
    writer = (
        tick_messages(envelopes, symbols)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if servers is not None:
        writer = writer.format("kafka").options(**sink_options(servers, topic))
    else:
        writer = writer.format("parquet").option("path", path)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER_INTERVAL)).start()


def start_trade_rejects(envelopes: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Keep trades that lack a usable field, with the reason, in a Parquet folder."""
    writer = (
        rejected(decode_envelopes(envelopes))
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER_INTERVAL)).start()
