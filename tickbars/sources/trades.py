"""Trade envelopes: `{"type": "trade", "data": [{s, t, p, v}, ...]}`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.operators.quality import REASON, check_ticks, first_reason
from tickbars.schemas import LIVE_SOURCE, PRICE
from tickbars.sources.variants import field, fields_null, is_text, value

#: More trades than an envelope holds, so that offset and place make one number.
ENVELOPE_TRADES = 1_000_000


def decode_envelopes(messages: DataFrame) -> DataFrame:
    """One tick per trade, with `reject_reason` for trades that lack a usable field.

    Envelopes of any other type (pings, errors) and envelopes without data give no ticks. Text that is no envelope,
    and trades whose data is null or cannot be read, give one refused row. The time is in epoch milliseconds, the volume is
    truncated to whole units and is 0 when missing; a null written out is refused in any field. `seq` orders trades of one time:
    by the message's offset, if it has one, and the place in the envelope.
    """
    offset = F.col("offset") if "offset" in messages.columns else F.lit(None)
    parsed = messages.select(F.try_parse_json(F.col("value").cast("string")).alias("envelope"), F.coalesce(offset.cast("bigint"), F.lit(0)).alias("offset"))
    envelope = F.col("envelope")
    kind, given, data = value(envelope, "type", "string"), field(envelope, "data"), value(envelope, "data", "array<variant>")
    unreadable = F.when(kind.isNull() & data.isNull(), F.lit("undecodable")).when(
        (kind == "trade") & data.isNull(), F.when(F.is_variant_null(given), F.lit("null data")).when(given.isNotNull(), F.lit("unreadable data"))
    )
    # The type is tested inside the generator, so that the message is parsed once.
    nothing = F.array(F.lit(None).cast("variant"))
    trades = parsed.select("envelope", "offset", unreadable.alias("unreadable")).select(
        "offset", "unreadable", F.posexplode(F.when(F.col("unreadable").isNotNull(), nothing).when(kind == "trade", data)).alias("place", "trade")
    )
    trade = F.col("trade")
    micros = (F.when(~is_text(trade, "t"), value(trade, "t", "decimal(20,3)")) * 1000).try_cast("bigint")
    # Each field is read once, here; a generator would read it wherever it is named.
    trades = trades.select("*", micros.alias("t"), *(value(trade, name, "string").alias(name) for name in ("s", "p", "v")))
    units = F.when(F.col("v").isNotNull(), F.col("v").try_cast("double").try_cast("bigint")).when(field(trade, "v").isNull(), F.lit(0).cast("bigint"))
    read = {"s": "symbol", "t": "event_time", "p": "price", "v": "volume"}
    fields = F.struct(
        F.col("s").alias("symbol"),
        F.timestamp_micros("t").alias("event_time"),
        F.col("p").try_cast("double").try_cast(PRICE).alias("price"),
        units.alias("volume"),
        F.lit(LIVE_SOURCE).alias("source"),
        (F.col("offset") * ENVELOPE_TRADES + F.col("place")).alias("seq"),
        F.coalesce("unreadable", first_reason(fields_null(trade, read))).alias("unreadable"),
    )
    ticks = check_ticks(trades.select(F.inline(F.array(fields))))
    return ticks.withColumn(REASON, F.coalesce("unreadable", REASON)).drop("unreadable")
