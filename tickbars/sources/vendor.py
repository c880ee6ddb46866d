"""Hourly vendor payloads: `{"status": "ok", "values": [{datetime, open, high, low, close, volume}]}`.

The symbol is not in the payload, it comes with the request; landed files keep it in the path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.operators.filters import starting_in
from tickbars.operators.quality import REASON, accepted, first_reason, rejected
from tickbars.schemas import BACKFILL_SOURCE, PRICE
from tickbars.sources.variants import field, fields_null, value


def landed_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payload documents below `path/symbol=<symbol>/`, one request per file."""
    return (
        spark.read.schema("value STRING, symbol STRING")
        .text(path, wholetext=True)
        .select("symbol", F.col("value").alias("payload"))
    )


def decode_payloads(payloads: DataFrame) -> DataFrame:
    """(symbol, payload) -> (symbol, failed, values): why a payload is refused as a whole, and its bars as VARIANTs otherwise.

    Without `values` it has no bars; a null written out, or anything but a list, is refused.
    """
    payload = F.col("payload")
    status, given, values = value(payload, "status", "string"), field(payload, "values"), value(payload, "values", "array<variant>")
    failed = (
        F.when(~status.eqNullSafe("ok"), F.concat(F.lit("status "), F.coalesce(status, F.lit("missing"))))
        .when(F.is_variant_null(given), F.lit("null values"))
        .when(given.isNotNull() & values.isNull(), F.lit("unreadable values"))
    )
    fields = F.struct(failed.alias("failed"), F.when(status == "ok", values).alias("values"))
    return payloads.select("symbol", F.try_parse_json("payload").alias("payload")).select("symbol", F.inline(F.array(fields)))


def all_bars(payloads: DataFrame) -> DataFrame:
    """Bars of the payloads with status `ok`, cast to their types, with `reject_reason`.

    A payload whose status is not `ok`, is absent or cannot be read is one refused row without a `position`. An offset
    in the datetime text is overwritten by UTC, not converted: a cast to TIMESTAMP_NTZ ignores it. A missing volume is 0;
    a null written out is refused in any field.
    """
    bars = decode_payloads(payloads).select("symbol", "failed", F.posexplode_outer("values").alias("position", "bar"))
    bars = bars.filter(F.col("position").isNotNull() | F.col("failed").isNotNull())
    bar = F.col("bar")
    names = ("open", "high", "low", "close")
    # Each field is read once, here; a generator would read it wherever it is named.
    bars = bars.select("*", *(value(bar, n, "string").alias(n) for n in ("datetime", *names, "volume")))
    prices = {f"{n}_price": F.col(n).try_cast("double").try_cast(PRICE) for n in names}
    start = F.col("datetime").try_cast("timestamp_ntz").cast("timestamp")
    units = F.col("volume").try_cast("double").try_cast("bigint")
    volume = F.when(F.col("volume").isNotNull(), units).when(field(bar, "volume").isNull(), F.lit(0).cast("bigint"))
    shown = {"datetime": "candle_start", **{n: f"{n}_price" for n in names}, "volume": "volume"}
    fields = F.struct(
        F.col("datetime"),
        start.alias("candle_start"),
        (start + F.expr("INTERVAL 1 HOUR")).alias("candle_end"),
        *(price.alias(name) for name, price in prices.items()),
        volume.alias("volume"),
        F.lit(BACKFILL_SOURCE).alias("source"),
        F.coalesce("failed", first_reason(fields_null(bar, shown))).alias("refused"),
    )
    typed = bars.select("symbol", "position", F.inline(F.array(fields)))
    checks = [(F.col(name).isNull(), f"bad {name}") for name in ["candle_start", *prices, "volume"]]
    return typed.withColumn(REASON, F.coalesce("refused", first_reason(checks))).drop("refused")


def decode_bars(payloads: DataFrame, start: Column, end: Column) -> DataFrame:
    """Good bars that start in [start, end). `position` is the bar's place in its payload."""
    return good_bars(all_bars(payloads), start, end)


def good_bars(bars: DataFrame, start: Column, end: Column) -> DataFrame:
    return starting_in(accepted(bars).drop("datetime"), start, end)


def payload_rejects(payloads: DataFrame) -> DataFrame:
    """Whole payloads whose status is not `ok`, is absent or cannot be read."""
    return backfill_rejects(all_bars(payloads)).filter("position IS NULL").select("symbol", REASON)


def bar_rejects(payloads: DataFrame) -> DataFrame:
    """Bars of good payloads with an unreadable time or number."""
    return backfill_rejects(all_bars(payloads)).filter("position IS NOT NULL").select("symbol", "datetime", REASON)


def backfill_rejects(bars: DataFrame) -> DataFrame:
    """Both of these from one decoding; a whole payload has no `position` and no `datetime`."""
    return rejected(bars).select("symbol", "datetime", "position", REASON)
