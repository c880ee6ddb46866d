"""One query per operator, over the whole `events` table (or what Spark derives from it).

Fixture choices, mirrored by `checks/oracle.py`:
* live candles have an outage from 06:00 to 11:59 every day, so backfill has hours to fill;
* the bars of 05:00 and 08:00 have a twin that starts at half past, where the two coverage rules differ;
* the `*_bounds` queries cut inside the data, at instants on which candles start.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickbars.functions import instant, lookback_start, to_ntz
from tickbars.operators import quality
from tickbars.operators.candles import tick_candles
from tickbars.operators.coverage import HOURLY_COLUMNS, live_hours
from tickbars.operators.filters import in_universe
from tickbars.plans import reports, summary
from tickbars.plans.backfill import land_bars, load_backfill, load_summary, sorted_bars
from tickbars.schemas import BACKFILL_SOURCE, CANDLES_1M
from tickbars.session import use_utc, work_dir
from tickbars.sources import vendor
from tickbars.sources.events import as_ticks, events_as_ticks
from tickbars.sources.tables import MarketTables
from tickbars.sources.ticks import decode_ticks, encode_ticks, landed_messages
from tickbars.sources.trades import decode_envelopes
from tickbars.streaming.candles import start_candles, start_rejects
from tickbars.streaming.counts import METRIC
from tickbars.streaming.state import open_windows

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
DAY = timedelta(days=1)
SYMBOLS = ["click", "error", "purchase", "signup", "view"]
REPORT_SYMBOL = "purchase"
REPORT_FROM = int(datetime(2024, 1, 1, tzinfo=timezone.utc).timestamp())
REPORT_TO = int(AS_OF.timestamp())
FETCH_FROM = datetime(2024, 1, 2, tzinfo=timezone.utc)
FETCH_TO = datetime(2024, 1, 30, tzinfo=timezone.utc)
CORRECTED_FROM = datetime(2024, 1, 16, tzinfo=timezone.utc)
#: In the outage, so bars start here, and a day and ten days before.
OUTAGE_BOUND = datetime(2024, 1, 20, 8, tzinfo=timezone.utc)
LIVE_BOUND = datetime(2024, 1, 20, 14, tzinfo=timezone.utc)


# Fixtures


def _ticks(spark: SparkSession, sf_dir: str, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    return events_as_ticks(use_utc(spark), sf_dir, since, until)


def _without_outage(ticks: DataFrame) -> DataFrame:
    return ticks.filter(~F.hour("event_time").between(6, 11))


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tick_candles(_without_outage(_ticks(spark, sf_dir)))


def _bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars over all ticks."""
    return tick_candles(_ticks(spark, sf_dir), "1 hour").select(*HOURLY_COLUMNS)


def _backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly bars and the half-past twins."""
    half_past = F.hour("candle_start").isin(5, 8)
    shifts = F.when(half_past, F.array(F.lit(0), F.lit(30))).otherwise(F.array(F.lit(0)))
    shift = F.make_dt_interval(mins=F.col("shift"))
    return (
        _bars(spark, sf_dir)
        .withColumn("shift", F.explode(shifts))
        .withColumn("candle_start", F.col("candle_start") + shift)
        .withColumn("candle_end", F.col("candle_end") + shift)
        .drop("shift")
    )


def _last_day(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All live and backfill candles; the window is cut by the operators alone."""
    return _live(spark, sf_dir), _backfill(spark, sf_dir)


# Candles, coverage, summary, reports


def candles_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(tick_candles(_ticks(spark, sf_dir)))


def symbol_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(in_universe(_ticks(spark, sf_dir), ["click", "purchase", "refund"]))


def live_hourly_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(summary.live_hourly_24h(_last_day(spark, sf_dir)[0], instant(AS_OF)))


def backfill_hourly_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the stored table, pruned to the dates of the window."""
    table = _tables(spark, "backfill_hourly_24h").backfill.create(spark)
    table.upsert(_backfill(spark, sf_dir), run=1, batch_id=0, unique=True)
    as_of = instant(AS_OF)
    return to_ntz(summary.backfill_hourly_24h(table.read(spark, lookback_start(as_of), as_of), as_of))


def combined_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(summary.combined_hourly_24h(*_last_day(spark, sf_dir), instant(AS_OF)))


def pair_analysis_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(summary.pair_analysis_24h(*_last_day(spark, sf_dir), instant(AS_OF)))


def pair_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the stored summary."""
    table = _tables(spark, "pair_report").summary.create(spark)
    rows = summary.pair_analysis_24h(*_last_day(spark, sf_dir), instant(AS_OF))
    table.upsert(rows.withColumn("updated_at", instant(AS_OF)), run=1, batch_id=0, unique=True)
    return to_ntz(reports.pair_report(table.read(spark)))


def live_hours_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(live_hours(_live(spark, sf_dir)))


def candlestick_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    live, backfill = _live(spark, sf_dir), _backfill(spark, sf_dir)
    return to_ntz(reports.candlestick_series(live, backfill, REPORT_SYMBOL, REPORT_FROM, REPORT_TO))


def volume_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    live, backfill = _live(spark, sf_dir), _backfill(spark, sf_dir)
    return to_ntz(reports.volume_series(live, backfill, REPORT_SYMBOL, REPORT_FROM, REPORT_TO))


def _numbered(rows: DataFrame) -> DataFrame:
    """With the place of each row of an ordered report, so that the order shows in its values."""
    counted = rows.withColumn("_at", F.monotonically_increasing_id())
    return counted.withColumn("place", F.row_number().over(Window.orderBy("_at"))).drop("_at")


def candlestick_series_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    live, backfill = _live(spark, sf_dir), _backfill(spark, sf_dir)
    since, until = (int(t.timestamp()) for t in (OUTAGE_BOUND - 10 * DAY, OUTAGE_BOUND))
    return to_ntz(_numbered(reports.candlestick_series(live, backfill, REPORT_SYMBOL, since, until)))


def volume_series_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    live, backfill = _live(spark, sf_dir), _backfill(spark, sf_dir)
    since, until = (int(t.timestamp()) for t in (OUTAGE_BOUND - 10 * DAY, OUTAGE_BOUND))
    return to_ntz(_numbered(reports.volume_series(live, backfill, REPORT_SYMBOL, since, until)))


def pair_report_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two symbols have the same change."""
    rows = summary.pair_analysis_24h(*_last_day(spark, sf_dir), instant(AS_OF)).withColumn("updated_at", instant(AS_OF))
    same = F.when(F.col("symbol").isin("view", "click"), F.lit(0).cast("decimal(10,4)")).otherwise(F.col("price_change_pct"))
    return _numbered(reports.pair_report(rows.withColumn("price_change_pct", same))).select("place", "symbol", "price_change_pct")


def symbol_list_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(symbol_list(spark, sf_dir))


def _on_the_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ticks of an hour happen as it begins."""
    return _ticks(spark, sf_dir).withColumn("event_time", F.date_trunc("HOUR", "event_time"))


def tied_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open and close of equal times go by the sequence."""
    return to_ntz(tick_candles(_on_the_hour(spark, sf_dir)))


def live_hourly_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live candles start exactly on both ends of the window."""
    return to_ntz(summary.live_hourly_24h(tick_candles(_on_the_hour(spark, sf_dir)), instant(LIVE_BOUND)))


def summary_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars start exactly on both ends. `signup` opens at zero, and `error` has bars alone, of no length: the table refuses both."""
    error = F.col("symbol") == "error"
    bars = _backfill(spark, sf_dir).withColumns(
        {
            "open_price": F.when(F.col("symbol") == "signup", F.lit(0).cast("decimal(18,6)")).otherwise(F.col("open_price")),
            "candle_end": F.when(error, F.col("candle_start")).otherwise(F.col("candle_end")),
        }
    )
    rows = summary.pair_analysis_24h(_live(spark, sf_dir).filter(~error), bars, instant(OUTAGE_BOUND))
    table = _tables(spark, "summary_bounds").summary.create(spark)
    table.upsert(rows, run=1, batch_id=0, unique=True)
    good = table.read(spark).withColumn(quality.REASON, F.lit("good"))
    return to_ntz(good.unionByName(table.rejects(spark).select(*good.columns)).drop("updated_at"))


def symbol_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.symbol_list(_live(spark, sf_dir), _backfill(spark, sf_dir))


# Codecs and quality


def ticks_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = encode_ticks(_ticks(spark, sf_dir))
    return messages.select(F.col("key").cast("string"), F.col("value").cast("string"), F.col("offset").alias("seq"))


def ticks_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = encode_ticks(_ticks(spark, sf_dir))
    return to_ntz(quality.accepted(quality.check_ticks(decode_ticks(messages))))


def tick_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with volume 0 to 6 are damaged, each value in its own way."""
    ticks = _ticks(spark, sf_dir)
    symbol = F.concat(F.lit('"symbol":"'), "symbol", F.lit('"'))
    event_time = F.concat(F.lit('"event_time":"'), F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"), F.lit('"'))
    price = F.concat(F.lit('"price":'), F.col("price").cast("double").cast("string"))
    volume = F.concat(F.lit('"volume":'), F.col("volume").cast("string"))

    def message(*fields):
        return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))

    epoch_ms = F.concat(F.lit('"event_time":'), F.unix_millis("event_time").cast("string"))
    damaged = {
        0: F.lit("garbage"),
        1: F.lit(None).cast("string"),
        2: message(event_time, price, volume),
        3: message(symbol, event_time, F.lit('"price":"n/a"'), volume),
        4: message(symbol, event_time, price, F.lit('"volume":3.7')),
        5: message(symbol, F.lit('"event_time":"soon"'), price, volume),
        6: message(symbol, epoch_ms, price, volume),
    }
    value = message(symbol, event_time, price, volume)
    for k, text in damaged.items():
        value = F.when(F.col("volume") == k, text).otherwise(value)
    messages = ticks.select(value.cast("binary").alias("value"), F.col("seq").alias("offset"))
    checked = quality.check_ticks(decode_ticks(messages), latest=instant(AS_OF))
    return quality.rejected(checked).select("seq", quality.REASON)


def trade_envelope_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event: an envelope of three trades (the second without volume, the third with a null one) and a ping."""
    millis = F.unix_millis("event_time")
    price = F.col("price").cast("double").cast("string")
    symbol = F.concat(F.lit('{"s":"'), "symbol", F.lit('","t":'))
    first = F.concat(symbol, millis.cast("string"), F.lit(',"p":'), price, F.lit(',"v":'), "volume", F.lit(".7}"))
    second = F.concat(symbol, (millis + 1).cast("string"), F.lit(',"p":"'), price, F.lit('"}'))
    third = F.concat(symbol, (millis + 2).cast("string"), F.lit(',"p":'), price, F.lit(',"v":null}'))
    envelope = F.concat(F.lit('{"type":"trade","data":['), F.concat_ws(",", first, second, third), F.lit("]}"))
    # The ping carries data, which must not become a trade.
    ping = F.concat(F.lit('{"type":"ping","data":['), first, F.lit("]}"))
    messages = _ticks(spark, sf_dir).select(F.explode(F.array(envelope, ping)).alias("value"))
    return to_ntz(quality.accepted(decode_envelopes(messages))).drop("seq")


def envelope_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event one envelope, damaged by its volume: no JSON, data of another kind or null, a trade without price or with a null volume, or a good one."""
    k = F.col("volume") % 6
    symbol = F.concat(F.lit('{"s":"'), "symbol", F.lit('","t":'), F.unix_millis("event_time").cast("string"))

    def trade(rest: str) -> Column:
        return F.concat(F.lit('{"type":"trade","data":['), symbol, F.lit(rest + "}]}"))

    value = (
        F.when(k == 0, F.concat(F.lit("garbage "), "symbol"))
        .when(k == 1, F.lit('{"type":"trade","data":"oops"}'))
        .when(k == 2, trade(',"v":1'))
        .when(k == 3, trade(',"p":1,"v":null'))
        .when(k == 4, F.lit('{"type":"trade","data":null}'))
        .otherwise(trade(',"p":1,"v":1'))
    )
    ticks = decode_envelopes(_ticks(spark, sf_dir).select(value.alias("value")))
    return ticks.groupBy("symbol", F.coalesce(quality.REASON, F.lit("good")).alias("reason")).agg(F.count(F.lit(1)).alias("ticks"))


def compacted_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles without a close where the volume is even, stored twice over and compacted: every refused row is still there."""
    bars = _bars(spark, sf_dir).withColumn("close_price", F.when(F.col("volume") % 2 == 1, F.col("close_price")))
    table = _tables(spark, "compacted_rejects").backfill.create(spark)
    table.upsert(bars.withColumn("position", F.lit(1)), run=1, batch_id=0, order_by=F.col("position"))
    table.upsert(bars, run=2, batch_id=0, unique=True)
    target = table.compact(spark, f"{table.path}-compacted")
    kept = target.read(spark).select("symbol", F.lit("good").alias("reason"))
    refused = target.rejects(spark).select("symbol", F.col(quality.REASON).alias("reason"))
    return kept.unionByName(refused).groupBy("symbol", "reason").agg(F.count(F.lit(1)).alias("bars"))


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vendor payload per symbol and day, so at most 24 bars each, with some damage.

    The 15th failed, the 16th has no status, the bars of the 17th are null and those of the 18th no list. Volumes at 02:00 are
    null, opens at 03:00 and times at 04:00 unreadable, times at 05:00 carry an offset, and a volume of 0 is left out.
    """
    hour = F.hour("candle_start")
    text = F.date_format("candle_start", "yyyy-MM-dd HH:mm:ss")
    bar = F.struct(
        F.when(hour == 4, F.lit("soon")).when(hour == 5, F.concat(text, F.lit("+05:30"))).otherwise(text).alias("datetime"),
        F.when(hour == 3, F.lit("n/a")).otherwise(F.col("open_price").cast("string")).alias("open"),
        *(F.col(f"{n}_price").cast("string").alias(n) for n in ("high", "low", "close")),
        F.when(hour == 2, F.lit("null")).when(F.col("volume") > 0, F.concat(F.col("volume").cast("string"), F.lit(".9"))).alias("volume"),
    )
    day = F.dayofmonth("day")
    status = F.when(day == 15, F.lit("error")).when(day != 16, F.lit("ok")).alias("status")
    return (
        _bars(spark, sf_dir)
        .groupBy("symbol", F.to_date("candle_start").alias("day"))
        .agg(F.array_sort(F.collect_list(bar)).alias("values"))
        .select(
            "symbol",
            F.when(day == 17, F.lit('{"status":"ok","values":null}'))
            .when(day == 18, F.lit('{"status":"ok","values":"none"}'))
            # Nulls aren't written, so those that must be stand as text until here.
            .otherwise(F.replace(F.to_json(F.struct(status, "values")), F.lit('"null"'), F.lit("null")))
            .alias("payload"),
        )
    )


def backfill_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(vendor.decode_bars(_payloads(spark, sf_dir), instant(FETCH_FROM), instant(FETCH_TO)).drop("position"))


def backfill_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = _payloads(spark, sf_dir)
    return vendor.backfill_rejects(vendor.all_bars(payloads)).drop("position")


def backfill_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = vendor.decode_bars(_payloads(spark, sf_dir), instant(FETCH_FROM), instant(FETCH_TO))
    return load_summary(bars, [*SYMBOLS, "refund"])


def backfill_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pass that lands the bars has counted."""
    bars = sorted_bars(vendor.all_bars(_payloads(spark, sf_dir)), instant(FETCH_FROM), instant(FETCH_TO))
    observed = land_bars(bars, work_dir(use_utc(spark), "backfill_load_counts"))
    return spark.createDataFrame(sorted(observed.items()), "kind STRING, found BIGINT")


def table_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles of five hours of the day break one table rule each."""
    hour = F.hour("candle_start")
    rows = tick_candles(_ticks(spark, sf_dir)).select(
        F.when(hour == 3, F.concat("symbol", F.lit("-" * 20))).when(hour != 4, F.col("symbol")).alias("symbol"),
        "candle_start",
        "candle_end",
        "open_price",
        F.when(hour == 5, F.col("high_price") + F.lit(10**12)).otherwise(F.col("high_price")).alias("high_price"),
        "low_price",
        "close_price",
        "volume",
        F.when(hour == 7, F.lit(3 * 10**9)).otherwise(F.col("trade_count")).alias("trade_count"),
        F.when(hour != 6, F.col("vwap")).alias("vwap"),
    )
    rejects = quality.rejected(quality.check_rows(rows, CANDLES_1M))
    return to_ntz(rejects.select("symbol", "candle_start", quality.REASON))


def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks taken for candle rows: minutes with several ticks break the candle key."""
    rows = _ticks(spark, sf_dir).select("symbol", F.date_trunc("MINUTE", "event_time").alias("candle_start"))
    return to_ntz(quality.key_violations(rows, CANDLES_1M.key))


# Keyed tables


def _tables(spark: SparkSession, name: str) -> MarketTables:
    return MarketTables(work_dir(use_utc(spark), name))


def upsert_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live candles, then corrected candles of all hours since the 16th, then that batch again."""
    table = _tables(spark, "upsert_candles").candles.create(spark)
    table.upsert(_live(spark, sf_dir), run=1, batch_id=0, unique=True)
    corrected = (
        tick_candles(_ticks(spark, sf_dir, since=CORRECTED_FROM))
        .withColumn("volume", F.col("volume") + 1)
        .withColumn("close_price", (F.col("close_price") + 1).cast("decimal(18,6)"))
    )
    for _ in range(2):
        table.upsert(corrected, run=1, batch_id=1, unique=True)
    table.upsert(corrected.limit(0), run=1, batch_id=2, unique=True)
    return to_ntz(table.read(spark).drop("updated_at"))


def upsert_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load with every bar twice, the last without source; then a second load of the afternoons."""
    table = _tables(spark, "upsert_backfill").backfill.create(spark)
    bars = _bars(spark, sf_dir)
    twice = bars.withColumn("position", F.explode(F.array(F.lit(1), F.lit(2))))
    first = F.col("position") == 1
    load = twice.withColumn("volume", F.when(first, F.col("volume") * 2).otherwise(F.col("volume"))).withColumn(
        "source", F.when(first, F.lit(BACKFILL_SOURCE))
    )
    table.upsert(load, run=1, batch_id=0, order_by=F.col("position"))
    afternoon = (
        bars.filter(F.hour("candle_start") >= 12)
        .withColumn("volume", F.col("volume") + 5)
        .withColumn("source", F.lit(BACKFILL_SOURCE))
    )
    table.upsert(afternoon, run=2, batch_id=0, unique=True)
    return to_ntz(table.read(spark).drop("updated_at"))


def upsert_pair_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries as of three days. `view` has no data in the newest, the oldest is written last."""
    table = _tables(spark, "upsert_pair_analysis").summary.create(spark)
    for run, as_of in enumerate([CORRECTED_FROM, AS_OF, CORRECTED_FROM - 5 * DAY], start=1):
        ticks = _ticks(spark, sf_dir)
        if as_of == AS_OF:
            ticks = ticks.filter(F.col("symbol") != "view")
        live, bars = tick_candles(_without_outage(ticks)), tick_candles(ticks, "1 hour")
        rows = summary.pair_analysis_24h(live, bars, instant(as_of))
        table.upsert(rows.withColumn("updated_at", instant(as_of)), run, 0, unique=True)
    return to_ntz(table.read(spark))


def upsert_doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of an hour taken for its bar: of several rows with one key in a batch the one with the greatest hash of its content is stored."""
    ticks = _on_the_hour(spark, sf_dir).select(
        "symbol",
        F.col("event_time").alias("candle_start"),
        (F.col("event_time") + F.expr("INTERVAL 1 HOUR")).alias("candle_end"),
        *(F.col("price").alias(f"{n}_price") for n in ("open", "high", "low", "close")),
        "volume",
        F.lit(BACKFILL_SOURCE).alias("source"),
    )
    table = _tables(spark, "upsert_doubled").backfill
    table.upsert(ticks, run=1, batch_id=0)
    stored, again = table.read(spark).drop("updated_at"), _tables(spark, "upsert_doubled").backfill
    # The same rows, dealt otherwise.
    again.upsert(ticks.repartition(7, "volume"), run=1, batch_id=0)
    both = stored.unionByName(again.read(spark).drop("updated_at"))
    return both.groupBy("symbol", F.col("candle_start").cast("timestamp_ntz").alias("candle_start")).agg(
        F.count(F.lit(1)).alias("stored"), F.count_distinct("open_price", "volume").alias("different")
    )


def backfill_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfill job: stored live candles, loaded payloads, refreshed summary as of the 30th."""
    tables = _tables(spark, "backfill_refresh").create(spark)
    tables.candles.upsert(_live(spark, sf_dir), run=1, batch_id=0, unique=True)
    load_backfill(spark, _payloads(spark, sf_dir), tables, SYMBOLS, as_of=FETCH_TO, run=2)
    return to_ntz(tables.summary.read(spark).drop("updated_at"))


def both_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream and the backfill job at once on the same tables, each refreshing the summary; then a last refresh."""
    root = work_dir(spark, "both_writers")
    tables = MarketTables(f"{root}/tables").create(use_utc(spark))
    messages = encode_ticks(_without_outage(_event_stream(spark, sf_dir)))
    stream = start_candles(messages, tables, f"{root}/checkpoint", available_now=True, as_of=FETCH_TO)
    load_backfill(spark, _payloads(spark, sf_dir), tables, SYMBOLS, as_of=FETCH_TO, run=2)
    stream.awaitTermination()
    summary.refresh_summary(spark, tables, run=3, batch_id=0, as_of=FETCH_TO)
    return to_ntz(tables.summary.read(spark).drop("updated_at"))


# Streams


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file(s) as a stream of ticks, whether `events.parquet` is one file or a folder."""
    schema = use_utc(spark).read.parquet(f"{sf_dir}/events.parquet").schema
    return as_ticks(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*"))


def _run(messages: DataFrame, tables: MarketTables, checkpoint: str, **options) -> None:
    start_candles(messages, tables, checkpoint, available_now=True, **options).awaitTermination()


def _stored_candles(spark: SparkSession, tables: MarketTables) -> DataFrame:
    return to_ntz(tables.candles.read(spark).drop("updated_at"))


def stream_candles_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events -> messages -> streamed candles -> stored candles; nothing is late."""
    root = work_dir(spark, "stream_candles_1m")
    tables = MarketTables(f"{root}/tables")
    _run(encode_ticks(_event_stream(spark, sf_dir)), tables, f"{root}/checkpoint", refresh=False)
    return _stored_candles(spark, tables)


def stream_pair_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary that the stream refreshes, with backfill bars already stored."""
    root = work_dir(spark, "stream_pair_analysis")
    tables = MarketTables(f"{root}/tables").create(use_utc(spark))
    tables.backfill.upsert(_backfill(spark, sf_dir), run=1, batch_id=0, unique=True)
    ticks = _without_outage(_event_stream(spark, sf_dir))
    _run(encode_ticks(ticks), tables, f"{root}/checkpoint", as_of=AS_OF)
    return to_ntz(tables.summary.read(spark).drop("updated_at"))


def stream_triggered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream on its own trigger, ended when it has taken all there is."""
    root = work_dir(spark, "stream_triggered")
    tables = MarketTables(f"{root}/tables")
    query = start_candles(encode_ticks(_event_stream(spark, sf_dir)), tables, f"{root}/checkpoint", refresh=False)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return _stored_candles(spark, tables)


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of seven messages one is garbage and one a century ahead: each tick is in a candle or among the refused."""
    root = work_dir(spark, "stream_rejects")
    tables = MarketTables(f"{root}/tables")
    kind = F.col("seq") % 7
    ticks = _event_stream(spark, sf_dir)
    ahead = F.when(kind == 1, F.col("event_time") + F.expr("INTERVAL 100 YEARS")).otherwise(F.col("event_time"))
    messages = encode_ticks(ticks.withColumn("event_time", ahead))
    garbage = F.when(F.col("offset") % 7 == 0, F.lit("garbage").cast("binary")).otherwise(F.col("value").cast("binary"))
    messages = messages.withColumn("value", garbage)
    _run(messages, tables, f"{root}/checkpoint", refresh=False)
    start_rejects(messages, f"{root}/rejects", f"{root}/checkpoint-rejects", available_now=True).awaitTermination()
    counted = tables.candles.read(spark).groupBy("symbol").agg(F.sum("trade_count").alias("ticks"))
    refused = spark.read.parquet(f"{root}/rejects").groupBy("symbol", quality.REASON).agg(F.count(F.lit(1)).alias("ticks"))
    return counted.withColumn(quality.REASON, F.lit("good")).unionByName(refused)


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's own counts of a topic in which one message of five is garbage and one lacks its volume."""
    root = work_dir(spark, "stream_counts")
    kind = F.col("seq") % 5
    ticks = _event_stream(spark, sf_dir)
    messages = encode_ticks(ticks.withColumn("volume", F.when(kind != 1, F.col("volume"))))
    garbage = F.when(F.col("offset") % 5 == 0, F.lit("garbage").cast("binary")).otherwise(F.col("value").cast("binary"))
    query = start_candles(messages.withColumn("value", garbage), MarketTables(f"{root}/tables"), f"{root}/checkpoint", available_now=True, refresh=False)
    query.awaitTermination()
    total: Counter = Counter()
    for progress in query.recentProgress:
        total.update(progress.observedMetrics[METRIC].asDict() if METRIC in progress.observedMetrics else {})
    return spark.createDataFrame([(reason, n) for reason, n in total.items() if n], "outcome STRING, ticks BIGINT")


def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows in the state after the first half of the ticks, and after a restart with the rest."""
    root = work_dir(spark, "stream_open_windows")
    tables, found = MarketTables(f"{root}/tables"), []
    for part, (since, until) in enumerate([(None, CORRECTED_FROM), (CORRECTED_FROM, None)], start=1):
        encode_ticks(_ticks(spark, sf_dir, since, until)).write.mode("append").parquet(f"{root}/messages")
        _run(landed_messages(spark, f"{root}/messages"), tables, f"{root}/checkpoint", refresh=False)
        held = open_windows(spark, f"{root}/checkpoint").drop("state_partition").withColumn("part", F.lit(part))
        # Later batches replace the state's files.
        held.write.parquet(f"{root}/part{part}")
        found.append(spark.read.schema(held.schema).parquet(f"{root}/part{part}"))
    return to_ntz(found[0].unionByName(found[1]))


def _land_and_run(spark: SparkSession, slices: list[DataFrame], name: str) -> DataFrame:
    """Land each slice of ticks as message files and run the stream over it, on one checkpoint."""
    root = work_dir(spark, name)
    tables = MarketTables(f"{root}/tables")
    for ticks in slices:
        encode_ticks(ticks).write.mode("append").parquet(f"{root}/messages")
        _run(landed_messages(spark, f"{root}/messages"), tables, f"{root}/checkpoint", refresh=False)
    return _stored_candles(spark, tables)


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream stopped and restarted every ten days."""
    starts = [AS_OF - n * 10 * DAY for n in (3, 2, 1)]
    bounds = zip([None, *starts[1:]], [*starts[1:], None])
    return _land_and_run(spark, [_ticks(spark, sf_dir, a, b) for a, b in bounds], "stream_restart")


def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks arrive up to 20 days after their time, in five arrival slices of ten days."""
    start, span, longest = datetime(2024, 1, 1, tzinfo=timezone.utc), 10 * DAY, 20 * DAY
    delay_seconds = (F.col("seq") * 7919 % 14400) * 120
    slices = []
    for n in range(5):
        since, until = start + n * span, start + (n + 1) * span
        arrival = F.unix_micros("event_time") + delay_seconds * 1_000_000
        inside = (arrival >= F.unix_micros(instant(since))) & (arrival < F.unix_micros(instant(until)))
        slices.append(_ticks(spark, sf_dir, since - longest, until).filter(inside))
    return _land_and_run(spark, slices, "stream_late_data")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "candles_1m": candles_1m,
    "symbol_filter": symbol_filter,
    "live_hourly_24h": live_hourly_24h,
    "backfill_hourly_24h": backfill_hourly_24h,
    "combined_hourly": combined_hourly,
    "pair_analysis_24h": pair_analysis_24h,
    "pair_report": pair_report,
    "live_hours": live_hours_query,
    "candlestick_series": candlestick_series,
    "volume_series": volume_series,
    "symbol_list": symbol_list,
    "candlestick_series_bounds": candlestick_series_bounds,
    "volume_series_bounds": volume_series_bounds,
    "pair_report_order": pair_report_order,
    "symbol_list_order": symbol_list_order,
    "tied_candles": tied_candles,
    "live_hourly_bounds": live_hourly_bounds,
    "summary_bounds": summary_bounds,
    "ticks_encode": ticks_encode,
    "ticks_decode": ticks_decode,
    "tick_rejects": tick_rejects,
    "trade_envelope_ticks": trade_envelope_ticks,
    "envelope_rejects": envelope_rejects,
    "compacted_rejects": compacted_rejects,
    "backfill_decode": backfill_decode,
    "backfill_rejects": backfill_rejects,
    "backfill_load_summary": backfill_load_summary,
    "table_violations": table_violations,
    "key_violations": key_violations,
    "upsert_candles": upsert_candles,
    "upsert_backfill": upsert_backfill,
    "upsert_pair_analysis": upsert_pair_analysis,
    "backfill_refresh": backfill_refresh,
    "both_writers": both_writers,
    "stream_candles_1m": stream_candles_1m,
    "stream_pair_analysis": stream_pair_analysis,
    "stream_restart": stream_restart,
    "stream_late_data": stream_late_data,
    "stream_triggered": stream_triggered,
    "stream_rejects": stream_rejects,
    "upsert_doubled": upsert_doubled,
    "backfill_load_counts": backfill_load_counts,
    "stream_counts": stream_counts,
    "stream_open_windows": stream_open_windows,
}
