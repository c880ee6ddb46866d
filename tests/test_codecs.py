import json

import pytest
from helpers import at, rows, ticks, wall
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tickbars.functions import instant
from tickbars.operators.quality import accepted, check_ticks, rejected
from tickbars.plans.backfill import load_summary
from tickbars.sources.ticks import decode_ticks, encode_ticks, topic_columns, topic_messages, topic_options
from tickbars.sources.trades import decode_envelopes
from tickbars.sources.vendor import bar_rejects, decode_bars, landed_payloads, payload_rejects
from tickbars.streaming.candles import checked_ticks
from tickbars.streaming.publish import sink_options


def messages(spark, values):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value STRING, offset BIGINT")
    return df.withColumn("value", F.col("value").cast("binary"))


def tick(**changes):
    base = {"symbol": "A", "event_time": "2024-01-01T00:00:05.123000+00:00", "price": 1.5, "volume": 2, "source": "s"}
    return json.dumps({k: v for k, v in {**base, **changes}.items() if v != "drop"})


def reasons(spark, *values):
    checked = check_ticks(decode_ticks(messages(spark, values)), latest=instant("2024-01-02T00:00:00"))
    return [r.reject_reason for r in checked.orderBy("seq").select("reject_reason").collect()]


def test_time_text_forms(spark):
    forms = ["2024-01-01T00:00:05.123000+00:00", "2024-01-01T00:00:05+00:00", "2024-01-01T00:00:05Z", "2024-01-01T05:30:05+05:30"]
    got = decode_ticks(messages(spark, [tick(event_time=f) for f in forms])).orderBy("seq")
    assert rows(got, "event_time") == [(wall("2024-01-01 00:00:05.123"),)] + [(wall("2024-01-01 00:00:05"),)] * 3


def test_bad_messages_are_rejected_with_a_reason(spark):
    assert reasons(
        spark,
        tick(),
        "garbage",
        None,
        "[1, 2]",
        tick(symbol="drop"),
        tick(event_time="soon"),
        tick(event_time=1704067205123),
        tick(price="n/a"),
        tick(price=1e13),
        tick(volume=3.7),
        tick(volume=None),
        tick(source="drop"),
    ) == [
        None,
        "undecodable",
        "undecodable",
        "undecodable",
        "missing symbol",
        "missing event_time",
        "event_time out of range",
        "missing price",
        "missing price",
        "missing volume",
        "missing volume",
        None,
    ]


def test_missing_source_gets_the_default(spark):
    assert rows(decode_ticks(messages(spark, [tick(source="drop")])), "source") == [("finnhub",)]


def test_encode_then_decode_is_identity(spark):
    source = ticks(spark, [("A", "2024-01-01 00:00:05.123456", "0.000001", 5, 1), ("B é\"", "2024-01-01 00:00:06", "999999.25", 0, 2)])
    back = accepted(check_ticks(decode_ticks(encode_ticks(source)))).drop("source").select(*source.columns)
    assert sorted(rows(back)) == sorted(rows(source))
    assert [bytes(r.key).decode() for r in encode_ticks(source).orderBy("offset").collect()] == ["A", 'B é"']


def test_envelopes(spark):
    values = [
        json.dumps({"type": "ping"}),
        json.dumps({"type": "trade"}),
        json.dumps({"data": [{"s": "A", "t": 1, "p": 1, "v": 1}]}),
        "garbage",
        json.dumps(
            {
                "type": "trade",
                "data": [
                    {"s": "A", "t": 1704067205123, "p": 1.25, "v": 12.7},
                    {"s": "A", "t": 1704067205124, "p": "2.5", "v": -12.7},
                    {"s": "B", "t": 1704067205125, "p": 3},
                    {"s": "C", "t": 1704067205125, "v": 1},
                    {"s": "D", "t": 1704067205125, "p": 1, "v": "many"},
                    {"s": "E", "t": 1704067205125, "p": 1, "v": None},
                    {"s": None, "t": 1704067205125, "p": 1, "v": 1},
                    {"s": "F", "t": None, "p": None, "v": 1},
                    {"s": "G", "t": "1704067205125", "p": 1, "v": 1},
                    {"s": "H", "t": 10**30, "p": 1, "v": 1},
                    None,
                    {"s": "I", "t": 1704067205125.25, "p": [1], "v": 1},
                    {"s": "J", "t": 1704067205125.25, "p": 1, "v": 1},
                ],
            }
        ),
    ]
    decoded = decode_envelopes(messages(spark, values))
    assert rows(accepted(decoded), "symbol", "event_time", "price", "volume", "source") == [
        ("A", wall("2024-01-01 00:00:05.123"), 1.25, 12, "finnhub"),
        ("A", wall("2024-01-01 00:00:05.124"), 2.5, -12, "finnhub"),
        ("B", wall("2024-01-01 00:00:05.125"), 3, 0, "finnhub"),
        ("J", wall("2024-01-01 00:00:05.125250"), 1, 1, "finnhub"),
    ]
    assert rows(rejected(decoded), "symbol", "reject_reason") == [
        (None, "undecodable"),
        ("C", "missing price"),
        ("D", "missing volume"),
        ("E", "null volume"),
        (None, "null symbol"),
        ("F", "null event_time"),
        ("G", "missing event_time"),
        ("H", "missing event_time"),
        (None, "missing symbol"),
        ("I", "missing price"),
    ]
    assert rows(accepted(decoded), "seq") == [(4_000_000,), (4_000_001,), (4_000_002,), (4_000_012,)]


def test_messages_are_read_once_as_variants(spark, plan):
    texts = plan(decode_envelopes(messages(spark, ["x"]))), plan(day_bars(payloads(spark, ("A", {"status": "ok"}))))
    for text in texts:
        physical = text.split("== Physical Plan ==")[1]
        assert physical.count("parseJson(") == 1 and "from_json" not in physical


def test_data_of_another_kind_is_refused(spark):
    values = ['{"type":"trade","data":"oops"}', '{"type":"trade","data":null}', '{"type":"trade","data":[]}', "null", None]
    decoded = decode_envelopes(messages(spark, values))
    assert sorted(rows(decoded, "reject_reason")) == [("null data",), ("undecodable",), ("undecodable",), ("unreadable data",)]


def bar(start, volume="12.7", **changes):
    full = {"datetime": start, "open": "1.5", "high": "2.0000005", "low": "1", "close": "1.25", "volume": volume, **changes}
    return {k: v for k, v in full.items() if v is not None}


def payloads(spark, *items):
    return spark.createDataFrame([(s, json.dumps(p)) for s, p in items], "symbol STRING, payload STRING")


def day_bars(source):
    return decode_bars(source, instant(at("2024-01-01 00:00")), instant(at("2024-01-02 00:00")))


def test_vendor_bars(spark):
    source = payloads(
        spark,
        (
            "A",
            {
                "status": "ok",
                "values": [
                    bar("2024-01-01 10:00:00"),
                    bar("2024-01-01T11:00:00+05:30", volume="-12.7"),
                    bar("2024-01-01", volume=None),
                    bar("2024-01-02 00:00:00"),
                    bar("2023-12-31 23:00:00"),
                    bar("soon"),
                    bar("2024-01-01 13:00:00", open="n/a"),
                    bar("2024-01-01 14:00:00", close=None),
                ],
            },
        ),
        ("B", {"status": "error", "values": [bar("2024-01-01 10:00:00")]}),
        ("C", {"values": [bar("2024-01-01 10:00:00")]}),
        ("D", {"status": "ok"}),
    )
    got = day_bars(source)
    assert sorted(rows(got, "symbol", "candle_start", "candle_end", "high_price", "volume", "source")) == [
        ("A", wall("2024-01-01 00:00"), wall("2024-01-01 01:00"), 2.000001, 0, "twelve_data"),
        ("A", wall("2024-01-01 10:00"), wall("2024-01-01 11:00"), 2.000001, 12, "twelve_data"),
        ("A", wall("2024-01-01 11:00"), wall("2024-01-01 12:00"), 2.000001, -12, "twelve_data"),
    ]
    assert rows(payload_rejects(source)) == [("B", "status error"), ("C", "status missing")]
    assert rows(bar_rejects(source)) == [
        ("A", "soon", "bad candle_start"),
        ("A", "2024-01-01 13:00:00", "bad open_price"),
        ("A", "2024-01-01 14:00:00", "bad close_price"),
    ]
    counts = {r.symbol: r.loaded_rows for r in load_summary(got, ["A", "B", "C", "D"]).collect()}
    assert counts == {"A": 3, "B": 0, "C": 0, "D": 0, None: 3}


def test_a_null_is_no_missing_field(spark):
    """Python's `get` gives the default for a missing field alone."""
    nulls = [{**bar(f"2024-01-01 {10 + i}:00:00"), name: None} for i, name in enumerate(("volume", "open", "close", "datetime"))]
    source = payloads(
        spark,
        ("A", {"status": "ok", "values": [bar("2024-01-01 09:00:00", volume=None), *nulls, None]}),
        ("B", {"status": "ok", "values": None}),
        ("C", {"status": "ok", "values": {"datetime": "x"}}),
        ("D", {"status": None}),
    )
    assert rows(day_bars(source), "symbol", "volume") == [("A", 0)]
    assert rows(bar_rejects(source), "reject_reason") == [("null volume",), ("null open_price",), ("null close_price",), ("null candle_start",), ("bad candle_start",)]
    assert rows(payload_rejects(source)) == [("B", "null values"), ("C", "unreadable values"), ("D", "status missing")]


def test_payload_files_take_the_symbol_from_the_path(spark, tmp_path):
    for symbol in ("A", "B"):
        folder = tmp_path / f"symbol={symbol}"
        folder.mkdir()
        (folder / "one.json").write_text(json.dumps({"status": "ok", "values": [bar("2024-01-01 10:00:00")]}, indent=1))
    got = day_bars(landed_payloads(spark, str(tmp_path)))
    assert sorted(rows(got, "symbol", "volume")) == [("A", 12), ("B", 12)]


def test_topic_options_and_columns(spark):
    """The connector's own names, and records of the schema that it gives, without a broker."""
    assert topic_options("host:9092") == {"kafka.bootstrap.servers": "host:9092", "subscribe": "market_ticks", "startingOffsets": "latest"}
    assert topic_options("h", "t", "earliest", 10)["maxOffsetsPerTrigger"] == "10"
    assert sink_options("host:9092") == {"kafka.bootstrap.servers": "host:9092", "topic": "market_ticks"}
    sent = encode_ticks(ticks(spark, [("A", "2024-01-01 00:00:05", "1.5", 3, 8)]))
    # A sink takes a key and a value, both binary or text.
    assert {sent.schema[name].dataType.simpleString() for name in ("key", "value")} == {"binary"}
    records = sent.select("key", "value", F.lit("market_ticks").alias("topic"), F.lit(0).alias("partition"), "offset", F.to_timestamp(F.lit("2024-01-01 00:00:06")).alias("timestamp"), F.lit(0).alias("timestampType"))
    got = checked_ticks(topic_columns(records))
    assert rows(got, "symbol", "price", "volume", "seq", "reject_reason") == [("A", 1.5, 3, 8, None)]
    late = checked_ticks(topic_columns(records.withColumn("timestamp", F.to_timestamp(F.lit("2023-12-31 23:00:00")))))
    assert rows(late, "reject_reason") == [("event_time out of range",)]


def test_topic_source_asks_for_kafka(spark):
    """The connector is not installed here; the reader must get as far as looking for it."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        topic_messages(spark, "host:9092", max_per_batch=10)
