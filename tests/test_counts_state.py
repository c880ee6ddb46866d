"""Counts taken while writing, state read as data, and ties within a batch."""

import json
import time

import pytest
from helpers import at, candles, rows, wall
from pyspark.sql import functions as F
from test_hours import scanned
from test_streaming import Landing

from tickbars.functions import instant
from tickbars.plans.backfill import load_backfill
from tickbars.schemas import CANDLES_1M
from tickbars.sources.tables import KeyedTable, MarketTables
from tickbars.streaming.counts import TickCounts
from tickbars.streaming.state import open_windows, operators


def bar(hour, **changes):
    return {"datetime": f"2024-01-01 {hour:02}:00:00", "open": "1", "high": "1", "low": "1", "close": "1", "volume": "5", **changes}


def test_a_load_counts_as_it_lands_and_holds_nothing(spark, tmp_path):
    values = [
        ("A", {"status": "ok", "values": [bar(9), bar(9, volume="7"), bar(10, open="x"), bar(23)]}),
        ("B", {"status": "error"}),
        ("C", {"status": "ok", "values": [bar(11, volume=None)]}),
        ("other", {"status": "ok", "values": [bar(9)]}),
    ]
    payloads = spark.createDataFrame([(s, json.dumps(p)) for s, p in values], "symbol STRING, payload STRING")
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    tables = MarketTables(str(tmp_path))
    for universe in (["A", "B", "C"], spark.createDataFrame([("A",), ("B",), ("C",)], "symbol STRING")):
        result = load_backfill(spark, payloads, tables, universe, as_of=at("2024-01-01 12:00"), run=3)
        assert result.observed == {"accepted": 2, "outside": 1, "refused_bars": 2, "refused_payloads": 1}
        assert {r.symbol: r.loaded_rows for r in result.counts.collect()} == {"A": 2, "B": 0, "C": 0, None: 2}
        assert sorted(rows(result.rejects, "symbol", "reject_reason")) == [("A", "bad open_price"), ("B", "status error"), ("C", "null volume")]
        assert rows(tables.backfill.read(spark), "symbol", "volume") == [("A", 7)]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    nothing = load_backfill(spark, payloads.limit(0), tables, ["A"], as_of=at("2024-01-01 12:00"), run=4)
    assert set(nothing.observed.values()) == {0} and nothing.rejects.collect() == []


def test_a_listener_adds_up_a_streams_ticks(spark, tmp_path):
    landing, counts = Landing(spark, tmp_path), TickCounts()
    landing.land(("A", "00:00:10", 10, 1), ("A", "soon", 10, 1))
    landing.land(("B", "00:00:10", 10, 1), ("B", "00:00:11", 10, None), (None, "00:00:12", 1, 1))
    spark.streams.addListener(counts)
    try:
        landing.run(files_per_batch=1)
        # Listeners hear of a batch a little after it ends.
        until = time.time() + 30
        while sum(counts.totals().values()) < 5 and time.time() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counts)
    assert counts.totals() == {"accepted": 2, "missing event_time": 1, "missing volume": 1, "missing symbol": 1}


def test_state_before_and_after_a_restart(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    landing.land(("A", "00:00:10", 10, 1), ("B", "00:05:20", 5, 1), ("A", "00:04:00", 5, 1), ("A", "00:02:00", 5, 1))
    landing.run()

    def held(batch=None):
        return sorted(rows(open_windows(spark, landing.checkpoint, batch), "symbol", "candle_start", "candle_end"))

    # The watermark is 00:03:20.
    first = [("A", wall("2024-01-01 00:04"), wall("2024-01-01 00:05")), ("B", wall("2024-01-01 00:05"), wall("2024-01-01 00:06"))]
    assert held() == first
    last = operators(spark, landing.checkpoint).first()
    assert last["operatorName"] == "stateStoreSave" and last["numPartitions"] == 4
    landing.run()
    assert held() == first
    landing.land(("A", "00:04:30", 7, 1), ("C", "00:06:10", 1, 1))
    landing.run()
    # The open window of A went on: its candle has both ticks, and the watermark has passed neither it nor B's.
    assert rows(landing.tables.candles.read(spark).filter("symbol = 'A'").orderBy(F.desc("candle_start")).limit(1), "trade_count") == [(2,)]
    assert [s for s, *_ in held()] == ["A", "B", "C"]
    assert held(last["maxBatchId"]) == first


@pytest.mark.parametrize("ordered", [False, True])
def test_a_doubled_key_gives_one_row_in_every_run(spark, tmp_path, ordered):
    held = candles(spark, [("A", "2024-01-01 10:00:00", str(p), str(p), str(p), str(p), v) for p in range(1, 30) for v in (1, 2)])
    found = set()
    for n in range(5 if ordered else 20):
        table = KeyedTable(str(tmp_path / str(n)), CANDLES_1M)
        dealt = held.orderBy(F.rand(n)).repartition(1 + n % 3)
        table.upsert(dealt, 1, 0, order_by=F.col("volume") if ordered else None, files=1)
        assert table.versions(spark).count() == 1
        found |= set(rows(table.read(spark), "close_price", "volume"))
    assert len(found) == 1
    assert not ordered or next(iter(found))[1] == 2


def test_one_symbol_of_many_reads_few_row_groups(spark, tmp_path):
    """Small files hold some symbols each, and know which they don't."""
    table = KeyedTable(str(tmp_path / "c"), CANDLES_1M)
    start = instant(at("2024-01-01 10:00"))
    for part in range(8):
        symbols = spark.range(part, 10_000, 8).select(F.concat(F.lit("S"), F.col("id")).alias("symbol"))
        batch = symbols.select("symbol", start.alias("candle_start"), (start + F.expr("INTERVAL 1 MINUTE")).alias("candle_end"), *(F.lit(1).alias(f"{n}_price") for n in ("open", "high", "low", "close")), F.lit(part).alias("volume"), F.lit(1).alias("trade_count"), F.lit(1).alias("vwap"))
        table.upsert(batch, 1, part, files=1, unique=True)
    one = table.read(spark, start, start).filter("symbol = 'S1234'")
    assert rows(one, "volume") == [(1234 % 8,)]
    # Of eight row groups its own, and seldom another.
    assert scanned(one) in (1250, 2500) and scanned(table.read(spark, start, start)) == 10_000
    assert rows(table.read(spark, start, start).filter("symbol = 'none'")) == []
