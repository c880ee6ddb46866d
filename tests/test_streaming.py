import json
import os
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from helpers import at, candles, rows, ticks, wall

from tickbars.plans.summary import pair_analysis_24h
from tickbars.functions import instant
from tickbars.operators.candles import tick_candles
from tickbars.sources.tables import MarketTables, RunFiles
from tickbars.sources.ticks import encode_ticks, landed_messages, text_messages
from tickbars.streaming.candles import start_candles, start_rejects, streaming_candles, writer_run
from tickbars.streaming.publish import start_publish


class Landing:
    """A folder of JSON lines and a stream over it; each step runs what has landed since."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, Path(root)
        self.files = self.root / "in"
        self.files.mkdir()
        self.tables = MarketTables(str(self.root / "tables"))
        self.checkpoint = str(self.root / "checkpoint")
        self.count = 0

    def land(self, *items):
        lines = [
            json.dumps({"symbol": s, "event_time": f"2024-01-01T{t}+00:00", "price": p, "volume": v, "source": "s"})
            for s, t, p, v in items
        ]
        path = self.files / f"{self.count:03d}.json"
        path.write_text("\n".join(lines))
        # The source takes files by modification time.
        os.utime(path, (1_704_200_000 + self.count,) * 2)
        self.count += 1

    def run(self, files_per_batch=None, **options):
        messages = text_messages(self.spark, str(self.files), files_per_batch)
        options = {"refresh": False, **options}
        query = start_candles(messages, self.tables, self.checkpoint, available_now=True, **options)
        query.awaitTermination()
        return query

    def emitted(self):
        """Candles per data batch, as (symbol, minute, open, high, low, close, volume, count)."""
        found = {}
        for r in self.tables.candles.versions(self.spark).collect():
            values = (r.open_price, r.high_price, r.low_price, r.close_price, r.volume, r.trade_count)
            found.setdefault(r.batch_id, []).append((r.symbol, r.candle_start.strftime("%H:%M"), *map(int, values)))
        return [sorted(found[b]) for b in sorted(found)]


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def test_trace_of_separate_runs(landing):
    steps = [
        [("A", "00:00:10", 10, 1), ("A", "00:00:50", 12, 1), ("B", "00:00:20", 5, 0)],
        [("A", "00:00:05", 9, 1)],
        [("B", "00:03:30", 6, 1)],
        [("A", "00:00:40", 99, 1), ("A", "00:01:10", 7, 1)],
        [("A", "00:10:00", 1, 1), ("A", "00:02:59", 2, 1)],
        [("A", "soon", 1, 1)],
    ]
    for step in steps:
        landing.land(*step)
        landing.run()
    assert landing.emitted() == [
        [("A", "00:00", 10, 12, 10, 12, 2, 2), ("B", "00:00", 5, 5, 5, 5, 0, 1)],
        [("A", "00:00", 9, 12, 9, 12, 3, 3)],
        [("B", "00:03", 6, 6, 6, 6, 1, 1)],
        [("A", "00:01", 7, 7, 7, 7, 1, 1)],
        [("A", "00:02", 2, 2, 2, 2, 1, 1), ("A", "00:10", 1, 1, 1, 1, 1, 1)],
    ]
    assert sorted(rows(landing.tables.candles.read(landing.spark), "symbol", "candle_start", "trade_count")) == [
        ("A", wall("2024-01-01 00:00"), 3),
        ("A", wall("2024-01-01 00:01"), 1),
        ("A", wall("2024-01-01 00:02"), 1),
        ("A", wall("2024-01-01 00:10"), 1),
        ("B", wall("2024-01-01 00:00"), 1),
        ("B", wall("2024-01-01 00:03"), 1),
    ]


def test_trace_of_batches_in_one_run(landing):
    """The late filter of a batch uses the watermark of the batch before it."""
    for item in [("A", "00:00:10", 10, 1), ("A", "00:05:00", 11, 1), ("A", "00:00:20", 12, 1), ("A", "00:00:30", 13, 1), ("A", "00:05:10", 13, 1)]:
        landing.land(item)
    landing.run(files_per_batch=1)
    assert [[(s, m, o, c, n) for s, m, o, _, _, c, _, n in batch] for batch in landing.emitted()] == [
        [("A", "00:00", 10, 10, 1)],
        [("A", "00:05", 11, 11, 1)],
        [("A", "00:00", 10, 12, 2)],
        [("A", "00:05", 11, 13, 2)],
    ]


def test_replayed_batch_changes_nothing(landing):
    landing.land(("A", "00:00:10", 10, 1), ("B", "00:01:10", 5, 2))
    landing.run()
    before = sorted(rows(landing.tables.candles.read(landing.spark).drop("updated_at")))
    # As after a crash between the write and the commit: the batch was planned but not finished.
    commits = Path(landing.checkpoint) / "commits"
    for f in commits.iterdir():
        f.unlink()
    landing.run()
    assert sorted(rows(landing.tables.candles.read(landing.spark).drop("updated_at"))) == before


def test_restart_keeps_the_run_and_continues_open_windows(landing):
    landing.land(("A", "00:00:10", 10, 1))
    landing.run()
    run = writer_run(landing.spark, landing.checkpoint)
    landing.land(("A", "00:00:20", 12, 1))
    landing.run()
    assert writer_run(landing.spark, landing.checkpoint) == run
    assert rows(landing.tables.candles.read(landing.spark), "open_price", "close_price", "trade_count") == [(10, 12, 2)]


def test_empty_batch_writes_nothing(landing):
    landing.land(("A", "soon", 10, 1))
    landing.run(refresh=True, as_of="2024-01-01T12:00:00")
    assert landing.tables.candles.versions(landing.spark).isEmpty()
    assert landing.tables.summary.versions(landing.spark).isEmpty()


def test_each_batch_refreshes_the_summary(landing, spark):
    landing.tables.create(spark)
    bars = candles(spark, [("A", "2024-01-01 00:00:00", "1", "1", "1", "1", 1), ("C", "2024-01-01 05:00:00", "2", "3", "2", "3", 6)], minutes=60)
    landing.tables.backfill.upsert(bars, 1, 0)
    landing.land(("A", "00:00:10", 10, 1), ("B", "00:01:10", 5, 2))
    landing.land(("A", "00:05:00", 20, 1))
    landing.run(files_per_batch=1, refresh=True, as_of="2024-01-01T12:00:00")
    got = landing.tables.summary.read(spark).drop("updated_at")
    want = pair_analysis_24h(landing.tables.candles.read(spark), landing.tables.backfill.read(spark), instant(at("2024-01-01 12:00")))
    assert sorted(rows(got)) == sorted(rows(want))
    assert sorted(rows(got, "symbol", "open_24h", "close_24h", "total_volume")) == [("A", 10, 20, 2), ("B", 5, 5, 2), ("C", 2, 3, 6)]


def test_a_streams_files_stay_few(landing, spark, monkeypatch):
    monkeypatch.setattr(RunFiles, "LEAST", 2)
    for k in range(9):
        landing.land(("A", f"00:00:{10 + k}", 10 + k, 1), ("B", f"00:01:{10 + k}", 5, 2))
    landing.run(files_per_batch=1, refresh=True, as_of="2024-01-01T12:00:00", merge_every=3, keep_merged=0)
    got = rows(landing.tables.summary.read(spark), "symbol", "close_24h", "total_volume")
    assert sorted(got) == [("A", 18, 9), ("B", 5, 18)]
    for table in (landing.tables.candles, landing.tables.hours, landing.tables.summary):
        # Merged at batches 0, 3 and 6: the merged file of batch 6, those it came from, and two more batches.
        assert len(list(Path(table.path).rglob("*.parquet"))) <= 7
    landing.land(("A", "00:08:30", 50, 1))
    landing.run(refresh=True, as_of="2024-01-01T12:00:00", merge_every=3)
    assert sorted(rows(landing.tables.summary.read(spark), "symbol", "close_24h", "total_volume")) == [("A", 50, 10), ("B", 5, 18)]


def test_future_time_does_not_close_the_stream(landing, spark):
    """A time in milliseconds read as seconds lies in a far year; it must not move the watermark."""
    good = {"symbol": "A", "event_time": "2024-01-01T00:00:10Z", "price": 1, "volume": 1}
    far = {**good, "event_time": 1704067205123}
    (landing.files / "000.json").write_text(json.dumps(far))
    landing.run()
    (landing.files / "001.json").write_text(json.dumps(good))
    landing.run()
    assert landing.tables.candles.read(spark).count() == 1
    out = str(landing.root / "rejects")
    start_rejects(text_messages(spark, str(landing.files)), out, str(landing.root / "c2"), available_now=True).awaitTermination()
    assert [r.reject_reason for r in spark.read.parquet(out).select("reject_reason").collect()] == ["event_time out of range"]


def test_every_tick_is_either_counted_or_refused(landing, spark):
    """The tolerance counts from the file's time, so both queries draw the line at one place, whenever they run."""
    start = datetime.fromtimestamp(1_704_200_000, timezone.utc)
    edges = {name: (start + timedelta(minutes=10, seconds=s)).isoformat() for name, s in (("at", 0), ("past", 1))}
    lines = [json.dumps({"symbol": name, "event_time": t, "price": 1, "volume": 1}) for name, t in edges.items()]
    path = landing.files / "000.json"
    path.write_text("\n".join(lines))
    os.utime(path, (1_704_200_000,) * 2)
    landing.run()
    out = str(landing.root / "rejects")
    start_rejects(text_messages(spark, str(landing.files)), out, str(landing.root / "c2"), available_now=True).awaitTermination()
    assert [r.symbol for r in landing.tables.candles.read(spark).collect()] == ["at"]
    assert [r.symbol for r in spark.read.parquet(out).collect()] == ["past"]


def test_state_is_dropped_behind_the_watermark(landing):
    landing.land(("A", "00:00:10", 10, 1), ("B", "00:00:20", 5, 1))
    landing.run()
    landing.land(("A", "01:00:00", 10, 1))
    query = landing.run()
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 1


def test_state_width_belongs_to_the_stream_alone(landing, spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    landing.land(("A", "00:00:10", 10, 1))
    query = landing.run(state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before != "3"
    assert query.recentProgress[0]["stateOperators"][0]["numShufflePartitions"] == 3


def test_batch_and_stream_agree(spark, tmp_path):
    source = ticks(spark, [("A", "2024-01-01 00:00:05", "1", 3, 2), ("A", "2024-01-01 00:00:05", "2", 1, 1), ("B", "2024-01-01 00:01:05", "4", 0, 3)])
    encode_ticks(source).write.parquet(str(tmp_path / "in"))
    tables = MarketTables(str(tmp_path / "tables"))
    start_candles(landed_messages(spark, str(tmp_path / "in")), tables, str(tmp_path / "c"), available_now=True, refresh=False).awaitTermination()
    want = tick_candles(source)
    assert sorted(rows(tables.candles.read(spark), *want.columns)) == sorted(rows(want))


def test_streaming_plan_has_no_python_and_no_sort(spark, tmp_path, plan):
    (tmp_path / "in").mkdir()
    text = plan(streaming_candles(text_messages(spark, str(tmp_path / "in"))))
    assert "Python" not in text and "SortAggregate" not in text


def test_publish_then_stream(spark, tmp_path):
    (tmp_path / "envelopes").mkdir()
    trade = {"type": "trade", "data": [{"s": "A", "t": 1704067205123, "p": 1.25, "v": 12.7}, {"s": "Z", "t": 1704067205123, "p": 1, "v": 1}]}
    (tmp_path / "envelopes" / "a.json").write_text(json.dumps(trade) + "\n" + json.dumps({"type": "ping"}))
    envelopes = text_messages(spark, str(tmp_path / "envelopes"))
    start_publish(envelopes, str(tmp_path / "c1"), path=str(tmp_path / "topic"), symbols=["A"], available_now=True).awaitTermination()
    tables = MarketTables(str(tmp_path / "tables"))
    start_candles(landed_messages(spark, str(tmp_path / "topic")), tables, str(tmp_path / "c2"), available_now=True, refresh=False).awaitTermination()
    assert rows(tables.candles.read(spark), "symbol", "candle_start", "close_price", "volume") == [("A", wall("2024-01-01 00:00"), 1.25, 12)]
