"""The summary from hourly states."""

import shutil
from datetime import timedelta

import pytest
from helpers import at, candles, rows
from test_streaming import Landing

from tickbars.functions import instant
from tickbars.operators.candles import hourly_candles
from tickbars.plans.hours import changed_hours, minutes_of_hours, rebuild_hours, refresh_hours, stored_hourly_24h
from tickbars.plans.summary import live_hourly_24h, pair_analysis_24h, refresh_summary
from tickbars.sources.tables import MarketTables


def minute(symbol, hour, minute, price, volume=1):
    return (symbol, f"2024-01-01 {hour:02}:{minute:02}:00", *[str(price)] * 4, volume)


def scanned(df):
    """Rows that the file scans of a DataFrame gave, after those skipped by statistics."""
    df.collect()
    seen = 0
    waiting = [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            waiting.append(node.plan())
        elif kind == "FileSourceScanExec":
            seen += node.metrics().apply("numOutputRows").value()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return seen


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Two days of 20 symbols, a minute in ten, stored in files of eight hours."""
    tables = MarketTables(str(tmp_path_factory.mktemp("stored")))
    start = at("2024-01-01 00:00")
    batches = []
    for hour in range(0, 48, 8):
        held = [
            (f"S{s}", (start + timedelta(hours=hour + h, minutes=m)).strftime("%Y-%m-%d %H:%M:%S"), *[str(1 + (s * 7 + h * 3 + m) % 9)] * 4, s + m)
            for h in range(8)
            for s in range(20)
            for m in range(0, 60, 10)
        ]
        batches.append(candles(spark, held))
    for n, batch in enumerate(batches):
        tables.candles.upsert(batch, 1, n, files=1)
    rebuild_hours(spark, tables, 1, 0, instant(start), instant(start + timedelta(days=2)))
    return tables


@pytest.fixture
def day(stored, tmp_path):
    shutil.copytree(stored.root, tmp_path / "day")
    return MarketTables(str(tmp_path / "day"))


def same(spark, tables, as_of):
    as_of = instant(at(as_of))
    got = stored_hourly_24h(spark, tables, as_of)
    want = live_hourly_24h(tables.candles.read(spark), as_of)
    return sorted(rows(got)) == sorted(rows(want.select(*got.columns))) and want.count() > 0


@pytest.mark.parametrize("as_of", ["2024-01-02 00:00", "2024-01-02 13:25", "2024-01-02 13:00", "2024-01-01 00:30", "2024-01-02 23:59:59"])
def test_states_and_cut_hours_are_the_window(spark, stored, as_of):
    assert same(spark, stored, as_of)


def test_only_changed_hours_are_read(spark, day):
    """Of 5,760 minutes, a batch in one hour reads those of the files of that time; the summary reads hours, not minutes."""
    batch = candles(spark, [minute("S1", 9, 5, 100), minute("S2", 9, 6, 100)])
    day.candles.upsert(batch, 1, 50, files=1)
    bounds = instant(at("2024-01-01 09:00")), instant(at("2024-01-01 10:00"))
    read = minutes_of_hours(spark, day, changed_hours(batch), [at("2024-01-01 09:00").date()], *bounds)
    assert read.count() == 14
    assert scanned(read) == 960 + 2
    refresh_hours(spark, day, batch, 1, 50)
    assert same(spark, day, "2024-01-02 00:00") and same(spark, day, "2024-01-02 09:07")
    hours = stored_hourly_24h(spark, day, instant(at("2024-01-02 00:00")))
    # 24 hours of 20 symbols and the two made anew, where the minutes are 2,882. 
    assert scanned(hours) <= 24 * 20 + 2
    two = batch.union(candles(spark, [minute("S1", 21, 5, 100)]))
    far = minutes_of_hours(spark, day, changed_hours(two), [at("2024-01-01 09:00").date()], bounds[0], instant(at("2024-01-01 22:00")))
    assert far.count() == 14 + 6


def test_late_and_corrected_minutes_count_once(spark, day):
    for n, row in enumerate([minute("S3", 5, 0, 50, 1000), minute("S3", 5, 0, 40, 7), minute("new", 5, 59, 3, 2)]):
        batch = candles(spark, [row])
        day.candles.upsert(batch, 1, 60 + n)
        # Twice, as a batch that is run again after a failure.
        refresh_hours(spark, day, batch, 1, 60 + n)
        refresh_hours(spark, day, batch, 1, 60 + n)
    assert same(spark, day, "2024-01-01 23:30")
    assert rows(day.hours.read(spark).filter("symbol = 'new'"), "open_price", "volume") == [(3, 2)]


def test_a_writer_that_read_earlier_does_not_win(spark, day):
    """Its state was made from fewer minutes, however late or with however new a run it is written."""
    stale = hourly_candles(day.candles.read(spark)).withColumn("updated_at", instant(at("2024-01-05 00:00")))
    held = stale.collect()
    batch = candles(spark, [minute("S4", 7, 1, 77, 500)])
    day.candles.upsert(batch, 2, 0)
    refresh_hours(spark, day, batch, 2, 0)
    day.hours.upsert(spark.createDataFrame(held, stale.schema), 3, 0)
    assert same(spark, day, "2024-01-01 23:00")


def test_empty_batches_and_tables(spark, tmp_path):
    tables = MarketTables(str(tmp_path / "none"))
    nothing = candles(spark, [minute("A", 1, 1, 1)]).limit(0)
    assert refresh_hours(spark, tables, nothing, 1, 0) == []
    rebuild_hours(spark, tables, 1, 0, instant(at("2024-01-01 00:00")), instant(at("2024-01-02 00:00")))
    refresh_summary(spark, tables, 1, 0, at("2024-01-02 00:00"), from_states=True)
    assert tables.summary.read(spark).collect() == []


def test_stream_with_late_data_and_restarts(spark, tmp_path):
    """After each start the stored summary is that of all stored minutes; another writer's minutes count from the next start on."""
    landing = Landing(spark, tmp_path)
    as_of = "2024-01-01T12:30:00"
    steps = [
        [("A", "00:00:10", 10, 1), ("B", "00:40:00", 4, 1)],
        [("A", "00:39:30", 11, 5), ("B", "00:41:00", 5, 2)],
        [("A", "12:29:00", 20, 1), ("A", "12:31:00", 99, 9), ("C", "11:00:00", 1, 1)],
    ]
    for n, step in enumerate(steps):
        landing.land(*step)
        if n == 2:
            landing.tables.candles.upsert(candles(spark, [minute("D", 3, 0, 6)]), 9, 0)
        landing.run(refresh=True, as_of=as_of)
        tables = landing.tables
        want = pair_analysis_24h(tables.candles.read(spark), tables.backfill.read(spark), instant(at("2024-01-01 12:30")))
        got = tables.summary.read(spark).drop("updated_at")
        assert sorted(rows(got)) == sorted(rows(want.select(*got.columns)))
    assert sorted(rows(got, "symbol", "close_24h")) == [("A", 20), ("B", 5), ("C", 1), ("D", 6)]
