"""Plans that must hold at scale."""

import pytest

from checks.queries import AS_OF, QUERIES, _backfill, _live, combined_hourly, ticks_decode
from tickbars.functions import instant, lookback_start
from tickbars.plans.summary import pair_analysis_24h
from tickbars.sources.tables import MarketTables

SF_DIR = "/root/testdata/sf0.01"
LAZY = [n for n in sorted(QUERIES) if not n.startswith(("stream_", "upsert_", "backfill_refresh"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, plan, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "CollectLimit"):
        assert bad not in text


def test_candles_are_hash_aggregated_before_the_shuffle(spark, plan):
    text = plan(QUERIES["candles_1m"](spark, SF_DIR)).split("== Physical Plan ==")[1]
    assert "SortAggregate" not in text and "partial_min_by" in text
    assert text.count("Exchange") == 1


def test_summary_scans_only_its_day(spark, plan, tmp_path):
    """As the jobs read it: both tables from the first date of the window on."""
    as_of = instant(AS_OF)
    tables = MarketTables(str(tmp_path)).create(spark)
    tables.candles.upsert(_live(spark, SF_DIR), run=1, batch_id=0)
    tables.backfill.upsert(_backfill(spark, SF_DIR), run=1, batch_id=0)
    live, bars = (t.read(spark, lookback_start(as_of), as_of) for t in (tables.candles, tables.backfill))
    text = plan(pair_analysis_24h(live, bars, as_of)).split("== Physical Plan ==")[1]
    assert text.count("GreaterThanOrEqual(candle_start,2024-01-30 00:00:00.0)") == text.count("FileScan") > 0
    assert "partial_bit_or(" in text


def test_coverage_side_reads_keys_only(spark, plan):
    text = plan(combined_hourly(spark, SF_DIR)).split("== Physical Plan ==")[1]
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text


def test_messages_are_parsed_once(spark, plan):
    text = plan(ticks_decode(spark, SF_DIR)).split("== Physical Plan ==")[1]
    assert text.count("from_json(") == 1


def test_report_filter_reaches_the_scan(spark, plan):
    text = plan(QUERIES["volume_series"](spark, SF_DIR)).split("== Physical Plan ==")[1]
    # One scan of each table, and one of the live minutes' keys.
    assert text.count("EqualTo(event_type,purchase)") == text.count("FileScan") == 3


@pytest.mark.parametrize("name", ["candlestick_series", "volume_series", "combined_hourly"])
def test_coverage_is_a_mask(spark, plan, name):
    text = plan(QUERIES[name](spark, SF_DIR)).split("== Physical Plan ==")[1]
    assert "Window" not in text and "LeftAnti" not in text
    assert "partial_bit_or(" in text
