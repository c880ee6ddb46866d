"""Every registered query against its SQL on the driver tables."""

import pytest

import __spark_entry__
from checks import queries
from checks.parity import differences
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, SF_DIR, name) == []


@pytest.mark.parametrize("name", ["upsert_pair_analysis", "backfill_refresh", "stream_pair_analysis"])
def test_the_window_is_not_cut_before_the_operator(spark, monkeypatch, name):
    bounds, read = [], queries.events_as_ticks

    def events_as_ticks(spark, sf_dir, since=None, until=None):
        bounds.append((since, until))
        return read(spark, sf_dir, since, until)

    monkeypatch.setattr(queries, "events_as_ticks", events_as_ticks)
    QUERIES[name](spark, "/root/testdata/sf0.001")
    assert bounds and set(bounds) == {(None, None)}


def test_every_query_of_the_engine_has_sql():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(QUERIES) <= set(__spark_entry__.oracle_sql())


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() == 1000
    assert df.columns[:3] == ["symbol", "candle_start", "candle_end"]
