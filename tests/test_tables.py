from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from helpers import at, candles, rows, wall
from pyspark.sql import functions as F

from tickbars.functions import instant
from tickbars.operators.quality import check_rows, key_violations, rejected
from tickbars.schemas import CANDLES_1H_BACKFILL, CANDLES_1M, PAIR_ANALYSIS_24H
from tickbars.sources.tables import KeyedTable, MarketTables, RunFiles

DAY1, DAY2 = "2024-01-01 10:00:00", "2024-01-02 10:00:00"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(str(tmp_path / "candles"), CANDLES_1M).create(spark)


def one(spark, start=DAY1, price="1", volume=1, symbol="A"):
    return candles(spark, [(symbol, start, price, price, price, price, volume)])


def state(table, spark):
    return sorted(rows(table.read(spark), "symbol", "candle_start", "close_price", "volume"))


def test_insert_replace_and_keep(spark, table):
    assert state(table, spark) == []
    table.upsert(one(spark).union(one(spark, DAY2)), 1, 0)
    table.upsert(one(spark, price="5", volume=9), 1, 1)
    assert state(table, spark) == [("A", wall(DAY1), 5, 9), ("A", wall(DAY2), 1, 1)]
    assert table.read(spark).filter("updated_at IS NULL").isEmpty()


def test_replay_and_empty_batch_change_nothing(spark, table):
    table.upsert(one(spark, price="5"), 1, 0)
    before = state(table, spark)
    table.upsert(one(spark, price="5"), 1, 0)
    table.upsert(one(spark).limit(0), 1, 1)
    assert state(table, spark) == before


def test_a_rewritten_batch_replaces_whole_rows(spark, table):
    table.upsert(one(spark, price="5", volume=9), 1, 0)
    table.upsert(one(spark, price="4", volume=10), 1, 0)
    assert state(table, spark) == [("A", wall(DAY1), 4, 10)]


def test_later_run_wins_over_more_batches(spark, table):
    table.upsert(one(spark, price="1"), 1, 99)
    table.upsert(one(spark, price="2"), 2, 0)
    assert state(table, spark)[0][2] == 2


def test_last_duplicate_wins(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "b"), CANDLES_1H_BACKFILL).create(spark)
    twice = one(spark, volume=1).withColumn("position", F.lit(1)).union(one(spark, volume=2).withColumn("position", F.lit(2)))
    bad = one(spark, volume=3).withColumn("position", F.lit(3)).withColumn("open_price", F.lit(None).cast("decimal(18,6)"))
    table.upsert(twice.union(bad), 1, 0, order_by=F.col("position"))
    assert rows(table.read(spark), "volume", "source") == [(2, "finnhub")]
    assert rows(table.rejects(spark), "volume", "reject_reason") == [(3, "open_price is null")]


def test_refused_rows_are_all_kept(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "b"), CANDLES_1H_BACKFILL).create(spark)
    bad = one(spark).withColumn("symbol", F.lit(None).cast("string"))
    several = bad.union(bad).union(bad).withColumn("position", F.lit(1))
    table.upsert(several, 1, 0, order_by=F.col("position"))
    assert table.rejects(spark).count() == 3
    target = table.compact(spark, str(tmp_path / "new"))
    assert rows(target.rejects(spark), "reject_reason") == [("symbol is null",)] * 3


def test_two_writers_at_once(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "c"), CANDLES_1M).create(spark)

    def write(run):
        for batch in range(15):
            table.upsert(one(spark, symbol=f"S{run}-{batch}"), run, batch)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, (1, 2)))
    assert table.read(spark).count() == 30


def test_newer_summary_wins_whatever_the_run(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "s"), PAIR_ANALYSIS_24H).create(spark)
    names = PAIR_ANALYSIS_24H.columns.fieldNames()
    base = spark.range(1).select(
        *(F.lit("A" if n == "symbol" else ("2024-01-01" if n.startswith("window") else "1")).alias(n) for n in names[:-1])
    )
    for run, updated, price in ((5, "2024-01-03", "3"), (9, "2024-01-02", "2"), (4, "2024-01-04", "4")):
        table.upsert(base.withColumn("avg_price", F.lit(price)).withColumn("updated_at", instant(updated)), run, 0)
    assert rows(table.read(spark), "avg_price") == [(4,)]


def test_reads_are_pruned_by_date_and_pushed_down(spark, table, plan):
    table.upsert(one(spark).union(one(spark, DAY2)), 1, 0)
    df = table.read(spark, since=instant(at("2024-01-02 00:00")), until=instant(at(DAY2))).filter("symbol = 'A'")
    assert rows(df, "candle_start") == [(wall(DAY2),)]
    text = plan(df)
    assert "candle_date" in text.split("PartitionFilters:")[1].split("PushedFilters")[0]
    pushed = text.split("PushedFilters:")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(candle_start" in pushed and "EqualTo(symbol,A)" in pushed
    # Fixed-width buffers only: versions are merged without sorting.
    assert "SortAggregate" not in text


def test_compacted_table_gives_way_to_later_batches(spark, table, tmp_path):
    table.upsert(one(spark, price="1").union(one(spark, DAY2)), 7, 3)
    table.upsert(one(spark, price="2"), 7, 4)
    target = table.compact(spark, str(tmp_path / "new"))
    assert state(target, spark) == state(table, spark)
    assert target.versions(spark).count() == 2
    target.upsert(one(spark, price="2"), 7, 4)
    assert state(target, spark) == state(table, spark)
    target.upsert(one(spark, price="3"), 7, 5)
    assert state(target, spark)[0][2] == 3


def test_a_large_date_is_not_forced_into_one_file(spark, table):
    many = spark.range(20000).select(
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("symbol"),
        instant(at(DAY1)).alias("candle_start"),
        instant(at(DAY1)).alias("candle_end"),
        *(F.rand(7).alias(f"{n}_price") for n in ("open", "high", "low", "close")),
        F.lit(1).alias("volume"),
        F.lit(1).alias("trade_count"),
        F.rand(8).alias("vwap"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        table.upsert(many, 1, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert table.read(spark).count() == 20000
    assert table.versions(spark).select(F.input_file_name()).distinct().count() > 1


def test_table_rules(spark):
    good = one(spark)
    bad = [
        good.withColumn("symbol", F.lit("x" * 21)),
        good.withColumn("symbol", F.lit(None).cast("string")),
        good.withColumn("trade_count", F.lit(3_000_000_000)),
        good.withColumn("vwap", F.lit("1e12")),
        good.withColumn("vwap", F.lit(None).cast("double")),
        good.withColumn("candle_start", F.lit("soon")),
    ]
    got = [rejected(check_rows(df, CANDLES_1M)).first().reject_reason for df in bad]
    assert got == [
        "symbol longer than 20",
        "symbol is null",
        "trade_count out of range",
        "vwap out of range",
        "vwap is null",
        "candle_start out of range",
    ]
    assert rejected(check_rows(good, CANDLES_1M)).isEmpty()
    assert rejected(check_rows(good.withColumn("source", F.lit("s" * 31)), CANDLES_1H_BACKFILL)).count() == 1


def test_rounding_to_the_column_scale(spark):
    df = spark.createDataFrame([("2.0000005", "-0.00005")], "p STRING, c STRING")
    assert rows(df.select(F.col("p").cast("decimal(18,6)"), F.col("c").cast("decimal(10,4)"))) == [(2.000001, -0.0001)]


def test_key_violations(spark):
    df = one(spark).union(one(spark)).union(one(spark, DAY2))
    assert rows(key_violations(df, CANDLES_1M.key)) == [("A", wall(DAY1), 2)]


def test_views_serve_plain_sql(spark, tmp_path):
    tables = MarketTables(str(tmp_path)).create(spark)
    tables.candles.upsert(one(spark), 1, 0)
    tables.register_views(spark)
    got = spark.sql("SELECT symbol, close_price FROM candles_1m WHERE symbol = :s", args={"s": "A"})
    assert rows(got) == [("A", 1)]
    assert spark.sql("SELECT * FROM pair_analysis_24h ORDER BY price_change_pct DESC").count() == 0


def data_files(table):
    return [str(f) for f in Path(table.path).rglob("*.parquet")]


def test_merging_a_writers_files_changes_no_row(spark, table):
    refused = one(spark, symbol="bad").withColumn("vwap", F.lit(None).cast("double"))
    table.upsert(one(spark, symbol="other", price="7"), 2, 0)
    table.upsert(one(spark, symbol="stale", start=DAY2), 1, 0)
    for batch in range(1, RunFiles.LEAST + 1):
        table.upsert(one(spark, price=str(batch)).union(refused) if batch < 3 else one(spark, price=str(batch)), 1, batch)
    before, rejects = state(table, spark), table.rejects(spark).count()
    files = RunFiles(table, 1, keep=0)
    listed = table.read(spark)
    assert files.merge(spark) == RunFiles.LEAST
    # The merged files stay until a later merge, for readers that know only them.
    assert listed.count() == 3 and state(table, spark) == before
    held = len(data_files(table))
    assert files.merge(spark) == 0
    assert state(table, spark) == before and table.rejects(spark).count() == rejects == 2
    # One file each of the merged day, the other day and the other writer, and two of refused rows.
    assert len(data_files(table)) == 5 < held
    table.upsert(one(spark, price="99"), 1, 50)
    assert state(table, spark)[0][2] == 99


def test_a_writer_that_died_after_merging_goes_on(spark, table):
    for batch in range(RunFiles.LEAST):
        table.upsert(one(spark, price=str(batch + 1)), 1, batch)
    before = state(table, spark)
    RunFiles(table, 1, keep=0).merge(spark)
    again = RunFiles(table, 1, keep=0)
    again.merge(spark)
    again.merge(spark)
    assert state(table, spark) == before and len(data_files(table)) == 1


def test_merged_files_stay_for_long_readers(spark, table, monkeypatch):
    """Each merge finds new files only, and deletes by age."""
    now = [1000.0]
    monkeypatch.setattr("time.monotonic", lambda: now[0])
    monkeypatch.setattr(RunFiles, "LEAST", 2)
    files = RunFiles(table, 1, keep=60)
    table.upsert(one(spark, price="1"), 1, 0)
    table.upsert(one(spark, price="2"), 1, 1)
    assert files.merge(spark) == 2
    listed = table.read(spark)
    for batch in (2, 3):
        now[0] += 30
        table.upsert(one(spark, price=str(batch + 1)), 1, batch)
        files.wrote([at(DAY1).date()])
        # The merged file is one of those to merge next.
        assert files.merge(spark) == 2
    # At 60 s the first two are gone; those of the merges since are there.
    assert len(data_files(table)) == 2 + 1 + 2
    assert state(table, spark) == [("A", wall(DAY1), 4, 1)]
    with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_EXIST|FileNotFound"):
        listed.count()


def test_a_read_lists_its_own_dates(spark, tmp_path, plan):
    """Folders and files that a window needs don't grow with the table's other dates."""
    table = KeyedTable(str(tmp_path / "c x"), CANDLES_1M)
    bounds = instant(at("2024-01-02 00:00")), instant(at("2024-01-03 00:00"))
    assert table.folders(spark) == [] and table.read(spark, *bounds).collect() == []
    listed = []
    for run, days in enumerate((range(1, 4), range(4, 29)), start=1):
        starts = [candles(spark, [("A", f"2024-01-{d:02} 10:00:00", "1", "1", "1", "1", d)]) for d in days]
        batch = starts[0]
        for more in starts[1:]:
            batch = batch.union(more)
        refused = batch.withColumn("vwap", F.lit(None).cast("double"))
        table.upsert(batch.coalesce(1), 1, run, files=1)
        table.upsert(refused.coalesce(1), 1, run + 10, files=1)
        window = table.versions(spark, *bounds)
        listed.append((len(table.folders(spark, days=[at(f"2024-01-0{d} 00:00").date() for d in (2, 3)])), len(window.inputFiles())))
        assert rows(table.read(spark, *bounds), "volume") == [(2,)]
    assert listed == [(2, 2), (2, 2)]
    assert table.read(spark).count() == 28 and table.rejects(spark).count() == 28
    table.upsert(one(spark, DAY2, volume=77), 2, 0)
    assert rows(table.read(spark, *bounds), "volume") == [(77,)]
    # One open end: the dates aren't known, all are listed, and the filter prunes them.
    assert table.read(spark, since=bounds[0]).count() == 27
