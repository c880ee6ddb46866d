from helpers import at, candles, rows, wall
from pyspark.sql import functions as F

from tickbars.plans import reports
from tickbars.sources.tables import MarketTables

FROM, TO = int(at("2024-01-01 10:05").timestamp()), int(at("2024-01-01 13:00").timestamp())


def sources(spark):
    live = candles(
        spark,
        [
            ("A", "2024-01-01 10:04:00", "1", "1", "1", "1", 1),
            ("A", "2024-01-01 10:05:00", "2", "3", "1", "2", 2),
            ("A", "2024-01-01 13:00:00", "4", "4", "4", "4", 4),
            ("A", "2024-01-01 13:01:00", "5", "5", "5", "5", 5),
            ("B", "2024-01-01 11:00:00", "6", "6", "6", "6", 6),
        ],
    )
    bars = candles(
        spark,
        [
            ("A", "2024-01-01 10:00:00", "10", "10", "10", "10", 10),
            ("A", "2024-01-01 10:30:00", "11", "11", "11", "11", 11),
            ("A", "2024-01-01 11:00:00", "12", "12", "12", "12", 12),
            ("A", "2024-01-01 12:30:00", "13", "13", "13", "13", 13),
            ("A", "2024-01-01 13:00:00", "14", "14", "14", "14", 14),
            ("C", "2024-01-01 11:00:00", "15", "15", "15", "15", 15),
        ],
        minutes=60,
    )
    return live, bars


def test_series_keep_both_ends_and_fill_uncovered_hours(spark):
    live, bars = sources(spark)
    assert rows(reports.candlestick_series(live, bars, "A", FROM, TO)) == [
        (wall("2024-01-01 10:05"), 2, 3, 1, 2),
        (wall("2024-01-01 11:00"), 12, 12, 12, 12),
        (wall("2024-01-01 12:30"), 13, 13, 13, 13),
        (wall("2024-01-01 13:00"), 4, 4, 4, 4),
    ]
    assert rows(reports.volume_series(live, bars, "A", FROM, TO), "value") == [(2,), (12,), (13,), (4,)]


def test_live_minutes_outside_the_range_still_cover_their_hour(spark):
    live, bars = sources(spark)
    start = int(at("2024-01-01 10:30").timestamp())
    assert rows(reports.volume_series(live, bars, "A", start, start)) == []


def test_a_symbol_is_a_value_not_sql(spark):
    live, bars = sources(spark)
    assert reports.volume_series(live, bars, "A' OR '1'='1", FROM, TO).isEmpty()


def test_symbol_list(spark):
    assert rows(reports.symbol_list(*sources(spark))) == [("A",), ("B",), ("C",)]


def test_pair_report_order(spark):
    table = spark.createDataFrame([("B", 1.0), ("A", 1.0), ("C", 2.0), ("D", -1.0)], "symbol STRING, price_change_pct DOUBLE")
    for name in reports.REPORT_COLUMNS[1:]:
        if name != "price_change_pct":
            table = table.withColumn(name, F.lit(0))
    got = reports.pair_report(table)
    assert got.columns == reports.REPORT_COLUMNS
    assert [r.symbol for r in got.collect()] == ["C", "A", "B", "D"]


def test_views_show_current_rows_and_series_read_them(spark, tmp_path):
    live, bars = sources(spark)
    tables = MarketTables(str(tmp_path)).create(spark)
    tables.candles.upsert(live, 1, 0)
    tables.candles.upsert(live.filter("symbol = 'B'").withColumn("volume", F.lit(60)), 2, 0)
    tables.backfill.upsert(bars, 1, 0)
    tables.register_views(spark)
    by_view = spark.sql("SELECT symbol, sum(volume) FROM candles_1m GROUP BY symbol ORDER BY symbol")
    assert rows(by_view) == [("A", 12), ("B", 60)]
    assert rows(spark.sql("SELECT max(volume) FROM candles_1h_backfill WHERE symbol = :s", args={"s": "A"})) == [(14,)]
    since, until = reports.scan_range(FROM, TO)
    series = reports.volume_series(tables.candles.read(spark, since, until), tables.backfill.read(spark, since, until), "A", FROM, TO)
    assert rows(series) == [
        (wall("2024-01-01 10:05"), 2),
        (wall("2024-01-01 11:00"), 12),
        (wall("2024-01-01 12:30"), 13),
        (wall("2024-01-01 13:00"), 4),
    ]
