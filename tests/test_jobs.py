import json
from types import SimpleNamespace

import pytest
from helpers import rows

from tickbars.__main__ import main
from tickbars.session import work_dir
from tickbars.sources.tables import MarketTables


def test_jobs_end_to_end(spark, tmp_path, capsys):
    envelopes, payloads = tmp_path / "envelopes", tmp_path / "payloads" / "symbol=AAPL"
    envelopes.mkdir()
    payloads.mkdir(parents=True)
    trades = [{"s": "AAPL", "t": 1704103505000, "p": 101, "v": 3}, {"s": "AAPL", "t": 1704103505000, "v": 3}]
    trade = {"type": "trade", "data": trades}
    (envelopes / "a.json").write_text(json.dumps(trade))
    bars = [
        {"datetime": f"2024-01-01 {h}:00:00", "open": "100", "high": "100", "low": "100", "close": "100", "volume": "5"}
        for h in ("09", "10")
    ]
    (payloads / "a.json").write_text(json.dumps({"status": "ok", "values": bars}))
    (payloads / "b.json").write_text(json.dumps({"status": "error", "values": bars}))
    other = tmp_path / "payloads" / "symbol=OTHER"
    other.mkdir()
    (other / "a.json").write_text(json.dumps({"status": "ok", "values": bars}))
    tables, topic, checkpoint = (str(tmp_path / n) for n in ("tables", "topic", "checkpoint"))
    as_of = "2024-01-01T12:00:00"

    main(["publish", "--envelopes", str(envelopes), "--path", topic, "--checkpoint", checkpoint + "-p", "--available-now", "--rejects", topic + "-rejects"])
    assert rows(spark.read.parquet(topic + "-rejects"), "symbol", "reject_reason") == [("AAPL", "missing price")]
    main(["stream", "--path", topic, "--tables", tables, "--checkpoint", checkpoint, "--as-of", as_of, "--available-now", "--rejects", str(tmp_path / "rejects")])
    stored = MarketTables(tables)
    assert rows(stored.summary.read(spark), "symbol", "open_24h", "close_24h", "total_volume") == [("AAPL", 101, 101, 3)]

    main(["backfill", "--payloads", str(payloads.parent), "--tables", tables, "--as-of", as_of])
    assert "AAPL" in capsys.readouterr().out
    counts = spark.read.parquet(f"{tables}/backfill_runs/*/counts")
    assert {r.symbol: r.loaded_rows for r in counts.collect()} == {"AAPL": 2, "MSFT": 0, "TSLA": 0, "NVDA": 0, "AMZN": 0, None: 2}
    assert rows(spark.read.parquet(f"{tables}/backfill_runs/*/bars/kind=refused"), "symbol", "reject_reason") == [("AAPL", "status error")]
    assert rows(stored.backfill.read(spark).groupBy("symbol").count()) == [("AAPL", 2)]
    # 10:05 is live, so only the 09:00 bar fills in.
    assert rows(stored.summary.read(spark), "symbol", "open_24h", "close_24h", "total_volume") == [("AAPL", 100, 101, 8)]

    out = str(tmp_path / "series")
    main(["report", "volume", "--tables", tables, "--symbol", "AAPL", "--from", "1704067200", "--to", "1704153600", "--out", out])
    assert sorted(rows(spark.read.parquet(out), "value")) == [(3,), (5,)]
    for name in ("pairs", "symbols"):
        main(["report", name, "--tables", tables])
        assert "AAPL" in capsys.readouterr().out

    main(["compact", "--tables", tables, "--target", tables + "-new"])
    new = MarketTables(tables + "-new")
    for old_table, new_table in ((stored.candles, new.candles), (stored.backfill, new.backfill), (stored.summary, new.summary)):
        assert sorted(rows(old_table.read(spark))) == sorted(rows(new_table.read(spark)))


def test_series_needs_its_arguments(tmp_path):
    with pytest.raises(SystemExit):
        main(["report", "volume", "--tables", str(tmp_path)])


def fake_session(master, **conf):
    context = SimpleNamespace(master=master, getConf=lambda: conf)
    return SimpleNamespace(sparkContext=context, conf={})


def test_work_dir_is_below_the_shared_folder():
    session = fake_session("spark://m:7077", **{"spark.checkpoint.dir": "/shared/ck/"})
    assert work_dir(session, "x").startswith("/shared/ck/tickbars/x-")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        work_dir(fake_session("spark://m:7077"), "x")
