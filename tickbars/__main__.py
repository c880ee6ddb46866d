"""Jobs: `python -m tickbars <publish|stream|backfill|report|compact> --help`, or through spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickbars.plans import reports
from tickbars.plans.backfill import load_backfill
from tickbars.schemas import DEFAULT_SYMBOLS, TICK_TOPIC
from tickbars.session import get_session
from tickbars.sources import ticks, vendor
from tickbars.sources.tables import MarketTables
from tickbars.streaming.candles import FUTURE_TOLERANCE, start_candles, start_rejects
from tickbars.streaming.publish import start_publish, start_trade_rejects


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tickbars")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("publish", help="trade envelopes (JSON lines landing in a folder) to tick messages")
    job.add_argument("--envelopes", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--symbols", type=_names, default=list(DEFAULT_SYMBOLS), help="trades of other symbols are left out")
    job.add_argument("--rejects", help="also keep refused trades in this folder")
    job.add_argument("--topic", default=TICK_TOPIC)
    job.add_argument("--available-now", action="store_true")
    target = job.add_mutually_exclusive_group(required=True)
    target.add_argument("--servers", help="publish to a topic on these brokers")
    target.add_argument("--path", help="publish as message files")

    job = jobs.add_parser("stream", help="tick messages to one-minute candles and the 24h summary")
    job.add_argument("--tables", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--rejects", help="also keep refused ticks in this folder")
    job.add_argument("--topic", default=TICK_TOPIC)
    job.add_argument("--starting-offsets", default="latest")
    job.add_argument("--max-per-batch", type=int, help="bound of messages per micro-batch of a topic")
    job.add_argument("--as-of", help="fixed summary time instead of the clock")
    job.add_argument("--tolerance", default=FUTURE_TOLERANCE, help="how far a tick's time may be ahead of its arrival")
    job.add_argument("--state-partitions", type=int, help="shuffle width of the stream, for its number of symbols")
    job.add_argument("--available-now", action="store_true")
    source = job.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="read the topic from these brokers")
    source.add_argument("--path", help="read message files")
    source.add_argument("--text", help="read JSON lines")

    job = jobs.add_parser("backfill", help="landed vendor payloads to hourly candles and the 24h summary")
    job.add_argument("--payloads", required=True, help="folder with symbol=<symbol>/ files")
    job.add_argument("--tables", required=True)
    job.add_argument("--symbols", type=_names, default=list(DEFAULT_SYMBOLS))
    job.add_argument("--as-of")

    job = jobs.add_parser("report", help="write or show a dashboard report")
    job.add_argument("name", choices=["candlesticks", "volume", "pairs", "symbols"])
    job.add_argument("--tables", required=True)
    job.add_argument("--symbol")
    job.add_argument("--from", dest="from_epoch", type=int, help="epoch seconds, included")
    job.add_argument("--to", dest="to_epoch", type=int, help="epoch seconds, included")
    job.add_argument("--out", help="Parquet folder; without it the first rows are shown")

    job = jobs.add_parser("compact", help="merge the versions of all tables into new ones")
    job.add_argument("--tables", required=True)
    job.add_argument("--target", required=True)
    return parser


def _names(text: str) -> list[str]:
    return [name.strip() for name in text.split(",") if name.strip()]


def _report(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    tables = MarketTables(args.tables).create(spark)
    if args.name == "pairs":
        return reports.pair_report(tables.summary.read(spark))
    if args.name == "symbols":
        # Every stored version names its symbol, so they need not be merged first.
        return reports.symbol_list(tables.candles.versions(spark), tables.backfill.versions(spark))
    since, until = reports.scan_range(args.from_epoch, args.to_epoch)
    series = reports.candlestick_series if args.name == "candlesticks" else reports.volume_series
    live, bars = (table.read(spark, since, until) for table in (tables.candles, tables.backfill))
    return series(live, bars, args.symbol, args.from_epoch, args.to_epoch, tables.candles.versions(spark, since, until))


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.servers:
        return ticks.topic_messages(spark, args.servers, args.topic, args.starting_offsets, args.max_per_batch)
    return ticks.landed_messages(spark, args.path) if args.path else ticks.text_messages(spark, args.text)


def _await(spark: SparkSession, queries: list[StreamingQuery], available_now: bool) -> None:
    if not available_now:
        spark.streams.awaitAnyTermination()
    for query in queries:
        query.awaitTermination()


def main(argv: list[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.job == "report" and args.name in ("candlesticks", "volume"):
        if None in (args.symbol, args.from_epoch, args.to_epoch):
            parser.error("--symbol, --from and --to are required for a series")
    spark = get_session()

    if args.job == "publish":
        envelopes = ticks.text_messages(spark, args.envelopes)
        queries = [
            start_publish(
                envelopes, args.checkpoint, args.servers, args.topic, args.path, args.symbols, args.available_now
            )
        ]
        if args.rejects:
            checkpoint = f"{args.checkpoint.rstrip('/')}-rejects"
            queries.append(start_trade_rejects(envelopes, args.rejects, checkpoint, args.available_now))
        _await(spark, queries, args.available_now)
    elif args.job == "stream":
        tables = MarketTables(args.tables)
        queries = [
            start_candles(
                _messages(spark, args),
                tables,
                args.checkpoint,
                args.available_now,
                as_of=args.as_of,
                state_partitions=args.state_partitions,
                tolerance=args.tolerance,
            )
        ]
        if args.rejects:
            checkpoint = f"{args.checkpoint.rstrip('/')}-rejects"
            queries.append(start_rejects(_messages(spark, args), args.rejects, checkpoint, args.available_now, args.tolerance))
        _await(spark, queries, args.available_now)
    elif args.job == "backfill":
        payloads = vendor.landed_payloads(spark, args.payloads)
        result = load_backfill(spark, payloads, MarketTables(args.tables), args.symbols, args.as_of)
        print(f"counts and rejects are stored below {args.tables}/backfill_runs: {result.observed}; the first of them:")
        result.counts.orderBy("symbol").show(truncate=False)
        result.rejects.show(truncate=False)
    elif args.job == "report":
        rows = _report(spark, args)
        rows.write.parquet(args.out) if args.out else rows.show(truncate=False)
    else:
        source, target = MarketTables(args.tables).create(spark), MarketTables(args.target)
        for table, new in zip(
            (source.candles, source.backfill, source.summary), (target.candles, target.backfill, target.summary)
        ):
            table.compact(spark, new.path)


if __name__ == "__main__":
    main()
