"""Command line of the jobs.

    spark-submit submit.py speed --servers broker:9092 --topic observations \\
        --view /data/speed --checkpoint /data/checkpoints/speed
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from obslayers.plans import live
from obslayers.plans.daily import add_new_parts, daily_table, run_daily
from obslayers.plans.hourly import run_hourly, run_hourly_days, run_summary
from obslayers.plans.raw import ingest_all, ingest_new
from obslayers.plans.replay import print_replay, write_replay
from obslayers.plans.speed import COMPACT_EVERY, SPEED_INTERVAL, run_speed, speed_table
from obslayers.schemas import DAILY_KEYS, SPEED_KEYS
from obslayers.session import build_session
from obslayers.sources.tables import replace_table
from obslayers.sources.topic import Topic
from obslayers.streaming.keyed import CassandraTable, serve
from obslayers.streaming.parts import DailyParts
from obslayers.streaming.runs import UNTIL_CAUGHT_UP, wait, wait_all


def _add_topic(parser: argparse.ArgumentParser) -> None:
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--folder", help="folder of topic files")
    parser.add_argument("--topic", default="observations")


def _add_stream(parser: argparse.ArgumentParser) -> None:
    _add_topic(parser)
    parser.add_argument("--starting", default="latest", choices=["latest", "earliest"])
    parser.add_argument("--since", help="first record time to take from a folder")
    parser.add_argument("--every", help="interval between micro-batches, such as '1 minute'")
    parser.add_argument("--once", action="store_true", help="stop when caught up")
    _add_reading(parser)


def _add_reading(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--per-trigger", type=int, help="most messages (Kafka) or files of a micro-batch")
    parser.add_argument("--min-partitions", type=int, help="least number of read tasks, for Kafka")


def _add_target(parser: argparse.ArgumentParser, table: str) -> None:
    parser.add_argument("--view", help="folder of the keyed table")
    parser.add_argument("--keyspace", help="Cassandra keyspace; its table is then the target")
    parser.add_argument("--table-name", default=table, help="Cassandra table")


def _topic(args: argparse.Namespace) -> Topic:
    return Topic(args.topic, args.servers, args.folder)


def _stream(args: argparse.Namespace, interval: str | None = None) -> dict:
    every = UNTIL_CAUGHT_UP if args.once else args.every or interval
    reading = {"per_trigger": args.per_trigger, "min_partitions": args.min_partitions}
    return {"starting": args.starting, "since": args.since, "every": every, **reading}


def _target(args: argparse.Namespace, keyed, keys: tuple[str, ...]):
    if args.keyspace and args.view:
        raise SystemExit("give either --view or --keyspace")
    if args.keyspace:
        return CassandraTable(args.keyspace, args.table_name, keys)
    return keyed(args.view) if args.view else None


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="submit.py")
    root.add_argument("--master")
    root.add_argument("--cluster", action="store_true", help="settings for a large cluster")
    jobs = root.add_subparsers(dest="job", required=True)

    raw = jobs.add_parser("raw", help="topic to raw table")
    _add_topic(raw)
    raw.add_argument("--table", required=True)
    raw.add_argument("--checkpoint", help="take only what is new since the last run")
    _add_reading(raw)

    speed = jobs.add_parser("speed", help="topic to live view")
    _add_stream(speed)
    _add_target(speed, "speed")
    speed.add_argument("--checkpoint", required=True)
    speed.add_argument("--mode", default="update", choices=["update", "append"])
    speed.add_argument("--partitions", type=int, help="state partitions")
    speed.add_argument(
        "--compact-every", type=int, default=COMPACT_EVERY, help="micro-batches between compactions of --view"
    )

    daily = jobs.add_parser("daily", help="raw table to daily view")
    daily.add_argument("--raw", required=True)
    daily.add_argument("--table", help="parquet table to append to")
    daily.add_argument("--parts", help="keep sums here and read only what is new in the raw table")
    daily.add_argument("--checkpoint", help="needed with --parts")
    daily.add_argument("--show", action="store_true")
    daily.add_argument("--strict", action="store_true", help="fail on malformed numbers and times")
    _add_target(daily, "batch_view")

    hourly = jobs.add_parser("hourly", help="clean table to hourly table")
    hourly.add_argument("--clean", required=True)
    hourly.add_argument("--table", required=True)
    hourly.add_argument("--since", help="first day to rebuild, of tables filed by day")
    hourly.add_argument("--until", help="last day to rebuild")

    summary = jobs.add_parser("summary", help="print the station summary of a clean table")
    summary.add_argument("--clean", required=True)

    watch = jobs.add_parser("watch", help="print a topic as it arrives")
    watch.add_argument("what", choices=["messages", "observations", "summary"])
    _add_stream(watch)

    archive = jobs.add_parser("archive", help="topic to clean table")
    _add_stream(archive)
    archive.add_argument("--table", required=True)
    archive.add_argument("--checkpoint", required=True)
    archive.add_argument("--by-day", action="store_true")
    archive.add_argument("--windows", action="store_true", help="also print ten-minute averages")
    archive.add_argument("--watermark", help="with --windows: how late rows may come; without, state grows for ever")

    replay = jobs.add_parser("replay", help="a topic from its beginning as readable lines")
    _add_topic(replay)
    replay.add_argument("--table", help="write all lines to this parquet table")
    replay.add_argument("--rows", type=int, help="print so many lines")
    replay.add_argument("--min-partitions", type=int, help="least number of read tasks, for Kafka")

    compact = jobs.add_parser("compact", help="fold the log of a keyed table")
    serving = jobs.add_parser("query", help="run SQL over keyed tables, as views speed and batch_view")
    compact.add_argument("kind", choices=["speed", "daily", "parts"])
    compact.add_argument("--view", required=True, help="folder of the keyed table, or of the parts")
    serving.add_argument("sql")
    serving.add_argument("--speed", help="folder of the live view")
    serving.add_argument("--daily", help="folder of the daily view")
    serving.add_argument("--output", help="parquet table for the result, instead of printing it")
    return root


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "raw":
        if args.checkpoint:
            reading = {"per_trigger": args.per_trigger, "min_partitions": args.min_partitions}
            wait(ingest_new(spark, _topic(args), args.table, args.checkpoint, **reading))
        else:
            ingest_all(spark, _topic(args), args.table, args.min_partitions)
    elif args.job == "speed":
        target = _target(args, speed_table, SPEED_KEYS)
        if target is None:
            raise SystemExit("speed needs --view or --keyspace")
        query = run_speed(
            spark,
            _topic(args),
            target,
            args.checkpoint,
            mode=args.mode,
            partitions=args.partitions,
            compact_every=args.compact_every,
            **_stream(args, SPEED_INTERVAL),
        )
        wait(query)
    elif args.job == "daily":
        target = _target(args, daily_table, DAILY_KEYS)
        if args.parts:
            if not args.checkpoint:
                raise SystemExit("daily --parts needs --checkpoint")
            wait(add_new_parts(spark, args.raw, args.parts, args.checkpoint, target, strict=args.strict))
        else:
            run_daily(spark, args.raw, args.table, target, args.show, strict=args.strict)
    elif args.job == "hourly":
        if args.since and args.until:
            run_hourly_days(spark, args.clean, args.table, args.since, args.until)
        else:
            run_hourly(spark, args.clean, args.table)
    elif args.job == "summary":
        run_summary(spark, args.clean, show=True)
    elif args.job == "watch":
        printers = {
            "messages": live.print_messages,
            "observations": live.print_observations,
            "summary": live.print_running_summary,
        }
        wait(printers[args.what](spark, _topic(args), **_stream(args)))
    elif args.job == "archive":
        if args.windows:
            streams = live.print_windows_and_archive(
                spark, _topic(args), args.table, args.checkpoint, watermark=args.watermark, **_stream(args)
            )
            wait_all(spark, streams)
        else:
            options = {**_stream(args), "by_day": args.by_day}
            wait(live.archive(spark, _topic(args), args.table, args.checkpoint, **options))
    elif args.job == "replay":
        if not args.table and not args.rows:
            raise SystemExit("replay needs --table or --rows")
        if args.table:
            write_replay(spark, _topic(args), args.table, args.min_partitions)
        if args.rows:
            print_replay(spark, _topic(args), args.rows, args.min_partitions)
    elif args.job == "compact":
        if args.kind == "parts":
            folded = DailyParts(args.view).fold(spark)
        else:
            folded = (speed_table if args.kind == "speed" else daily_table)(args.view).compact(spark)
        print(f"epochs folded: {folded}")
    elif args.job == "query":
        tables = {}
        if args.speed:
            tables["speed"] = speed_table(args.speed)
        if args.daily:
            tables["batch_view"] = daily_table(args.daily)
        serve(spark, tables)
        result = spark.sql(args.sql)
        if args.output:
            replace_table(result, args.output)
        else:
            print("\t".join(result.columns))
            # Every row that the SQL asks for, partition by partition.
            for row in result.toLocalIterator():
                print("\t".join(map(str, row)))


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"obslayers-{args.job}", args.master, cluster=args.cluster)
    try:
        run(spark, args)
    finally:
        spark.stop()
