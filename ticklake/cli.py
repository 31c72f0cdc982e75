"""Jobs for ``spark-submit``: ``python -m ticklake.cli JOB --help``.

Each job runs once and can be repeated by any scheduler. Kafka and JDBC settings come from
the environment (see ``ticklake.settings``).
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ticklake.operators import filters
from ticklake.plans import dashboard, market_report
from ticklake.session import build_session
from ticklake.settings import JdbcSettings, KafkaSettings
from ticklake.sinks.messages import publish_files, publish_stream
from ticklake.sinks.tables import append_jdbc, append_snapshot, create_snapshot_table
from ticklake.sources.messages import file_messages, kafka_messages
from ticklake.sources.mini_tickers import explode_mini_tickers
from ticklake.sources.snapshots import load_snapshot
from ticklake.sources.tables import scan_jdbc
from ticklake.streaming import fan_out, jobs, writers


def _table(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.jdbc:
        split = (args.partition_column, args.lower, args.upper, args.partitions)
        return scan_jdbc(spark, JdbcSettings.from_env(), args.table, *split)
    return spark.read.parquet(args.table) if "/" in args.table else spark.table(args.table)


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return file_messages(spark, args.files)
    return kafka_messages(
        spark,
        KafkaSettings.from_env(),
        starting_offsets=args.starting_offsets,
        fail_on_data_loss=not args.ignore_data_loss,
        min_partitions=args.min_partitions,
        max_offsets_per_trigger=args.max_offsets,
    )


def _trigger(args: argparse.Namespace) -> jobs.Trigger | None:
    if args.once:
        return {"availableNow": True}
    return {"processingTime": args.every} if args.every else None


def snapshot(spark: SparkSession, args: argparse.Namespace) -> None:
    now = dt.datetime.now(dt.timezone.utc)
    run_ts = dt.datetime.fromisoformat(args.run_ts) if args.run_ts else now
    rows = load_snapshot(spark, args.input, run_ts, args.multi_line)
    if args.jdbc:
        append_jdbc(rows, JdbcSettings.from_env(), args.table)
        return
    create_snapshot_table(spark, args.table, args.location)
    append_snapshot(rows, args.table)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = _table(spark, args)
    day = "run_date" if "run_date" in rows.columns else None
    market_report.write_report(filters.latest_snapshot(rows, day=day), args.output)


def views(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = dashboard.working_set(_table(spark, args), args.symbols, args.period, args.limit)
    dashboard.write_views(rows, args.output)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """One sink is a query of its own; with rejects or console, one read feeds all of them."""
    messages, trigger = _messages(spark, args), _trigger(args)
    if args.drop_malformed and not args.rejects:
        raise SystemExit("--drop-malformed leaves messages out: say with --rejects where to keep them")
    if args.job == "stream-parquet":
        if not (args.rejects or args.console):
            query = jobs.ticks_to_parquet(messages, args.output, f"{args.checkpoint}/{args.job}", trigger)
            return jobs.wait_for(spark, query)
        sinks = [fan_out.parquet_sink(args.output, args.drop_malformed)]
    else:
        write = (
            writers.jdbc_writer(JdbcSettings.from_env(), args.output)
            if args.jdbc
            else writers.parquet_writer(args.output)
        )
        sinks = [fan_out.ticks_sink(write, args.cross_batch, args.drop_malformed)]
    if args.rejects:
        sinks.append(fan_out.rejects_sink(args.rejects))
    if args.console:
        sinks.append(fan_out.console_sink())
    jobs.wait_for(spark, fan_out.fan_out(messages, sinks, f"{args.checkpoint}/{args.job}", trigger))


def normalise(spark: SparkSession, args: argparse.Namespace) -> None:
    ticks, target = explode_mini_tickers(_messages(spark, args)), f"{args.checkpoint}/normalise"
    if args.output:
        query = publish_files(ticks, args.output, target, _trigger(args))
    else:
        query = publish_stream(ticks, KafkaSettings.from_env(topic_variable=args.topic_variable), target, _trigger(args))
    jobs.wait_for(spark, query)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    store = writers.parquet_writer(args.table)
    if args.output:
        writers.compact_days(store.read(spark), args.output, args.before)
    else:
        store.compact(spark, args.before)


def _add_source(job: argparse.ArgumentParser) -> None:
    job.add_argument("--files", help="folder of landed messages; default is Kafka")
    job.add_argument("--starting-offsets", default="latest")
    job.add_argument("--ignore-data-loss", action="store_true", help="go on where Kafka lost messages")
    job.add_argument("--min-partitions", type=int, help="read Kafka with at least so many tasks")
    job.add_argument("--max-offsets", type=int, help="messages per micro-batch")
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--every", help="trigger interval", default=None)
    job.add_argument("--once", action="store_true", help="process what is there and end")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="ticklake")
    commands = root.add_subparsers(dest="job", required=True)

    load = commands.add_parser("snapshot", help="append landed ticker files to the snapshot table")
    load.add_argument("--input", required=True)
    load.add_argument("--table", required=True)
    load.add_argument("--location")
    load.add_argument("--run-ts", help="ISO time of the snapshot, UTC; default now")
    load.add_argument("--multi-line", action="store_true")
    load.add_argument("--jdbc", action="store_true", help="append to a database table")
    load.set_defaults(run=snapshot)

    made = commands.add_parser("report", help="rankings and summary of the newest snapshot")
    made.set_defaults(run=report)
    shown = commands.add_parser("views", help="dashboard views of recent ticks")
    shown.add_argument("--symbols", nargs="+")
    shown.add_argument("--period", choices=list(filters.PERIODS), default="24H")
    shown.add_argument("--limit", type=int, help="only the newest ticks, before the period")
    shown.set_defaults(run=views)
    for reader in (made, shown):
        reader.add_argument("--table", required=True, help="table name or Parquet path")
        reader.add_argument("--jdbc", action="store_true")
        reader.add_argument("--partition-column", help="splits a JDBC scan, with the next three")
        reader.add_argument("--lower")
        reader.add_argument("--upper")
        reader.add_argument("--partitions", type=int)
        reader.add_argument("--output", required=True)

    for name in ("stream-parquet", "stream-table"):
        job = commands.add_parser(name)
        _add_source(job)
        job.add_argument("--output", required=True, help="path, or table with --jdbc")
        job.add_argument("--drop-malformed", action="store_true")
        job.add_argument("--rejects", help="Parquet path for what --drop-malformed leaves out")
        job.add_argument("--console", action="store_true")
        job.set_defaults(run=stream)
        if name == "stream-table":
            job.set_defaults(every="1 second")
            job.add_argument("--jdbc", action="store_true")
            job.add_argument("--cross-batch", action="store_true")

    made = commands.add_parser("normalise", help="payload arrays to tick messages")
    _add_source(made)
    made.add_argument("--output", help="folder for message files; default is Kafka")
    made.add_argument("--topic-variable", default="KAFKA_OUTPUT_TOPIC", help="variable that names the topic")
    made.set_defaults(run=normalise)

    packed = commands.add_parser("compact", help="few files per closed day of the stream table")
    packed.add_argument("--table", required=True)
    packed.add_argument("--output", help="a second table for the closed days; default is in place")
    packed.add_argument("--before", required=True, help="first day that stays open")
    packed.set_defaults(run=compact)
    return root


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    args.run(build_session(f"ticklake-{args.job}"), args)


if __name__ == "__main__":
    main()
