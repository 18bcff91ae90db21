"""Command line: ``python -m stoplens <job>``, or ``run_job.py`` with spark-submit.

Endpoints and paths are arguments. Credentials belong in Spark's own
configuration, not here.
"""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from .plans import jobs
from .schemas import LINE_STATS, WINDOW_STATS
from .session import build_session
from .sinks import write_cassandra, write_kafka
from .sinks.archive import ROWS_PER_FILE
from .sources import read_routes, stream_kafka
from .streaming import cassandra_table, console, run_to_end, start


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="stoplens")
    parser.add_argument("--master")
    parser.add_argument("--time-zone", default="UTC")
    parser.add_argument("--shuffle-partitions", type=int)
    commands = parser.add_subparsers(dest="job", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        return commands.add_parser(name, help=text)

    def stream_arguments(sub: argparse.ArgumentParser, starting: str) -> None:
        sub.add_argument("--servers", required=True)
        sub.add_argument("--topic", required=True)
        sub.add_argument("--starting", default=starting)
        sub.add_argument("--out")
        sub.add_argument("--checkpoint", required=True)
        sub.add_argument("--every", default="1 minute")
        sub.add_argument("--drain", action="store_true", help="stop at the end of the topic")

    publish = command("publish", "snapshot documents to keyed messages")
    publish.add_argument("--snapshots", required=True)
    publish.add_argument("--one-per-line", action="store_true")
    publish.add_argument("--servers", required=True)
    publish.add_argument("--topic", required=True)
    publish.add_argument("--follow", action="store_true", help="go on with new documents")
    publish.add_argument("--checkpoint", help="needed to follow")
    publish.add_argument("--rejects", required=True, help="where texts that are no passages go")
    publish.add_argument("--every", default="1 minute")

    archive = command("archive", "messages to the partitioned archive")
    stream_arguments(archive, "earliest")
    archive.add_argument("--legacy-nulls", action="store_true")
    archive.add_argument("--rejects", help="where messages that are no JSON objects go; <out>-rejects if not given")
    archive.add_argument("--max-records", type=int, default=ROWS_PER_FILE, help="rows of a file")

    stats = command("line-stats", "line statistics of the archive")
    stats.add_argument("--lake", required=True)
    stats.add_argument("--year", type=int)
    stats.add_argument("--month", type=int)
    stats.add_argument("--max-wait", type=float, default=15)
    stats.add_argument("--parser", choices=["first_int", "delay_text"], default="first_int")
    stats.add_argument("--out")
    stats.add_argument("--write-id", type=int, help="number of the write; newer replaces older")
    stats.add_argument("--rejects")
    stats.add_argument("--cassandra-keyspace", help="write there instead of to --out")

    live = command("live-stats", "messages to window statistics")
    stream_arguments(live, "latest")
    live.add_argument("--routes", required=True)
    live.add_argument("--mode", choices=["update", "append", "complete"], default="update")
    live.add_argument("--rejects")
    live.add_argument("--cassandra-keyspace", help="write there instead of to --out")
    live.add_argument("--console", action="store_true", help="print closed windows")
    live.add_argument("--dedup-key", action="append", help="count a repeated observation of these fields once; append mode only")
    live.add_argument("--console-rows", type=int, default=20, help="rows printed of a micro-batch")

    changes = command("changes", "messages to change events")
    stream_arguments(changes, "earliest")
    changes.add_argument("--order", default="kafka_ts", help="field that orders a passage's messages")
    changes.add_argument("--state", help="table of last values; <out>-state if not given")
    changes.add_argument("--slice-width", type=float, help="keep last values in the stream's state store, by slices so wide")

    serving = command("serving", "show stored window statistics")
    serving.add_argument("--table", required=True)
    serving.add_argument("--line", action="append")
    serving.add_argument("--since")
    return parser


def _checked(parser: argparse.ArgumentParser, args: argparse.Namespace) -> argparse.Namespace:
    """Ends with a message where a job lacks what its output needs."""
    elsewhere = getattr(args, "cassandra_keyspace", None) or getattr(args, "console", False)
    if hasattr(args, "out") and not args.out and not elsewhere:
        parser.error(f"{args.job} needs --out")
    if args.job == "line-stats" and args.out and args.write_id is None:
        parser.error("line-stats --out needs --write-id")
    if getattr(args, "cassandra_keyspace", None) and not args.rejects:
        parser.error(f"{args.job} --cassandra-keyspace needs --rejects, as its keys may not be null")
    if getattr(args, "dedup_key", None) and not args.console and args.mode != "append":
        parser.error("live-stats --dedup-key needs --mode append or --console")
    if args.job == "publish" and args.follow and not args.checkpoint:
        parser.error("publish --follow needs --checkpoint")
    return args


def _run_stream(writer, args: argparse.Namespace) -> None:
    if args.drain:
        run_to_end(writer)
    else:
        start(writer, args.every).awaitTermination()


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return stream_kafka(spark, args.servers, args.topic, args.starting)


def main(argv: list[str] | None = None) -> None:
    parser = _parser()
    args = _checked(parser, parser.parse_args(argv))
    spark = build_session(
        f"stoplens-{args.job}", args.master, args.shuffle_partitions, args.time_zone
    )
    if args.job == "publish":
        send = partial(write_kafka, servers=args.servers, topic=args.topic)
        if args.follow:
            writer = jobs.follow_job(spark, args.snapshots, send, args.rejects, args.checkpoint, args.one_per_line)
            start(writer, args.every).awaitTermination()
        else:
            jobs.publish_job(spark, args.snapshots, send, args.rejects, args.one_per_line)
    elif args.job == "archive":
        messages = _messages(spark, args)
        writer = jobs.archive_job(
            messages,
            args.out,
            args.checkpoint,
            args.rejects,
            max_records=args.max_records,
            legacy_nulls=args.legacy_nulls,
        )
        _run_stream(writer, args)
    elif args.job == "line-stats":
        found = jobs.line_stats_job(
            spark, args.lake, args.year, args.month, max_wait=args.max_wait, parser=args.parser
        )
        if args.cassandra_keyspace:
            rejects = write_cassandra(found, LINE_STATS, args.cassandra_keyspace)
            rejects.write.mode("overwrite").parquet(args.rejects)
        else:
            jobs.store_line_stats(found, args.out, args.write_id, args.rejects)
    elif args.job == "live-stats":
        messages, routes = _messages(spark, args), read_routes(spark, args.routes)
        options = {"dedup_keys": args.dedup_key} if args.dedup_key else {}
        if args.console:
            writer = console(jobs.live_stats(messages, routes, **options), args.console_rows)
        elif args.cassandra_keyspace:
            writer = cassandra_table(
                jobs.live_stats(messages, routes, **options),
                f"{args.checkpoint}/cassandra-{args.mode}",
                WINDOW_STATS,
                args.cassandra_keyspace,
                args.rejects,
                args.mode,
            )
        else:
            writer = jobs.live_stats_job(
                messages, routes, args.out, args.checkpoint, args.mode, args.rejects, **options
            )
        _run_stream(writer, args)
    elif args.job == "changes":
        writer = jobs.changes_job(
            _messages(spark, args),
            args.out,
            args.checkpoint,
            args.order,
            state_path=args.state,
            slice_width=args.slice_width,
        )
        _run_stream(writer, args)
    else:
        for row in jobs.serving_job(spark, args.table, args.line, args.since).toLocalIterator():
            print(*row, sep="\t")


if __name__ == "__main__":
    main()
