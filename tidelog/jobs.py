"""Jobs to submit: land a feed in the log, apply a table's events to its target.

    spark-submit --py-files tidelog.zip tidelog/jobs.py land --feed DIR --log DIR --checkpoint DIR
    spark-submit --py-files tidelog.zip tidelog/jobs.py apply -d DB -t TABLE --log DIR \
        --root DIR --checkpoint DIR
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidelog import session
from tidelog.sources.feed import decode, read_feed, table_filter
from tidelog.streaming import apply


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidelog.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    land = jobs.add_parser("land", help="change feed to log")
    land.add_argument("--feed", required=True)
    land.add_argument("--tables", nargs="*", help="patterns of db.table, all if left out")
    one = jobs.add_parser("apply", help="log to keyed table")
    one.add_argument("-d", "--db", required=True)
    one.add_argument("-t", "--table", required=True)
    one.add_argument("--root", required=True)
    one.add_argument("--kind", choices=("mor", "cow"), default="mor")
    for p in (land, one):
        p.add_argument("--log", required=True)
        p.add_argument("--checkpoint", required=True)
        p.add_argument("--interval", help="e.g. '3 seconds'; without it work off what is there")
        p.add_argument("--files-per-trigger", type=int)
        p.add_argument("--host.name", dest="host_name", default="-", help="kept in the app name")
    return parser.parse_args(argv)


def start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    if args.job == "land":
        events = decode(
            read_feed(spark, args.feed, streaming=True, files_per_trigger=args.files_per_trigger)
        )
        if args.tables:
            events = table_filter(events, args.tables)
        return apply.land_log(events, args.log, args.checkpoint, args.interval)
    name = (args.db, args.table)
    target = apply.open_target(spark, args.root, *name, kind=args.kind)
    log = apply.stream_log(spark, args.log, args.files_per_trigger)
    each = apply.fan_out_batch({name: target})
    return apply.run_batches(log, each, args.checkpoint, args.interval)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    builder = SparkSession.builder.appName(f"tidelog {args.job} {args.host_name}")
    start(session.configure(builder.getOrCreate()), args).awaitTermination()


if __name__ == "__main__":
    main()
