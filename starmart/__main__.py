"""spark-submit entry points: load a topic, refresh marts, show a served page."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from starmart.plans import load, mart_updates, publish, serving
from starmart.schemas import CLUSTERED_BY, TABLE_DDL
from starmart.session import build_session
from starmart.sources.relational import connection
from starmart.sources.topics import read_topic, stream_topic
from starmart.streaming.streams import stream_files


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starmart")
    parser.add_argument("--input-gb", type=int, help="size of the data read, to size shuffles")
    commands = parser.add_subparsers(dest="command", required=True)

    loading = commands.add_parser("load", help="load one event type into the warehouse")
    loading.add_argument("event_type", choices=list(load.LOADERS))
    loading.add_argument("--warehouse", required=True)
    source = loading.add_mutually_exclusive_group(required=True)
    source.add_argument("--topic")
    source.add_argument("--files", help="Parquet folder of topic-shaped rows")
    loading.add_argument("--servers", help="bootstrap servers of the topic")
    loading.add_argument("--min-partitions", type=int)
    loading.add_argument("--checkpoint", help="read as a stream, with progress kept in this folder")
    loading.add_argument("--max-offsets", type=int, help="messages of a micro-batch at most, of a topic")
    loading.add_argument("--max-files", type=int, help="files of a micro-batch at most")

    sending = commands.add_parser("publish", help="publish a session table to its topic")
    sending.add_argument("event_type", choices=list(publish.MAPPERS))
    sending.add_argument("--files", required=True, help="Parquet folder of the session table")
    sending.add_argument("--servers", required=True)
    sending.add_argument("--prefix", default="", help="what the topic's name begins with")

    export = commands.add_parser("export", help="append new rows of a table to a relational table")
    export.add_argument("table", choices=list(TABLE_DDL))
    export.add_argument("--warehouse", required=True)
    export.add_argument("--url", required=True)
    export.add_argument("--user")
    export.add_argument("--password-env", help="environment variable that holds the password")
    export.add_argument("--driver")

    laying = commands.add_parser("layout", help="rewrite a fact table for filters on several columns")
    laying.add_argument("table", choices=list(CLUSTERED_BY))
    laying.add_argument("--warehouse", required=True)
    laying.add_argument("--seasons", type=int, nargs="+")

    refresh = commands.add_parser("marts", help="refresh the marts")
    refresh.add_argument("--warehouse", required=True)
    refresh.add_argument("--seasons", type=int, nargs="*")

    check = commands.add_parser("check", help="report constraint violations")
    check.add_argument("--warehouse", required=True)

    show = commands.add_parser("page", help="run a served query")
    show.add_argument("name", choices=list(serving.PAGES))
    show.add_argument("--warehouse", required=True)
    show.add_argument("--year", type=int)
    show.add_argument("--gp")
    show.add_argument("--d1")
    show.add_argument("--d2")
    show.add_argument("--rows", type=int, help="show so many rows; all if not given")
    return parser.parse_args(argv)


def run_load(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.checkpoint:
        if args.files:
            raw = stream_files(spark, args.files, spark.read.parquet(args.files).schema, max_files=args.max_files)
        else:
            raw = stream_topic(
                spark, args.servers, args.topic, max_offsets=args.max_offsets, min_partitions=args.min_partitions
            )
        load.load_stream(spark, raw, args.event_type, args.warehouse, args.checkpoint)
        return
    if args.files:
        raw = spark.read.parquet(args.files)
    else:
        raw = read_topic(spark, args.servers, args.topic, args.min_partitions)
    load.LOADERS[args.event_type](spark, raw, args.warehouse)
    mart_updates.update_marts(spark, args.warehouse)


def display(rows: DataFrame, most: int | None = None) -> None:
    """Print all rows, or the first ``most`` and how many are left out."""
    n = rows.count()
    rows.show(n if most is None else most, truncate=False)
    if most is not None and n > most:
        print(f"{n - most} more rows")


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session(input_bytes=args.input_gb and args.input_gb * 10**9)
    if args.command == "load":
        run_load(spark, args)
    elif args.command == "publish":
        publish.publish(spark.read.parquet(args.files), args.event_type, args.servers, args.prefix)
    elif args.command == "export":
        password = args.password_env and os.environ[args.password_env]
        load.export_table(spark, args.warehouse, args.table, connection(args.url, args.user, password, args.driver))
    elif args.command == "layout":
        load.lay_out(spark, args.warehouse, args.table, args.seasons)
    elif args.command == "marts":
        load.refresh_marts(spark, args.warehouse, args.seasons)
    elif args.command == "check":
        display(load.check_constraints(spark, args.warehouse))
    else:
        serving.register_views(spark, args.warehouse)
        given = {name: getattr(args, name) for name in ("year", "gp", "d1", "d2") if getattr(args, name) is not None}
        display(serving.page(spark, args.name, **given), args.rows)


if __name__ == "__main__":
    main()
