"""The jobs as commands: ``python -m flightloom JOB ...`` or via spark-submit."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom import schemas
from flightloom.functions import payload_drift
from flightloom.operators import preview
from flightloom.plans import (
    filter_and_route,
    land_batch,
    land_csv,
    publish_flight_max,
    round_trip,
)
from flightloom.plans.landing import account_rows, create_landing_tables
from flightloom.session import build_session
from flightloom.sources import (
    FileTopics,
    KafkaTopics,
    MaximumTable,
    Topics,
    save_lookup_table,
    save_table,
    scan,
    scan_where_in,
)
from flightloom.streaming import drain_flight_max, drain_typed, drain_unique, land_topic

SCHEMAS = {
    "samples": schemas.SAMPLES,
    "metadata": schemas.METADATA,
    "word": schemas.WORD,
    "result": schemas.RESULT,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="flightloom", description=__doc__)
    top.add_argument("--master", help="Spark master; left out, spark-submit decides")
    top.add_argument("--hive", action="store_true", help="use the Hive catalog")
    top.add_argument("--shuffle-bytes", type=int, help="expected size of the largest shuffle")
    where = top.add_mutually_exclusive_group(required=True)
    where.add_argument("--kafka-servers", help="host:port,... of the Kafka brokers")
    where.add_argument("--topic-root", help="shared folder that holds topics as files")
    for side in ("read", "write"):
        top.add_argument(
            f"--{side}-option",
            action="append",
            default=[],
            metavar="NAME=VALUE",
            help=f"Kafka {side} setting, such as security.protocol or minPartitions; may be repeated",
        )
    top.add_argument("--rows", type=int, default=20, help="rows to show")
    top.add_argument("--publish-name", help="under which a publish may be run again; file topics")
    top.add_argument(
        "--since", type=datetime.fromisoformat, help="only records from this broker time on"
    )
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("round-trip", help="publish a table, read it back typed")
    job.add_argument("--table", required=True)
    job.add_argument("--topic", required=True)
    job.add_argument("--schema", required=True, choices=sorted(SCHEMAS))
    job.add_argument("--period", action="append", help="only these periods; may be repeated")
    job.add_argument("--key", default="unique_id")
    job.add_argument("--lossless-time", action="store_true", help="keep microseconds")

    job = jobs.add_parser("route", help="publish the rows of one id to several topics")
    job.add_argument("--table", required=True)
    job.add_argument("--topic", required=True, action="append")
    job.add_argument("--schema", required=True, choices=sorted(SCHEMAS))
    job.add_argument("--unique-id", required=True, type=int)

    job = jobs.add_parser("flight-max", help="publish the largest offsets, read them back")
    job.add_argument("--samples", required=True, help="table of samples")
    job.add_argument("--metadata", required=True, help="table of metadata")
    job.add_argument("--topic", required=True)
    job.add_argument("--unique-id", type=int, help="left out: all ids")
    job.add_argument(
        "--collapse", action="store_true", help="merge samples ahead; for values that repeat"
    )

    job = jobs.add_parser("land-csv", help="land spooled result rows as a part of a table")
    job.add_argument("--path", required=True, help="folder of CSV files")
    _landing_arguments(job, "table of refused lines")
    job.add_argument("--load", required=True, help="name of the part; the same for a retry")

    job = jobs.add_parser("land-batch", help="land a whole result topic as a part of a table")
    job.add_argument("--topic", required=True)
    _landing_arguments(job, "table of refused records")
    job.add_argument("--load", required=True, help="name of the part; the same for a retry")

    job = jobs.add_parser("drift", help="what payloads of a topic have beside a schema")
    job.add_argument("--topic", required=True)
    job.add_argument("--schema", required=True, choices=sorted(SCHEMAS))

    job = jobs.add_parser("drain-flight-max", help="keep the largest offsets up to date")
    job.add_argument("--topic", required=True, help="topic of samples")
    job.add_argument("--metadata", required=True, help="table of metadata")
    job.add_argument("--path", required=True, help="shared folder of the results")
    job.add_argument("--checkpoint", required=True, help="shared folder")
    job.add_argument("--delay", default="1 day", help="how late a record may be")
    job.add_argument("--result-topic", help="also publish what each batch changes")

    job = jobs.add_parser("save", help="save a table or view as a new table")
    job.add_argument("--table", required=True)
    job.add_argument("--to", required=True)
    job.add_argument("--location")
    job.add_argument("--partition", action="append", help="partition column; may be repeated")
    job.add_argument("--lookup", help="column whose single values are looked up later")

    job = jobs.add_parser("drain", help="append what is new in a topic to typed files")
    job.add_argument("--topic", required=True)
    job.add_argument("--schema", required=True, choices=sorted(SCHEMAS))
    job.add_argument("--path", required=True, help="shared folder")
    job.add_argument("--checkpoint", required=True, help="shared folder")
    job.add_argument("--unique-within", help="drain repeated records once, such as '7 days'")
    job.add_argument("--stream-option", action="append", default=[], metavar="NAME=VALUE")

    job = jobs.add_parser("land", help="land what is new in a result topic")
    job.add_argument("--topic", required=True)
    _landing_arguments(job, "table of refused records")
    job.add_argument("--checkpoint", required=True, help="shared folder")
    job.add_argument(
        "--stream-option",
        action="append",
        default=[],
        metavar="NAME=VALUE",
        help="such as maxFilesPerTrigger=1000, to land a long backlog in bounded batches",
    )
    return top


def _landing_arguments(job: argparse.ArgumentParser, rejects: str) -> None:
    job.add_argument("--table", required=True)
    job.add_argument("--rejects", required=True, help=rejects)
    job.add_argument("--accounts", help="table of counts per part")
    job.add_argument("--staging", required=True, help="shared folder")
    job.add_argument("--location", help="folder of the tables; left out, the warehouse")
    job.add_argument("--create", action="store_true", help="create the tables; fails if they exist")


def _options(given: list[str]) -> dict[str, str]:
    return dict(option.split("=", 1) for option in given)


def run(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    """Runs a job; returns what it shows."""
    topics: Topics = (
        KafkaTopics(
            spark,
            args.kafka_servers,
            {"isolation.level": "read_committed", **_options(args.read_option)},
            _options(args.write_option),
        )
        if args.kafka_servers
        else FileTopics(spark, args.topic_root)
    )
    if args.job == "round-trip":
        rows = (
            scan_where_in(spark, args.table, args.period)
            if args.period
            else scan(spark, args.table)
        )
        schema = SCHEMAS[args.schema]
        return [
            round_trip(
                rows, topics, args.topic, schema, args.key, args.lossless_time, args.publish_name
            )
        ]
    if args.job == "route":
        routed = filter_and_route(
            scan(spark, args.table),
            F.col("unique_id") == args.unique_id,
            topics,
            args.topic,
            SCHEMAS[args.schema],
            publish=args.publish_name,
        )
        return list(routed.values())
    if args.job == "flight-max":
        samples, metadata = scan(spark, args.samples), scan(spark, args.metadata)
        return [
            publish_flight_max(
                samples,
                metadata,
                topics,
                args.topic,
                args.unique_id,
                args.collapse,
                args.publish_name,
            )
        ]
    if args.job in ("land-csv", "land-batch"):
        tables = args.table, args.rejects
        lines = schemas.REJECTED_LINE if args.job == "land-csv" else schemas.REJECTED
        if args.create:
            create_landing_tables(
                spark, *tables, args.location, by_batch=True, accounts=args.accounts, rejected=lines
            )
        rest = *tables, args.staging, args.load, args.accounts
        if args.job == "land-csv":
            counts = land_csv(spark, args.path, *rest)
        else:
            counts = land_batch(topics.read(args.topic, since=args.since), *rest)
        return [spark.table(args.table), spark.table(args.rejects), account_rows(spark, counts)]
    if args.job == "drift":
        records = topics.read(args.topic, since=args.since)
        return [payload_drift(records, SCHEMAS[args.schema])]
    if args.job == "save":
        if args.lookup and args.partition:
            raise SystemExit("a table is saved for lookups or in partitions, not both")
        if args.lookup:
            save_lookup_table(scan(spark, args.table), args.to, args.lookup, args.location)
        else:
            save_table(scan(spark, args.table), args.to, args.location, args.partition or [])
        return [spark.table(args.to)]
    if args.job == "drain-flight-max":
        table = MaximumTable(spark, args.path)
        stream = topics.read_stream(args.topic, since=args.since)
        done = drain_flight_max(
            stream,
            scan(spark, args.metadata),
            table,
            args.checkpoint,
            delay=args.delay,
            publish=(topics, args.result_topic) if args.result_topic else None,
        )
        print(done)
        return [table.read()]
    stream = topics.read_stream(args.topic, since=args.since, **_options(args.stream_option))
    if args.job == "drain":
        where = SCHEMAS[args.schema], args.path, args.checkpoint
        if args.unique_within:
            return [drain_unique(stream, *where, within=args.unique_within)]
        return [drain_typed(stream, *where)]
    land_topic(
        stream,
        args.table,
        args.rejects,
        args.staging,
        args.checkpoint,
        args.create,
        args.location,
        args.accounts,
    )
    return [spark.table(args.table), spark.table(args.rejects)]


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"flightloom {args.job}", args.master, args.shuffle_bytes, args.hive)
    for shown in run(spark, args):
        preview(shown, args.rows).show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
