"""Command line of the jobs, for ``spark-submit``.

    ingest    messages (Kafka topic or text files) to the clean and quarantine zones
    archive   the same messages, unparsed, into date/hour folders
    load      new files of the landing zones into the bronze tables, after a quality gate
    build     bronze to stored silver, quality gate, gold tables
    refresh   the same for some event days only, by way of daily totals
    forecast  daily plays from stored silver, seven days ahead
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from listenlake.operators.parse import parse_messages
from listenlake.plans import forecasting, medallion
from listenlake.session import get_session
from listenlake.sinks.tables import read_silver
from listenlake.sources.catalog import source
from listenlake.sources.files import file_messages
from listenlake.sources.kafka import kafka_options, kafka_stream
from listenlake.streaming import ingest


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="listenlake", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("ingest", "archive"):
        job = jobs.add_parser(name)
        job.add_argument("--bootstrap-servers")
        job.add_argument("--topic")
        job.add_argument("--max-offsets-per-trigger", type=int)
        job.add_argument("--files", help="folder of text files instead of a topic")
        job.add_argument("--out", required=True)
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--once", action="store_true", help="process what is there and stop")
        if name == "ingest":
            job.add_argument("--strict", action="store_true", help="blank ids count as missing")
            job.add_argument("--by-country", action="store_true")
            job.add_argument("--two-queries", action="store_true", help="each zone at its own pace; the job ends if one does")
            job.add_argument("--dead-letters", help="folder for messages that break the contract, with their text")
    job = jobs.add_parser("load")
    job.add_argument("--clean", required=True)
    job.add_argument("--quarantine", required=True)
    job.add_argument("--schema", default="bronze")
    job.add_argument("--no-gate", action="store_true", help="publish whatever the checks find")
    for name in ("build", "refresh"):
        job = jobs.add_parser(name)
        job.add_argument("--bronze", default="bronze")
        job.add_argument("--silver", required=True, help="root of the lake: silver, marts and releases")
        job.add_argument("--gold", default="gold")
        job.add_argument("--as-of")
        job.add_argument("--no-gate", action="store_true", help="publish whatever the checks find")
        if name == "refresh":
            job.add_argument("--rollups", required=True, help="path of the daily totals")
            job.add_argument("--first", required=True, help="first event day")
            job.add_argument("--last", required=True, help="last event day")
    job = jobs.add_parser("forecast")
    job.add_argument("--silver", required=True)
    job.add_argument("--schema", default="gold")
    job.add_argument("--run-id")
    job.add_argument("--model", choices=sorted(forecasting.MODELS), default="trend")
    return parser


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return file_messages(spark, args.files)
    if not (args.bootstrap_servers and args.topic):
        raise SystemExit("give --files, or --bootstrap-servers and --topic")
    options = kafka_options(
        args.bootstrap_servers, args.topic, max_offsets_per_trigger=args.max_offsets_per_trigger
    )
    return kafka_stream(spark, options)


def _start_zones(args: argparse.Namespace, messages: DataFrame, trigger: str | None) -> list[StreamingQuery]:
    parsed, out, checkpoint = parse_messages(messages), args.out.rstrip("/"), args.checkpoint.rstrip("/")
    if args.two_queries:
        queries = list(ingest.start_zone_queries(
            parsed, f"{out}/zone=clean", f"{out}/zone=quarantine", f"{checkpoint}/clean", f"{checkpoint}/quarantine",
            trigger, trigger and ingest.QUARANTINE_TRIGGER, strict=args.strict,
            partition_clean_by=["country"] if args.by_country else None,
        ))
    else:
        queries = [ingest.start_zones_single_scan(
            parsed, out, f"{checkpoint}/zones" if args.dead_letters else checkpoint, trigger, strict=args.strict, by_country=args.by_country,
        )]
    if args.dead_letters:
        letters = trigger and ingest.QUARANTINE_TRIGGER
        queries.append(ingest.start_dead_letters(messages, args.dead_letters, f"{checkpoint}/dead-letters", letters))
    return queries


def run(spark: SparkSession, argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    if args.job in ("ingest", "archive"):
        trigger = None if args.once else ingest.CLEAN_TRIGGER
        messages = _messages(spark, args)
        if args.job == "archive":
            queries = [ingest.start_hourly_archive(messages, args.out, args.checkpoint, trigger)]
        else:
            queries = _start_zones(args, messages, trigger)
        if args.once:
            for query in queries:
                query.awaitTermination()
        else:
            ingest.await_any(spark, queries)
    elif args.job == "load":
        medallion.load_landing(spark, args.clean, args.quarantine, args.schema, gate=not args.no_gate)
    elif args.job == "build":
        bronze = source(spark, args.bronze, "listening_events").drop("event_date")
        medallion.build_lake(spark, bronze, args.silver, args.gold, args.as_of, as_tables=True, gate=not args.no_gate)
    elif args.job == "refresh":
        bronze = source(spark, args.bronze, "listening_events")
        medallion.refresh_days(
            spark, bronze, args.first, args.last, args.silver, args.rollups, args.as_of,
            gate=not args.no_gate, gold_schema=args.gold,
        )
    else:
        silver = read_silver(spark, args.silver)
        run_id = args.run_id or uuid.uuid4().hex
        if forecasting.run_forecast(silver, args.schema, run_id, args.model) is None:
            print("fewer than two days of data: no forecast")


if __name__ == "__main__":
    run(get_session())
