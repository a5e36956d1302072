"""Run a fan-out job from the command line.

    python -m fanwrite stream -sendToHbase -sendToES -parallel -duration=10 \\
        --kafka broker:9092 --topic events --root <shared folder>
    python -m fanwrite stream -sendToHbase --log <message log folder> --root <folder> --available-now
    python -m fanwrite stream -sendToHbase --offset-log <folder> --root <folder> --source-option maxOffsetsPerTrigger=1000000 --without-repeats "1 hour"
    python -m fanwrite bulk --csv <events.csv> --root <folder> [-singleTable] [--layout wide] [--load-id 3 --replace]

The job flags are the ones ``FanoutOptions.from_flags`` knows; the rest
names the source, its options (``--source-option startingOffsets=earliest``,
repeated as needed) and the output root.  Outputs go to ``<root>/cells``, ``<root>/index``, ``<root>/rejects``,
``<root>/stats``, a record of every batch's progress to ``<root>/progress`` and the
checkpoint to ``<root>/_checkpoint``.  ``--mixed-headers`` reads a CSV folder whose
files have headers of their own.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from fanwrite.options import FanoutOptions
from fanwrite.session import apply_engine_conf


def _split(argv: list[str]) -> tuple[list[str], list[str]]:
    """Job flags (single dash) apart from the runner's own ``--`` options."""
    flags = [a for a in argv if a.startswith("-") and not a.startswith("--")]
    rest = [a for a in argv if a not in flags]
    return flags, rest


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m fanwrite")
    p.add_argument("command", choices=("stream", "bulk"))
    p.add_argument("--root", required=True, help="output root, a folder every executor can reach")
    p.add_argument("--kafka", help="bootstrap servers (stream)")
    p.add_argument("--topic", default="events", help="topic list (stream)")
    p.add_argument("--log", help="message log folder instead of Kafka (stream)")
    p.add_argument("--offset-log", help="message log read by offsets of each partition (stream)")
    p.add_argument("--without-repeats", metavar="INTERVAL", help="leave out messages repeated within so much event time (stream)")
    p.add_argument("--available-now", action="store_true", help="drain what is there and stop (stream)")
    p.add_argument("--timeout", type=float, default=None, help="stop after this many seconds (stream)")
    p.add_argument("--csv", help="CSV event file or folder (bulk)")
    p.add_argument("--mixed-headers", action="store_true", help="every CSV file has a header of its own (bulk)")
    p.add_argument("--parquet", help="parquet table with an 'event' map column (bulk)")
    p.add_argument("--layout", choices=("blob", "wide"), default=None)
    p.add_argument("--source-option", action="append", default=[], metavar="KEY=VALUE", help="option of the source (stream)")
    p.add_argument("--load-id", type=int, default=None, help="bulk load id (default: the first unused)")
    p.add_argument("--replace", action="store_true", help="let the load take the place of one with its id (bulk)")
    return p


def main(argv: list[str] | None = None) -> int:
    flags, rest = _split(list(sys.argv[1:] if argv is None else argv))
    args = _parser().parse_args(rest)
    extra = {"layout": args.layout} if args.layout else {}
    opts = FanoutOptions.from_flags(flags, **extra)
    spark = SparkSession.builder.appName(f"fanwrite-{args.command}").getOrCreate()
    apply_engine_conf(spark)
    root = args.root.rstrip("/")

    if args.command == "bulk":
        from fanwrite.plans.bulk import bulk_load
        from fanwrite.sinks import RejectSink
        from fanwrite.sources.csv_events import read_csv_events, read_mixed_csv_events

        if args.csv:
            events = (read_mixed_csv_events if args.mixed_headers else read_csv_events)(spark, args.csv)
        elif args.parquet:
            events = spark.read.parquet(args.parquet)
        else:
            raise SystemExit("bulk needs --csv or --parquet")
        report = bulk_load(events, f"{root}/cells", opts, load_id=args.load_id, rejects=RejectSink(f"{root}/rejects"), replace=args.replace)
        print(f"load {report.load_id}: {report.events} events as {report.cells} cells, {report.rejects} rejects in {report.seconds:.1f} s")
        return 0

    from fanwrite.operators.repeats import without_repeats
    from fanwrite.sinks import IndexSink, RejectSink, StatsSink, TableSink
    from fanwrite.sources.messages import kafka_stream, message_log_stream
    from fanwrite.sources.offset_log import offset_log_stream
    from fanwrite.streaming import FanoutJob
    from fanwrite.streaming.progress import ProgressLog

    sinks = []
    if opts.send_to_table:
        sinks.append(TableSink(f"{root}/cells", opts))
    if opts.send_to_index:
        sinks.append(IndexSink(f"{root}/index", opts))
    job = FanoutJob(opts, sinks, rejects=RejectSink(f"{root}/rejects"), stats=StatsSink(f"{root}/stats"))
    options = dict(o.split("=", 1) for o in args.source_option)
    if args.log:
        messages = message_log_stream(spark, args.log, **options)
    elif args.offset_log:
        messages = offset_log_stream(spark, args.offset_log, **({"checkpoint": f"{root}/_checkpoint"} | options))
    elif args.kafka:
        messages = kafka_stream(spark, args.kafka, args.topic, **options)
    else:
        raise SystemExit("stream needs --kafka, --log or --offset-log")
    if args.without_repeats:
        messages = without_repeats(messages, args.without_repeats)
    trigger = {"availableNow": True} if args.available_now else None
    progress = ProgressLog(spark, f"{root}/progress").start()
    try:
        query = job.start(messages, f"{root}/_checkpoint", trigger=trigger, query_name="fanwrite")
        query.awaitTermination(args.timeout)
        if query.isActive:
            query.stop()
    finally:
        progress.stop()
    if query.exception() is not None:
        raise query.exception()
    return 0


if __name__ == "__main__":
    sys.exit(main())
