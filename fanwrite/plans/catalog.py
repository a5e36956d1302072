"""Registered queries: one per operator of the fan-out, each ``(spark, sf_dir)
-> DataFrame``, with an equivalent DuckDB SQL text over the same tables.

Every query reads the whole ``events`` table of ``sf_dir`` (or data Spark
derives from it: message logs, CSV files, written cells).  Queries that
write go to a fresh folder under the shared root named by
``spark.checkpoint.dir`` and return a DataFrame read back from it.

Map columns do not hash the same across engines, so queries that produce
events return ``(key, qualifier, value)`` rows instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanwrite.functions.codec import decode, encode, payload_size
from fanwrite.functions.events import drop_empty, entries, put_constants, put_field, restamp_time
from fanwrite.functions.text import blob_text
from fanwrite.operators.decode import decode_messages, good, rejected
from fanwrite.operators.latest import document_fields
from fanwrite.operators.layout import blob_cells, wide_cells
from fanwrite.operators.parallelism import spread_table
from fanwrite.operators.tenants import route_counts, tenant_filter, tenant_list
from fanwrite.options import FanoutOptions
from fanwrite.plans.bulk import bulk_load
from fanwrite.plans.fanout import prepare
from fanwrite.session import scratch_dir
from fanwrite.sinks.index_sink import IndexSink, read_latest
from fanwrite.sinks.records import RejectSink, StatsSink, read_records
from fanwrite.sinks.table_sink import TableSink, read_cells
from fanwrite.sources.csv_events import WHOLE_LINES, header_line, read_csv_events, write_csv_events
from fanwrite.sources.messages import message_log_stream, messages_from_events, write_message_log
from fanwrite.sources.tables import events_from_table, raw_events_from_table, read_table, tenant_source_predicate
from fanwrite.streaming.runner import FanoutJob, run_until_done

Query = Callable[[SparkSession, str], DataFrame]

CELLS = ("table_name", "row_key", "family", "qualifier", "value")
DECODED_FIELDS = ("id", "dt", "rv39", "evt", "sun", "sev", "msg")
# Fields that the ``events`` table also gives as plain columns.
LIFTED = ("id", "rv39")


def _opts(**kw) -> FanoutOptions:
    base = dict(row_key="id")
    base.update(kw)
    return FanoutOptions(**base)


def _table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_table(read_table(spark, sf_dir, "events"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_from_table(_table(spark, sf_dir))


def _prepared(spark: SparkSession, sf_dir: str, opts: FanoutOptions) -> DataFrame:
    return prepare(_events(spark, sf_dir), opts, lifted=LIFTED)


def _fields(df: DataFrame, key: str) -> DataFrame:
    return entries(df, key)


# ---------------------------------------------------------------- transforms


def q_events_to_map(spark, sf_dir):
    return _fields(_events(spark, sf_dir), "event_id")


def q_enrich_constant(spark, sf_dir):
    opts = _opts()
    return _fields(_events(spark, sf_dir).withColumn("event", put_constants("event", opts.enrich)), "event_id")


# Twenty constants; one overwrites the event's own severity.
MANY_CONSTANTS = {f"c{i:02d}": f"v{i}" for i in range(19)} | {"sev": "fixed"}


def q_enrich_many(spark, sf_dir):
    return _fields(prepare(_events(spark, sf_dir), _opts(enrich=MANY_CONSTANTS)), "event_id")


def q_enrich_hook(spark, sf_dir):
    # A hook of the user's in place of the constants: a field derived from another.
    region = F.coalesce(F.upper(F.col("event")["rv39"]), F.lit("NONE"))
    prepared = prepare(_events(spark, sf_dir), _opts(), enrich=lambda df: df.withColumn("event", put_field("event", "region", region)))
    return _fields(prepared, "event_id")


def q_restamp_event_time(spark, sf_dir):
    ev = _events(spark, sf_dir).withColumn("event", restamp_time("event", clock="ts"))
    return ev.select("event_id", F.col("event")["dt"].alias("dt"))


def q_drop_empty_fields(spark, sf_dir):
    # A producer that sends every field, NULLs included, as JSON; the decoded
    # maps then lose their NULL and empty values.
    raw = raw_events_from_table(_table(spark, sf_dir))
    wire = raw.select("event_id", encode("event").alias("payload"))
    return _fields(wire.select("event_id", drop_empty(decode("payload")).alias("event")), "event_id")


def q_row_key(spark, sf_dir):
    # Keyed as the fan-out keys events: from the lifted id column, so only
    # ``event_id`` is read.
    return _prepared(spark, sf_dir, _opts()).select("event_id", "row_key")


def q_wide_cells(spark, sf_dir):
    return wide_cells(_prepared(spark, sf_dir, _opts(layout="wide"))).select(*CELLS)


def q_blob_cells(spark, sf_dir):
    return blob_cells(_prepared(spark, sf_dir, _opts(layout="blob"))).select(*CELLS)


def q_tenant_list(spark, sf_dir):
    return tenant_list(_prepared(spark, sf_dir, _opts()))


def q_tenant_filter(spark, sf_dir):
    # The implied source predicate goes to the parquet scan; the tenant
    # filter on the prepared events stays the exact one.
    table = spread_table(read_table(spark, sf_dir, "events").filter(tenant_source_predicate("purchase")))
    prepared = prepare(events_from_table(table), _opts(), lifted=LIFTED)
    return tenant_filter(prepared, "purchase").select("event_id", "row_key", "tenant")


def q_route_counts(spark, sf_dir):
    return route_counts(_prepared(spark, sf_dir, _opts()))


# ---------------------------------------------------------------- codec


def _messages(spark, sf_dir, legacy=None) -> DataFrame:
    return messages_from_events(_events(spark, sf_dir), legacy=legacy)


def _decoded_fields(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("key").cast("string").alias("msg_key"),
        *[F.col("event")[c].alias(c) for c in DECODED_FIELDS],
    )


def q_decode_events(spark, sf_dir):
    return _decoded_fields(good(decode_messages(_messages(spark, sf_dir))))


def q_encode_events(spark, sf_dir):
    wire = _events(spark, sf_dir).select("event_id", encode("event").alias("payload"))
    return wire.select(
        "event_id",
        payload_size("payload").cast("long").alias("payload_bytes"),
        decode("payload")["msg"].alias("msg"),
    )


def q_rejects(spark, sf_dir):
    # Mixed producers: one sends ``error`` events as the map's {k=v} text
    # instead of JSON.  Those rows must come out as rejects, not vanish.
    msgs = _messages(spark, sf_dir, legacy=F.col("event")["evt"] == "error")
    bad = rejected(decode_messages(msgs))
    return bad.select(
        F.col("key").cast("string").alias("msg_key"), "reason", F.col("value").cast("string").alias("payload")
    )


def q_rejects_by_reason(spark, sf_dir):
    # Producers at fault in different ways: text instead of JSON, no payload,
    # a repeated field, a second object, and text after the object.
    msgs = _messages(spark, sf_dir)
    text, n = F.col("value").cast("string"), F.col("offset") % 7
    broken = (
        F.when(n == 0, F.lit("{id=1}"))
        .when(n == 1, F.lit(None).cast("string"))
        .when(n == 2, F.concat(F.lit('{"id":"0",'), F.substring(text, 2, 1 << 30)))
        .when(n == 3, F.concat(text, F.lit('{"id":"2"}')))
        .when(n == 4, F.concat(text, F.lit("] junk")))
        .otherwise(text)
    )
    decoded = decode_messages(msgs.withColumn("value", F.encode(broken, "UTF-8")))
    return decoded.groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(F.count("*").alias("messages"))


def q_route_by_message_field(spark, sf_dir):
    # An event field named like a message column is read from the event.
    events = _events(spark, sf_dir).withColumn("event", put_field("event", "topic", F.col("event")["evt"]))
    decoded = decode_messages(messages_from_events(events, topic="wire"))
    return route_counts(prepare(decoded, _opts(tenant_field="topic")))


def _write_csv(spark, sf_dir, long_rows=False) -> str:
    fields = raw_events_from_table(_table(spark, sf_dir)).select([F.col("event")[c].alias(c) for c in DECODED_FIELDS])
    root = scratch_dir(spark, "csv") + "/events"
    if not long_rows:
        return write_csv_events(fields, root, list(DECODED_FIELDS))
    # Every fifth event has one field more than the header of its file.
    longer = F.col("id").cast("bigint") % 5 == 0
    write_csv_events(fields.filter(~longer), root, list(DECODED_FIELDS))
    lines = fields.filter(longer).select(F.concat_ws(",", *(F.coalesce(F.col(c), F.lit("")) for c in DECODED_FIELDS), F.lit("EXTRA")).alias(header_line(spark, root)))
    lines.write.options(**WHOLE_LINES, quote="\x00").mode("append").csv(root)
    return root


def q_csv_rejects(spark, sf_dir):
    read = read_csv_events(spark, _write_csv(spark, sf_dir, long_rows=True))
    return read.select("reason", "line").filter("reason IS NOT NULL")


def q_csv_events(spark, sf_dir):
    ev = good(read_csv_events(spark, _write_csv(spark, sf_dir))).withColumn("event_key", F.col("event")["id"])
    return entries(ev, "event_key")


# ---------------------------------------------------------------- sinks


def q_sink_single_table(spark, sf_dir):
    opts = _opts(single_table=True, layout="blob")
    root = scratch_dir(spark, "single-table")
    TableSink(root, opts).write(_prepared(spark, sf_dir, opts), 0)
    return read_cells(spark, root).select(*CELLS)


def q_sink_tenant_tables(spark, sf_dir):
    opts = _opts(single_table=False, layout="wide")
    root = scratch_dir(spark, "tenant-tables")
    TableSink(root, opts).write(_prepared(spark, sf_dir, opts), 0)
    return read_cells(spark, root).select(*CELLS)


def q_index_upsert_latest(spark, sf_dir):
    # Documents keyed by user: many versions per id, the newest by event time wins.
    opts = _opts(index_id_field="sun")
    root = scratch_dir(spark, "index")
    IndexSink(root, opts, order_by=("ts", "event_id")).write(_prepared(spark, sf_dir, opts), 0)
    return document_fields(read_latest(spark, root))


def q_index_upsert_batches(spark, sf_dir):
    # The same, arriving in four batches in no order; the rule that the
    # event's own time decides is stored with the versions.
    opts = _opts(index_id_field="sun")
    root = scratch_dir(spark, "index-batches")
    sink = IndexSink(root, opts, order_by=("ts", "event_id"), batch_first=False)
    prepared = _prepared(spark, sf_dir, opts)
    for b in range(4):
        sink.write(prepared.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == b), b)
    return document_fields(read_latest(spark, root))


# Cells per file for bulk loads.  The original drivers sent puts in client
# batches; that is an RPC setting with no storage meaning here, and a file per
# few thousand cells would mean ~10^8 files at 100 TB.  A file bound of a
# million cells (tens of MB) keeps files large and their size bounded.
BULK_CELLS_PER_FILE = 1_000_000


def q_bulk_load_cells(spark, sf_dir):
    opts = _opts(single_table=True, layout="wide", max_records_per_file=BULK_CELLS_PER_FILE)
    root = scratch_dir(spark, "bulk")
    bulk_load(_events(spark, sf_dir), root, opts, load_id=0, lifted=LIFTED)
    return read_cells(spark, root).select(*CELLS)


def q_bulk_rejects(spark, sf_dir):
    # A CSV with long rows: cells of the good ones, rejects of the others.
    opts = _opts(single_table=True, layout="blob", max_records_per_file=BULK_CELLS_PER_FILE)
    root = scratch_dir(spark, "bulk-rejects")
    read = read_csv_events(spark, _write_csv(spark, sf_dir, long_rows=True))
    report = bulk_load(read, root + "/cells", opts, rejects=RejectSink(root + "/rejects"))
    cells = read_cells(spark, root + "/cells").select("value")
    rejects = read_records(spark, root + "/rejects").select("line")
    if (report.events, report.rejects) != (cells.count(), rejects.count()):
        raise RuntimeError(f"the report {report} does not agree with what was written")
    return cells.select(F.lit("cell").alias("kind"), F.col("value").alias("content")).union(rejects.select(F.lit("reject"), "line"))


# ---------------------------------------------------------------- streams


def _message_log(spark, sf_dir, legacy=None) -> str:
    return write_message_log(_messages(spark, sf_dir, legacy=legacy), scratch_dir(spark, "message-log"))


def q_stream_ingest(spark, sf_dir):
    log = _message_log(spark, sf_dir)
    work = scratch_dir(spark, "ingest")
    decoded = decode_messages(message_log_stream(spark, log))
    q = (
        decoded.filter(F.col("reason").isNull())
        .select("key", "event")
        .writeStream.format("parquet")
        .option("checkpointLocation", work + "/_checkpoint")
        .trigger(availableNow=True)
        .start(work + "/out")
    )
    run_until_done(q)
    return _decoded_fields(spark.read.parquet(work + "/out"))


def _fanout(spark, sf_dir, opts, index_order, batch_first, legacy=None, stats=False):
    log = _message_log(spark, sf_dir, legacy=legacy)
    work = scratch_dir(spark, "fanout")
    sinks = [TableSink(work + "/cells", opts), IndexSink(work + "/index", opts, order_by=index_order, batch_first=batch_first)]
    job = FanoutJob(
        opts,
        sinks,
        rejects=RejectSink(work + "/rejects"),
        stats=StatsSink(work + "/stats") if stats else None,
    )
    return log, work, job


def q_stream_fanout(spark, sf_dir):
    opts = _opts(send_to_table=True, send_to_index=True, layout="wide")
    log, work, job = _fanout(spark, sf_dir, opts, ("timestamp", "partition", "offset"), batch_first=True)
    run_until_done(job.start(message_log_stream(spark, log), work + "/_checkpoint", trigger={"availableNow": True}))
    return read_cells(spark, work + "/cells").select(*CELLS)


def q_stream_fanout_parallel(spark, sf_dir):
    opts = _opts(send_to_table=True, send_to_index=True, parallel=True, index_id_field="sun")
    log, work, job = _fanout(spark, sf_dir, opts, ("timestamp", "offset"), batch_first=False)
    run_until_done(job.start(message_log_stream(spark, log), work + "/_checkpoint", trigger={"availableNow": True}))
    return document_fields(read_latest(spark, work + "/index"))


def q_stream_resume(spark, sf_dir):
    # The log first holds the events of the first half of the time range; the
    # query drains it and stops.  The rest arrives while it is stopped, and a
    # restart on the same checkpoint must read exactly the new messages.
    opts = _opts(send_to_table=True, send_to_index=True, layout="blob")
    messages = _messages(spark, sf_dir)
    bounds = messages.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
    middle = bounds["lo"] + (bounds["hi"] - bounds["lo"]) / 2
    early = F.col("timestamp") <= F.lit(middle)
    log = scratch_dir(spark, "message-log")
    write_message_log(messages.filter(early), log)
    work = scratch_dir(spark, "resume")
    sinks = [TableSink(work + "/cells", opts), IndexSink(work + "/index", opts)]
    job = FanoutJob(opts, sinks, rejects=RejectSink(work + "/rejects"))
    run_until_done(job.start(message_log_stream(spark, log), work + "/_checkpoint", trigger={"availableNow": True}))
    drained = job.rows
    late = messages.filter(~early)
    write_message_log(late, log, append=True)
    run_until_done(job.start(message_log_stream(spark, log), work + "/_checkpoint", trigger={"availableNow": True}))
    if job.rows - drained != late.count():
        raise RuntimeError(f"restart read {job.rows - drained} messages, expected only the {late.count()} new ones")
    return read_cells(spark, work + "/cells").select(*CELLS)


def _both_sinks(spark, sf_dir, parallel: bool) -> DataFrame:
    """Cells and documents of one job in which some events lack an id."""
    opts = _opts(send_to_table=True, send_to_index=True, row_key="position", parallel=parallel)
    unkeyed = F.col("event_id") % 4 == 0
    events = _events(spark, sf_dir)
    events = events.withColumn("event", F.when(unkeyed, F.map_filter("event", lambda k, v: k != "id")).otherwise(F.col("event")))
    log = write_message_log(messages_from_events(events), scratch_dir(spark, "message-log"))
    work = scratch_dir(spark, "both-sinks")
    sinks = [TableSink(work + "/cells", opts), IndexSink(work + "/index", opts)]
    job = FanoutJob(opts, sinks, rejects=RejectSink(work + "/rejects"))
    run_until_done(job.start(message_log_stream(spark, log), work + "/_checkpoint", trigger={"availableNow": True}))
    cells = read_cells(spark, work + "/cells").select(F.lit("cell").alias("kind"), F.col("table_name").alias("name"), F.col("value").alias("content"))
    docs = read_latest(spark, work + "/index").select(F.lit("document"), "doc_id", blob_text("event"))
    lost = read_records(spark, work + "/rejects").select(F.col("reason"), F.col("key").cast("string"), F.lit(""))
    return cells.union(docs).union(lost)


def q_fanout_both_sinks(spark, sf_dir):
    return _both_sinks(spark, sf_dir, parallel=False)


def q_fanout_both_sinks_parallel(spark, sf_dir):
    return _both_sinks(spark, sf_dir, parallel=True)


def q_stream_table_only(spark, sf_dir):
    # One sink at the job's own interval: the query is stopped once the rows
    # of the log are through.
    opts = _opts(send_to_table=True, layout="blob", duration_seconds=1)
    messages = _messages(spark, sf_dir)
    log = write_message_log(messages, scratch_dir(spark, "message-log"))
    work = scratch_dir(spark, "table-only")
    job = FanoutJob(opts, [TableSink(work + "/cells", opts)], rejects=RejectSink(work + "/rejects"))
    query = job.start(message_log_stream(spark, log), work + "/_checkpoint")
    query.processAllAvailable()
    query.stop()
    if query.exception() is not None:
        raise query.exception()
    return read_cells(spark, work + "/cells").select(*CELLS)


def q_batch_stats(spark, sf_dir):
    opts = _opts(send_to_table=True, send_to_index=True, layout="blob")
    log, work, job = _fanout(
        spark, sf_dir, opts, ("timestamp", "partition", "offset"), batch_first=True, legacy=F.col("event")["evt"] == "error", stats=True
    )
    run_until_done(job.start(message_log_stream(spark, log), work + "/_checkpoint", trigger={"availableNow": True}))
    stats = read_records(spark, work + "/stats")
    return stats.groupBy("sink", "table_name").agg(F.sum("row_count").cast("long").alias("row_count"))


QUERIES: dict[str, Query] = {
    "events_to_map": q_events_to_map,
    "enrich_constant": q_enrich_constant,
    "enrich_many": q_enrich_many,
    "enrich_hook": q_enrich_hook,
    "restamp_event_time": q_restamp_event_time,
    "drop_empty_fields": q_drop_empty_fields,
    "row_key": q_row_key,
    "wide_cells": q_wide_cells,
    "blob_cells": q_blob_cells,
    "tenant_list": q_tenant_list,
    "tenant_filter": q_tenant_filter,
    "route_counts": q_route_counts,
    "route_by_message_field": q_route_by_message_field,
    "decode_events": q_decode_events,
    "encode_events": q_encode_events,
    "rejects": q_rejects,
    "rejects_by_reason": q_rejects_by_reason,
    "csv_events": q_csv_events,
    "csv_rejects": q_csv_rejects,
    "sink_single_table": q_sink_single_table,
    "sink_tenant_tables": q_sink_tenant_tables,
    "index_upsert_latest": q_index_upsert_latest,
    "index_upsert_batches": q_index_upsert_batches,
    "bulk_load_cells": q_bulk_load_cells,
    "bulk_rejects": q_bulk_rejects,
    "stream_ingest": q_stream_ingest,
    "stream_resume": q_stream_resume,
    "stream_fanout": q_stream_fanout,
    "stream_fanout_parallel": q_stream_fanout_parallel,
    "fanout_both_sinks": q_fanout_both_sinks,
    "fanout_both_sinks_parallel": q_fanout_both_sinks_parallel,
    "stream_table_only": q_stream_table_only,
    "batch_stats": q_batch_stats,
}
