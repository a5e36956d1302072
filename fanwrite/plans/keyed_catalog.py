"""Registered queries of keyed state, lookups, offsets and storage layouts (see
:mod:`fanwrite.plans.catalog`), and their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanwrite.functions.events import entries
from fanwrite.operators.decode import decode_messages, good
from fanwrite.operators.latest import document_fields
from fanwrite.operators.lookup import lookup_enrichment
from fanwrite.operators.repeats import without_repeats
from fanwrite.operators.sketches import SketchSink, distinct_values
from fanwrite.plans.catalog import CELLS, DECODED_FIELDS, Query, _decoded_fields, _events, _messages, _opts, _prepared, _table
from fanwrite.plans.fanout import prepare
from fanwrite.plans.oracle import BLOB, DECODED, FIELDS, LATEST_BY_USER, ROW_KEY, TABLE, _blob, _with
from fanwrite.session import scratch_dir
from fanwrite.sinks.bucketed_index import BucketedIndexSink, read_latest_bucketed
from fanwrite.sinks.index_sink import IndexSink
from fanwrite.sinks.records import RejectSink
from fanwrite.sinks.sorted_table import SortedTableSink, read_rows, read_sorted_cells
from fanwrite.sinks.table_sink import TableSink, read_cells, read_cells_of_tenants
from fanwrite.sources.csv_events import read_mixed_csv_events, write_csv_events
from fanwrite.sources.messages import message_log_stream, messages_from_events, write_message_log
from fanwrite.sources.offset_log import offset_log_stream, write_offset_log
from fanwrite.sources.tables import lifted, raw_events_from_table, read_table
from fanwrite.streaming.index_state import IndexChanges
from fanwrite.streaming.progress import ProgressLog, read_progress
from fanwrite.streaming.runner import FanoutJob, run_until_done

ARRIVALS = 4  # times at which data arrives, and a stopped query is started again
AVAILABLE = {"availableNow": True}


def _arrive(spark, sf_dir, log: str, k: int) -> str:
    """The events of arrival ``k``, in no order of time, as new files of a message log."""
    part = _messages(spark, sf_dir).filter(F.pmod("offset", F.lit(ARRIVALS)) == k)
    return write_message_log(part, log, append=True)


def _log_stream(spark, log):
    return message_log_stream(spark, log, maxFilesPerTrigger=1_000_000)  # one batch a start


# ---------------------------------------------------------------- documents


def q_index_state_changes(spark, sf_dir):
    # Documents keyed by user over four batches, the query restarted for each: what
    # every batch emits is the documents it changed.
    work = scratch_dir(spark, "index-state")
    job = IndexChanges(
        _opts(index_id_field="sun"), work + "/index", rejects=RejectSink(work + "/rejects"), order_by=("timestamp", "offset"), batch_first=False
    )
    for k in range(ARRIVALS):
        _arrive(spark, sf_dir, work + "/log", k)
        run_until_done(job.start(_log_stream(spark, work + "/log"), work + "/_checkpoint", trigger=AVAILABLE))
    changed = spark.read.parquet(work + "/index")
    return changed.select(F.col("batch_id").cast("long").alias("batch_id"), "doc_id", F.col("event")["id"].alias("id"), F.col("event")["dt"].alias("dt"))


def q_index_bucketed_latest(spark, sf_dir):
    # Four batches in no order of time, the second one written twice (a replay).
    opts = _opts(index_id_field="sun")
    root = scratch_dir(spark, "index-buckets")
    table = f"fanwrite_index_{uuid.uuid4().hex[:12]}"
    sink = BucketedIndexSink(root, opts, table, buckets=16, order_by=("ts", "event_id"), batch_first=False)
    prepared = _prepared(spark, sf_dir, opts)
    for b in (0, 1, 2, 3, 1):
        sink.write(prepared.filter(F.pmod("event_id", F.lit(ARRIVALS)) == b), b)
    return document_fields(read_latest_bucketed(spark, root, table))


# ---------------------------------------------------------------- sources


# The header of every third event's file: other fields in another order.
OTHER_HEADER = ("msg", "sev", "id", "sun", "evt", "rv39")


def q_csv_mixed_headers(spark, sf_dir):
    fields = raw_events_from_table(_table(spark, sf_dir)).select([F.col("event")[c].alias(c) for c in DECODED_FIELDS])
    root = scratch_dir(spark, "csv-mixed") + "/events"
    third = F.col("id").cast("bigint") % 3 == 0
    write_csv_events(fields.filter(~third), root, list(DECODED_FIELDS))
    write_csv_events(fields.filter(third), root, list(OTHER_HEADER), append=True)
    events = good(read_mixed_csv_events(spark, root)).withColumn("event_key", F.col("event")["id"])
    return entries(events, "event_key")


def q_stream_without_repeats(spark, sf_dir):
    # Three arrivals in order of time.  Each repeats some of its own messages and
    # some of the one before.
    messages = _messages(spark, sf_dir)
    bounds = messages.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
    span = bounds["hi"] - bounds["lo"]
    cuts = [bounds["lo"], bounds["lo"] + span / 3, bounds["lo"] + span * 2 / 3]
    part = F.when(F.col("timestamp") < F.lit(cuts[1]), 0).when(F.col("timestamp") < F.lit(cuts[2]), 1).otherwise(2)
    work = scratch_dir(spark, "repeats")
    for k in range(3):
        own = messages.filter(part == k)
        again = messages.filter((part == k) & (F.col("offset") % 5 == 0) | (part == k - 1) & (F.col("offset") % 7 == 0))
        write_message_log(own.union(again), work + "/log", append=True)
        once = without_repeats(_log_stream(spark, work + "/log"), f"{int(span.total_seconds()) + 1} seconds")
        query = decode_messages(once).filter(F.col("reason").isNull()).select("key", "event").writeStream.format("parquet")
        run_until_done(query.option("checkpointLocation", work + "/_checkpoint").trigger(**AVAILABLE).start(work + "/out"))
    return _decoded_fields(spark.read.parquet(work + "/out"))


def q_stream_offsets_resume(spark, sf_dir):
    # A log of four partitions is read up to a bound and the query stopped within
    # it; more arrives, and a restart goes on from each partition's offset.
    opts = _opts(send_to_table=True, layout="blob", duration_seconds=1)
    messages = messages_from_events(_events(spark, sf_dir), partitions=4)
    bounds = messages.agg(F.count("*").alias("n"), F.max("offset").alias("last")).first()
    early = F.col("offset") <= bounds["last"] // 2
    work = scratch_dir(spark, "offsets")
    log, checkpoint = work + "/log", work + "/_checkpoint"
    write_offset_log(messages.filter(early), log)
    job = FanoutJob(opts, [TableSink(work + "/cells", opts)], rejects=RejectSink(work + "/rejects"))
    bound = {"maxOffsetsPerTrigger": max(4, bounds["last"] // 3), "checkpoint": checkpoint}
    run_until_done(job.start(offset_log_stream(spark, log, **bound), checkpoint, trigger=AVAILABLE))
    if not 0 < job.rows < bounds["n"] / 2:
        raise RuntimeError(f"the first start read {job.rows} messages: it was to stop within the log")
    write_offset_log(messages.filter(~early), log)
    query = job.start(offset_log_stream(spark, log, **bound), checkpoint)
    query.processAllAvailable()
    query.stop()
    if query.exception() is not None:
        raise query.exception()
    return read_cells(spark, work + "/cells").select(*CELLS)


# ---------------------------------------------------------------- lookups


def _customers(spark, sf_dir, cached=False):
    # Two customers a key, the later one counts; users past the last key have none.
    customers = read_table(spark, sf_dir, "customer")
    return lookup_enrichment(
        customers, F.floor(F.col("c_custkey") / 2), on="sun", fields={"seg": "c_mktsegment", "cn": "c_name"}, order_by="c_custkey", cached=cached
    )


def q_lookup_enrich(spark, sf_dir):
    return entries(prepare(_events(spark, sf_dir), _opts(), enrich=_customers(spark, sf_dir)), "event_id")


def q_lookup_enrich_stream(spark, sf_dir):
    opts = _opts(send_to_table=True, layout="wide")
    work = scratch_dir(spark, "lookup")
    write_message_log(_messages(spark, sf_dir), work + "/log")
    job = FanoutJob(opts, [TableSink(work + "/cells", opts)], rejects=RejectSink(work + "/rejects"), enrich=_customers(spark, sf_dir, cached=True))
    run_until_done(job.start(message_log_stream(spark, work + "/log"), work + "/_checkpoint", trigger=AVAILABLE))
    return read_cells(spark, work + "/cells").select(*CELLS)


# ---------------------------------------------------------------- layouts


def _sorted_cells(spark, sf_dir) -> str:
    opts = _opts(single_table=True, layout="blob")
    root = scratch_dir(spark, "sorted")
    SortedTableSink(root, opts).write(_prepared(spark, sf_dir, opts), 0)
    return root


def q_sorted_key_ranges(spark, sf_dir):
    return read_sorted_cells(spark, _sorted_cells(spark, sf_dir)).select(*CELLS)


def q_sorted_key_lookup(spark, sf_dir):
    # The rows of the events of one kind, by their keys.
    keys = _prepared(spark, sf_dir, _opts()).filter(F.col("tenant") == "error").select("row_key")
    return read_rows(spark, _sorted_cells(spark, sf_dir), keys).select(*CELLS)


def q_tenant_set_cells(spark, sf_dir):
    # The tables of the tenants that the events of the greatest value are of.
    opts = _opts(layout="blob")
    root = scratch_dir(spark, "tenant-set")
    TableSink(root, opts).write(_prepared(spark, sf_dir, opts), 0)
    events = _table(spark, sf_dir)
    greatest = events.agg(F.max("value")).first()[0]
    tenants = events.filter(F.col("value") == F.lit(greatest)).select(lifted("rv39").alias("tenant"))
    return read_cells_of_tenants(spark, root, tenants, opts).select(*CELLS)


# ---------------------------------------------------------------- measures


def q_stream_progress(spark, sf_dir):
    opts = _opts(send_to_table=True, send_to_index=True, layout="blob")
    work = scratch_dir(spark, "progress")
    sinks = [TableSink(work + "/cells", opts), IndexSink(work + "/index", opts)]
    job = FanoutJob(opts, sinks, rejects=RejectSink(work + "/rejects"))
    log = ProgressLog(spark, work + "/progress").start()
    try:
        for k in range(ARRIVALS):
            _arrive(spark, sf_dir, work + "/log", k)
            run_until_done(job.start(_log_stream(spark, work + "/log"), work + "/_checkpoint", trigger=AVAILABLE))
    finally:
        log.stop()
    return read_progress(spark, work + "/progress").select("batch_id", "input_rows")


def q_tenant_sketches(spark, sf_dir):
    # Distinct tenants over the life of a stream, from the sketches of its batches.
    prepared = _prepared(spark, sf_dir, _opts())
    sink = SketchSink(scratch_dir(spark, "sketches"), "rv39")
    for b in range(ARRIVALS):
        sink.write(prepared.filter(F.pmod("event_id", F.lit(ARRIVALS)) == b), b)
    return distinct_values(spark, sink.root)


QUERIES: dict[str, Query] = {
    "index_state_changes": q_index_state_changes,
    "index_bucketed_latest": q_index_bucketed_latest,
    "csv_mixed_headers": q_csv_mixed_headers,
    "lookup_enrich": q_lookup_enrich,
    "lookup_enrich_stream": q_lookup_enrich_stream,
    "stream_without_repeats": q_stream_without_repeats,
    "stream_offsets_resume": q_stream_offsets_resume,
    "sorted_key_ranges": q_sorted_key_ranges,
    "sorted_key_lookup": q_sorted_key_lookup,
    "tenant_set_cells": q_tenant_set_cells,
    "stream_progress": q_stream_progress,
    "tenant_sketches": q_tenant_sketches,
}

_LOOKUP = """,
l AS (SELECT c_custkey // 2 AS k, arg_max(c_mktsegment, c_custkey) AS seg, arg_max(c_name, c_custkey) AS cn FROM customer GROUP BY 1),
e AS (SELECT b.*, l.seg, l.cn FROM b LEFT JOIN l ON l.k = b.user_id)"""
_LOOKED_UP = FIELDS + ", seg, cn"

ORACLE_SQL: dict[str, str] = {
    "index_state_changes": _with(
        "SELECT batch_id, sun AS doc_id, id, dt FROM m WHERE NOT EXISTS (\n"
        "  SELECT 1 FROM m p WHERE p.user_id = m.user_id AND p.batch_id < m.batch_id AND (p.ts, p.event_id) > (m.ts, m.event_id))",
        extra=f",\nm AS (SELECT *, event_id % {ARRIVALS} AS batch_id FROM b "
        f"QUALIFY row_number() OVER (PARTITION BY user_id, event_id % {ARRIVALS} ORDER BY ts DESC, event_id DESC) = 1)",
    ),
    "index_bucketed_latest": LATEST_BY_USER,
    "csv_mixed_headers": _with(
        f"SELECT event_key, qualifier, value FROM (SELECT id AS event_key, {FIELDS} FROM c) UNPIVOT (value FOR qualifier IN ({FIELDS}))",
        extra=",\nc AS (SELECT * REPLACE (CASE WHEN event_id % 3 <> 0 THEN dt END AS dt) FROM b)",
    ),
    "lookup_enrich": _with(
        f"SELECT event_id, qualifier, value FROM (SELECT event_id, {_LOOKED_UP} FROM e) UNPIVOT (value FOR qualifier IN ({_LOOKED_UP}))", extra=_LOOKUP
    ),
    "lookup_enrich_stream": _with(
        f"SELECT table_name, row_key, 'evt' AS family, qualifier, value FROM (SELECT {TABLE} AS table_name, {ROW_KEY} AS row_key, {_LOOKED_UP} FROM e) "
        f"UNPIVOT (value FOR qualifier IN ({_LOOKED_UP}))",
        extra=_LOOKUP,
    ),
    "stream_without_repeats": DECODED,
    "stream_offsets_resume": _blob(TABLE),
    "sorted_key_ranges": _blob("'events'"),
    "sorted_key_lookup": _with(
        f"SELECT 'events' AS table_name, {ROW_KEY} AS row_key, 'evt' AS family, 'data' AS qualifier, {BLOB} AS value FROM b WHERE rv39 = 'error'"
    ),
    "tenant_set_cells": _with(
        f"SELECT {TABLE} AS table_name, {ROW_KEY} AS row_key, 'evt' AS family, 'data' AS qualifier, {BLOB} AS value FROM b\n"
        f"WHERE {TABLE} IN (SELECT {TABLE} FROM b WHERE sev = (SELECT CAST(max(value) AS VARCHAR) FROM events))"
    ),
    "stream_progress": f"SELECT event_id % {ARRIVALS} AS batch_id, count(*) AS input_rows FROM events GROUP BY 1",
    "tenant_sketches": _with("SELECT count(DISTINCT rv39) AS distinct_values, count(*) AS row_count FROM b"),
}
