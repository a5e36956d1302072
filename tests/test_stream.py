"""Streaming fan-out: stream = batch, failure and restart, parallel sinks, guards."""

import os
import time

import pytest
from pyspark.sql import functions as F

from fanwrite.operators.layout import blob_cells
from fanwrite.options import FanoutOptions
from fanwrite.plans.fanout import prepare
from fanwrite.sinks import IndexSink, RejectSink, StatsSink, TableSink, read_cells, read_latest, read_records
from fanwrite.sources.messages import message_log_stream, messages_from_events, write_message_log
from fanwrite.sources.tables import events_from_table, read_table
from fanwrite.streaming import FanoutJob, run_until_done

from frames import rows_of

CELLS = ("table_name", "row_key", "family", "qualifier", "value")


@pytest.fixture()
def log(spark, sf_small, scratch):
    ev = events_from_table(read_table(spark, sf_small, "events"))
    msgs = messages_from_events(ev, legacy=F.col("event")["evt"] == "error")
    return write_message_log(msgs, scratch + "/log", 4)


class FlakySink:
    """Wraps a sink and fails its first write of one batch (then works)."""

    def __init__(self, inner, fail_batch, marker):
        self.inner, self.fail_batch, self.marker = inner, fail_batch, marker
        self.name, self.root = inner.name, inner.root

    def write(self, df, batch_id):
        if batch_id == self.fail_batch and not os.path.exists(self.marker):
            open(self.marker, "w").close()
            raise RuntimeError("injected sink failure")
        self.inner.write(df, batch_id)

    def stats(self, df, seconds):
        return self.inner.stats(df, seconds)


def stop_after_batches(query, job, batches, timeout_seconds=600, poll=0.2):
    """Stop a running query once ``job`` has completed ``batches`` more
    micro-batches (a controlled interruption, as a failed driver would be)."""
    before = job.batches
    deadline = time.monotonic() + timeout_seconds
    while time.monotonic() < deadline and query.isActive and job.batches - before < batches:
        time.sleep(poll)
    query.stop()
    return job.batches - before


def batch_cells(spark, sf_small, opts):
    ev = events_from_table(read_table(spark, sf_small, "events")).filter(F.col("event")["evt"] != "error")
    return rows_of(blob_cells(prepare(ev, opts)).select(*CELLS))


def test_stream_equals_batch_and_counts_add_up(spark, sf_small, scratch, log):
    opts = FanoutOptions(row_key="id", send_to_table=True, send_to_index=True)
    job = FanoutJob(
        opts,
        [TableSink(scratch + "/cells", opts), IndexSink(scratch + "/index", opts)],
        rejects=RejectSink(scratch + "/rejects"),
        stats=StatsSink(scratch + "/stats"),
    )
    run_until_done(job.start(message_log_stream(spark, log, max_files_per_trigger=1), scratch + "/ckpt", trigger={"availableNow": True}), 300)
    assert job.batches == 4
    streamed = rows_of(read_cells(spark, scratch + "/cells").select(*CELLS))
    assert streamed == batch_cells(spark, sf_small, opts)
    n_msgs = spark.read.parquet(log).count()
    n_rejects = read_records(spark, scratch + "/rejects").count()
    assert len(streamed) + n_rejects == n_msgs
    stats = {(r["sink"], r["table_name"]): r["n"] for r in read_records(spark, scratch + "/stats").groupBy("sink", "table_name").agg(F.sum("row_count").alias("n")).collect()}
    assert stats[("rejects", "decode")] == n_rejects
    assert stats[("index", "index")] == len(streamed)


@pytest.mark.parametrize("parallel", [False, True])
def test_failed_sink_then_restart_gives_clean_result(spark, sf_small, scratch, log, parallel):
    opts = FanoutOptions(row_key="id", send_to_table=True, send_to_index=True, parallel=parallel)
    table = TableSink(scratch + "/cells", opts)
    index = FlakySink(IndexSink(scratch + "/index", opts), fail_batch=1, marker=scratch + "/failed-once")
    job = FanoutJob(opts, [table, index], rejects=RejectSink(scratch + "/rejects"))
    q = job.start(message_log_stream(spark, log, max_files_per_trigger=1), scratch + "/ckpt", trigger={"availableNow": True})
    with pytest.raises(Exception):
        run_until_done(q, 300)
    assert os.path.exists(scratch + "/failed-once")
    # restart on the same checkpoint: batch 1 is replayed, nothing is doubled
    run_until_done(job.start(message_log_stream(spark, log, max_files_per_trigger=1), scratch + "/ckpt", trigger={"availableNow": True}), 300)
    assert rows_of(read_cells(spark, scratch + "/cells").select(*CELLS)) == batch_cells(spark, sf_small, opts)
    docs = read_latest(spark, scratch + "/index")
    assert docs.count() == docs.select("doc_id").distinct().count() == len(batch_cells(spark, sf_small, opts))


def test_fresh_checkpoint_on_used_output_is_refused(spark, scratch, log):
    opts = FanoutOptions(row_key="id", send_to_table=True)
    job = FanoutJob(opts, [TableSink(scratch + "/cells", opts)], rejects=RejectSink(scratch + "/rejects"))
    run_until_done(job.start(message_log_stream(spark, log, max_files_per_trigger=1), scratch + "/ckpt", trigger={"availableNow": True}), 300)
    with pytest.raises(RuntimeError, match="checkpoint"):
        job.start(message_log_stream(spark, log, max_files_per_trigger=1), scratch + "/other-ckpt", trigger={"availableNow": True})


def test_no_sink_is_an_error():
    with pytest.raises(ValueError):
        FanoutJob(FanoutOptions(), [])


def test_empty_batch_writes_nothing(spark, scratch):
    opts = FanoutOptions(send_to_table=True)
    job = FanoutJob(opts, [TableSink(scratch + "/cells", opts)], rejects=RejectSink(scratch + "/rejects"))
    empty = spark.createDataFrame([], "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    job.process_batch(empty, 0)
    assert not os.path.exists(scratch + "/cells")


def test_enrichment_hook_replaces_default(spark, scratch):
    from fanwrite.functions import put_field

    opts = FanoutOptions(send_to_table=True, layout="wide")
    hook = lambda df: df.withColumn("event", put_field("event", "region", F.upper(F.col("event")["rv39"])))
    job = FanoutJob(opts, [TableSink(scratch + "/cells", opts)], rejects=RejectSink(scratch + "/rejects"), enrich=hook)
    msgs = spark.createDataFrame(
        [(b"k", b'{"id":"1","rv39":"eu"}', "t", 0, 1, None)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp",
    )
    job.process_batch(msgs, 0)
    got = {r["qualifier"]: r["value"] for r in read_cells(spark, scratch + "/cells").collect()}
    assert got == {"id": "1", "rv39": "eu", "region": "EU"}


def test_bad_and_null_payloads_become_rejects(spark, scratch):
    opts = FanoutOptions(send_to_table=True, send_to_index=True)
    job = FanoutJob(opts, [TableSink(scratch + "/cells", opts), IndexSink(scratch + "/index", opts)], rejects=RejectSink(scratch + "/rejects"))
    rows = [
        (b"a", b"not json"),
        (b"b", b'{"a":'),
        (b"c", b"[]"),
        (b"d", None),
        (b"e", b'{"rv39":"t"}'),
        (b"f", b'{"id":"1","rv39":"t"}'),
    ]
    msgs = spark.createDataFrame(
        [(k, v, "t", 0, i, None) for i, (k, v) in enumerate(rows)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp",
    )
    job.process_batch(msgs, 0)
    rej = {bytes(r["key"]).decode(): r["reason"] for r in read_records(spark, scratch + "/rejects").collect()}
    assert rej == {"a": "decode", "b": "decode", "c": "decode", "d": "null_payload", "e": "no_doc_id"}
    # the event without an id is no document, but a row of the table all the same
    assert read_cells(spark, scratch + "/cells").count() == 2
    assert read_latest(spark, scratch + "/index").count() == 1


def test_command_line_stream_and_bulk(spark, sf_small, scratch, log):
    from fanwrite.__main__ import main
    from fanwrite.sources.csv_events import write_csv_events
    from fanwrite.sources.tables import raw_events_from_table

    assert main(["stream", "-sendToHbase", "-sendToES", "-parallel", "--log", log, "--root", scratch + "/s", "--available-now", "--source-option", "maxFilesPerTrigger=2"]) == 0
    n_msgs = spark.read.parquet(log).count()
    n_rejects = read_records(spark, scratch + "/s/rejects").count()
    assert read_cells(spark, scratch + "/s/cells").count() + n_rejects == n_msgs
    codes = ["id", "dt", "rv39", "evt", "sun", "sev", "msg"]
    fields = raw_events_from_table(read_table(spark, sf_small, "events")).select([F.col("event")[c].alias(c) for c in codes])
    csv = write_csv_events(fields, scratch + "/csv", codes)
    assert main(["bulk", "-singleTable", "--csv", csv, "--root", scratch + "/b", "--layout", "wide"]) == 0
    cells = read_cells(spark, scratch + "/b/cells")
    assert cells.select("row_key").distinct().count() == fields.count()
    assert {r["table_name"] for r in cells.select("table_name").distinct().collect()} == {"events"}
    with pytest.raises(SystemExit):
        main(["bulk", "--csv", csv])  # an output root must be named


def test_command_line_of_offset_logs_and_mixed_headers(spark, sf_small, scratch):
    from fanwrite.__main__ import main
    from fanwrite.sources.offset_log import write_offset_log
    from fanwrite.streaming.progress import read_progress

    messages = messages_from_events(events_from_table(read_table(spark, sf_small, "events")), partitions=2)
    write_offset_log(messages.union(messages.where("offset % 10 = 0").withColumn("offset", F.col("offset") + 5000)), scratch + "/log")
    args = ["stream", "-singleTable", "-sendToHbase", "-sendToES", "--offset-log", scratch + "/log", "--root", scratch + "/s", "--available-now"]
    assert main([*args, "--source-option", "maxOffsetsPerTrigger=500"]) == 0
    first = read_progress(spark, scratch + "/s/progress").collect()
    assert len(first) == 1 and 0 < first[0]["input_rows"] <= 500
    assert main(args) == 0
    assert sum(r["input_rows"] for r in read_progress(spark, scratch + "/s/progress").collect()) == 1100
    assert read_cells(spark, scratch + "/s/cells").count() == 1100
    assert main([*args[:-2], scratch + "/r", "--available-now", "--without-repeats", "60 days"]) == 0
    assert read_cells(spark, scratch + "/r/cells").count() == 1100  # another offset is another message
    os.makedirs(scratch + "/csv")
    for name, text in (("a", "E(id),T(rv39)\n1,x\n"), ("b", "T(rv39),E(id)\ny,2\n")):
        with open(f"{scratch}/csv/{name}.csv", "w") as f:
            f.write(text)
    assert main(["bulk", "--csv", scratch + "/csv", "--mixed-headers", "--root", scratch + "/b"]) == 0
    assert sorted(r["table_name"] for r in read_cells(spark, scratch + "/b/cells").collect()) == ["events-x", "events-y"]


def test_stop_while_running_then_resume(spark, sf_small, scratch, log):
    opts = FanoutOptions(row_key="id", send_to_table=True, send_to_index=True)
    job = FanoutJob(opts, [TableSink(scratch + "/cells", opts), IndexSink(scratch + "/index", opts)], rejects=RejectSink(scratch + "/rejects"))
    running = job.start(message_log_stream(spark, log, max_files_per_trigger=1), scratch + "/ckpt", trigger={"processingTime": "0 seconds"})
    stop_after_batches(running, job, 1, timeout_seconds=300)
    assert not running.isActive
    run_until_done(job.start(message_log_stream(spark, log, max_files_per_trigger=1), scratch + "/ckpt", trigger={"availableNow": True}), 300)
    assert rows_of(read_cells(spark, scratch + "/cells").select(*CELLS)) == batch_cells(spark, sf_small, opts)


def test_last_batch_reports_rows_and_rate(spark, scratch):
    opts = FanoutOptions(send_to_table=True)
    job = FanoutJob(opts, [TableSink(scratch + "/cells", opts)], rejects=RejectSink(scratch + "/rejects"))
    msgs = spark.createDataFrame(
        [(b"k", b'{"id":"%d","rv39":"t"}' % i, "t", 0, i, None) for i in range(7)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp",
    )
    job.process_batch(msgs, 0)
    t = job.last_timings
    assert (job.batches, job.rows) == (1, 7) and t["rows"] == 7 and t["events_per_second"] > 0 and t["table"] > 0


def test_custom_sink_that_writes_nothing_does_not_hang(spark, scratch):
    class NullSink:
        name, root = "null", scratch + "/null"

        def write(self, df, batch_id):
            return None

        def stats(self, df, seconds):
            return TableSink(self.root, FanoutOptions()).stats(df, seconds)

    job = FanoutJob(FanoutOptions(), [NullSink()], rejects=RejectSink(scratch + "/rejects"))
    msgs = spark.createDataFrame(
        [(b"a", b"oops", "t", 0, 0, None), (b"b", b'{"id":"1"}', "t", 0, 1, None)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp",
    )
    job.process_batch(msgs, 0)
    assert [r["reason"] for r in read_records(spark, scratch + "/rejects").collect()] == ["decode"]


MESSAGES = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"


def test_rejects_need_a_sink_and_fail_fails_for_every_reason(spark, scratch):
    opts = FanoutOptions(send_to_table=True, send_to_index=True)
    table, index = TableSink(scratch + "/cells", opts), IndexSink(scratch + "/index", opts)
    with pytest.raises(ValueError, match="reject sink"):
        FanoutJob(opts, [table])
    strict = FanoutOptions(send_to_table=True, send_to_index=True, on_bad="fail")
    for payload in (None, b"no", b'{"rv39":"no id"}', b'{"id":"1","id":"2"}', b'{"id":"1"} junk'):
        msgs = spark.createDataFrame([(b"a", b'{"id":"1"}', "t", 0, 0, None), (b"b", payload, "t", 0, 1, None)], MESSAGES)
        with pytest.raises(Exception, match="bad row"):
            FanoutJob(strict, [table, index]).process_batch(msgs, 0)


def test_repeated_keys_and_trailing_text_are_rejects(spark, scratch):
    opts = FanoutOptions(send_to_table=True)
    job = FanoutJob(opts, [TableSink(scratch + "/cells", opts)], rejects=RejectSink(scratch + "/rejects"))
    payloads = {
        "good": b' {"id":"1"} ', "twice": b'{"id":"1","id":"2"}', "two": b'{"id":"1"}{"id":"2"}', "list": b'{"id":"1"},{"id":"2"}',
        "junk": b'{"id":"3"} junk', "closing": b'{"id":"3"}] junk', "bracket": b'],[{"id":"3"}', "empty": b"", "null": b"null",
        "forged": b'{"id":"3"},{"\\u0001end-of-payload":""}] ',
    }
    msgs = spark.createDataFrame([(k.encode(), v, "t", 0, i, None) for i, (k, v) in enumerate(payloads.items())], MESSAGES)
    job.process_batch(msgs, 0)
    got = {bytes(r["key"]).decode(): r["reason"] for r in read_records(spark, scratch + "/rejects").collect()}
    assert got == {k: "duplicate_field" if k == "twice" else "decode" for k in payloads if k != "good"}
    assert read_cells(spark, scratch + "/cells").count() == 1


class ContextSink:
    """Notes a local property of the thread that writes."""

    def __init__(self, name, seen, error=None):
        self.name, self.root, self.seen, self.error = name, name, seen, error

    def write(self, df, batch_id):
        self.seen[self.name] = df.sparkSession.sparkContext.getLocalProperty("fanwrite.test")
        df.count()
        if self.error:
            raise RuntimeError(self.error)


def test_parallel_sinks_inherit_the_job_context_and_report_all_errors(spark, scratch):
    opts = FanoutOptions(send_to_table=True, parallel=True, on_bad="fail")
    seen = {}
    msgs = spark.createDataFrame([(b"a", b'{"id":"1"}', "t", 0, 0, None)], MESSAGES)
    spark.sparkContext.setLocalProperty("fanwrite.test", "here")
    try:
        FanoutJob(opts, [ContextSink("x", seen), ContextSink("y", seen)]).process_batch(msgs, 0)
        assert seen == {"x": "here", "y": "here"}
        with pytest.raises(RuntimeError, match="one") as failure:
            FanoutJob(opts, [ContextSink("x", seen, "one"), ContextSink("y", seen, "two")]).process_batch(msgs, 0)
        assert "two" in failure.value.__notes__[0]
    finally:
        spark.sparkContext.setLocalProperty("fanwrite.test", None)


def test_event_field_named_like_a_message_column_is_read_from_the_event(spark):
    from fanwrite.operators.decode import decode_messages

    msgs = spark.createDataFrame([(b"k", b'{"id":"1","topic":"fromevent","key":"x"}', "t", 0, 0, None)], MESSAGES)
    for field, table in (("topic", "events-fromevent"), ("key", "events-x"), ("partition", "unrouted")):
        assert prepare(decode_messages(msgs), FanoutOptions(tenant_field=field)).first()["table_name"] == table


def test_a_streams_cached_batch_is_split_within_a_table(spark, scratch):
    # One table holds all rows; the rebalance before the cache must not leave it to one task.
    ids = spark.range(0, 40000, 1, 8)
    event = F.create_map(F.lit("id"), F.col("id").cast("string"), F.lit("rv39"), F.lit("only"), F.lit("p"), F.sha2(F.col("id").cast("string"), 256))
    events = ids.select(F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), event.alias("event"))
    log = write_message_log(messages_from_events(events), scratch + "/log", 8)
    opts = FanoutOptions(row_key="id", send_to_table=True, send_to_index=True, layout="blob")
    job = FanoutJob(opts, [TableSink(scratch + "/cells", opts), IndexSink(scratch + "/index", opts)], rejects=RejectSink(scratch + "/rejects"))
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        run_until_done(job.start(message_log_stream(spark, log), scratch + "/ckpt", trigger={"availableNow": True}), 300)
        assert spark.conf.get("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning") == "false"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for sink, reader in (("cells", read_cells), ("index", read_latest)):
        files = [f for _, _, names in os.walk(f"{scratch}/{sink}") for f in names if f.endswith(".parquet")]
        assert len(files) > 3, (sink, files)
        assert reader(spark, f"{scratch}/{sink}").count() == 40000
