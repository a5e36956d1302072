"""The index as keyed state: changed documents per batch, rejects, replay, guards."""

import os

import pytest
from pyspark.sql import functions as F

from fanwrite.options import FanoutOptions
from fanwrite.sinks import IndexSink, RejectSink, read_latest, read_records
from fanwrite.sources.messages import message_log_stream, write_message_log
from fanwrite.streaming import run_until_done
from fanwrite.streaming.index_state import IndexChanges

from frames import rows_of

ONCE = {"availableNow": True}
SCHEMA = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


def messages(spark, rows):
    """Rows (offset, second, payload)."""
    data = [(b"k", p.encode() if p is not None else None, "t", 0, o, None) for o, _, p in rows]
    seconds = {o: s for o, s, _ in rows}
    table = spark.createDataFrame(data, SCHEMA).drop("timestamp")
    times = spark.createDataFrame([(o, s) for o, s in seconds.items()], "offset bigint, s bigint")
    return table.join(times, "offset").select("key", "value", "topic", "partition", "offset", F.timestamp_seconds("s").alias("timestamp"))


def doc(i, v):
    return f'{{"id":"{i}","v":"{v}"}}'


BATCHES = [
    [(0, 50, doc("a", 1)), (1, 40, doc("b", 1)), (2, 60, doc("a", 2)), (3, None, doc("n", 1))],
    [(4, 55, doc("a", 3)), (5, 45, doc("b", 2)), (6, 1, '{"v":"no id"}'), (7, 1, "{a=b}"), (8, 1, None)],
    [(9, 60, doc("a", 4)), (10, 10, doc("c", 1)), (11, None, doc("n", 2)), (12, 2, '{"v":"no id either"}')],
]


def run(spark, scratch, job, batches, start=0):
    for k, rows in enumerate(batches, start):
        write_message_log(messages(spark, rows), scratch + "/log", files=1, append=k > 0)
        run_until_done(job.start(message_log_stream(spark, scratch + "/log"), scratch + "/ckpt", trigger=ONCE), 300)


def job_of(scratch, **kw):
    opts = FanoutOptions(enrich={})
    return IndexChanges(opts, scratch + "/index", rejects=RejectSink(scratch + "/rejects"), **kw)


def changes(spark, scratch):
    df = spark.read.parquet(scratch + "/index")
    return sorted((r["batch_id"], r["doc_id"], r["event"]["v"]) for r in df.collect())


def test_the_data_decides(spark, scratch):
    job = job_of(scratch, order_by=("timestamp", "offset"), batch_first=False)
    run(spark, scratch, job, BATCHES)
    # a stays at version 2 until one of the same second comes later in the log;
    # versions without a time come before all others
    assert changes(spark, scratch) == [(0, "a", "2"), (0, "b", "1"), (0, "n", "1"), (1, "b", "2"), (2, "a", "4"), (2, "c", "1"), (2, "n", "2")]
    latest = read_latest(spark, scratch + "/index")
    assert sorted((r["doc_id"], r["event"]["v"]) for r in latest.collect()) == [("a", "4"), ("b", "2"), ("c", "1"), ("n", "2")]
    rejects = read_records(spark, scratch + "/rejects")
    assert rows_of(rejects, "batch_id", "reason", "offset") == [(1, "decode", 7), (1, "no_doc_id", 6), (1, "null_payload", 8), (2, "no_doc_id", 12)]
    assert {bytes(r["value"]) for r in rejects.where("reason = 'no_doc_id'").collect()} == {b'{"v":"no id"}', b'{"v":"no id either"}'}


def test_arrival_decides(spark, scratch):
    job = job_of(scratch, order_by=("timestamp", "offset"))
    run(spark, scratch, job, BATCHES)
    assert changes(spark, scratch) == [(0, "a", "2"), (0, "b", "1"), (0, "n", "1"), (1, "a", "3"), (1, "b", "2"), (2, "a", "4"), (2, "c", "1"), (2, "n", "2")]


def test_versions_keep_their_types_and_read_with_those_of_the_sink(spark, scratch):
    job = job_of(scratch, order_by=("timestamp", "offset"), batch_first=False)
    run(spark, scratch, job, BATCHES[:1])
    opts = FanoutOptions(enrich={})
    plain = IndexSink(scratch + "/plain", opts, order_by=("timestamp", "offset"), batch_first=False)
    from fanwrite.operators.decode import decode_messages, good
    from fanwrite.plans.fanout import prepare

    plain.write(prepare(good(decode_messages(messages(spark, BATCHES[0]))), opts), 0)
    columns = ("doc_id", "event", "version", "batch_id")
    key = lambda r: r["doc_id"]
    got = sorted(read_latest(spark, scratch + "/index").select(*columns).collect(), key=key)
    assert got == sorted(read_latest(spark, scratch + "/plain").select(*columns).collect(), key=key)


def test_failed_batch_is_replayed_from_the_state_before_it(spark, scratch):
    job = job_of(scratch, order_by=("timestamp", "offset"), batch_first=False)
    run(spark, scratch, job, BATCHES[:1])
    write, marker = job.write, scratch + "/failed"

    def failing(changed, batch_id):
        write(changed, batch_id)
        if not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("lost after the write")

    job.write = failing
    write_message_log(messages(spark, BATCHES[1]), scratch + "/log", files=1, append=True)
    with pytest.raises(Exception, match="lost after the write"):
        run_until_done(job.start(message_log_stream(spark, scratch + "/log"), scratch + "/ckpt", trigger=ONCE), 300)
    run(spark, scratch, job, BATCHES[2:], start=2)
    assert changes(spark, scratch) == [(0, "a", "2"), (0, "b", "1"), (0, "n", "1"), (1, "b", "2"), (2, "a", "4"), (2, "c", "1"), (2, "n", "2")]


def test_guards(spark, scratch):
    with pytest.raises(ValueError, match="reject sink"):
        IndexChanges(FanoutOptions(), scratch + "/index")
    with pytest.raises(ValueError, match="ordered"):
        IndexChanges(FanoutOptions(on_bad="fail"), scratch + "/index", order_by=())
    job = job_of(scratch)
    run(spark, scratch, job, BATCHES[:1])
    with pytest.raises(RuntimeError, match="already holds batches"):
        job.start(message_log_stream(spark, scratch + "/log"), scratch + "/other", trigger=ONCE)
    with pytest.raises(ValueError, match="can't be ordered"):
        job_of(scratch, order_by=("event",)).changes(message_log_stream(spark, scratch + "/log"))
