"""Progress records and sketches of distinct values."""

import pytest
from pyspark.sql import functions as F

from fanwrite.operators.sketches import SketchSink, distinct_values, relative_error
from fanwrite.options import FanoutOptions
from fanwrite.plans.fanout import prepare
from fanwrite.sinks import IndexSink, RejectSink, StatsSink, TableSink, read_records
from fanwrite.sources.messages import message_log_stream, messages_from_events, write_message_log
from fanwrite.sources.tables import events_from_table, read_table
from fanwrite.streaming import FanoutJob, run_until_done
from fanwrite.streaming.progress import ProgressLog, read_progress

ONCE = {"availableNow": True}


def test_progress_agrees_with_the_statistics(spark, sf_small, scratch):
    events = events_from_table(read_table(spark, sf_small, "events"))
    write_message_log(messages_from_events(events), scratch + "/log", files=3)
    opts = FanoutOptions(row_key="id")
    sinks = [TableSink(scratch + "/cells", opts), IndexSink(scratch + "/index", opts), SketchSink(scratch + "/sketch", "sun")]
    job = FanoutJob(opts, sinks, rejects=RejectSink(scratch + "/rejects"), stats=StatsSink(scratch + "/stats"))
    log = ProgressLog(spark, scratch + "/progress").start()
    try:
        run_until_done(job.start(message_log_stream(spark, scratch + "/log", 1), scratch + "/ckpt", trigger=ONCE, query_name="fan"), 300)
    finally:
        log.stop()
    assert log.errors == []
    records = read_progress(spark, scratch + "/progress").collect()
    stats = read_records(spark, scratch + "/stats").where("sink = 'index'")
    assert {r["batch_id"]: r["input_rows"] for r in records} == {r["batch_id"]: r["row_count"] for r in stats.collect()}
    assert {r["query_name"] for r in records} == {"fan"} and len({r["run_id"] for r in records}) == 1
    assert all(r["batch_ms"] > 0 and r["processed_rows_per_second"] > 0 and r["durations_ms"]["addBatch"] > 0 for r in records)
    # the sketch is a sink among the others
    assert distinct_values(spark, scratch + "/sketch").first()["row_count"] == 1000
    assert read_progress(spark, scratch + "/nothing").count() == 0


def test_a_failing_record_does_not_end_the_query(spark, scratch):
    log = ProgressLog(spark, "nosuchscheme://x/y").start()
    try:
        write_message_log(messages_from_events(spark.range(3).select(F.col("id").alias("event_id"), F.current_timestamp().alias("ts"), F.create_map(F.lit("id"), F.lit("1")).alias("event"))), scratch + "/log")
        query = message_log_stream(spark, scratch + "/log").writeStream.format("parquet").option("checkpointLocation", scratch + "/ckpt").trigger(**ONCE)
        run_until_done(query.start(scratch + "/out"), 120)
    finally:
        log.stop()
    assert spark.read.parquet(scratch + "/out").count() == 3 and len(log.errors) == 1


def events(spark, n, tenants):
    rows = spark.range(n).select(F.create_map(F.lit("id"), F.col("id").cast("string"), F.lit("rv39"), (F.col("id") * 7919 % tenants).cast("string")).alias("event"))
    return prepare(rows, FanoutOptions(row_key="id", single_table=True))


@pytest.mark.parametrize("tenants", [3, 5000])
def test_sketches_of_batches_add_up(spark, scratch, tenants):
    sink = SketchSink(scratch, "rv39")
    frame = events(spark, 20000, tenants)
    for b in range(4):
        sink.write(frame.where(F.pmod(F.xxhash64("row_key"), F.lit(4)) == b), b)
    sink.write(frame.where(F.pmod(F.xxhash64("row_key"), F.lit(4)) == 2), 2)  # a replay
    found = distinct_values(spark, scratch).first()
    assert found["row_count"] == 20000
    assert abs(found["distinct_values"] - tenants) <= 3 * relative_error() * tenants
    if tenants == 3:
        assert found["distinct_values"] == 3
    some = distinct_values(spark, scratch, "table_name", where=F.col("batch_id") < 2).collect()
    assert [r["table_name"] for r in some] == ["events"] and 0 < some[0]["row_count"] < 20000


def test_sketch_of_missing_values(spark, scratch):
    sink = SketchSink(scratch, "nowhere")
    sink.write(events(spark, 10, 2), 0)
    assert tuple(distinct_values(spark, scratch).first()) == (0, 10)
