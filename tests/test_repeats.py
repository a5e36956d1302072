"""Repeated messages: across batches and restarts, late ones, static tables."""

from pyspark.sql import functions as F

from fanwrite.operators.repeats import without_repeats
from fanwrite.sources.messages import message_log_stream, write_message_log
from fanwrite.streaming import run_until_done
from fanwrite.streaming.progress import ProgressLog, read_progress

HOUR = 3600
DAY = 24 * HOUR  # times are counted from the second day: nothing is newer than the first watermark, 0, before it


def messages(spark, rows):
    """Rows (offset, second, value)."""
    table = spark.createDataFrame([(v.encode(), o, s) for o, s, v in rows], "value binary, offset bigint, s bigint")
    return table.select(F.lit(b"k").alias("key"), "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset", F.timestamp_seconds(F.col("s") + DAY).alias("timestamp"))


def run(spark, scratch, batches, within="1 hour"):
    for k, rows in enumerate(batches):
        write_message_log(messages(spark, rows), scratch + "/log", files=1, append=k > 0)
        once = without_repeats(message_log_stream(spark, scratch + "/log"), within)
        query = once.writeStream.format("parquet").option("checkpointLocation", scratch + "/ckpt").trigger(availableNow=True)
        run_until_done(query.start(scratch + "/out"), 300)
    return sorted((r["offset"], bytes(r["value"]).decode()) for r in spark.read.parquet(scratch + "/out").collect())


def test_repeats_in_and_across_batches_and_restarts(spark, scratch):
    batches = [
        [(1, 0, "a"), (1, 0, "a"), (2, 10, "b")],
        [(1, 0, "a"), (3, HOUR, "c"), (2, 10, "b")],
        [(3, HOUR, "c"), (4, HOUR + 1, "d"), (4, HOUR + 1, "d")],
    ]
    assert run(spark, scratch, batches) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_late_messages_are_left_out_and_counted(spark, scratch):
    log = ProgressLog(spark, scratch + "/progress").start()
    try:
        batches = [[(1, 10 * HOUR, "a")], [(2, 9 * HOUR - 1, "late"), (3, 9 * HOUR + 1, "in time")], [(1, 10 * HOUR, "a")]]
        assert run(spark, scratch, batches) == [(1, "a"), (3, "in time")]
    finally:
        log.stop()
    records = {r["batch_id"]: r for r in read_progress(spark, scratch + "/progress").collect()}
    assert not log.errors and sum(r["rows_late"] for r in records.values()) == 1
    assert sum(r["input_rows"] for r in records.values()) == 4


def test_state_is_dropped_behind_the_watermark(spark, scratch):
    log = ProgressLog(spark, scratch + "/progress").start()
    try:
        run(spark, scratch, [[(k * 10 + j, 10 * k * HOUR, "x") for j in range(10)] for k in range(4)])
    finally:
        log.stop()
    held = [r["state_rows"] for r in read_progress(spark, scratch + "/progress").orderBy("batch_id").collect()]
    assert held and max(held) <= 20  # of the newest span, not of the stream


def test_static_table(spark):
    rows = [(1, 0, "a"), (1, 0, "a"), (2, 0, "b"), (None, 0, "n"), (None, 5, "n")]
    got = without_repeats(messages(spark, rows), "1 hour").collect()
    assert sorted(str(r["offset"]) for r in got) == ["1", "2", "None"]
    assert without_repeats(messages(spark, []), "1 hour").count() == 0


def test_other_keys(spark):
    rows = [(1, 0, "a"), (2, 0, "a"), (3, 0, "b")]
    assert without_repeats(messages(spark, rows), "1 hour", by=("value",)).count() == 2
