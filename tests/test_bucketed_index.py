"""Documents in buckets: no exchange, one bucket a point read, replay, a new session."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from fanwrite.options import FanoutOptions
from fanwrite.sinks import IndexSink, read_latest
from fanwrite.sinks.bucketed_index import BucketedIndexSink, read_latest_bucketed

ORDER = ("ts", "event_id")


def events(spark, rows):
    table = spark.createDataFrame([(d, v, t, v) for d, v, t in rows], "doc_id string, event_id bigint, s bigint, n bigint")
    return table.select("doc_id", "event_id", F.timestamp_seconds("s").alias("ts"), F.create_map(F.lit("n"), F.col("n").cast("string")).alias("event"))


def docs(df):
    return sorted((r["doc_id"], r["event"]["n"], r["batch_id"]) for r in df.collect())


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


BATCHES = [[(f"d{i % 7}", i, 100 - i) for i in range(40)] + [(None, 99, 1)], [(f"d{i % 9}", i, 100 + i) for i in range(50, 60)], [("d1", 70, 5)]]


@pytest.fixture()
def table():
    return "t_" + uuid.uuid4().hex[:8]


@pytest.mark.parametrize("batch_first", [True, False])
def test_same_documents_as_the_plain_index(spark, scratch, table, batch_first):
    opts = FanoutOptions()
    bucketed = BucketedIndexSink(scratch + "/b", opts, table, buckets=4, order_by=ORDER, batch_first=batch_first)
    plain = IndexSink(scratch + "/p", opts, order_by=ORDER, batch_first=batch_first)
    for b, rows in enumerate(BATCHES):
        for sink in (bucketed, plain):
            sink.write(events(spark, rows), b)
    want = docs(read_latest(spark, scratch + "/p"))
    assert docs(read_latest_bucketed(spark, scratch + "/b", table)) == want
    # a replay replaces its batch, also by fewer rows or none
    bucketed.write(events(spark, BATCHES[1]), 1)
    assert docs(read_latest_bucketed(spark, scratch + "/b", table)) == want
    bucketed.write(events(spark, []), 1)
    plain.write(events(spark, []), 1)
    assert docs(read_latest_bucketed(spark, scratch + "/b", table)) == docs(read_latest(spark, scratch + "/p")) != want


def test_reads_neither_shuffle_nor_open_other_buckets(spark, scratch, table):
    sink = BucketedIndexSink(scratch, FanoutOptions(), table, buckets=8, order_by=ORDER)
    for b, rows in enumerate(BATCHES):
        sink.write(events(spark, rows), b)
    every = plan(read_latest_bucketed(spark, scratch, table))
    assert "Exchange" not in every and "SelectedBucketsCount: 8 out of 8" in every
    one = read_latest_bucketed(spark, scratch, table, doc_id="d1")
    assert docs(one) == [("d1", "70", 2)]
    assert "Exchange" not in plan(one) and re.search(r"SelectedBucketsCount: 1 out of 8", plan(one))
    files = spark.table(table).where("batch_id = 0").inputFiles()
    assert len(files) <= 8


def test_hot_document_is_one_row_before_it_is_dealt(spark, scratch, table):
    sink = BucketedIndexSink(scratch, FanoutOptions(), table, buckets=4, order_by=ORDER)
    sink.write(events(spark, [("hot", i, i) for i in range(500)] + [("cold", 1, 1)]), 0)
    assert spark.table(table).count() == 2


def test_another_session_declares_the_table_again(spark, scratch, table):
    sink = BucketedIndexSink(scratch, FanoutOptions(), table, buckets=4, order_by=ORDER)
    for b, rows in enumerate(BATCHES):
        sink.write(events(spark, rows), b)
    want = docs(read_latest_bucketed(spark, scratch, table))
    spark.sql(f"DROP TABLE {table}")
    assert docs(read_latest_bucketed(spark, scratch, table)) == want
    assert "Exchange" not in plan(read_latest_bucketed(spark, scratch, table))
    spark.sql(f"DROP TABLE {table}")
    sink.write(events(spark, [("new", 80, 1)]), 3)  # a restarted job goes on writing
    assert docs(read_latest_bucketed(spark, scratch, table)) == sorted([*want, ("new", "80", 3)])


def test_number_of_buckets_stays(spark, scratch, table):
    BucketedIndexSink(scratch, FanoutOptions(), table, buckets=4, order_by=ORDER).write(events(spark, BATCHES[0]), 0)
    with pytest.raises(ValueError, match="keeps its number"):
        BucketedIndexSink(scratch, FanoutOptions(), table + "x", buckets=8, order_by=ORDER).write(events(spark, BATCHES[1]), 1)
    with pytest.raises(ValueError, match="no bucketed index"):
        read_latest_bucketed(spark, scratch + "/nothing", table + "y")
