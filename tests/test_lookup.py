"""Lookup enrichment: unmatched, repeated and missing keys, both join forms, streams."""

import pytest
from pyspark.sql import functions as F

from fanwrite.operators.lookup import is_small, lookup_enrichment, one_per_key
from fanwrite.options import FanoutOptions
from fanwrite.plans.fanout import prepare

EVENTS = [
    (1, {"sun": "1", "seg": "own", "x": "y"}),
    (2, {"sun": "2"}),
    (3, {"sun": "9"}),  # no match
    (4, {"x": "no user"}),
    (5, {"sun": ""}),
    (6, None),
    (7, {"sun": "3", "seg": "own"}),
]
ROWS = [(1, "old", "n1", 1), (1, "new", "n1", 2), (2, "a", None, 5), (2, "b", None, 5), (3, "", "n3", 1), (None, "null", "n", 9), (4, None, None, None)]
WANT = {
    1: {"sun": "1", "seg": "new", "cn": "n1", "x": "y"},
    2: {"sun": "2", "seg": "b"},
    3: {"sun": "9"},
    4: {"x": "no user"},
    5: {"sun": ""},
    6: None,
    7: {"sun": "3", "seg": "own", "cn": "n3"},
}


@pytest.fixture()
def events(spark):
    return spark.createDataFrame(EVENTS, "event_id bigint, event map<string,string>")


@pytest.fixture()
def table(spark):
    return spark.createDataFrame(ROWS, "k bigint, segment string, name string, version bigint")


def hook(table, **kw):
    return lookup_enrichment(table, "k", on="sun", fields={"seg": "segment", "cn": "name"}, order_by="version", **kw)


@pytest.mark.parametrize("max_rows, join", [(1000, "BroadcastHashJoin"), (2, "SortMergeJoin")])
def test_both_forms(spark, events, table, max_rows, join):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, -1)  # what the library decides, not what Spark would
    try:
        out = events.transform(hook(table, max_rows=max_rows))
        assert out.columns == events.columns
        assert {r["event_id"]: r["event"] for r in out.collect()} == WANT and out.count() == len(EVENTS)
        assert join in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(threshold)


def test_size_is_checked_in_rows_and_bytes(spark, table):
    rows = one_per_key(table, F.col("k"), {"seg": "segment"})
    assert rows.count() == 4
    assert is_small(rows, 4, 1000) and not is_small(rows, 3, 1000) and not is_small(rows, 4, 10)
    empty = table.where("false")
    assert is_small(one_per_key(empty, F.col("k"), {"seg": "segment"}), 0, 0)


def test_without_an_order_the_greatest_values_count(spark, table):
    found = {r["lookup_key"]: r["looked_up"]["seg"] for r in one_per_key(table, F.col("k"), {"seg": "segment"}).collect()}
    assert found == {"1": "old", "2": "b", "3": "", "4": None}


def test_empty_table_changes_nothing(spark, events, table):
    out = events.transform(hook(table.where("false")))
    assert {r["event_id"]: r["event"] for r in out.collect()} == dict(EVENTS)


def test_cached_lookup_is_read_once(spark, events, table, scratch):
    table.write.parquet(scratch + "/t")
    enrich = hook(spark.read.parquet(scratch + "/t"), cached=True)
    assert {r["event_id"]: r["event"] for r in events.transform(enrich).collect()} == WANT
    assert "InMemoryTableScan" in events.transform(enrich)._jdf.queryExecution().executedPlan().toString()


def test_as_the_hook_of_a_job(spark, events, table):
    out = prepare(events, FanoutOptions(row_key="blob", tenant_field="seg"), enrich=hook(table))
    assert {r["event_id"]: r["table_name"] for r in out.collect() if r["event"] is not None} == {
        1: "events-new", 2: "events-b", 3: "unrouted", 4: "unrouted", 5: "unrouted", 7: "events-own",
    }
