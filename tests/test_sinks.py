"""Sinks: replay safety, latest-wins, routing by partition, bulk load counts."""

import os

import pytest
from pyspark.sql import functions as F

from fanwrite.operators.decode import decode_messages, good
from fanwrite.operators.layout import wide_cells
from fanwrite.options import FanoutOptions
from fanwrite.plans.bulk import bulk_load
from fanwrite.plans.fanout import prepare
from fanwrite.sinks import IndexSink, RejectSink, TableSink, read_cells, read_latest, read_records
from fanwrite.sinks.fs import batch_ids

from frames import rows_of

MAP = "map<string,string>"


def events_df(spark, rows):
    """rows: list of (event dict, ts text, offset)."""
    return spark.createDataFrame(rows, f"event {MAP}, ts string, offset long").withColumn("ts", F.to_timestamp("ts"))


def test_same_batch_twice_gives_same_rows(spark, scratch):
    opts = FanoutOptions(layout="wide", row_key="id")
    ev = prepare(events_df(spark, [({"id": "1", "rv39": "a", "x": "1"}, "2024-01-01 00:00:00", 1)]), opts)
    sink = TableSink(scratch + "/cells", opts)
    sink.write(ev, 7)
    once = rows_of(read_cells(spark, scratch + "/cells"))
    sink.write(ev, 7)
    assert rows_of(read_cells(spark, scratch + "/cells")) == once
    assert len(once) == 4  # id, rv39, x, obscountry


def test_missing_tenant_goes_to_unrouted_table(spark, scratch):
    opts = FanoutOptions(row_key="id")
    ev = prepare(events_df(spark, [({"id": "1"}, "2024-01-01 00:00:00", 1), ({"id": "2", "rv39": "t"}, "2024-01-01 00:00:00", 2)]), opts)
    TableSink(scratch, opts).write(ev, 0)
    assert rows_of(read_cells(spark, scratch), "table_name") == [("events-t",), ("unrouted",)]


def test_tenant_with_path_characters_reads_back_by_equality(spark, scratch):
    opts = FanoutOptions(row_key="id")
    weird = "a/b=c d%:ü"
    ev = prepare(events_df(spark, [({"id": "1", "rv39": weird}, "2024-01-01 00:00:00", 1)]), opts)
    TableSink(scratch, opts).write(ev, 0)
    got = read_cells(spark, scratch, table=f"events-{weird}")
    assert got.count() == 1
    assert got.first()["value"].startswith("{id=1")


def test_table_filter_prunes_partitions(spark, scratch):
    opts = FanoutOptions(row_key="id")
    ev = prepare(events_df(spark, [({"id": str(i), "rv39": f"t{i % 3}"}, "2024-01-01 00:00:00", i) for i in range(30)]), opts)
    TableSink(scratch, opts).write(ev, 0)
    df = read_cells(spark, scratch, table="events-t1")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "events-t1" in plan
    assert df.count() == 10


def test_index_latest_version_wins_across_batches(spark, scratch):
    opts = FanoutOptions(row_key="id")
    sink = IndexSink(scratch, opts, order_by=("ts", "offset"))
    b0 = prepare(events_df(spark, [({"id": "u1", "v": "old"}, "2024-01-01 00:00:00", 1), ({"id": "u2", "v": "only"}, "2024-01-01 00:00:00", 2)]), opts)
    b1 = prepare(events_df(spark, [({"id": "u1", "v": "new"}, "2024-01-02 00:00:00", 3)]), opts)
    sink.write(b0, 0)
    sink.write(b1, 1)
    docs = {r["doc_id"]: r["event"]["v"] for r in read_latest(spark, scratch).collect()}
    assert docs == {"u1": "new", "u2": "only"}


def test_index_order_within_batch_uses_version_columns(spark, scratch):
    opts = FanoutOptions(row_key="id")
    sink = IndexSink(scratch, opts, order_by=("ts", "offset"))
    rows = [({"id": "u", "v": str(i)}, "2024-01-01 00:00:00", i) for i in range(50)]
    sink.write(prepare(events_df(spark, rows), opts), 0)
    assert read_latest(spark, scratch).first()["event"]["v"] == "49"


def test_batch_first_false_uses_data_order_across_batches(spark, scratch):
    opts = FanoutOptions(row_key="id")
    sink = IndexSink(scratch, opts, order_by=("ts",), batch_first=False)
    sink.write(prepare(events_df(spark, [({"id": "u", "v": "late-arriving-new"}, "2024-01-05 00:00:00", 1)]), opts), 0)
    sink.write(prepare(events_df(spark, [({"id": "u", "v": "old"}, "2024-01-01 00:00:00", 2)]), opts), 1)
    assert read_latest(spark, scratch).first()["event"]["v"] == "late-arriving-new"


def test_rewriting_an_old_batch_replaces_its_versions(spark, scratch):
    opts = FanoutOptions(row_key="id")
    sink = IndexSink(scratch, opts, order_by=("ts", "offset"))
    for b in range(3):
        rows = [({"id": f"u{i}", "v": f"{b}-{i}"}, f"2024-01-0{b + 1} 00:00:00", b * 10 + i) for i in range(3 - b)]
        sink.write(prepare(events_df(spark, rows), opts), b)
    sink.write(prepare(events_df(spark, [({"id": "u2", "v": "again"}, "2024-01-01 00:00:00", 9)]), opts), 0)
    got = dict(rows_of(read_latest(spark, scratch).select("doc_id", F.col("event")["v"].alias("v"))))
    assert got == {"u0": "2-0", "u1": "1-1", "u2": "again"}


def test_connector_gets_flat_documents_the_latest_of_each_id(spark, scratch):
    import glob
    import json

    opts = FanoutOptions(row_key="id", enrich={})
    sink = IndexSink("", opts, order_by=("ts",), connector="json", connector_options={"path": scratch + "/docs"}, fields=("id", "v", "w"))
    rows = [({"id": "u", "v": "new"}, "2024-01-05 00:00:00", 1), ({"id": "u", "v": "old", "w": "x"}, "2024-01-01 00:00:00", 2), ({"id": "z", "w": "y"}, "2024-01-01 00:00:00", 3)]
    sink.write(prepare(events_df(spark, rows), opts), 0)
    docs = [json.loads(line) for f in glob.glob(scratch + "/docs/*.json") for line in open(f)]
    assert sorted(docs, key=str) == [{"doc_id": "u", "id": "u", "v": "new"}, {"doc_id": "z", "id": "z", "w": "y"}]
    with pytest.raises(ValueError, match="fields"):
        IndexSink("", opts, connector="json")


def test_index_errors_log_or_raise(spark, scratch):
    ev = prepare(events_df(spark, [({"id": "1"}, "2024-01-01 00:00:00", 1)]), FanoutOptions())
    bad_connector = dict(connector="no.such.format", fields=("id",))
    IndexSink(scratch, FanoutOptions(index_errors="log"), order_by=("ts",), **bad_connector).write(ev, 0)
    with pytest.raises(Exception):
        IndexSink(scratch, FanoutOptions(), order_by=("ts",), **bad_connector).write(ev, 0)


def test_bulk_load_writes_every_row(spark, scratch):
    # 5,001 events, 5,000 per file: every row lands, in two files.
    df = spark.range(5001).select(F.create_map(F.lit("id"), F.col("id").cast("string")).alias("event"))
    opts = FanoutOptions(single_table=True, layout="wide", row_key="id", max_records_per_file=5000, file_layout="rebalance")
    bulk_load(df, scratch, opts, load_id=0)
    cells = read_cells(spark, scratch)
    assert cells.filter(F.col("qualifier") == "id").count() == 5001
    assert cells.select("row_key").distinct().count() == 5001
    assert batch_ids(spark, scratch) == [0]


def test_wide_cells_count_equals_sum_of_map_sizes(spark, sf_small):
    from fanwrite.sources.tables import events_from_table, read_table

    ev = prepare(events_from_table(read_table(spark, sf_small, "events")), FanoutOptions(row_key="id"))
    total = ev.select(F.sum(F.size("event"))).first()[0]
    assert wide_cells(ev).count() == total


def test_decode_good_plus_rejects_equals_messages(spark, sf_small):
    from fanwrite.sources.messages import messages_from_events
    from fanwrite.sources.tables import events_from_table, read_table

    msgs = messages_from_events(events_from_table(read_table(spark, sf_small, "events")), legacy=F.col("event")["evt"] == "view")
    dec = decode_messages(msgs)
    n, n_good, n_bad = msgs.count(), good(dec).count(), dec.filter(F.col("reason").isNotNull()).count()
    assert n_good + n_bad == n and n_bad > 0


def test_bulk_load_report_counts_without_extra_job(spark, scratch):
    df = spark.range(1234).select(
        F.create_map(F.lit("id"), F.col("id").cast("string"), F.lit("e"), F.lit("")).alias("event")
    )
    rep = bulk_load(df, scratch, FanoutOptions(single_table=True, layout="wide", row_key="id"), load_id=3)
    assert (rep.events, rep.cells) == (1234, 2468)  # id and obscountry; the empty field is dropped
    assert rep.events_per_second is None or rep.events_per_second > 0
    assert read_cells(spark, scratch).count() == 2468


class _StubContext:
    def __init__(self, master, conf_dir=None):
        self.master = master
        self._conf = {"spark.checkpoint.dir": conf_dir} if conf_dir else {}

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return None


class _StubSession:
    def __init__(self, master, conf_dir=None):
        self.sparkContext = _StubContext(master, conf_dir)


def test_shared_root_comes_from_the_session_and_is_required_on_a_cluster():
    from fanwrite.session import shared_root

    assert shared_root(_StubSession("spark://head:7077", "hdfs://nn/shared/ck/")) == "hdfs://nn/shared/ck"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(_StubSession("yarn"))


def test_reload_with_dynamic_overwrite_set_leaves_no_old_tables(spark, scratch):
    opts = FanoutOptions(row_key="id")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sink = TableSink(scratch, opts)
        for tenant in ("a", "b"):
            sink.write(prepare(events_df(spark, [({"id": "1", "rv39": tenant}, "2024-01-01 00:00:00", 1)]), opts), 0)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert rows_of(read_cells(spark, scratch), "table_name") == [("events-b",)]


def test_other_formats_read_back(spark, scratch):
    opts = FanoutOptions(row_key="id")
    TableSink(scratch, opts, fmt="orc").write(prepare(events_df(spark, [({"id": "1", "rv39": "t"}, "2024-01-01 00:00:00", 1)]), opts), 0)
    assert read_cells(spark, scratch, fmt="orc").first()["table_name"] == "events-t"


def test_bulk_load_sets_bad_rows_aside_and_guards_load_ids(spark, scratch):
    opts = FanoutOptions(row_key="id")
    rows = [({"id": "1"}, None), (None, None), ({"id": "2"}, "csv_long_row")]
    events = spark.createDataFrame(rows, f"event {MAP}, reason string")
    with pytest.raises(Exception, match="bad row"):
        bulk_load(events, scratch + "/none", opts)
    rejects = RejectSink(scratch + "/rejects")
    report = bulk_load(events, scratch + "/cells", opts, rejects=rejects)
    assert (report.events, report.cells, report.rejects, report.load_id) == (1, 1, 2, 0)
    assert rows_of(read_records(spark, scratch + "/rejects"), "reason") == [("csv_long_row",), ("null_event",)]
    good = events.filter("event IS NOT NULL AND reason IS NULL")
    assert bulk_load(good, scratch + "/cells", opts).load_id == 1
    with pytest.raises(ValueError, match="already"):
        bulk_load(good, scratch + "/cells", opts, load_id=1)
    assert bulk_load(good, scratch + "/cells", opts, load_id=1, replace=True).load_id == 1
    assert read_cells(spark, scratch + "/cells").count() == 2
