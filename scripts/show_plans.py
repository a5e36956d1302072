"""Write the executed physical plans of the headline queries to PLANS.md.

    python scripts/show_plans.py [sf_dir]

Each query runs once at small scale (so AQE shows its final plan, with
codegen ids), then its plan is printed in the ``formatted`` form.  The write
paths (table sink, index sink) are shown as the DataFrames the sinks write.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NOTES = {
    "wide_cells": "scan -> (spread) -> build map, enrich, route, key -> explode_outer + filter; one codegen span after the map projection",
    "route_counts": "only `event_type` is read (tenant lifted from source columns); partial + final HashAggregate",
    "tenant_filter": "the implied source predicate `event_type = purchase` is pushed to the parquet scan (PushedFilters); the exact tenant filter runs before any map is built",
    "decode_events": "from_json once, in a one-row generator; the good-row filter sits above it",
    "table_sink_write": "per-tenant write: REBALANCE on table_name before the explode (AQE sizes files, splits hot tenants)",
    "index_latest": "latest wins: partial max_by per task before the shuffle on doc_id, final max_by after",
    "index_bucketed_latest": "the same from hash buckets: no exchange, the scan's own partitioning is used",
    "index_bucketed_point": "one document: one bucket of the scan (SelectedBucketsCount)",
    "sorted_row": "one row key: the folders of its key range (PartitionFilters), then row groups by PushedFilters and bloom filters",
    "tenant_set_cells": "a set of tenants: dynamic pruning of the table folders by a broadcast whose size was checked",
    "lookup_enrich": "the lookup table reduced to one row a key, broadcast after a count of rows and bytes",
    "csv_mixed_headers": "each line joined to its own file's header codes by `_metadata.file_path`",
    "stream_batch": "one micro-batch as FanoutJob caches it: decode (generator), prepare, one REBALANCE on table_name; "
    "every sink reads this cache",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from fanwrite.plans import catalog as c
    from fanwrite.session import local_session, scratch_dir
    from fanwrite.sinks import IndexSink, RejectSink, TableSink, read_latest

    spark = local_session()
    frames = {
        "wide_cells": c.q_wide_cells(spark, sf_dir),
        "route_counts": c.q_route_counts(spark, sf_dir),
        "tenant_filter": c.q_tenant_filter(spark, sf_dir),
        "decode_events": c.q_decode_events(spark, sf_dir),
    }
    opts = c._opts(layout="wide")
    frames["table_sink_write"] = TableSink("unused", opts).cells(c._prepared(spark, sf_dir, opts))
    root = scratch_dir(spark, "plans-index")
    IndexSink(root, opts, order_by=("ts", "event_id")).write(c._prepared(spark, sf_dir, opts), 0)
    frames["index_latest"] = read_latest(spark, root)

    from fanwrite.plans import keyed_catalog as k
    from fanwrite.sinks.bucketed_index import BucketedIndexSink, read_latest_bucketed
    from fanwrite.sinks.sorted_table import read_row, read_sorted_cells

    buckets = scratch_dir(spark, "plans-buckets")
    BucketedIndexSink(buckets, opts, "plans_index", buckets=16, order_by=("ts", "event_id")).write(c._prepared(spark, sf_dir, opts), 0)
    frames["index_bucketed_latest"] = read_latest_bucketed(spark, buckets, "plans_index")
    frames["index_bucketed_point"] = read_latest_bucketed(spark, buckets, "plans_index", doc_id="7")
    cells = k._sorted_cells(spark, sf_dir)
    frames["sorted_row"] = read_row(spark, cells, read_sorted_cells(spark, cells).first()["row_key"])
    for name in ("tenant_set_cells", "lookup_enrich", "csv_mixed_headers"):
        frames[name] = k.QUERIES[name](spark, sf_dir)

    from pyspark.sql import functions as F

    from fanwrite.sources.messages import message_log
    from fanwrite.streaming import FanoutJob

    stream_opts = c._opts(send_to_table=True, send_to_index=True, layout="wide")
    job = FanoutJob(stream_opts, [TableSink("unused", stream_opts), IndexSink("unused", stream_opts)], rejects=RejectSink("unused"))
    batch = message_log(spark, c._message_log(spark, sf_dir))
    frames["stream_batch"] = job.prepared(batch).hint("rebalance", "table_name").filter(F.col("reason").isNull())

    out = ["# PLANS", "", f"Executed physical plans (AQE final) of the headline queries on `{sf_dir}`, "
           "written by `scripts/show_plans.py`.", ""]
    for name, df in frames.items():
        # collect() runs this DataFrame's own query execution, so explain()
        # then prints AQE's final plan (a small-scale diagnostic only).
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        out += [f"## {name}", "", NOTES.get(name, ""), "", "```", buf.getvalue().rstrip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out) + "\n")
    print(f"wrote {path}")


if __name__ == "__main__":
    main()
