"""Bulk load: a static table of events written through the table sink.

The same prepared plan as a stream batch, written by one Spark job.  There
is no client-side batch size: every row is written, and
``opts.max_records_per_file`` bounds file size instead.  Rows that cannot be
loaded go to a reject sink, or the load fails.  Counts come from Observations
on the rows read and the cells written, so the report costs no extra job.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fanwrite.operators.decode import REASON_NULL_EVENT, fail_on
from fanwrite.options import FanoutOptions
from fanwrite.plans.fanout import Enrich, prepare
from fanwrite.sinks.fs import batch_ids
from fanwrite.sinks.records import RejectSink
from fanwrite.sinks.table_sink import TableSink


@dataclass(frozen=True)
class LoadReport:
    events: int
    cells: int
    seconds: float
    rejects: int = 0
    load_id: int = 0

    @property
    def events_per_second(self) -> float | None:
        """Rate over the whole load; None when no time was measured."""
        return self.events / self.seconds if self.seconds > 0 else None


def bulk_load(
    events: DataFrame,
    root: str,
    opts: FanoutOptions,
    load_id: int | None = None,
    enrich: Enrich | None = None,
    rejects: RejectSink | None = None,
    replace: bool = False,
    lifted: Sequence[str] = (),
) -> LoadReport:
    """Write ``(..., event)`` rows as cells under ``root/batch_id=<load_id>``.

    ``load_id`` defaults to the first one after those in use; a used one is
    refused unless ``replace`` says that the load takes its place.  Rows with
    a ``reason`` or a NULL event (``null_event``) go to ``rejects``; without a
    reject sink, or with ``on_bad="fail"``, the first such row fails the load.
    """
    used = batch_ids(events.sparkSession, root)
    if load_id is None:
        load_id = used[-1] + 1 if used else 0
    elif load_id in used and not replace:
        raise ValueError(f"load {load_id} is already in {root}; pass replace=True to load it anew")
    sink = TableSink(root, opts)
    reason = F.when(F.col("event").isNull(), F.lit(REASON_NULL_EVENT))
    if "reason" in events.columns:
        reason = F.coalesce("reason", reason)
    if rejects is None or opts.on_bad == "fail":
        reason = fail_on(reason)
    prepared = prepare(events.withColumn("reason", reason), opts, enrich=enrich, lifted=lifted)
    rows, cells = Observation("bulk_rows"), Observation("bulk_cells")
    bad = F.col("reason").isNotNull()
    observed = prepared.observe(rows, F.count_if(~bad).alias("events"), F.count_if(bad).alias("rejects"))
    start = time.perf_counter()
    sink.write(observed.filter(~bad), load_id, counts=cells)
    n_rejects = int(rows.get["rejects"] or 0)
    if rejects is not None and (n_rejects or load_id in used):
        rejects.write(prepared.filter(bad), load_id)
    seconds = time.perf_counter() - start
    return LoadReport(int(rows.get["events"] or 0), int(cells.get["cells"] or 0), seconds, n_rejects, load_id)
