"""Micro-batch fan-out with Structured Streaming.

``source (messages) -> decode -> prepare -> foreachBatch(sinks...)``

* With several readers (two sinks, or a sink and statistics) the batch is read
  from its source once: decoded, prepared and persisted (``MEMORY_AND_DISK``);
  every sink reads the cache, which is released in ``finally`` even if a sink
  fails.  A job with one sink writes straight from the source.
* Sinks are independent of each other: all take every decoded event, but the
  index leaves out events without an id, which it cannot key; those are
  reported as rejects and still reach the table.
* Sinks run one after another (table, then index) or, with
  ``opts.parallel``, on a small thread pool that inherits the caller's job
  context; every sink's error is re-raised so the batch fails and is replayed
  from the checkpoint instead of being reported done with data missing.
* No row vanishes: a job that sets bad rows aside needs a reject sink, one
  with ``on_bad="fail"`` fails on the first bad row.
* Every sink overwrites its own ``batch_id`` folder, so a replayed batch
  leaves the same result as one clean run.  Two sinks are not atomic
  together: after a failure one may be ahead of the other until the replay.
* A run needs a checkpoint location; with a fresh checkpoint the batch ids
  restart at 0, so starting on output that already holds batches is refused.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fanwrite.operators.decode import REASON_NO_DOC_ID, decode_columns, decode_messages, fail_on
from fanwrite.operators.parallelism import spread
from fanwrite.options import FanoutOptions
from fanwrite.plans.fanout import Enrich, Preparer
from fanwrite.sinks.fs import batch_ids, list_names
from fanwrite.sinks.index_sink import IndexSink
from fanwrite.sinks.records import RejectSink, StatsSink
from fanwrite.sinks.table_sink import TableSink
from fanwrite.sources.messages import POSITION_COLUMNS

log = logging.getLogger("fanwrite")

# What a batch's REBALANCE needs to be sized at run time.  By default a cached
# plan keeps its shuffle's own partitions: one task for each table, however
# large.  A rebalanced task holds few tables: it keeps a file open for each
# instead of sorting its cells by table (tables beyond that number are sorted).
BATCH_CONF = {
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


@contextmanager
def batch_conf(spark: SparkSession) -> Iterator[None]:
    """``BATCH_CONF`` set on the batch's session (a stream has its own), and put back."""
    before = {k: spark.conf.get(k) for k in BATCH_CONF}
    try:
        for k, v in BATCH_CONF.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


class FanoutJob:
    """The per-batch work of a fan-out stream (usable on a static batch too)."""

    def __init__(
        self,
        opts: FanoutOptions,
        sinks: Sequence,
        rejects: RejectSink | None = None,
        stats: StatsSink | None = None,
        enrich: Enrich | None = None,
        position: Sequence[str] | None = POSITION_COLUMNS,
        min_partitions: int | None = None,
    ):
        if not sinks:
            raise ValueError("no sink selected: enable the table sink, the index sink or both")
        if rejects is None and opts.on_bad == "reject":
            raise ValueError("a job that sets bad rows aside needs a reject sink; on_bad='fail' fails on them instead")
        self.opts = opts
        self.sinks = list(sinks)
        self.rejects = rejects
        self.stats = stats
        self.enrich = enrich
        self.position = tuple(position) if position else None
        self.min_partitions = min_partitions
        # One shuffle for all sinks: with per-tenant writes the batch is
        # rebalanced on table_name before it is cached.  AQE sizes (and
        # skew-splits) those partitions, the table sink then writes them
        # without another shuffle, and the index versions come out as
        # advisory-sized files instead of one small file per input task.
        self.balance = opts.rebalance_writes
        if self.balance:
            for s in self.sinks:
                if isinstance(s, TableSink):
                    s.input_balanced = True
        self._needs_id = any(isinstance(s, IndexSink) for s in self.sinks)
        self._preparer = Preparer(opts, self.position, enrich)
        self._columns = None
        self.last_timings: dict[str, float] = {}
        self.batches = 0  # that held rows
        self.rows = 0  # read from the source in those batches

    def prepared(self, batch: DataFrame) -> DataFrame:
        """The batch decoded and prepared; ``lost`` is why a row is a reject of
        the job as a whole or of the index alone, NULL for neither."""
        strict = self.opts.on_bad == "fail"
        # Expressions are built on the first batch and reused afterwards.
        if self._columns is None:
            lost = F.col("reason")
            if self._needs_id:
                unkeyed = F.when(F.col("doc_id").isNull(), F.lit(REASON_NO_DOC_ID))
                lost = F.coalesce(lost, fail_on(unkeyed) if strict else unkeyed)
            # Good rows do not need their raw payload any more (rejects do): a
            # cached batch then holds each event once, decoded.
            self._columns = decode_columns(strict), lost, F.when(F.col("lost").isNotNull(), F.col("value"))
        decode, lost, value = self._columns
        prepared = self._preparer(decode_messages(batch, columns=decode))
        return prepared.withColumn("lost", lost).withColumn("value", value)

    def _timed(self, sink, frame: DataFrame, batch_id: int) -> tuple[float, bool]:
        start = time.perf_counter()
        wrote = sink.write(frame, batch_id) is not False
        return time.perf_counter() - start, wrote

    def _write_all(self, good: DataFrame, batch_id: int) -> tuple[dict[str, float], bool]:
        """Every sink's seconds, and whether a built-in one wrote."""
        if self.opts.parallel and len(self.sinks) > 1:
            with ThreadPoolExecutor(max_workers=len(self.sinks), thread_name_prefix="fanout-sink") as pool:
                write = inheritable_thread_target(good.sparkSession)(self._timed)
                futures = [pool.submit(write, s, good, batch_id) for s in self.sinks]
                errors = [e for f in futures if (e := f.exception()) is not None]
            for e in errors[1:]:
                errors[0].add_note(f"another sink failed too: {e!r}")
            if errors:
                raise errors[0]
            results = [f.result() for f in futures]
        else:
            results = [self._timed(s, good, batch_id) for s in self.sinks]
        wrote = any(ok and isinstance(s, (TableSink, IndexSink)) for s, (_, ok) in zip(self.sinks, results))
        return {s.name: seconds for s, (seconds, _) in zip(self.sinks, results)}, wrote

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        with batch_conf(batch.sparkSession):
            self._process(batch, batch_id)

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        started = time.perf_counter()
        prepared = self.prepared(spread(batch, self.min_partitions))
        if self.balance:
            prepared = prepared.hint("rebalance", "table_name")
        several = len(self.sinks) > 1 or self.stats is not None
        if several:
            prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if (prepared if several else batch).isEmpty():
                return
            # The sinks' own write jobs count rows and rejects on the way
            # (an Observation), so a clean batch needs no extra job to learn
            # that there is nothing to reject.
            obs = Observation()
            counted = prepared.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("lost").isNotNull()).alias("rejects"))
            good = counted.filter(F.col("reason").isNull())
            # obs.get blocks until an action on `counted` has run: trust it
            # only when a built-in sink (which always writes `counted`) wrote.
            timings, observed = self._write_all(good, batch_id)
            bad = prepared.filter(F.col("lost").isNotNull()).withColumn("reason", F.col("lost"))
            if self.rejects is not None:
                n_bad = obs.get["rejects"] if observed else (0 if bad.isEmpty() else 1)
                timings[self.rejects.name] = self._timed(self.rejects, bad, batch_id)[0] if n_bad else 0.0
            if self.stats is not None:
                frames = [s.stats(good, timings[s.name]) for s in self.sinks]
                if self.rejects is not None:
                    frames.append(self.rejects.stats(bad, timings[self.rejects.name]))
                self.stats.write(reduce(DataFrame.unionByName, frames), batch_id)
            total = time.perf_counter() - started
            timings["batch_total"] = total
            self.batches += 1
            if observed:
                # Free: the Observation was filled by the sinks' own writes.
                rows = int(obs.get["rows"] or 0)
                self.rows += rows
                timings["rows"] = rows
                timings["events_per_second"] = rows / total if total > 0 else None
            self.last_timings = timings
            log.info("batch %s: %s", batch_id, _summary(timings))
        finally:
            if several:
                prepared.unpersist()

    def output_roots(self) -> list[str]:
        roots = [s.root for s in self.sinks if hasattr(s, "root")]
        roots += [x.root for x in (self.rejects, self.stats) if x is not None]
        return roots

    def start(
        self,
        messages: DataFrame,
        checkpoint: str,
        trigger: dict | None = None,
        query_name: str | None = None,
    ) -> StreamingQuery:
        """Start the streaming query.  ``trigger`` defaults to the batch
        interval of the options; pass ``{"availableNow": True}`` to drain what
        is there and stop."""
        if not messages.isStreaming:
            raise ValueError("start() needs a streaming DataFrame; use process_batch for a static one")
        spark = messages.sparkSession
        refuse_used_output(spark, checkpoint, self.output_roots())
        writer = messages.writeStream.foreachBatch(self.process_batch).option("checkpointLocation", checkpoint)
        writer = writer.trigger(**(trigger or {"processingTime": self.opts.trigger_interval}))
        if query_name:
            writer = writer.queryName(query_name)
        return writer.start()


def refuse_used_output(spark: SparkSession, checkpoint: str, roots: Sequence[str]) -> None:
    """Fails if a query would start anew, from batch 0, on output that holds batches."""
    if not list_names(spark, f"{checkpoint.rstrip('/')}/offsets"):
        used = [r for r in roots if batch_ids(spark, r)]
        if used:
            raise RuntimeError(
                f"output {used} already holds batches but checkpoint {checkpoint} is empty; "
                "a fresh checkpoint restarts at batch 0 and would overwrite them"
            )


def _summary(timings: dict) -> str:
    return ", ".join(f"{k}={v:.3f}" if isinstance(v, float) else f"{k}={v}" for k, v in timings.items())


def run_until_done(query: StreamingQuery, timeout_seconds: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query, as long as its input takes; with a
    timeout, stop it and fail if it overruns."""
    finished = query.awaitTermination(timeout_seconds)
    if finished is False:
        query.stop()
        raise TimeoutError(f"streaming query did not finish within {timeout_seconds} s")
    if query.exception() is not None:
        raise query.exception()
    return query
