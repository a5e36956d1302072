"""The document index as keyed state: a batch emits only the documents it changed.

``transformWithState`` keeps the version of every document's latest event in the
state store (RocksDB: on the executors' disks, with its changes under the query's
checkpoint).  Of the versions that a batch brings, the newest one is compared with
it; if it is newer still, or arrival decides (``batch_first``), it replaces the
state and is emitted, else nothing is.  So what a batch writes grows with the
documents that changed, not with the versions that arrived, and an index behind
a connector is sent no document twice.

The state holds versions, not events.  Rows without a document (rejects) pass
through the same operator in groups of their own, dealt by their position so
that no group is large, and come out with their reason.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from fanwrite.operators.decode import REASON_NO_DOC_ID, decode_messages, fail_on
from fanwrite.options import FanoutOptions
from fanwrite.plans.fanout import Enrich, Preparer
from fanwrite.sinks.records import RejectSink
from fanwrite.sources.messages import POSITION_COLUMNS
from fanwrite.streaming.runner import refuse_used_output

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LOST_GROUPS = 1024  # groups that a batch's rejects are dealt over
LEAST = -(1 << 63)

RAW = "reason string, key binary, value binary, topic string, partition int, offset bigint"
RAW_COLUMNS = [c.split()[0] for c in RAW.split(", ")]


class LatestVersion(StatefulProcessor):
    """Per document: the newest version so far, as the columns that order versions."""

    def __init__(self, order: Sequence[str], schema: str, batch_first: bool):
        self.order = list(order)
        self.schema = schema
        self.batch_first = batch_first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is None:
            yield from rows
            return
        newest, best = None, None
        for part in rows:
            version, at = max((v, k) for k, v in enumerate(zip(*(part[c].tolist() for c in self.order))))
            if newest is None or version > newest:
                newest, best = version, part.iloc[[at]]
        known = self.latest.get()
        if best is not None and (known is None or self.batch_first or newest > tuple(known)):
            self.latest.update(newest)
            yield best

    def close(self) -> None:
        pass


def _stored(column: str, kind: T.DataType) -> tuple[Column, str, Column]:
    """How an ordering column is held in the state: an expression without NULLs (which
    come first), its type, and the way back."""
    name = F.col(f"v_{column}")
    if isinstance(kind, T.TimestampType):
        return F.coalesce(F.unix_micros(column), F.lit(LEAST)), "bigint", F.timestamp_micros(F.nullif(name, F.lit(LEAST)))
    if isinstance(kind, T.IntegralType):
        return F.coalesce(F.col(column).cast("bigint"), F.lit(LEAST)), "bigint", F.nullif(name, F.lit(LEAST)).cast(kind)
    if isinstance(kind, T.StringType):
        return F.coalesce(F.col(column), F.lit("")), "string", name
    raise ValueError(f"versions can't be ordered by {column}: {kind.simpleString()}")


def changed_documents(prepared: DataFrame, order_by: Sequence[str], batch_first: bool) -> DataFrame:
    """``doc_id, event, version, batch_first`` of the documents that a batch of the
    (streaming, prepared) events changes, and its rejects: ``doc_id`` NULL, with
    ``reason`` and the raw message."""
    held = {c: _stored(c, prepared.schema[c].dataType) for c in order_by}
    lost = F.col("lost").isNotNull()
    spread = F.pmod(F.xxhash64(*POSITION_COLUMNS), F.lit(LOST_GROUPS)).cast("int")
    rows = prepared.select(
        F.when(~lost, F.col("doc_id")).alias("doc_id"),
        F.when(lost, spread).otherwise(F.lit(0)).alias("bucket"),
        F.when(~lost, F.to_json("event", {"ignoreNullFields": "false"})).alias("body"),
        *(expr.alias(f"v_{c}") for c, (expr, _, _) in held.items()),
        F.col("lost").alias("reason"),
        *RAW_COLUMNS[1:],
    )
    state = ", ".join(f"v_{c} {kind}" for c, (_, kind, _) in held.items())
    processor = LatestVersion([f"v_{c}" for c in order_by], state, batch_first)
    out = rows.groupBy("doc_id", "bucket").transformWithStateInPandas(
        processor, f"doc_id string, bucket int, body string, {state}, {RAW}", outputMode="Update", timeMode="None"
    )
    event = F.from_json("body", "map<string,string>")
    version = F.struct(*(back.alias(c) for c, (_, _, back) in held.items()))
    return out.select("doc_id", event.alias("event"), version.alias("version"), F.lit(batch_first).alias("batch_first"), *RAW_COLUMNS)


class IndexChanges:
    """A stream that keeps an index: every batch's changed documents are written to
    ``<root>/batch_id=<n>/`` in the form of :class:`~fanwrite.sinks.IndexSink`, so
    ``read_latest`` reads both.

    A replayed batch starts from the state before it and writes the same folder
    again.  Messages that can't be decoded, and events without a document id, go
    to ``rejects``.
    """

    def __init__(
        self,
        opts: FanoutOptions,
        root: str,
        rejects: RejectSink | None = None,
        order_by: Sequence[str] = ("timestamp", "partition", "offset"),
        batch_first: bool = True,
        enrich: Enrich | None = None,
    ):
        if rejects is None and opts.on_bad == "reject":
            raise ValueError("a job that sets bad rows aside needs a reject sink; on_bad='fail' fails on them instead")
        if not order_by:
            raise ValueError("versions need a column to be ordered by")
        self.opts = opts
        self.root = root.rstrip("/")
        self.rejects = rejects
        self.order_by = list(order_by)
        self.batch_first = batch_first
        self._preparer = Preparer(opts, POSITION_COLUMNS, enrich)

    def changes(self, messages: DataFrame) -> DataFrame:
        strict = self.opts.on_bad == "fail"
        prepared = self._preparer(decode_messages(messages, strict))
        unkeyed = F.when(F.col("doc_id").isNull(), F.lit(REASON_NO_DOC_ID))
        lost = F.coalesce(F.col("reason"), fail_on(unkeyed) if strict else unkeyed)
        return changed_documents(prepared.withColumn("lost", lost), self.order_by, self.batch_first)

    def write(self, changed: DataFrame, batch_id: int) -> None:
        changed = changed.persist(StorageLevel.MEMORY_AND_DISK)  # the state is gone through once
        try:
            docs = changed.where("doc_id IS NOT NULL").select("doc_id", "event", "version", "batch_first")
            docs.write.mode("overwrite").parquet(f"{self.root}/batch_id={int(batch_id)}")
            lost = changed.where("doc_id IS NULL")
            if self.rejects is not None and not lost.isEmpty():
                self.rejects.write(lost.select(*RAW_COLUMNS), batch_id)
        finally:
            changed.unpersist()

    def start(self, messages: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Start the query (see :meth:`FanoutJob.start`).  The state store's provider is
        set to RocksDB, which this kind of state needs."""
        spark = messages.sparkSession
        refuse_used_output(spark, checkpoint, [self.root, *([self.rejects.root] if self.rejects else [])])
        spark.conf.set(STATE_STORE, ROCKSDB)
        writer = self.changes(messages).writeStream.outputMode("update").foreachBatch(self.write).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"processingTime": self.opts.trigger_interval})).start()
