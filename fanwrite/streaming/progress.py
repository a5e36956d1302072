"""What a running stream has read, when and how fast, as rows that can be queried.

:class:`ProgressLog` listens to the session's streaming queries and writes one small
record per batch beside their checkpoints (a batch that is replayed replaces its
record).  It takes no job of its own: Spark has measured all of it already.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from fanwrite.sinks.fs import list_names, write_text

WAIT_MS = 60_000

SCHEMA = (
    "query_id string, run_id string, query_name string, batch_id bigint, started string, input_rows bigint, input_rows_per_second double, "
    "processed_rows_per_second double, batch_ms bigint, durations_ms map<string,bigint>, rows_late bigint, state_rows bigint, state_bytes bigint"
)


class ProgressLog(StreamingQueryListener):
    """Records of the batches that read something, under ``<root>/<query id>/``.

    ``start`` and ``stop`` add it to the session and take it off again.  A failing
    record is kept in ``errors``: it must not end the query that it describes.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.errors: list[str] = []

    def start(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def stop(self) -> None:
        """Events reach listeners after the batch is through: those on their way are awaited."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(WAIT_MS)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return  # nothing arrived; the batch's id will be used again
        states = p.stateOperators
        record = {
            "query_id": str(p.id),
            "run_id": str(p.runId),
            "query_name": p.name,
            "batch_id": p.batchId,
            "started": p.timestamp,
            "input_rows": p.numInputRows,
            "input_rows_per_second": p.inputRowsPerSecond,
            "processed_rows_per_second": p.processedRowsPerSecond,
            "batch_ms": p.batchDuration,
            "durations_ms": dict(p.durationMs),
            "rows_late": sum(s.numRowsDroppedByWatermark for s in states),
            "state_rows": sum(s.numRowsTotal for s in states),
            "state_bytes": sum(s.memoryUsedBytes for s in states),
        }
        try:
            write_text(self.spark, f"{self.root}/{p.id}/{p.batchId:012d}.json", json.dumps(record))
        except Exception as e:  # noqa: BLE001
            self.errors.append(f"batch {p.batchId}: {e!r}")


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """The records so far, also while the query runs (no rows if there are none)."""
    folders = [f"{root.rstrip('/')}/{n}" for n in list_names(spark, root)]
    return spark.read.schema(SCHEMA).json(folders) if folders else spark.createDataFrame([], SCHEMA)
