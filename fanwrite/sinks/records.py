"""Reject and statistics sinks (both batch-keyed overwrites, like the others)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanwrite.operators.stats import rows_per_reason

REJECT_COLUMNS = ("reason", "key", "value", "topic", "partition", "offset", "line", "event")


class RejectSink:
    """Rows that failed decode or validation, with their raw payload or line
    (the event itself where the source has neither)."""

    name = "rejects"

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def records(self, rejects: DataFrame) -> DataFrame:
        raw = "value" in rejects.columns or "line" in rejects.columns
        cols = [c for c in REJECT_COLUMNS if c in rejects.columns and not (raw and c == "event")]
        return rejects.select(*cols)

    def write(self, rejects: DataFrame, batch_id: int) -> bool:
        self.records(rejects).write.mode("overwrite").parquet(f"{self.root}/batch_id={int(batch_id)}")
        return True

    def stats(self, rejects: DataFrame, seconds: float | None) -> DataFrame:
        return rows_per_reason(rejects, seconds)


class StatsSink:
    """``(batch_id, sink, table_name, rows, seconds)`` per batch."""

    name = "stats"

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def write(self, stats: DataFrame, batch_id: int) -> bool:
        stats.write.mode("overwrite").parquet(f"{self.root}/batch_id={int(batch_id)}")
        return True


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """Read a batch-keyed record folder (rejects or stats) with ``batch_id``."""
    root = root.rstrip("/")
    return spark.read.option("basePath", root).parquet(root).withColumn("batch_id", F.col("batch_id").cast("long"))
