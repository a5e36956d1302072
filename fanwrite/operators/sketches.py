"""Mergeable sketches of distinct values, kept per batch of a stream.

A HyperLogLog sketch of a batch is a few kilobytes whatever the batch holds, and
the union of sketches is the sketch of all of them.  So the number of distinct
tenants, or of distinct users of each tenant, over the life of a stream is read
from one row per batch and table, without the events.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fanwrite.functions.events import get_field
from fanwrite.operators.stats import rows_per_table
from fanwrite.sinks.records import read_records

LG_K = 12


def relative_error(lg_k: int = LG_K) -> float:
    """The relative standard error of an estimate from sketches of ``2 ** lg_k`` slots."""
    return math.sqrt(math.log(2)) / math.sqrt(1 << lg_k)


class SketchSink:
    """Per batch and table: a sketch of its distinct ``value`` (an event field), and the
    rows it stands for.  NULL values are not counted.  A sink of a fan-out job."""

    name = "sketch"

    def __init__(self, root: str, value: str, lg_k: int = LG_K):
        self.root = root.rstrip("/")
        self.value = value
        self.lg_k = lg_k

    def sketches(self, events: DataFrame) -> DataFrame:
        sketch = F.hll_sketch_agg(get_field("event", self.value), F.lit(self.lg_k))
        return events.groupBy("table_name").agg(sketch.alias("sketch"), F.count("*").alias("row_count"))

    def write(self, events: DataFrame, batch_id: int) -> bool:
        self.sketches(events).write.mode("overwrite").parquet(f"{self.root}/batch_id={int(batch_id)}")
        return True

    def stats(self, events: DataFrame, seconds: float | None) -> DataFrame:
        return rows_per_table(events, self.name, seconds)


def distinct_values(spark: SparkSession, root: str, *by: str, where: Column | None = None) -> DataFrame:
    """``(by..., distinct_values, row_count)``: the estimates over the stored batches
    (``where`` may pick some, by ``batch_id`` or ``table_name``), for all tables
    together or by ``table_name``.  The estimate is within about three times
    :func:`relative_error` of the true number, and exact for the first few dozen."""
    stored = read_records(spark, root)
    stored = stored if where is None else stored.where(where)
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values")
    return stored.groupBy(*by).agg(union, F.sum("row_count").alias("row_count"))
