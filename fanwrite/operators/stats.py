"""Per-batch statistics rows ``(sink, table_name, row_count, seconds,
events_per_second)``.

Counts are distributed aggregates over the (cached) batch; only the wall
time of each sink comes from the driver, as a literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATS_SCHEMA = "sink string, table_name string, row_count long, seconds double, events_per_second double"


def _stats(counts: DataFrame, sink: str, table_name: Column, seconds: float | None) -> DataFrame:
    secs = F.lit(seconds).cast("double")
    return counts.select(
        F.lit(sink).alias("sink"),
        table_name.alias("table_name"),
        "row_count",
        secs.alias("seconds"),
        # NULL when no time was measured: never a division by zero.
        F.when(secs > 0, F.col("row_count") / secs).alias("events_per_second"),
    )


def rows_per_table(events: DataFrame, sink: str, seconds: float | None) -> DataFrame:
    counts = events.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))
    return _stats(counts, sink, F.col("table_name"), seconds)


def rows_total(events: DataFrame, sink: str, table_name: str, seconds: float | None) -> DataFrame:
    counts = events.agg(F.count(F.lit(1)).alias("row_count"))
    return _stats(counts, sink, F.lit(table_name), seconds)


def rows_per_reason(rejects: DataFrame, seconds: float | None) -> DataFrame:
    counts = rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))
    return _stats(counts, "rejects", F.col("reason"), seconds)
