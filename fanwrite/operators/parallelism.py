"""Task parallelism for inputs that arrive in too few partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame

MIN_PARTITIONS = "spark.fanwrite.minPartitions"


def spread(df: DataFrame, min_partitions: int | None) -> DataFrame:
    """``df`` dealt evenly over ``min_partitions`` tasks, if that is given.

    The number is an explicit setting for inputs known to arrive in too few
    partitions (one unsplittable file, a small micro-batch).  Without it the
    input keeps the partitions of its source and no shuffle is added.
    """
    return df.repartition(min_partitions) if min_partitions and min_partitions > 1 else df


def spread_table(df: DataFrame) -> DataFrame:
    """A table dealt over as many tasks as the session's
    ``spark.fanwrite.minPartitions`` says; unset, as its source has it."""
    return spread(df, int(df.sparkSession.conf.get(MIN_PARTITIONS, "0")))
