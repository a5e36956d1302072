"""Cell tables in sorted key ranges, for reads of single rows.

Cells lie in ``<root>/batch_id=<n>/table_name=<t>/key_range=<k>/``: ``k`` is the
beginning of the row key.  Events are dealt over the tasks by ranges of (table,
row key), so a hot tenant is cut into many tasks, and each file is sorted by row
key and has a bloom filter on it.  A read of one key opens the folders of its
range only (a partition filter), of these the files and row groups whose least
and greatest keys enclose it, and of those the ones whose bloom filter has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fanwrite.operators.layout import cells
from fanwrite.options import FanoutOptions
from fanwrite.sinks.table_sink import CELL_READ_SCHEMA, TableSink

KEY_DIGITS = 1  # characters of the row key (hex digits) that name a range: 16 ranges
BROADCAST_KEYS = 1_000_000
SORTED_READ_SCHEMA = T.StructType([*CELL_READ_SCHEMA.fields, T.StructField("key_range", T.StringType(), True)])


class SortedTableSink(TableSink):
    """:class:`TableSink` with sorted key ranges (Parquet).  ``key_digits`` grows with
    the table: each digit makes 16 times as many folders a table."""

    partition_columns = ("table_name", "key_range")

    def __init__(self, root: str, opts: FanoutOptions, key_digits: int = KEY_DIGITS, options: dict | None = None):
        bloom = {"parquet.bloom.filter.enabled#row_key": "true"}
        super().__init__(root, opts, options=bloom | (options or {}))
        self.key_digits = int(key_digits)

    def cells(self, events: DataFrame) -> DataFrame:
        ranged = events.repartitionByRange("table_name", "row_key")  # before the wide layout multiplies the rows
        out = cells(ranged, self.opts.layout, self.opts.family).withColumn("key_range", F.substring("row_key", 1, self.key_digits))
        return out.sortWithinPartitions("table_name", "key_range", "row_key")


def read_sorted_cells(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SORTED_READ_SCHEMA).parquet(root.rstrip("/"))


def _cells_of(df: DataFrame) -> DataFrame:
    return df.select("table_name", "row_key", "family", "qualifier", "value", "batch_id")


def read_row(spark: SparkSession, root: str, row_key: str, table: str | None = None, key_digits: int = KEY_DIGITS) -> DataFrame:
    """The cells of one row key, of one table or of all."""
    found = read_sorted_cells(spark, root).where((F.col("key_range") == row_key[:key_digits]) & (F.col("row_key") == row_key))
    return _cells_of(found if table is None else found.where(F.col("table_name") == table))


def read_rows(spark: SparkSession, root: str, keys: DataFrame, key_digits: int = KEY_DIGITS) -> DataFrame:
    """The cells of the row keys in ``keys`` (column ``row_key``; NULL and repeated ones
    count for nothing).

    Up to ``BROADCAST_KEYS`` keys are broadcast and prune the folders of other
    ranges at run time; more are joined by a shuffle.
    """
    wanted = keys.where("row_key IS NOT NULL AND row_key <> ''").select("row_key", F.substring("row_key", 1, key_digits).alias("key_range")).distinct()
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted
    return _cells_of(read_sorted_cells(spark, root).join(wanted, ["key_range", "row_key"], "left_semi"))
