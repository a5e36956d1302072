"""Document index in hash buckets: current documents without a shuffle.

The versions lie in a table clustered into a fixed number of buckets by
``doc_id`` and partitioned by ``batch_id``.  All versions of a document are in
files of one bucket, so :func:`read_latest_bucketed` groups within the scan's own
partitioning (no exchange), and a filter on ``doc_id`` opens one bucket.

A batch is first reduced to the latest version of each document (partial
aggregation before the shuffle: a document with a third of all versions is one
row by then), then dealt by bucket, which gives one file per bucket and batch.
The folder's name holds the number of buckets, so that a reader can't take
another one.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fanwrite.operators.latest import latest_versions
from fanwrite.options import FanoutOptions
from fanwrite.sinks.fs import list_names
from fanwrite.sinks.index_sink import IndexSink

BUCKETS = 64
_FOLDER = re.compile(r"buckets-(\d+)")


def _declare(spark: SparkSession, table: str, folder: str, buckets: int, schema: T.StructType) -> None:
    """The table over ``folder`` in the session's catalog, if it isn't there yet."""
    if spark.catalog.tableExists(table):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (batch_id) "
        f"CLUSTERED BY (doc_id) SORTED BY (doc_id) INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    if list_names(spark, folder):
        spark.sql(f"MSCK REPAIR TABLE {table}")


class BucketedIndexSink(IndexSink):
    """:class:`IndexSink` whose versions are kept in buckets.  ``table`` names the
    table in the catalog (its files stay under ``root`` when it is dropped)."""

    def __init__(
        self,
        root: str,
        opts: FanoutOptions,
        table: str,
        buckets: int = BUCKETS,
        order_by: Sequence[str] = ("timestamp", "partition", "offset"),
        batch_first: bool = True,
    ):
        super().__init__(root, opts, order_by, batch_first)
        self.table = table
        self.buckets = int(buckets)

    def store(self, docs: DataFrame, batch_id: int) -> None:
        spark = docs.sparkSession
        others = [n for n in list_names(spark, self.root) if _FOLDER.fullmatch(n) and n != f"buckets-{self.buckets}"]
        if others:
            raise ValueError(f"{self.root} holds {others[0]}: an index keeps its number of buckets")
        batch = F.lit(batch_id).cast("bigint").alias("batch_id")
        latest = latest_versions(docs.withColumn("batch_id", batch))
        rows = latest.select("doc_id", "event", "version", F.lit(self.batch_first).alias("batch_first"))
        _declare(spark, self.table, f"{self.root}/buckets-{self.buckets}", self.buckets, rows.select("*", batch).schema)
        dealt = rows.repartition(self.buckets, "doc_id")
        # The partition is named, so an attempt's folder is replaced even by no rows.
        spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION (batch_id = {batch_id}) SELECT * FROM {{dealt}}", dealt=dealt)


def read_versions_bucketed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All stored versions, through the catalog's table, which a new session declares again."""
    folders = [n for n in list_names(spark, root.rstrip("/")) if _FOLDER.fullmatch(n)]
    if len(folders) != 1:
        raise ValueError(f"{root} is no bucketed index: {folders}")
    folder = f"{root.rstrip('/')}/{folders[0]}"
    if not spark.catalog.tableExists(table):
        read = spark.read.parquet(folder)
        schema = read.withColumn("batch_id", F.col("batch_id").cast("bigint")).schema
        _declare(spark, table, folder, int(_FOLDER.fullmatch(folders[0])[1]), schema)
    return spark.table(table).select("doc_id", "event", "version", "batch_first", "batch_id")


def read_latest_bucketed(spark: SparkSession, root: str, table: str, doc_id: str | None = None) -> DataFrame:
    """Current documents; one document's bucket alone is read if ``doc_id`` is given."""
    versions = read_versions_bucketed(spark, root, table)
    return latest_versions(versions if doc_id is None else versions.where(F.col("doc_id") == F.lit(doc_id)))
