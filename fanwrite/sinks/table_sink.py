"""Wide-column table sink: cells written as ``<root>/batch_id=<n>/table_name=<t>/``.

One write job per batch whatever the number of tenants: the destination
table is a partition column, not a loop over tenants.  Each batch overwrites
its own ``batch_id`` folder, so a replayed batch replaces what an earlier
attempt wrote (no duplicates).  Readers take all batches.

File sizing: with ``file_layout="rebalance"`` the events pass a REBALANCE on
``table_name`` before the write.  AQE then packs small tables together and
splits a large one into advisory-sized tasks, so a tenant holding a third of
all rows is written by many tasks while small tenants do not produce one
tiny file per input task.  ``"narrow"`` skips that shuffle (files = tasks x
tables).  ``"auto"`` (default) rebalances per-tenant writes and writes a
single table narrow: there each input task writes one file, and a shuffle on
the one table name would only funnel small loads into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fanwrite.functions.routing import route
from fanwrite.operators.layout import cell_columns, cells
from fanwrite.operators.stats import rows_per_table
from fanwrite.options import FanoutOptions

CELL_READ_SCHEMA = T.StructType(
    [
        T.StructField("row_key", T.StringType(), True),
        T.StructField("family", T.StringType(), True),
        T.StructField("qualifier", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
        T.StructField("batch_id", T.LongType(), True),
        T.StructField("table_name", T.StringType(), True),
    ]
)


class TableSink:
    """Cells of prepared events to a partitioned table (parquet by default).

    ``fmt``/``options`` pass through to ``DataFrameWriter`` for another file
    format.  A table-store connector that takes DataFrames can be used the
    same way; none ships with this package.
    """

    name = "table"
    partition_columns: tuple[str, ...] = ("table_name",)

    def __init__(
        self,
        root: str,
        opts: FanoutOptions,
        fmt: str = "parquet",
        options: dict | None = None,
        input_balanced: bool = False,
    ):
        """``input_balanced``: the events arrive already rebalanced on
        ``table_name`` (a stream job does that once, before caching, for all
        its sinks), so the sink adds no shuffle of its own."""
        self.root = root.rstrip("/")
        self.opts = opts
        self.fmt = fmt
        self.options = dict(options or {})
        self.input_balanced = input_balanced
        self._cell_columns = None  # built on first use, reused per batch

    def cells(self, events: DataFrame) -> DataFrame:
        # Rebalance the events, not the cells: the wide layout multiplies rows
        # by the field count, so shuffling before the explode moves far fewer
        # rows (column pruning keeps only what the layout reads).
        if self.opts.rebalance_writes and not self.input_balanced:
            events = events.hint("rebalance", "table_name")
        if self._cell_columns is None:
            self._cell_columns = cell_columns(self.opts.layout, self.opts.family)
        return cells(events, self.opts.layout, columns=self._cell_columns)

    def path(self, batch_id: int) -> str:
        return f"{self.root}/batch_id={int(batch_id)}"

    def write(self, events: DataFrame, batch_id: int, counts: Observation | None = None) -> bool:
        """Write one batch of cells, replacing what the batch's folder holds;
        ``counts`` gets their number as ``cells``."""
        cells = self.cells(events)
        if counts is not None:
            cells = cells.observe(counts, F.count(F.lit(1)).alias("cells"))
        # Static: a replay may no longer write every table that an earlier
        # attempt wrote, and must not leave those behind.
        writer = cells.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*self.partition_columns).format(self.fmt)
        if self.opts.max_records_per_file:
            writer = writer.option("maxRecordsPerFile", int(self.opts.max_records_per_file))
        writer.options(**self.options).save(self.path(batch_id))
        return True

    def stats(self, events: DataFrame, seconds: float | None) -> DataFrame:
        return rows_per_table(events, self.name, seconds)


def read_cells(spark: SparkSession, root: str, table: str | None = None, fmt: str = "parquet") -> DataFrame:
    """All cells under ``root`` (every batch), optionally of one table, in the
    format the sink wrote.  The table filter is on a partition column, so only
    that table's folders are read."""
    df = spark.read.schema(CELL_READ_SCHEMA).format(fmt).load(root.rstrip("/"))
    if table is not None:
        df = df.filter(F.col("table_name") == F.lit(table))
    return df.select("table_name", "row_key", "family", "qualifier", "value", "batch_id")


# Tenants up to which their tables' names are broadcast, to prune the folders read.
BROADCAST_TENANTS = 100_000


def read_cells_of_tenants(
    spark: SparkSession, root: str, tenants: DataFrame, opts: FanoutOptions, tenant: str = "tenant", fmt: str = "parquet"
) -> DataFrame:
    """The cells of a set of tenants, given as a column of a DataFrame.

    The tenants' table names are joined to the partition column: the folders of
    other tenants are left out at run time (dynamic partition pruning), without
    the list on the driver.  A NULL tenant stands for the events without one;
    repeated tenants count once, unknown ones give nothing.  More than
    ``BROADCAST_TENANTS`` names are joined by a shuffle.
    """
    named = tenants.select(route(tenant, opts.base_table, False, opts.unrouted_table).alias("table_name"))
    # Spark prunes by a side that has a comparison; an equality with a literal, also a
    # negated one, on the table name itself would make it leave the pruning out.
    named = named.where(F.length("table_name") > 0).distinct()
    named = F.broadcast(named) if named.count() <= BROADCAST_TENANTS else named
    return read_cells(spark, root, fmt=fmt).join(named, "table_name", "left_semi")
