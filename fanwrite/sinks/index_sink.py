"""Document index sink: each event is a document keyed by its id; the latest
version of a document wins.

Versions are appended per batch as ``<root>/batch_id=<n>/`` (an overwrite of
that batch's folder, so replays do not duplicate and a reload replaces).
:func:`read_latest` resolves the current documents with a grouped ``max_by``.

``order_by`` names the columns that order versions within the data (for a
message source: timestamp, partition, offset).  ``batch_first`` decides
whether arrival batch comes first (last write wins) or the data's own order
does (external version, as a search index's external versioning does); the
rule is stored with every version, so readers need not know it.

An external index connector can be used through ``connector`` and
``connector_options`` (for example ``org.elasticsearch.spark.sql`` with
``es.resource`` and ``es.mapping.id``).  A connector takes flat documents:
``doc_id`` and the event fields named in ``fields``, the latest version of
each id in the batch.  No connector ships with this package.
"""

from __future__ import annotations

import sys
import traceback
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanwrite.operators.latest import latest_versions
from fanwrite.operators.stats import rows_total
from fanwrite.options import FanoutOptions


class IndexSink:
    name = "index"

    def __init__(
        self,
        root: str,
        opts: FanoutOptions,
        order_by: Sequence[str] = ("timestamp", "partition", "offset"),
        batch_first: bool = True,
        connector: str | None = None,
        connector_options: dict | None = None,
        fields: Sequence[str] = (),
    ):
        if connector and not fields:
            raise ValueError("a connector needs the event fields that make up a document")
        self.root = root.rstrip("/")
        self.opts = opts
        self.order_by = list(order_by)
        self.batch_first = batch_first
        self.connector = connector
        self.connector_options = dict(connector_options or {})
        self.fields = list(fields)

    def documents(self, events: DataFrame) -> DataFrame:
        version = F.struct(*[F.col(c) for c in self.order_by]) if self.order_by else F.struct(F.lit(0).alias("v"))
        docs = events.filter(F.col("doc_id").isNotNull())
        return docs.select("doc_id", "event", version.alias("version"), F.lit(self.batch_first).alias("batch_first"))

    def flat_documents(self, docs: DataFrame, batch_id: int) -> DataFrame:
        """The batch's latest version of each document, a column for each field."""
        latest = latest_versions(docs.withColumn("batch_id", F.lit(int(batch_id)).cast("long")))
        return latest.select("doc_id", *(F.col("event")[f].alias(f) for f in self.fields if f != "doc_id"))

    def write(self, events: DataFrame, batch_id: int) -> bool:
        """Write one batch of versions; False when an error was logged and
        swallowed (``index_errors="log"``)."""
        try:
            docs = self.documents(events)
            if self.connector:
                flat = self.flat_documents(docs, batch_id)
                flat.write.format(self.connector).options(**self.connector_options).mode("append").save()
            else:
                self.store(docs, int(batch_id))
            return True
        except Exception:
            if self.opts.index_errors == "log":
                traceback.print_exc(file=sys.stderr)
                return False
            raise

    def store(self, docs: DataFrame, batch_id: int) -> None:
        docs.write.mode("overwrite").parquet(f"{self.root}/batch_id={batch_id}")

    def stats(self, events: DataFrame, seconds: float | None) -> DataFrame:
        return rows_total(events.filter(F.col("doc_id").isNotNull()), self.name, "index", seconds)


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """All stored versions (``doc_id, event, version, batch_first, batch_id``)."""
    df = spark.read.parquet(root.rstrip("/")).withColumn("batch_id", F.col("batch_id").cast("long"))
    return df.select("doc_id", "event", "version", "batch_first", "batch_id")


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """Current documents, resolved by ``max_by`` under the rule stored with them."""
    return latest_versions(read_versions(spark, root))
