"""Latest-version-wins resolution of document versions.

Versions are ``(doc_id, event, version, batch_first, batch_id)``.  The newest
version of a document is found with ``max_by`` in a grouped aggregate: each
map task first reduces its own rows to one per document (partial
aggregation), so a document with a huge number of versions never sends them
all to one task.  A struct with a map is no hash aggregation buffer, so both
steps sort by ``doc_id``; with unique ids the first one removes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanwrite.functions.events import entries


def version_order():
    """Ordering key: batch, then version if the row says that arrival comes
    first; else version, then batch."""
    return F.struct(F.when(F.col("batch_first"), F.col("batch_id")), F.col("version"), F.col("batch_id"))


def latest_versions(versions: DataFrame) -> DataFrame:
    """One row per ``doc_id``: the version with the greatest ordering key."""
    best = F.max_by(F.struct("event", "version", "batch_id"), version_order())
    return versions.groupBy("doc_id").agg(best.alias("d")).select(
        "doc_id", F.col("d.event").alias("event"), F.col("d.version").alias("version"), F.col("d.batch_id").alias("batch_id")
    )


def document_fields(docs: DataFrame) -> DataFrame:
    """Documents as ``(doc_id, qualifier, value)`` rows (see
    :func:`fanwrite.functions.events.entries`)."""
    return entries(docs, "doc_id")
