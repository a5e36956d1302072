"""Enrichment from a table: fields looked up by a field of the event.

The lookup is an enrichment hook (``DataFrame -> DataFrame``), so bulk loads,
registered queries and streams use the same one; in a stream every micro-batch
is joined with the static table.

The table is first reduced to its key and the wanted columns, one row a key.  It
is broadcast only if it has been counted and measured to be small; a larger one
is joined by a shuffle, in which AQE splits a hot key of the events.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanwrite.functions.events import get_field
from fanwrite.plans.fanout import Enrich

# Measured size (text of keys and values) up to which a lookup table is broadcast.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def one_per_key(table: DataFrame, key: Column, fields: Mapping[str, str], order_by: Column | None = None) -> DataFrame:
    """``lookup_key, looked_up``: a row for each key that isn't NULL, with a struct of
    the wanted columns as text, named by field code.

    Of rows that repeat a key, the one with the greatest ``order_by`` counts (of
    equal ones, or without it, the one with the greatest values).
    """
    values = F.struct(*(F.col(c).cast("string").alias(code) for code, c in fields.items()))
    rows = table.select(key.cast("string").alias("lookup_key"), values.alias("looked_up"), (F.lit(0) if order_by is None else order_by).alias("rank"))
    best = F.max(F.struct("rank", "looked_up")).alias("best")
    return rows.where("lookup_key IS NOT NULL").groupBy("lookup_key").agg(best).select("lookup_key", F.col("best.looked_up").alias("looked_up"))


def is_small(rows: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("lookup_key") + F.octet_length(F.to_json("looked_up"))).alias("bytes")).first()
    return size["n"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def lookup_enrichment(
    table: DataFrame,
    key: Column | str,
    on: str,
    fields: Mapping[str, str],
    order_by: Column | str | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    cached: bool = False,
) -> Enrich:
    """A hook that puts ``fields`` (field code -> column of ``table``) into the events
    whose field ``on`` equals ``key``.

    A found value overwrites the event's own; NULL and empty ones are left out.
    An event without a match, or without the field, stays as it is; a NULL event
    (a reject) stays NULL.  No event is lost or repeated, whatever the table
    holds (see :func:`one_per_key` for repeated keys).

    ``cached``: the reduced table is kept by the executors, so that a stream's batches
    don't read it anew; a later change of the table is not seen then.
    """
    by = F.col(key) if isinstance(key, str) else key
    order = F.col(order_by) if isinstance(order_by, str) else order_by
    rows = one_per_key(table, by, fields, order)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK) if cached else rows
    small = is_small(rows, max_rows, max_bytes)
    named = rows.withColumnsRenamed({"lookup_key": "_lookup_key", "looked_up": "_looked_up"})
    lookup = F.broadcast(named) if small else named

    def enrich(events: DataFrame) -> DataFrame:
        event, found = F.col("event"), F.col("_looked_up")
        joined = events.join(lookup, get_field("event", on) == F.col("_lookup_key"), "left")
        present = [(code, found[code].isNotNull() & (found[code] != F.lit(""))) for code in fields]
        added = F.map_filter(F.create_map(*(x for code in fields for x in (F.lit(code), found[code]))), lambda k, v: v.isNotNull() & (v != F.lit("")))
        replaced = F.array(*(F.when(there, F.lit(code)) for code, there in present))
        kept = F.map_filter(event, lambda k, v: ~F.coalesce(F.array_contains(replaced, k), F.lit(False)))
        put = F.when(event.isNotNull() & found.isNotNull(), F.map_concat(kept, added)).otherwise(event)
        return joined.withColumn("event", put).drop("_lookup_key", "_looked_up")

    return enrich
