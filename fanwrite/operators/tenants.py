"""Tenant operators over prepared events (``tenant`` lifted to a column)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tenant_list(events: DataFrame, include_missing: bool = False) -> DataFrame:
    """Distinct tenants, kept distributed (partial + final hash aggregate).

    Nothing here needs the list on the driver: routing is a column and the
    write is partitioned by it.
    """
    out = events.select("tenant").distinct()
    return out if include_missing else out.filter(F.col("tenant").isNotNull())


def tenant_filter(events: DataFrame, tenant: str) -> DataFrame:
    """Events of one tenant (a plain column predicate Catalyst can push down)."""
    return events.filter(F.col("tenant") == F.lit(tenant))


def route_counts(events: DataFrame) -> DataFrame:
    """Events per destination table."""
    return events.groupBy("table_name").agg(F.count(F.lit(1)).alias("events"))
