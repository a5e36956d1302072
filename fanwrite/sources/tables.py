"""Static table sources: the driver's parquet tables and their event form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fanwrite.functions.events import fields_to_map, raw_map
from fanwrite.options import TIME_FORMAT


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a test-data directory."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_fields() -> dict:
    """How a row of the ``events`` table becomes an event (field code -> column).

    ``rv39`` is the tenant; ``signup`` events carry none, so they exercise the
    missing-tenant path.  ``msg`` holds JSON text with quotes and braces.
    """
    return {
        "id": F.col("event_id").cast("string"),
        "dt": F.date_format("ts", TIME_FORMAT),
        "rv39": F.when(F.col("event_type") == "signup", F.lit(None).cast("string")).otherwise(F.col("event_type")),
        "evt": F.col("event_type"),
        "sun": F.col("user_id").cast("string"),
        "sev": F.col("value").cast("string"),
        "msg": F.col("props"),
    }


def tenant_source_predicate(tenant: str) -> Column:
    """A source-column predicate implied by ``rv39 == tenant``.

    A present tenant is ``event_type`` itself, so ``rv39 = t`` implies
    ``event_type = t``.  Catalyst keeps a filter on the lifted column as a
    CASE expression, which parquet cannot use; this plain comparison reaches
    the scan (``PushedFilters``) and lets it skip the row groups of other
    tenants.  Apply it to the table and keep the exact tenant filter on top.
    """
    return F.col("event_type") == F.lit(tenant)


def lifted(code: str) -> Column:
    """One field as a plain column: NULL where the map leaves it out."""
    expr = table_fields()[code]
    return F.when(expr != F.lit(""), expr)


def events_from_table(df: DataFrame, keep=("event_id", "ts"), lift=("id", "rv39")) -> DataFrame:
    """``events`` rows as ``(keep..., event MAP<STRING,STRING>, <lifted codes>)``.

    NULL and empty values are left out of the map.  The fields in ``lift``
    are also given as plain columns named by their code, computed from the
    source columns: a filter on them (a tenant, an id) reaches the parquet
    scan, which it cannot through a map lookup.
    """
    return df.select(*keep, fields_to_map(table_fields()).alias("event"), *[lifted(c).alias(c) for c in lift])


def raw_events_from_table(df: DataFrame, keep=("event_id", "ts")) -> DataFrame:
    """Like :func:`events_from_table` but every code is present, NULLs kept
    (what a producer that sends every field would put on the wire)."""
    return df.select(*keep, raw_map(table_fields()).alias("event"))
