"""Cell layouts: an event becomes wide-column cells
``(table_name, row_key, family, qualifier, value)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanwrite.functions.text import blob_text
from fanwrite.options import BLOB_QUALIFIER, FAMILY

CELL_COLUMNS = ("table_name", "row_key", "family", "qualifier", "value")


def wide_cell_columns(family: str = FAMILY) -> list[Column]:
    """Exploded cells; empty values still to be filtered (see :func:`cells`)."""
    return [
        F.col("table_name"),
        F.col("row_key"),
        F.lit(family).alias("family"),
        # explode_outer: plain explode makes the optimizer infer a
        # ``size(event) > 0`` filter and push it below the projections that
        # build the map, building every map twice.  An empty or NULL event
        # gives one NULL row here, which the non-empty filter drops.
        F.explode_outer("event").alias("qualifier", "value"),
    ]


def blob_cell_columns(family: str = FAMILY, qualifier: str = BLOB_QUALIFIER) -> list[Column]:
    return [
        F.col("table_name"),
        F.col("row_key"),
        F.lit(family).alias("family"),
        F.lit(qualifier).alias("qualifier"),
        blob_text("event").alias("value"),
    ]


def cell_columns(layout: str, family: str = FAMILY) -> list[Column]:
    """The projection that turns prepared events into cells (build once,
    reuse per batch)."""
    if layout == "wide":
        return wide_cell_columns(family)
    if layout == "blob":
        return blob_cell_columns(family)
    raise ValueError(f"unknown layout {layout!r}")


def wide_cells(events: DataFrame, family: str = FAMILY) -> DataFrame:
    """One cell per non-empty field; the qualifier is the field code."""
    return events.select(*wide_cell_columns(family)).filter(_non_empty())


def blob_cells(events: DataFrame, family: str = FAMILY, qualifier: str = BLOB_QUALIFIER) -> DataFrame:
    """One cell per event holding its ``{k=v, ...}`` text."""
    return events.select(*blob_cell_columns(family, qualifier))


def _non_empty() -> Column:
    # Wide layout: NULL and empty values get no cell.  Filtering the exploded
    # rows (rather than the map with ``map_filter``) keeps the layout free of
    # higher-order functions, so explode and filter stay in whole-stage codegen.
    return F.col("value").isNotNull() & (F.col("value") != F.lit(""))


def cells(events: DataFrame, layout: str, family: str = FAMILY, columns: list[Column] | None = None) -> DataFrame:
    """Prepared events to cells (``columns``: a prebuilt :func:`cell_columns`)."""
    out = events.select(*(columns or cell_columns(layout, family)))
    return out.filter(_non_empty()) if layout == "wide" else out
