"""Destination table of an event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fanwrite.functions.events import ColumnLike, _col
from fanwrite.options import TABLE_SEPARATOR


def route(tenant: ColumnLike, base_table: str, single_table: bool, unrouted_table: str = "unrouted") -> Column:
    """``base_table`` when one table is used, else ``<base_table>-<tenant>``.

    An event without a tenant goes to ``unrouted_table`` instead of failing
    the batch.
    """
    if single_table:
        return F.lit(base_table)
    return F.coalesce(F.concat(F.lit(base_table + TABLE_SEPARATOR), _col(tenant)), F.lit(unrouted_table))
