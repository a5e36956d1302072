"""Column expressions over the sparse event map ``MAP<STRING,STRING>``.

All of these are native Catalyst expressions (``create_map``, ``map_filter``,
``map_concat``, ``element_at``), so they run inside the JVM and pipeline with
the scan and the write; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from fanwrite.options import RESTAMP_OFFSET_MINUTES, TIME_FORMAT

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def raw_map(fields: Mapping[str, ColumnLike]) -> Column:
    """Map with one entry per code, values cast to text; NULL values are kept."""
    pairs: list[Column] = []
    for code, c in fields.items():
        pairs += [F.lit(code), _col(c).cast("string")]
    return F.create_map(*pairs)


def drop_empty(event: ColumnLike) -> Column:
    """Keep entries whose value is neither NULL nor the empty string.

    Whitespace is not trimmed: a value of one space stays.
    """
    return F.map_filter(_col(event), lambda k, v: v.isNotNull() & (v != F.lit("")))


def fields_to_map(fields: Mapping[str, ColumnLike]) -> Column:
    """Row to event map, leaving out NULL and empty fields."""
    return drop_empty(raw_map(fields))


def get_field(event: ColumnLike, code: str) -> Column:
    """Value of one field; NULL when the event does not carry it."""
    return _col(event)[code]


def put_field(event: ColumnLike, code: str, value: ColumnLike) -> Column:
    """Set a field, overwriting an existing value (``value`` is a column or a column name).

    ``map_concat`` refuses a repeated key, so the old entry is filtered out
    first.  A NULL event stays NULL.
    """
    ev = _col(event)
    entry = F.create_map(F.lit(code), _col(value))
    # The common case (field absent) is a plain concat; only an event that
    # already has the field pays for filtering its map.
    replaced = F.map_concat(F.map_filter(ev, lambda k, v: k != F.lit(code)), entry)
    return F.when(ev.isNull(), F.lit(None)).when(F.map_contains_key(ev, F.lit(code)), replaced).otherwise(F.map_concat(ev, entry))


def put_constants(event: ColumnLike, constants: Mapping[str, str]) -> Column:
    """Enrichment by constant fields (each overwrites).

    One filter and one concat whatever the number of constants, so the
    expression grows linearly with them.  A NULL event stays NULL.
    """
    ev = _col(event)
    if not constants:
        return ev
    kept = F.map_filter(ev, lambda k, v: ~k.isin(*constants))
    return F.map_concat(kept, F.create_map(*(F.lit(x) for pair in constants.items() for x in pair)))


def restamp_time(
    event: ColumnLike,
    clock: ColumnLike | None = None,
    offset_minutes: int = RESTAMP_OFFSET_MINUTES,
    code: str = "dt",
    fmt: str = TIME_FORMAT,
) -> Column:
    """If the event carries ``code``, replace it by ``clock - offset`` as text.

    ``clock`` defaults to ``current_timestamp()``; pass a column (for example
    the event's own timestamp) for a reproducible run.
    """
    ev = _col(event)
    clock_col = F.current_timestamp() if clock is None else _col(clock)
    stamped = F.date_format(clock_col - F.expr(f"INTERVAL {int(offset_minutes)} MINUTES"), fmt)
    return F.when(get_field(ev, code).isNotNull(), put_field(ev, code, stamped)).otherwise(ev)


def entries(df, *keep: str, event: str = "event"):
    """``(keep…, qualifier, value)``: one row per entry of each event.

    Uses ``explode_outer`` and drops its NULL row for empty events: a plain
    ``explode`` lets the optimizer infer ``size(event) > 0`` and push that
    filter below the projection that builds the map, building it twice.
    """
    out = df.select(*keep, F.explode_outer(event).alias("qualifier", "value"))
    return out.filter(F.col("qualifier").isNotNull())
