"""Text forms of events and of CSV headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fanwrite.functions.events import ColumnLike, _col


def blob_text(event: ColumnLike) -> Column:
    """The event as ``{k1=v1, k2=v2}`` with keys in sorted order.

    Sorted keys make the text the same for equal events on every run.  A NULL
    value prints as ``null``; an empty value prints as nothing after ``=``.
    """
    ev = _col(event)
    # Keys are unique, so sorting the (key, value) entries sorts by key; no
    # per-key lookup back into the map.
    entries = F.transform(
        F.sort_array(F.map_entries(ev)),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))),
    )
    return F.when(ev.isNotNull(), F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}")))


def header_code(label: str) -> str:
    """Field code from a CSV header cell ``Label(code)``: the text between the
    first ``(`` and the last character.  A cell without ``(`` keeps all but its
    last character, as the header rule has it; cells are column names, so this
    runs on the driver over the header only."""
    return label[label.find("(") + 1 : len(label) - 1]


def header_code_column(label: ColumnLike) -> Column:
    """:func:`header_code` of a column of header cells."""
    text = _col(label)
    start = F.locate("(", text)  # 0: none
    return F.substring(text, start + 1, F.greatest(F.length(text) - 1 - start, F.lit(0)))
