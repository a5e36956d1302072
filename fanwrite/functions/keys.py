"""Row keys for the cell tables.

A key drawn at random on every attempt makes a replayed batch write its rows
a second time.  The default keys here are UUID-shaped MD5 digests of
something that is the same on every replay, so re-running a batch rewrites
the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fanwrite.functions.events import ColumnLike, _col


def uuid_text(hex32: ColumnLike) -> Column:
    """Format 32 hex digits as 8-4-4-4-12 (NULL stays NULL)."""
    h = _col(hex32)
    parts = F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.substring(h, 13, 4),
        F.substring(h, 17, 4),
        F.substring(h, 21, 12),
    )
    return F.when(h.isNotNull(), parts)


def digest_key(text: ColumnLike) -> Column:
    """UUID-shaped MD5 of a text; NULL in, NULL out."""
    return uuid_text(F.md5(_col(text).cast("string")))


def position_key(*position: ColumnLike) -> Column:
    """Key from a source position such as (topic, partition, offset)."""
    return digest_key(F.concat_ws("/", *[_col(p).cast("string") for p in position]))


def random_key() -> Column:
    """A fresh random UUID per row and attempt (not replay-safe)."""
    return F.expr("uuid()")


def row_key(strategy: str, id_text: Column, position: list[Column] | None, blob_text: Column) -> Column:
    """Pick the row key expression.

    ``id``: digest of the event id; ``position``: digest of the source
    position; ``blob``: digest of the whole event text; ``auto``: the source
    position when the source has one, else the id, else the blob text;
    ``random``: ``uuid()``.
    """
    if strategy == "random":
        return random_key()
    if strategy == "id":
        return digest_key(id_text)
    if strategy == "blob":
        return digest_key(blob_text)
    if strategy == "position":
        if not position:
            raise ValueError("row_key='position' needs a source with a position")
        return position_key(*position)
    if strategy == "auto":
        if position:
            return position_key(*position)
        return F.coalesce(digest_key(id_text), digest_key(blob_text))
    raise ValueError(f"unknown row key strategy {strategy!r}")
