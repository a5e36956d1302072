"""Event-time text to timestamps.

Event times arrive as text in one of two forms: ``yyyy-MM-dd HH:mm:ss`` (what
re-stamping writes) or the JVM's default date text ``EEE MMM dd HH:mm:ss zzz
yyyy`` with a zone name.  Spark's parser accepts neither the day-of-week
letter nor zone names, so the day is dropped and the zone name is replaced by
its offset before parsing.  Text that fits neither form gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fanwrite.functions.events import ColumnLike, _col
from fanwrite.options import TIME_FORMAT

# Zone names of event-time text and their UTC offsets.
ZONE_OFFSETS = {"IST": "+0530", "UTC": "+0000", "GMT": "+0000"}
PLAIN_FORMAT = TIME_FORMAT
ZONED_FORMAT = "MMM dd HH:mm:ss Z yyyy"


def event_time(text: ColumnLike) -> Column:
    """Timestamp from event-time text (NULL when it cannot be read)."""
    t = F.trim(_col(text))
    zoned = F.regexp_replace(t, r"^[A-Za-z]{3} ", "")
    for name, offset in ZONE_OFFSETS.items():
        zoned = F.regexp_replace(zoned, f" {name} ", f" {offset} ")
    return F.coalesce(
        F.try_to_timestamp(t, F.lit(PLAIN_FORMAT)),
        F.try_to_timestamp(zoned, F.lit(ZONED_FORMAT)),
    )
