"""Messages that a source delivers again.

A producer that retries, or a log that is read twice, brings a message more than
once.  ``without_repeats`` keeps the first within a span of event time; the state
of a key is dropped once the watermark has passed its end, so what is held is
bounded by the span, not by the stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from fanwrite.sources.messages import POSITION_COLUMNS


def without_repeats(messages: DataFrame, within: str, by: Sequence[str] = POSITION_COLUMNS, time: str = "timestamp") -> DataFrame:
    """The messages less those that repeat ``by`` (NULL equals NULL) within ``within``
    (an interval such as ``"1 hour"``) of the first one's ``time``.

    In a stream a message that is no newer than the newest one of earlier batches
    less ``within`` is late: whether it is a repeat can't be told any more, and it
    is left out (counted as ``rows_late`` in :mod:`fanwrite.streaming.progress`),
    so choose the span longer than the source may lag.  A static table has no late
    rows: one message of each ``by`` is kept.
    """
    if not messages.isStreaming:
        return messages.dropDuplicates(list(by))
    return messages.withWatermark(time, within).dropDuplicatesWithinWatermark(list(by))
