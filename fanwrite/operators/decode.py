"""Decode message payloads into events, marking rejects instead of failing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanwrite.functions.codec import decode_array, repeats_key

REASON_NULL_PAYLOAD = "null_payload"
REASON_DECODE = "decode"
REASON_DUPLICATE_FIELD = "duplicate_field"
REASON_NO_DOC_ID = "no_doc_id"
REASON_NULL_EVENT = "null_event"


def fail_on(reason: Column) -> Column:
    """``reason`` as a check: a row that has one fails the job."""
    return F.when(reason.isNotNull(), F.raise_error(F.concat(F.lit("bad row: "), reason)).cast("string"))


def decode_columns(strict: bool = False, payload: str = "value") -> tuple[Column, Column, Column]:
    """The generator that yields the decoded entries, and the expressions of
    ``event`` and ``reason`` over them.

    Column expressions are unresolved, so a stream builds them once and
    reuses them on every micro-batch (each ``F.*`` call is a round trip to
    the JVM on the driver).
    """
    generator = F.explode(decode_array(payload)).alias("_entries")
    repeats = repeats_key("_entries")
    event = F.when(~repeats, F.col("_entries"))
    reason = (
        F.when(F.col(payload).isNull(), F.lit(REASON_NULL_PAYLOAD))
        .when(F.col("_entries").isNull(), F.lit(REASON_DECODE))
        .when(repeats, F.lit(REASON_DUPLICATE_FIELD))
    )
    return generator, event, fail_on(reason) if strict else reason


def decode_messages(
    messages: DataFrame, strict: bool = False, payload: str = "value", columns: tuple[Column, Column, Column] | None = None
) -> DataFrame:
    """Add ``event`` (the decoded map) and ``reason`` (NULL for good rows).

    Reasons: ``null_payload``; ``decode`` for a payload that is not one JSON
    object and nothing else; ``duplicate_field`` for an object that repeats a
    key.  With ``strict`` any of them fails the job instead.
    """
    # The decoded map comes out of a one-row generator rather than a plain
    # projection.  A filter on ``event``/``reason`` (good rows, rejects) is
    # then evaluated on the decoded column; through a projection the
    # optimizer would inline ``from_json`` into the filter, parsing every
    # payload twice and, below a repartition, in the pre-shuffle tasks.
    generator, event, reason = columns or decode_columns(strict, payload)
    return messages.select("*", generator).withColumns({"event": event, "reason": reason}).drop("_entries")


def good(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNull())


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNotNull())
