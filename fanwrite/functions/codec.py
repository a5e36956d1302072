"""Payload codec: event map <-> JSON bytes.

The wire contract is one JSON object whose values are strings.  ``from_json``
alone stops after the first JSON value and keeps repeated keys, so a payload is
read as the first of two elements of an array whose second one is a marker:
text after the object, a second object or a closing bracket of the payload's
own all change what the array holds.  Malformed, truncated or non-object
payloads become NULL, which is how rejects are found.  Bare JSON numbers are
read as their text, nested objects as their JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fanwrite.functions.events import ColumnLike, _col

EVENTS_TYPE = "array<map<string,string>>"
MARKER = "\x01end-of-payload"
_SECOND = ',{"\\u0001end-of-payload":""}]'


def repeats_key(event: ColumnLike) -> Column:
    """Whether a decoded map holds a key more than once."""
    keys = F.map_keys(_col(event))
    return F.size(keys) != F.size(F.array_distinct(keys))


def decode_array(payload: ColumnLike) -> Column:
    """An array of one map: the payload's entries, repeated keys and all; the
    map is NULL unless the payload is one JSON object and nothing else.

    An array, so that the parsed text is bound once (as a lambda's argument).
    """
    text = _col(payload).cast("string")
    both = F.from_json(F.concat(F.lit("["), text, F.lit(_SECOND)), EVENTS_TYPE)
    unmarked = ~F.contains(text, F.lit("end-of-payload"))

    def first(parsed: Column) -> Column:
        whole = (F.size(parsed) == 2) & F.map_contains_key(F.get(parsed, F.lit(1)), F.lit(MARKER)) & unmarked
        return F.when(whole, F.get(parsed, F.lit(0)))

    return F.transform(F.array(both), first)


def decode(payload: ColumnLike) -> Column:
    """Bytes (or text) to an event map; NULL for anything but one JSON object
    without repeated keys."""
    return F.transform(decode_array(payload), lambda event: F.when(~repeats_key(event), event))[0]


def encode(event: ColumnLike) -> Column:
    """Event map to UTF-8 JSON bytes."""
    return F.encode(F.to_json(_col(event)), "UTF-8")


def payload_size(payload: ColumnLike) -> Column:
    """Size of an encoded payload in bytes."""
    return F.octet_length(_col(payload))
