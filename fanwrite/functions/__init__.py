"""Native column expressions used by every fan-out plan."""

from fanwrite.functions.codec import decode, encode, payload_size
from fanwrite.functions.events import (
    drop_empty,
    entries,
    fields_to_map,
    get_field,
    put_constants,
    put_field,
    raw_map,
    restamp_time,
)
from fanwrite.functions.keys import digest_key, position_key, random_key, row_key, uuid_text
from fanwrite.functions.routing import route
from fanwrite.functions.text import blob_text, header_code
from fanwrite.functions.timefmt import event_time

__all__ = [
    "blob_text",
    "decode",
    "digest_key",
    "drop_empty",
    "encode",
    "event_time",
    "entries",
    "fields_to_map",
    "get_field",
    "header_code",
    "payload_size",
    "position_key",
    "put_constants",
    "put_field",
    "random_key",
    "raw_map",
    "restamp_time",
    "route",
    "row_key",
    "uuid_text",
]
