"""Sources: parquet tables, message streams (Kafka or a file log), CSV files."""

from fanwrite.sources.csv_events import read_csv_events, write_csv_events
from fanwrite.sources.messages import (
    MESSAGE_SCHEMA,
    POSITION_COLUMNS,
    kafka_stream,
    message_log,
    message_log_stream,
    messages_from_events,
    write_message_log,
)
from fanwrite.sources.tables import events_from_table, raw_events_from_table, read_table, table_fields, tenant_source_predicate

__all__ = [
    "MESSAGE_SCHEMA",
    "POSITION_COLUMNS",
    "events_from_table",
    "kafka_stream",
    "message_log",
    "message_log_stream",
    "messages_from_events",
    "raw_events_from_table",
    "read_csv_events",
    "read_table",
    "table_fields",
    "tenant_source_predicate",
    "write_csv_events",
    "write_message_log",
]
