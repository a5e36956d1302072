"""Sinks: wide-column cell tables, the document index, rejects and stats."""

from fanwrite.sinks.index_sink import IndexSink, read_latest, read_versions
from fanwrite.sinks.records import RejectSink, StatsSink, read_records
from fanwrite.sinks.table_sink import CELL_READ_SCHEMA, TableSink, read_cells

__all__ = [
    "CELL_READ_SCHEMA",
    "IndexSink",
    "RejectSink",
    "StatsSink",
    "TableSink",
    "read_cells",
    "read_latest",
    "read_records",
    "read_versions",
]
