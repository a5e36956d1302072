"""DataFrame -> DataFrame operators of the fan-out."""

from fanwrite.operators.decode import decode_messages, good, rejected
from fanwrite.operators.latest import document_fields, latest_versions
from fanwrite.operators.layout import CELL_COLUMNS, blob_cells, cells, wide_cells
from fanwrite.operators.parallelism import spread, spread_table
from fanwrite.operators.tenants import route_counts, tenant_filter, tenant_list

__all__ = [
    "CELL_COLUMNS",
    "blob_cells",
    "cells",
    "decode_messages",
    "document_fields",
    "good",
    "latest_versions",
    "rejected",
    "route_counts",
    "spread",
    "spread_table",
    "tenant_filter",
    "tenant_list",
    "wide_cells",
]
