"""All registered queries of the library, and the SQL they are held against."""

from __future__ import annotations

from fanwrite.plans import catalog, keyed_catalog, oracle

QUERIES: dict[str, catalog.Query] = catalog.QUERIES | keyed_catalog.QUERIES
ORACLE_SQL: dict[str, str] = oracle.ORACLE_SQL | keyed_catalog.ORACLE_SQL
