"""fanwrite: a Spark-native event fan-out engine.

Sparse, string-keyed events (``MAP<STRING,STRING>``) are decoded from message
payloads, enriched, routed to destination tables and written to several sinks
per micro-batch: wide-column style cell tables (one per tenant or one shared,
blob or one cell per field) and a document index where the latest version of
each document id wins.  Everything is expressed with DataFrame column
expressions so Catalyst plans one narrow, code-generated stage per batch.
"""

from fanwrite.options import FanoutOptions

__all__ = ["FanoutOptions"]
