"""The shared fan-out transform: events -> enriched, keyed, routed events.

Stream batches, bulk loads and the registered queries all go through
:func:`prepare`.  It is one lazy ``DataFrame -> DataFrame`` of narrow column
expressions, so Catalyst pipelines it with the scan and the write in one
stage: no shuffle, no Python per row.  A custom enrichment hook can build on
the default with ``lambda df: more(enrich_constants(opts)(df))``.

Columns added: ``event`` (enriched), ``doc_id``, ``tenant``, ``table_name``,
``row_key``; ``reason`` is kept or added (NULL = good).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanwrite.functions.events import get_field, put_constants
from fanwrite.functions.keys import row_key
from fanwrite.functions.routing import route
from fanwrite.functions.text import blob_text
from fanwrite.options import FanoutOptions

Enrich = Callable[[DataFrame], DataFrame]


def enrich_constants(opts: FanoutOptions) -> Enrich:
    """The default enrichment: put each constant of ``opts.enrich``."""

    def _enrich(df: DataFrame) -> DataFrame:
        return df.withColumn("event", put_constants("event", opts.enrich))

    return _enrich


class Preparer:
    """:func:`prepare` with its column expressions built once.

    Column expressions are unresolved, so a stream keeps one ``Preparer`` and
    applies it to every micro-batch; only the plan analysis is per batch, not
    the hundreds of driver-to-JVM calls that build the expressions.
    """

    def __init__(
        self,
        opts: FanoutOptions,
        position: Sequence[str] | None = None,
        enrich: Enrich | None = None,
        lifted: Sequence[str] = (),
    ):
        self.opts = opts
        self.position = tuple(position) if position else None
        self.enrich = enrich
        self.lifted = frozenset(lifted)
        self._enriched = None
        self._derived: dict[tuple, dict] = {}

    def _is_lifted(self, code: str) -> bool:
        # A source may declare that it carries a field as a plain column
        # named by its code (lifted from its own columns, so predicates push
        # down).  Use it unless enrichment may have rewritten that field in
        # the map.  A column that merely has the name (a message's key, say)
        # is never taken for the field.
        return code in self.lifted and self.enrich is None and code not in self.opts.enrich

    def _field(self, code: str):
        return F.col(code) if self._is_lifted(code) else get_field("event", code)

    def _derived_columns(self, columns: tuple) -> dict:
        opts = self.opts
        pos = [F.col(c) for c in self.position] if self.position else None
        doc_id = self._field(opts.index_id_field)
        tenant = self._field(opts.tenant_field)
        if opts.row_key == "id" and "reason" not in columns and self._is_lifted("id"):
            # Every row has an event (a frame without rejects) and the id is a
            # source column: the key needs no map, so a narrow projection
            # reads only the id's own column.
            key = row_key("id", F.col("id"), pos, None)
        else:
            key = F.when(F.col("event").isNotNull(), row_key(opts.row_key, get_field("event", "id"), pos, blob_text("event")))
        return {
            "doc_id": doc_id,
            "tenant": tenant,
            "table_name": route(tenant, opts.base_table, opts.single_table, opts.unrouted_table),
            "row_key": key,
        }

    def __call__(self, events: DataFrame) -> DataFrame:
        columns = tuple(events.columns)
        df = events if "reason" in columns else events.withColumn("reason", F.lit(None).cast("string"))
        if self.enrich is not None:
            df = df.transform(self.enrich)
        else:
            if self._enriched is None:
                self._enriched = put_constants("event", self.opts.enrich)
            df = df.withColumn("event", self._enriched)
        derived = self._derived.get(columns)
        if derived is None:
            derived = self._derived[columns] = self._derived_columns(columns)
        # One projection for all derived columns: separate withColumn calls
        # would each re-analyse the whole plan on the driver.
        return df.withColumns(derived)


def prepare(
    events: DataFrame,
    opts: FanoutOptions,
    position: Sequence[str] | None = None,
    enrich: Enrich | None = None,
    lifted: Sequence[str] = (),
) -> DataFrame:
    """Enrich, lift, route and key events (rows with a NULL event pass through
    untouched, so rejects stay in the same frame).

    ``enrich`` replaces the default constant enrichment: any ``DataFrame ->
    DataFrame`` over the ``event`` column (native expressions, or a pandas UDF
    where nothing native fits).  ``position`` names the source position
    columns used by position row keys.  ``lifted`` declares the fields that
    the source also carries as plain columns named by their code.  An event
    without an id has a NULL ``doc_id``: the index cannot key it, other sinks
    take it.
    """
    return Preparer(opts, position, enrich, lifted)(events)
