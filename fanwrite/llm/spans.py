"""Column expressions shared by the operators that return text spans.

A span is ``struct<kind: string, start: bigint, end: bigint>`` in code points,
end exclusive; the operators return them sorted by start, then by kind in the
order the operator lists its kinds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
)


def spans_of(find: Callable[[str | None], list[tuple[str, int, int]]]) -> Callable[[Column], Column]:
    """A column function that applies a span finder to whole texts."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in find(t)] for t in batch], dtype=object)

    return F.pandas_udf(run, SPANS)


def only(spans: Column, kinds: tuple[str, ...]) -> Column:
    """The spans of the given kinds, order kept."""
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def count(spans: Column, kind: str) -> Column:
    return F.size(only(spans, (kind,))).cast("bigint")


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas; '' for none."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def digest(spans: Column) -> Column:
    return F.sha2(as_text(spans), 256)
