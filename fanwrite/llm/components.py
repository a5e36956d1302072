"""Connected components of an undirected graph given as edges.

Alternating star contraction: the large star links every larger neighbour of
a node to the least of its neighbours and itself, the small star does so for
the smaller ones; when neither changes anything, every node hangs on the
least node of its component.  The number of rounds grows with the logarithm
of the graph's size.  Minima are aggregated before the shuffle and each
round's edges are written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanwrite.session import scratch_dir


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _star(arcs: DataFrame) -> DataFrame:
    """Each arc with the least of its source and that one's targets."""
    least = arcs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return arcs.join(least, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    arcs = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _star(arcs).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    arcs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = _star(arcs)
    moved = stars.select(F.col("b").alias("a"), F.col("m").alias("b")).union(stars.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one target only, a lesser one that has none itself."""
    rising = edges.where("a < b")
    inner = edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi")
    split = edges.groupBy("a").count().where("count > 1")
    return rising.isEmpty() and inner.isEmpty() and split.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns a, b: bigint),
    the component being its least node.  Loops and repeated edges are fine;
    an edge with a null end is left out; no edges give no rows.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "components")
    while not _are_stars(edges):
        edges = stored(_large_star(edges), "components")
        edges = stored(_small_star(edges), "components")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
