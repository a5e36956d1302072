"""Nearest neighbours by a hash-prefix forest.

Each tree gives every vector a long string of bits.  Five of them are a letter: of a
random projection to ``DIMENSIONS`` dimensions, which is largest in absolute value,
and its sign.  A tree is the sorted array of the strings: the vectors that share
a prefix, of any number of bits, are a stretch of it.

A query descends in all trees to its longest matching prefixes (as long as the
stretches hold ``START`` times the square root of all rows times those asked for)
and then ascends in all trees at once, a bit at a time, until its best ones are met
in so many trees that hardly any can have been missed in all of them (``missed``);
the last step up is to the whole table.  On its way up a query takes no vector that
is worse than as many as it needs of those it has met.  So the same rule holds at every size and for
crowded or slanted vectors.  For largest inner products, vectors are scaled by the
largest norm and get one more component that makes their length 1; queries get a
0 there.

Vectors and strings are stored once in the shared folder, dealt evenly over
tasks that read them in blocks of bounded size; each block sorts its own part
of every tree, so a crowded prefix is spread over all blocks and no vector is
copied.  Queries go to all blocks, ``QUERY_BLOCK`` at a time; a block returns
its best few for each.  Equal vectors are searched once, under their least
ids; as many ids are kept as a query can return.
"""

from __future__ import annotations

import functools
import math
import sys
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fanwrite.llm.components import stored

TREES = 128
DIMENSIONS = 16  # of a letter's projection; it has twice as many values
LETTERS = 4
SEED = 20260102
NEAREST = 20
START = 5  # times sqrt(rows * nearest): rows (repeats included) in the stretches a query begins with
FEW = 64  # queries up to which a block compares their strings with all of its own instead of sorting these
MISSED = 0.05  # of the nearest, that may be missed by estimate
BLOCK_ROWS = 12_000
QUERY_BLOCK = 20_000
ROWS_OUT = 5_000  # results of a block handed on at once
SLICE = 500  # vectors projected at once

LETTER_BITS = (2 * DIMENSIONS - 1).bit_length()
BITS = LETTERS * LETTER_BITS
DEPTHS = np.array([0, *range(4, BITS + 1, 2)])  # bits of the prefixes that are counted


class Queries(NamedTuple):
    """Vectors of a query block with their tree strings, the depth each ascends to, and
    the score below which it needs no more."""

    keys: list[tuple[int, int]]
    vectors: np.ndarray
    strings: np.ndarray
    depths: np.ndarray
    floors: np.ndarray


def projections(dim: int, trees: int) -> list[np.ndarray]:
    rng = np.random.default_rng(SEED)
    return [rng.standard_normal((dim, trees * DIMENSIONS)) for _ in range(LETTERS)]


def tree_strings(vectors: np.ndarray, trees: int) -> np.ndarray:
    """The string of every vector in every tree, as a number."""
    out = np.zeros((trees, len(vectors)), np.int32)
    for p in projections(vectors.shape[1], trees):
        for start in range(0, len(vectors), SLICE):
            y = (vectors[start : start + SLICE] @ p).reshape(-1, trees, DIMENSIONS)
            largest = np.abs(y).argmax(axis=2)
            sign = np.take_along_axis(y, largest[:, :, None], axis=2)[:, :, 0] > 0
            part = out[:, start : start + SLICE]
            part <<= LETTER_BITS
            part |= (2 * largest + sign).T.astype(np.int32)
    return out


def lengthened(vectors: np.ndarray, largest_norm: float) -> np.ndarray:
    """Scaled to at most length 1, with the component that is missing to 1."""
    scaled = vectors / largest_norm
    rest = np.sqrt(np.maximum(0.0, 1 - (scaled**2).sum(axis=1)))
    return np.column_stack([scaled, rest])


class Forest:
    """The part of the forest over one block: every tree's strings, sorted when first needed."""

    def __init__(self, strings: np.ndarray) -> None:
        self.unsorted = strings

    @functools.cached_property
    def order(self) -> np.ndarray:
        return np.argsort(self.unsorted, axis=1, kind="stable")

    @functools.cached_property
    def strings(self) -> np.ndarray:
        return np.take_along_axis(self.unsorted, self.order, axis=1)

    def met(self, strings: np.ndarray, depths: np.ndarray) -> Iterator[np.ndarray]:
        """For each query, in how many trees every row of the block shares its prefix."""
        trees, n = self.unsorted.shape
        few = len(depths) <= FEW
        begin, end = self.stretches(strings, depths) if not few else (None, None)
        for q, depth in enumerate(depths):
            if depth == 0:
                yield np.full(n, trees)
            elif few:
                yield ((self.unsorted ^ strings[:, q, None]) >> (BITS - depth) == 0).sum(axis=0)
            else:
                yield np.bincount(np.concatenate([o[i:j] for o, i, j in zip(self.order, begin[:, q], end[:, q], strict=True)]), minlength=n)

    def stretches(self, strings: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end, in each tree, of what shares so many bits with the queries."""
        below = (BITS - depths).astype(np.int32)
        low = (strings >> below) << below
        high = ((strings >> below) + 1) << below
        ends = [[np.searchsorted(mine, x) for mine, x in zip(self.strings, bound, strict=True)] for bound in (low, high)]
        return np.array(ends[0]), np.array(ends[1])

    def sizes(self, strings: np.ndarray) -> np.ndarray:
        """For each query, candidates at each of ``DEPTHS``, summed over the trees."""
        out = np.empty((strings.shape[1], len(DEPTHS)), np.int64)
        for k, d in enumerate(DEPTHS):
            begin, end = self.stretches(strings, np.full(strings.shape[1], d))
            out[:, k] = (end - begin).sum(axis=0)
        return out


class Block(NamedTuple):
    vectors: np.ndarray
    ids: list[list[int]]
    forest: Forest


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[Block]:
    """The rows of a task in blocks of at least ``BLOCK_ROWS`` (the last may be smaller)."""
    held: list[pd.DataFrame] = []
    for batch in chain(batches, [None]):
        if batch is not None and len(batch):
            held.append(batch)
        if held and (batch is None or sum(map(len, held)) >= BLOCK_ROWS):
            rows = pd.concat(held)
            strings = np.ascontiguousarray(np.stack(rows["strings"].to_numpy()).T)
            yield Block(np.stack(rows["vector"].to_numpy()), [np.asarray(i).tolist() for i in rows["ids"]], Forest(strings))
            held = []


def _index(points: DataFrame, norms: dict[int, float], trees: int) -> DataFrame:
    """``points`` with the strings of each vector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                vectors = np.stack(part["vector"].to_numpy())
                yield part.assign(strings=list(tree_strings(lengthened(vectors, norms[dim]), trees).T))

    return points.mapInPandas(run, "ids array<bigint>, vector array<double>, dim int, strings array<int>")


def _valid(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, vector, dim, norm, h1, h2`` of the rows that take part, repeated rows once."""
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    largest = F.array_max(F.transform("vector", F.abs))
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~bad).withColumn("largest", largest).where("largest > 0")
    # Scaled before squaring: the squares of very small or large components are no numbers.
    norm = F.col("largest") * F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / F.col("largest")) * (x / F.col("largest"))))
    rows = rows.withColumn("norm", F.least(norm, F.lit(sys.float_info.max)))
    rows = rows.withColumns({"dim": F.size("vector"), "h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})
    return rows.dropDuplicates(["id", "h1", "h2"])


def search(
    df: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    nearest: int = NEAREST,
    trees: int = TREES,
    start: float = START,
) -> DataFrame:
    """``query_id, rank, vec_id, score, candidates``: for every row of ``queries`` its
    ``nearest`` rows of ``df`` that were found, by inner product in double
    precision, ties to the smaller id, the row of the query's own id left out;
    ``candidates`` is how many different vectors it was compared with in the end.
    With ``start=math.inf`` every query is compared with all rows: the exact way.

    Rows whose id or vector is null, and vectors that are zero or hold null or
    non-finite components, take no part on either side.  A product too large for a
    double is infinite (the least, if it has infinite parts of both signs).  Vectors are compared
    with those of equal length only.  Equal vectors under several ids are
    several rows; rows that repeat an id and vector count once.  Other columns
    are not read; empty tables give an empty result.
    """
    rows, asked = _valid(df, key, vector), _valid(queries, key, vector)
    by_id = Window.partitionBy("h1", "h2").orderBy("id")
    points = rows.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= nearest + 1)
    points = points.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("id")).alias("ids"), *(F.first(c).alias(c) for c in ("vector", "dim")))
    kinds = asked.groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.first("dim").alias("dim"))
    shapes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.max("norm").alias("norm")).collect()
    tasks = max(1, math.ceil(sum(r["n"] for r in shapes) / BLOCK_ROWS))
    index = stored(_index(points.select("ids", "vector", "dim").repartition(tasks), {r["dim"]: r["norm"] for r in shapes}, trees), "ann-index")
    kinds = stored(kinds, "ann-queries")
    out = None
    for size in index.groupBy("dim").count().orderBy("dim").collect():
        mine = index.where(F.col("dim") == size["dim"]).select("ids", "vector", "strings")
        for block in _query_blocks(kinds.where(F.col("dim") == size["dim"]), trees):
            found = _search_block(mine, block, start * math.sqrt(size["count"] * nearest), nearest)
            out = found if out is None else out.union(found)
    if out is None:
        return df.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double, candidates bigint")
    best = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), F.col("ids")[0])
    out = out.withColumn("r", F.row_number().over(best)).where(F.col("r") <= nearest + 1)
    hits = asked.select(F.col("id").alias("query_id"), "h1", "h2").join(out, ["h1", "h2"])
    hits = hits.select("query_id", F.explode("ids").alias("vec_id"), "score", "candidates").where("vec_id <> query_id")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score", "candidates")


def _query_blocks(kinds: DataFrame, trees: int) -> Iterator[Queries]:
    """Distinct query vectors, at most about ``QUERY_BLOCK`` at once."""
    n = math.ceil(kinds.count() / QUERY_BLOCK)
    for b in range(n):
        some = kinds if n == 1 else kinds.where(F.pmod(F.xxhash64("h1", "h2"), F.lit(n)) == b)
        rows = some.select("h1", "h2", "vector").collect()
        if rows:
            vectors = np.array([r["vector"] for r in rows])
            unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            strings = tree_strings(np.column_stack([unit, np.zeros(len(unit))]), trees)
            yield Queries([(r["h1"], r["h2"]) for r in rows], vectors, strings, np.zeros(len(rows), np.int64), np.full(len(rows), -np.inf))


def _search_block(points: DataFrame, queries: Queries, wanted: float, nearest: int) -> DataFrame:
    """``h1, h2, ids, score, candidates``: each block's best for every query.

    Queries begin where the trees hold ``wanted`` rows, repeats included, and
    ascend by a bit until ``_complete``."""
    asked = points.sparkSession.sparkContext.broadcast(queries)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(asked.value.keys), len(DEPTHS)), np.int64)
        for block in _blocks(batches):
            total += block.forest.sizes(asked.value.strings)
        q, d = np.nonzero(total)
        if len(q):
            yield pd.DataFrame({"q": q, "depth": DEPTHS[d], "n": total[q, d]})

    sizes = points.mapInPandas(count, "q int, depth int, n bigint").groupBy("q", "depth").agg(F.sum("n").alias("n"))
    enough = sizes.where((F.col("n") >= wanted) | (F.col("depth") == 0)).groupBy("q").agg(F.max("depth").alias("depth"))
    depths = np.zeros(len(queries.keys), np.int64)
    for r in enough.collect():
        depths[r["q"]] = r["depth"]
    pending, out = queries._replace(depths=depths), None
    while len(pending.keys):
        found = stored(_ascended(points, pending, nearest), "ann-found")
        done, floors = _complete(found, pending, nearest)
        kept = found if done.all() else found.join(F.broadcast(_keys(points, pending, done)), ["h1", "h2"], "left_semi")
        out = kept if out is None else out.union(kept)
        rest = np.flatnonzero(~done)
        pending = Queries([pending.keys[i] for i in rest], pending.vectors[rest], pending.strings[:, rest], pending.depths[rest] - 1, floors[rest])
    candidates = F.sum("n").over(Window.partitionBy("h1", "h2")).alias("candidates")
    return out.select("h1", "h2", "ids", "score", candidates).where("ids IS NOT NULL")


def _keys(points: DataFrame, asked: Queries, which: np.ndarray) -> DataFrame:
    return points.sparkSession.createDataFrame([k for k, w in zip(asked.keys, which, strict=True) if w], "h1 bigint, h2 bigint")


def _ascended(points: DataFrame, asked: Queries, nearest: int) -> DataFrame:
    """``h1, h2, ids, score, trees, n``: each block's best for every query at its
    depth, from its floor on, in how many trees they were met, and the block's
    number of distinct candidates (on one of the rows, which has no ids if none of
    them reached the floor; 0 on the others)."""
    ready = points.sparkSession.sparkContext.broadcast(asked)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(batches):
            yield from _nearest(block, ready.value, nearest)

    return points.mapInPandas(find, "h1 bigint, h2 bigint, ids array<bigint>, score double, trees int, n bigint")


def missed(once: Column, twice: Column) -> Column:
    """How many of the nearest were met in no tree, if so many were met in one
    and in two only (Chao's estimator, which is exact for equal chances and
    low for unequal ones)."""
    return once * (once - 1) / (2 * (twice + 1))


def _complete(found: DataFrame, asked: Queries, nearest: int) -> tuple[np.ndarray, np.ndarray]:
    """Which queries need not ascend further, and the score of the last one each needs."""
    best = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), F.col("ids")[0])
    ranked = found.where("ids IS NOT NULL").withColumn("r", F.row_number().over(best)).where(F.col("r") <= nearest + 1)
    times = {k: F.count_if(F.col("trees") == k) for k in (1, 2)}
    met = ranked.groupBy("h1", "h2").agg(F.count("*").alias("met"), F.min("score").alias("floor"), missed(times[1], times[2]).alias("missed"))
    # A row a query of the block.
    last = {(r["h1"], r["h2"]): (r["missed"] <= MISSED * nearest, r["floor"]) for r in met.where(F.col("met") > nearest).collect()}
    done = np.array([d == 0 or last.get(k, (False,))[0] for k, d in zip(asked.keys, asked.depths, strict=True)], bool)
    return done, np.array([last[k][1] if k in last else -np.inf for k in asked.keys])


def _nearest(block: Block, asked: Queries, nearest: int) -> Iterator[pd.DataFrame]:
    """The block's best candidates of each query, one more than asked for as
    the query may be among them."""
    first = np.array([i[0] for i in block.ids])
    rows: list[tuple] = []
    for q, trees in enumerate(block.forest.met(asked.strings, asked.depths)):
        key, candidates = asked.keys[q], np.flatnonzero(trees)
        n = len(candidates)
        with np.errstate(over="ignore", invalid="ignore"):
            scores = block.vectors[candidates] @ asked.vectors[q]
        scores[np.isnan(scores)] = -np.inf  # infinite parts of both signs
        floor = asked.floors[q]
        if n > nearest + 1:
            floor = max(floor, np.partition(scores, -nearest - 1)[-nearest - 1])
        candidates, scores = candidates[scores >= floor], scores[scores >= floor]
        best = np.lexsort((first[candidates], -scores))[: nearest + 1]
        rows += [(*key, block.ids[candidates[i]], scores[i], trees[candidates[i]], 0 if k else n) for k, i in enumerate(best)]
        if n and not len(best):
            rows.append((*key, None, None, None, n))
        if len(rows) >= ROWS_OUT or q == len(asked.keys) - 1:
            out = pd.DataFrame(rows, columns=["h1", "h2", "ids", "score", "trees", "n"])
            yield out.astype({"trees": "Int32"})
            rows = []


def neighbours(embeddings: DataFrame, every: int = 20) -> DataFrame:
    """Neighbours of the rows whose vec_id is divisible by ``every``."""
    return search(embeddings, embeddings.where(F.col("vec_id") % every == 0))
