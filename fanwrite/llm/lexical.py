"""Ranked lexical search as an exact inner-product search in ball trees.

A document is a sparse vector: for each term it holds (1000000000 * tf) div
(1000 * tf + 8 * m), m growing with its length.  An item is a sparse vector of
term weights times the term's occurrences.  The score is their product, in
whole numbers, so no rounding decides a rank.

The items' words are dealt into blocks of bounded size.  One pass over the
documents cuts them into terms, counts them and keeps, of each document, its
length and the block's terms; lengths and document frequencies are added up by
Spark.  Then each task builds ball trees (``Tree``) over its documents, a few
thousand at a time, and asks them for every item: subtrees are opened best
first, by a bound from the centroid and radius (``Tree.bound``), and a subtree
is left out when its bound is below the item's lowest kept score so far.  The
lists of the tasks are merged in Spark.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fanwrite.llm.components import stored

TOP = 10
BLOCK_WORDS = 200_000  # words of items that are searched at once
DOCUMENTS = 4_096  # of one tree at most
POSTINGS = 400_000  # terms of the documents of one tree, about
LEAF = 32
SAFE = 1e-9  # bounds are raised by this share of what they are made of
WHOLE = 75  # of a hundred: how far length counts

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def terms(text: str | None) -> list[bytes]:
    """A-Z lower-cased; runs of digits, letters and any non-ASCII characters."""
    return _TERM.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


def length_factor(n: int, n_documents: int, n_terms: int) -> int:
    return 100 - WHOLE + (WHOLE * n * n_documents) // n_terms


def parts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a document's terms are worth, in whole numbers."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Item(NamedTuple):
    """A row of the benchmark: its terms (positions in the block's list of
    terms, ascending) and their weights times occurrences."""

    row: int
    terms: np.ndarray
    weights: np.ndarray


class Node(NamedTuple):
    """A ball: the terms below (ascending), their mean values and the radius;
    either two children or the documents and their values, a row a term."""

    terms: np.ndarray
    centre: np.ndarray
    radius: float
    children: tuple[int, int] | None
    documents: np.ndarray
    values: np.ndarray | None


class Tree:
    """A ball tree over the documents of a frame with ids, and their terms and values."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, flat_terms: np.ndarray, flat_values: np.ndarray) -> None:
        self.ids = ids
        self.lengths, self.starts = lengths, np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.flat_terms, self.flat_values = flat_terms, flat_values
        self.nodes: list[Node] = []
        if len(ids):
            self._build()

    def _postings(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms, values and the place in ``rows`` of each posting of some documents."""
        n = self.lengths[rows]
        owner = np.repeat(np.arange(len(rows)), n)
        at = np.repeat(self.starts[rows] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(len(owner))
        return self.flat_terms[at], self.flat_values[at], owner

    def _build(self) -> None:
        waiting = [(np.arange(len(self.ids)), -1)]
        links: dict[int, list[int]] = {}
        while waiting:
            rows, parent = waiting.pop()
            me = len(self.nodes)
            if parent >= 0:
                links.setdefault(parent, []).append(me)
            found, values, owner = self._postings(rows)
            names, at = np.unique(found, return_inverse=True)
            exact = values.astype(np.float64)
            centre = np.bincount(at, exact, len(names)) / len(rows)
            squares = np.bincount(owner, exact * exact, len(rows))

            def apart(point: np.ndarray) -> np.ndarray:
                """Squared distances to a point, and no less than that."""
                norm = float(point @ point)
                return np.maximum(squares - 2 * np.bincount(owner, exact * point[at], len(rows)) + norm, 0) + SAFE * (squares + norm)  # noqa: B023

            far = apart(centre)
            radius = math.sqrt(float(far.max()))
            if len(rows) <= LEAF:
                table = np.zeros((len(names), len(rows)), np.int64)
                table[at, owner] = values
                self.nodes.append(Node(names, centre, radius, None, rows, table))
                continue

            def place(row: int) -> np.ndarray:
                return np.bincount(at[owner == row], exact[owner == row], len(names))  # noqa: B023

            first = int(far.argmax())
            to_first = apart(place(first))
            to_second = apart(place(int(to_first.argmax())))
            side = to_first - to_second
            left = side < 0
            if not len(rows) // 16 < left.sum() < len(rows) - len(rows) // 16:  # copies, or a lone far one
                left = np.zeros(len(rows), bool)
                left[np.argsort(side, kind="stable")[: len(rows) // 2]] = True
            self.nodes.append(Node(names, centre, radius, (0, 0), rows[:0], None))
            waiting += [(rows[left], me), (rows[~left], me)]
        for me, pair in links.items():
            self.nodes[me] = self.nodes[me]._replace(children=tuple(pair))

    def bound(self, node: Node, item: Item) -> tuple[float, np.ndarray, np.ndarray]:
        """No document below scores more; with the item's terms that are met
        there and their places.

        A document differs from the centre in terms met below only, so the item's
        other terms add nothing to what the radius allows.
        """
        at = np.searchsorted(node.terms, item.terms)
        at[at == len(node.terms)] = 0
        met = node.terms[at] == item.terms if len(node.terms) else np.zeros(len(at), bool)
        at, weights = at[met], item.weights[met]
        if not len(at):
            return 0.0, at, weights
        exact = weights.astype(np.float64)
        return (float(node.centre[at] @ exact) + math.sqrt(float(exact @ exact)) * node.radius) * (1 + SAFE), at, weights

    def search(self, item: Item, best: list[tuple[int, int]], top: int) -> int:
        """Adds the tree's best documents to ``best``, a heap of (score, -id) of
        ``top`` at most; returns the number of documents scored."""
        scored = 0
        if not self.nodes:
            return scored
        queue = [(-math.inf, 0)]
        while queue:
            ahead, me = heapq.heappop(queue)
            if len(best) == top and -ahead < best[0][0]:
                break
            node = self.nodes[me]
            if node.children is not None:
                for child in node.children:
                    reach = self.bound(self.nodes[child], item)[0]
                    if reach > 0 and not (len(best) == top and reach < best[0][0]):
                        heapq.heappush(queue, (-reach, child))
                continue
            _, at, weights = self.bound(node, item)
            scored += len(node.documents)
            scores = weights @ node.values[at]
            for row in np.nonzero(scores >= max(1, best[0][0] if len(best) == top else 1))[0].tolist():
                entry = (int(scores[row]), -int(self.ids[node.documents[row]]))
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return scored


def _items(items: DataFrame, key: str, text: str) -> DataFrame:
    """``item, text, n`` once for each item id and text, with the number of its terms."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(n=[len(terms(t)) for t in batch["text"]])

    named = items.select(F.col(key).cast("bigint").alias("item"), F.col(text).alias("text")).distinct()
    return named.mapInPandas(run, "item bigint, text string, n bigint").where("n > 0")


def _counted(docs: DataFrame, names: Broadcast[dict[bytes, int]]) -> DataFrame:
    """``id, n, terms, tfs`` of every document with a term: its length and those
    of its terms that ``names`` numbers, with their occurrences."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = names.value
        for batch in batches:
            rows = []
            for i, t in zip(batch["id"], batch["text"], strict=True):
                if found := terms(t):
                    counts = [(known[w], c) for w, c in Counter(found).items() if w in known]
                    rows.append((i, len(found), [k for k, _ in counts], [c for _, c in counts]))
            yield pd.DataFrame(rows, columns=["id", "n", "terms", "tfs"]).astype({"id": "Int64"})

    return docs.mapInPandas(run, "id bigint, n bigint, terms array<int>, tfs array<bigint>")


def _trees(batches: Iterator[pd.DataFrame], n_documents: int, n_terms: int) -> Iterator[Tree]:
    """Trees over a task's documents, of bounded numbers of documents and postings."""
    held: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    size = 0

    def tree() -> Tree:
        lengths = np.array([len(t) for _, _, t, _ in held])
        m = np.repeat(np.array([length_factor(n, n_documents, n_terms) for _, n, _, _ in held]), lengths)
        values = parts(np.concatenate([f for *_, f in held]), m)
        return Tree(np.array([i for i, *_ in held]), lengths, np.concatenate([t for _, _, t, _ in held]), values)

    for batch in batches:
        for row in batch.itertuples(index=False):
            held.append((row.id, row.n, row.terms, row.tfs))
            size += len(row.terms)
            if len(held) == DOCUMENTS or size >= POSTINGS:
                yield tree()
                held, size = [], 0
    if held:
        yield tree()


def _search(counted: DataFrame, block: Broadcast[list[Item]], n_documents: int, n_terms: int, top: int) -> DataFrame:
    """``row, id, score``: each task's best documents of every item of a block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list[list[tuple[int, int]]] = [[] for _ in block.value]
        for tree in _trees(batches, n_documents, n_terms):
            for item, heap in zip(block.value, best, strict=True):
                tree.search(item, heap, top)
        for item, heap in zip(block.value, best, strict=True):
            if heap:
                yield pd.DataFrame([(item.row, -i, score) for score, i in heap], columns=["row", "id", "score"])

    wanted = counted.where(F.col("id").isNotNull() & (F.size("terms") > 0)).select("id", "n", "terms", "tfs")
    return wanted.mapInPandas(run, "row bigint, id bigint, score bigint")


def rank(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``item_key, rank, key, score``: for each item its ``top`` documents of the
    highest scores above 0 (fewer, if there are not so many), equal ones by
    ascending key.

    Null, empty and wordless texts hold no term; such documents don't count and
    such items have no rows.  Repeated rows of ``docs`` are a document each.
    Repeated rows of ``items`` are one item; those of one id with different texts
    are ranked each by itself (as is one without an id).  A document without a
    key counts in the statistics but is not ranked.  Empty tables give no rows;
    other columns are not read.
    """
    spark = docs.sparkSession
    kept = stored(_items(items, item_key, item_text), "lexical-items")
    n_blocks = max(1, math.ceil((kept.agg(F.sum("n")).first()[0] or 0) / block_words))
    named = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    ranked = None
    for b in range(n_blocks):
        rows = kept if n_blocks == 1 else kept.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == b)
        asked = [(r["item"], Counter(terms(r["text"]))) for r in rows.collect()]  # about block_words words
        names = {w: k for k, w in enumerate(sorted({w for _, counts in asked for w in counts}))}
        counted = stored(_counted(named, spark.sparkContext.broadcast(names)), "lexical-terms")
        sizes = counted.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
        held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        df = {r["term"]: r["df"] for r in held.collect()}  # of the block's terms
        block = [_item(row, counts, names, df, sizes["documents"]) for row, (_, counts) in enumerate(asked)]
        found = _search(counted, spark.sparkContext.broadcast(block), sizes["documents"], sizes["terms"] or 1, top)
        found = stored(found, "lexical-found")
        order = Window.partitionBy("row").orderBy(F.col("score").desc(), "id")
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        ids = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(asked)], "row bigint, item bigint")
        best = best.join(F.broadcast(ids), "row").select(F.col("item").alias(item_key), "rank", F.col("id").alias(key), "score")
        ranked = best if ranked is None else ranked.union(best)
    return ranked


def _item(row: int, counts: Counter[bytes], names: dict[bytes, int], df: dict[int, int], n_documents: int) -> Item:
    """An item's vector; terms that no document holds can't score."""
    pairs = sorted((names[w], c * weight(n_documents, df[names[w]])) for w, c in counts.items() if names[w] in df)
    return Item(row, np.array([k for k, _ in pairs], np.int32), np.array([w for _, w in pairs], np.int64))
