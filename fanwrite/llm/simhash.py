"""SimHash near-duplicates by a Gray-order hierarchical index of fingerprints.

A document's fingerprint is a 64-bit SimHash of its three-word shingles; two
fingerprints link when they differ in at most ``DISTANCE`` bits, and linked
documents form components.

Fingerprints are made distinct first, so copies cost nothing further.  If two
differ in three bits, one of any four bands of bits is the same in both: a
fingerprint goes to four cells, one a band, and links are sought within cells
only.  A cell of more than ``CELL`` fingerprints is split in the same way by
its remaining bits, and again, until all are small; with 13 bits left a cell
can hold no more.  So every link is found, whatever the cells' sizes, and no
task takes more than a bounded part of them.

The cells that a task has gathered are indexed together (``GrayIndex``): sorted
by Gray rank, neighbours share most bits.  ``FAN`` neighbours make a node that
holds the bits common to all below it, and so on upwards.  A pair of nodes
whose common bits differ in more than ``DISTANCE`` places is dropped with all
pairs below it; one that can't differ in more is linked as a whole; one that
lies in a known component is not opened again.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from fanwrite.llm.components import components, stored

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 3
CELL = 8_192  # fingerprints of a cell joined in one task
LEAST_CELL = 1 << DISTANCE
CHUNK = 32_768  # fingerprints of whole cells in one index
FAN = 8
PAIRS = 16_384  # node pairs opened at once
SLICE = 65_536  # shingles whose bits are counted at once
BROADCAST_ROWS = 1_000_000  # cells up to which their names are broadcast


def fingerprint(text: str | None) -> int:
    """A text's SimHash, unsigned: bit by bit the majority of its shingles'
    XXH64 (fewer words: of all of them as one; no words: zero)."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, n, SLICE):
        part = words[start : min(start + SLICE, n) + SHINGLE - 1]
        hashes = [xxh64_intdigest(b" ".join(part[i : i + SHINGLE]), SEED) for i in range(min(SLICE, n - start))]
        ones += np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint_column(text: Column) -> Column:
    """The fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.array([fingerprint(t) for t in batch], np.uint64).view(np.int64))

    return F.pandas_udf(run, "bigint")(text)


def bands(mask: int) -> list[int]:
    """``mask`` widened by each of four bands of the bits it lacks."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    cuts = [i * len(free) // (DISTANCE + 1) for i in range(DISTANCE + 2)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(cuts, cuts[1:])]


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The places of codes in Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Level(NamedTuple):
    """Nodes of one height: bits that are one, or zero, in all codes below, and
    the first and last cell met there."""

    ones: np.ndarray
    zeros: np.ndarray
    low: np.ndarray
    high: np.ndarray


class GrayIndex:
    """Codes of whole cells (``cells`` ascending), in Gray order within each."""

    def __init__(self, codes: np.ndarray, cells: np.ndarray) -> None:
        order = np.lexsort((gray_rank(codes), cells))
        self.codes, cells = codes[order], cells[order]
        self.levels = [Level(self.codes, ~self.codes, cells, cells)]
        while len(self.levels[-1].ones) > FAN:
            below = self.levels[-1]
            starts = np.arange(0, len(below.ones), FAN)
            common = (np.bitwise_and.reduceat(bits, starts) for bits in (below.ones, below.zeros))
            self.levels.append(Level(*common, np.minimum.reduceat(below.low, starts), np.maximum.reduceat(below.high, starts)))
        self.label = np.arange(len(self.codes))  # least member of each code's component so far

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.label[a], self.label[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]

    def known(self, height: int) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest label below each node of a height."""
        starts = np.arange(0, len(self.codes), FAN**height)
        return np.minimum.reduceat(self.label, starts), np.maximum.reduceat(self.label, starts)

    def children(self, nodes: np.ndarray, height: int) -> tuple[np.ndarray, np.ndarray]:
        """All children of nodes, by columns of ``FAN``, and which of them exist."""
        found = nodes[:, None] * FAN + np.arange(FAN)
        return found, found < len(self.levels[height - 1].ones)

    def whole(self, nodes: np.ndarray, height: int) -> tuple[np.ndarray, np.ndarray]:
        """Every code below each of ``nodes``, with the number of its node in the list."""
        size = FAN**height
        found = nodes[:, None] * size + np.arange(size)
        there = found < len(self.codes)
        return found[there], np.nonzero(there)[0]

    def link(self) -> None:
        """Finds all links within cells, up to components."""
        top = len(self.levels) - 1
        a, b = np.triu_indices(len(self.levels[top].ones))
        stack = [(top, a, b)]
        while stack:
            height, a, b = stack.pop()
            if len(a) > PAIRS:
                stack.append((height, a[PAIRS:], b[PAIRS:]))
                a, b = a[:PAIRS], b[:PAIRS]
            level = self.levels[height]
            least, greatest = self.known(height)
            open_ = (level.high[a] >= level.low[b]) & ~((least[a] == greatest[b]) & (greatest[a] == least[b]))
            a, b = a[open_], b[open_]
            differ = np.bitwise_count((level.ones[a] & level.zeros[b]) | (level.zeros[a] & level.ones[b]))
            shared = np.bitwise_count((level.ones[a] | level.zeros[a]) & (level.ones[b] | level.zeros[b]))
            near = differ <= DISTANCE
            whole = near & (differ + (BITS - shared) <= DISTANCE)  # no pair below can differ more
            if whole.any():
                first = a[whole] * FAN**height  # all are linked with the first of a, those of b in any case
                for nodes in (a[whole], b[whole]):
                    members, of = self.whole(nodes, height)
                    self.unite(first[of], members)
            a, b = a[near & ~whole], b[near & ~whole]
            if height and len(a):
                x, x_there = self.children(a, height)
                y, y_there = self.children(b, height)
                both = x_there[:, :, None] & y_there[:, None, :] & (x[:, :, None] <= y[:, None, :])
                x, y = np.broadcast_arrays(x[:, :, None], y[:, None, :])
                stack.append((height - 1, x[both], y[both]))


def link_cells(codes: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that tie together what is linked within cells: each code of a
    component with the component's first."""
    index = GrayIndex(codes.view(np.uint64), cells)
    index.link()
    ends = index.codes.view(np.int64)
    tied = index.label != np.arange(len(ends))
    return ends[tied], ends[index.label[tied]]


def _join_cells(rows: DataFrame) -> DataFrame:
    """Links ``a, b`` between codes of one cell; every cell lies in one task,
    which indexes about ``CHUNK`` codes of whole cells at a time."""

    def joined(parts: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if parts:
            chunk = pd.concat(parts)
            cells = chunk.groupby(["mask", "key"], sort=False).ngroup().to_numpy()
            a, b = link_cells(chunk["code"].to_numpy(), cells)
            yield pd.DataFrame({"a": a, "b": b})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if sum(map(len, held)) >= CHUNK:
                last = held[-1].iloc[-1]  # its cell goes on into this batch perhaps
                same = ((batch["mask"] == last["mask"]) & (batch["key"] == last["key"])).to_numpy()
                yield from joined([*held, batch[same]])
                held, batch = [], batch[~same]
            held.append(batch) if len(batch) else None
        yield from joined(held)

    return rows.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInPandas(run, "a bigint, b bigint")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> BITS - 1 else mask


def links(codes: DataFrame, cell: int = CELL) -> DataFrame:
    """``a, b`` for distinct ``code`` (bigint): links enough to tie together all
    that differ in at most ``DISTANCE`` bits.  ``cell``: at least ``LEAST_CELL``,
    what three bits can tell apart, so that splitting comes to an end."""
    if cell < LEAST_CELL:
        raise ValueError(f"cells of less than {LEAST_CELL} codes can't always be split")
    spark = codes.sparkSession
    rows = codes.select("code", F.explode(F.array(*(F.lit(_signed(m)) for m in bands(0)))).alias("mask"))
    found, split = [], False
    while True:
        rows = rows.select("code", "mask", F.col("code").bitwiseAND(F.col("mask")).alias("key"))
        if split:
            rows = rows.distinct()  # different bands may have come to the same bits
        sizes = rows.groupBy("mask", "key").agg(F.count("*").alias("n"))
        large = stored(sizes.where(F.col("n") > cell).select("mask", "key"), "simhash-large")
        n = large.count()
        if not n:
            found.append(_join_cells(rows))
            break
        large = F.broadcast(large) if n <= BROADCAST_ROWS else large
        found.append(_join_cells(rows.join(large, ["mask", "key"], "left_anti")))
        rows = stored(rows.join(large, ["mask", "key"], "left_semi").select("code", "mask"), "simhash-split")
        masks = [r["mask"] for r in rows.select("mask").distinct().collect()]  # at most four times those before, six times
        table = spark.createDataFrame([(m, _signed(n)) for m in masks for n in bands(m % (1 << BITS))], "mask bigint, narrower bigint")
        rows = rows.join(F.broadcast(table), "mask").select("code", F.col("narrower").alias("mask"))
        split = True
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def group_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, code, component`` for every row: its fingerprint (signed) and the
    least key that links reach, its own included.

    Null, empty and wordless texts have fingerprint zero, linked like any
    other.  Repeated rows stay; rows of one key with different texts are each
    linked by their own.  A row without a key takes the component of the keys
    it reaches (null if none).  Other columns are not read; an empty table
    gives an empty result.
    """
    named = docs.select(F.col(key).cast("bigint").alias("id"), fingerprint_column(F.col(text)).alias("code"))
    coded = stored(named, "simhash-codes")
    codes = stored(coded.groupBy("code").agg(F.min("id").alias("id")), "simhash-distinct")
    tied = components(links(codes))
    grouped = codes.join(tied, F.col("code") == F.col("node"), "left").select("code", "id", F.coalesce("component", "code").alias("group"))
    least = grouped.groupBy("group").agg(F.min("id").alias("component"))
    labels = grouped.join(least, "group").select("code", "component")
    return coded.join(labels, "code").select(F.col("id").alias(key), "code", "component")


def groups(docs: DataFrame) -> DataFrame:
    code = F.lower(F.lpad(F.hex("code"), BITS // 4, "0"))
    return group_documents(docs).select("doc_id", code.alias("fingerprint"), F.col("component").alias("component_id"))
