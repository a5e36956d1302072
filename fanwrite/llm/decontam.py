"""Benchmark decontamination by a prefix-filtered set join.

A window is ten consecutive words of a benchmark item (all words of an item
with fewer).  A document holds a window only if it holds every five-word
shingle of it; so it must hold the window's rarest shingle, and that shingle
alone is a sufficient prefix for exact containment.  Rarity is the number of
documents that hold the shingle, counted over all documents.

A document is cut into words once; wherever a prefix shingle occurs, its
offset in the window and the window's length give the only place the window
can be (positional and length bounds), and the words there are compared
whole.

The windows' index of a benchmark of up to ``BLOCK_WORDS`` words is broadcast and
searched for text by text.  That of a larger one stays a table (``joined``): what
is broadcast then is a bitmap of fixed size that holds its shingles, so that of the
documents' shingles few others are shuffled; counts and prefixes come from joins on
the shingles, and windows are compared with the words round the place.  The
documents are read three times, however large the benchmark.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from fanwrite.llm.components import stored

WINDOW = 10
SHINGLE = 5
BLOCK_WORDS = 200_000  # benchmark words up to which their index is broadcast
BITMAP_BITS = 28  # places of the bitmap, as a power of two: 32 MB
BITMAP_ROW = 1 << 15  # places in a row of Spark's bitmaps
BROADCAST_ROWS = 1_000_000  # texts with hits up to which they are broadcast
SEGMENT_WORDS = 20_000  # longer items are cut into overlapping segments

_LETTERS = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TABLE = bytes(b if b in _LETTERS else 32 for b in bytes(range(256)).lower())

FOUND = "n_words bigint, hits array<bigint>, items array<string>"


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased; runs of digits, letters and any non-ASCII characters."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class Index(NamedTuple):
    """starts: first words of the prefix shingles by their length; prefixes:
    (offset, window length) pairs of a shingle; windows: their items."""

    starts: dict[int, frozenset[bytes]]
    prefixes: dict[bytes, tuple[tuple[int, int], ...]]
    windows: dict[bytes, tuple[str | None, ...]]


def shingles_of(window: list[bytes]) -> list[bytes]:
    """The window's five-word shingles; the whole window if it has fewer words."""
    k = min(SHINGLE, len(window))
    return [b" ".join(window[i : i + k]) for i in range(len(window) - k + 1)]


def windows_of(item: list[bytes]) -> Iterator[list[bytes]]:
    if item:
        for i in range(max(1, len(item) - WINDOW + 1)):
            yield item[i : i + WINDOW]


def build(items: Iterable[tuple[str | None, str]], counts: dict[bytes, int]) -> Index:
    """The index of a block; each window enters under its rarest shingle."""
    windows: dict[bytes, set[str | None]] = {}
    prefixes: dict[bytes, set[tuple[int, int]]] = {}
    for item_id, text in items:
        for window in windows_of(text.encode().split()):
            name = b" ".join(window)
            if name not in windows:
                rarity = [(counts.get(s, 0), s, i) for i, s in enumerate(shingles_of(window))]
                _, rarest, offset = min(rarity)
                prefixes.setdefault(rarest, set()).add((offset, len(window)))
            windows.setdefault(name, set()).add(item_id)
    return Index(starts(prefixes), {s: tuple(sorted(p)) for s, p in prefixes.items()}, {w: tuple(i) for w, i in windows.items()})


def starts(shingles: Iterable[bytes]) -> dict[int, frozenset[bytes]]:
    first: dict[int, set[bytes]] = {}
    for s in shingles:
        parts = s.split()
        first.setdefault(len(parts), set()).add(parts[0])
    return {k: frozenset(v) for k, v in first.items()}


def occurrences(text: list[bytes], first: dict[int, frozenset[bytes]]) -> Iterator[tuple[int, bytes]]:
    """Places where a shingle may begin, and the words there."""
    for k, known in first.items():
        for i, w in enumerate(text):
            if w in known:
                yield i, b" ".join(text[i : i + k])


def search(text: list[bytes], index: Index) -> tuple[list[tuple[int, int]], set[str]]:
    """Word ranges covered by windows (merged, in order) and the items they are from."""
    ranges: list[tuple[int, int]] = []
    items: set[str] = set()
    n = len(text)
    for i, shingle in occurrences(text, index.starts):
        for offset, size in index.prefixes.get(shingle, ()):
            start = i - offset
            if start >= 0 and start + size <= n and (of := index.windows.get(b" ".join(text[start : start + size]))):
                ranges.append((start, start + size))
                items.update(x for x in of if x is not None)
    return merged(ranges), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def segments(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """``item, words, n`` with a row for every item, several overlapping by a
    window less a word for long ones; items without words have none."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, value in zip(batch["item"], batch["text"], strict=True):
                all_words = words(value)
                for i in range(0, max(len(all_words) - WINDOW + 1, min(1, len(all_words))), SEGMENT_WORDS):
                    part = all_words[i : i + SEGMENT_WORDS + WINDOW - 1]
                    rows.append((item, b" ".join(part).decode("utf-8", "replace"), len(part)))
            yield pd.DataFrame(rows, columns=["item", "words", "n"])

    named = benchmark.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text"))
    return named.mapInPandas(cut, "item string, words string, n bigint")


def rarity(docs: DataFrame, text: str, items: list[tuple[str | None, str]]) -> dict[bytes, int]:
    """In how many documents each shingle of a block occurs (counted over all)."""
    names = sorted({s for _, t in items for w in windows_of(t.encode().split()) for s in shingles_of(w)})
    shared = docs.sparkSession.sparkContext.broadcast(names)

    def tally(texts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = {s: i for i, s in enumerate(shared.value)}
        first = starts(at)
        total: Counter[int] = Counter()
        for batch in texts:
            for t in batch["text"]:
                total.update({at[s] for _, s in occurrences(words(t), first) if s in at})
        if total:
            yield pd.DataFrame({"i": list(total), "n": list(total.values())})

    counted = docs.select(F.col(text).alias("text")).mapInPandas(tally, "i bigint, n bigint")
    return {names[r["i"]]: r["n"] for r in counted.groupBy("i").agg(F.sum("n").alias("n")).collect()}


def searcher(index: Broadcast[Index]) -> Callable[[Iterator[pd.Series]], Iterator[pd.DataFrame]]:
    """Searches texts for the windows of an index."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                cut = words(t)
                ranges, of = search(cut, index.value)
                rows.append((len(cut), [int(x) for r in ranges for x in r], sorted(of)))
            yield pd.DataFrame(rows, columns=["n_words", "hits", "items"])

    return run


def _name(shingle: bytes) -> int:
    return xxh3_64_intdigest(shingle) - (1 << 63)


def _windows(parts: DataFrame) -> DataFrame:
    """``window, size, names``: the distinct windows of the benchmark and the names of
    their shingles, in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(b" ".join(w).decode(), len(w), [_name(s) for s in shingles_of(w)]) for t in batch["words"] for w in windows_of(t.encode().split())]
            yield pd.DataFrame(rows, columns=["window", "size", "names"])

    return parts.mapInPandas(run, "window string, size int, names array<bigint>").dropDuplicates(["window"])


def _items_of(parts: DataFrame) -> DataFrame:
    """``window, item`` of every window of the benchmark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(b" ".join(w).decode(), i) for i, t in zip(batch["item"], batch["words"], strict=True) for w in windows_of(t.encode().split())]
            yield pd.DataFrame(rows, columns=["window", "item"])

    return parts.where("item IS NOT NULL").mapInPandas(run, "window string, item string").distinct()


def _bitmap(names: DataFrame) -> np.ndarray:
    """A bit for each place that a name (column name) falls on."""
    place = (F.col("name").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)) + 1).alias("place")  # Spark counts them from 1
    rows = names.select(place).groupBy(F.bitmap_bucket_number("place").alias("row")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    out = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    for r in rows.collect():  # at most 8,192 rows of 4 KB
        start = (r["row"] - 1) * BITMAP_ROW // 8
        out[start : start + len(r["bits"])] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _shingles_met(docs: DataFrame, bitmap: np.ndarray, sizes: list[int], places: bool) -> DataFrame:
    """Shingles (of ``sizes`` words) of the texts that fall on the bitmap: ``name``, once a
    text; or ``key, at, before, around, name`` of every place, with the words round it."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = shared.value
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch["key"], batch["text"], strict=True):
                cut, seen = words(text), set()
                for k in sizes:
                    if len(cut) < k:
                        continue
                    names = np.array([_name(b" ".join(cut[i : i + k])) for i in range(len(cut) - k + 1)], np.int64)
                    on = names & ((1 << BITMAP_BITS) - 1)
                    for i in np.flatnonzero(bits[on >> 3] >> (on & 7).astype(np.uint8) & 1).tolist():
                        if places:
                            first = max(0, i - WINDOW + 1)
                            rows.append((key, i, i - first, b" ".join(cut[first : i + WINDOW]).decode("utf-8", "replace"), int(names[i])))
                        else:
                            seen.add(int(names[i]))
                if not places:
                    rows += [(x,) for x in seen]
            yield pd.DataFrame(rows, columns=["key", "at", "before", "around", "name"] if places else ["name"])

    schema = "key string, at bigint, before int, around string, name bigint" if places else "name bigint"
    return docs.mapInPandas(run, schema)


def joined(docs: DataFrame, parts: DataFrame, text: str) -> DataFrame:
    """``key, hits, items`` of the texts in which a window occurs (``key``: the text's SHA-256)."""
    texts = docs.select(F.sha2(F.col(text), 256).alias("key"), F.col(text).alias("text")).where("text IS NOT NULL")
    windows = stored(_windows(parts), "benchmark-windows")
    sizes = sorted(r["k"] for r in windows.select(F.least("size", F.lit(SHINGLE)).alias("k")).distinct().collect())
    shingles = windows.select("window", "size", F.posexplode("names").alias("offset", "name"))
    met = _shingles_met(texts, _bitmap(shingles), sizes, places=False)
    counts = met.groupBy("name").agg(F.count("*").alias("n")).join(shingles.select("name").distinct(), "name")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "name", "offset")).alias("rarest")
    prefixes = shingles.join(counts, "name", "left").groupBy("window", "size").agg(rarest)
    prefixes = stored(prefixes.select("window", "size", F.col("rarest.name").alias("name"), F.col("rarest.offset").alias("offset")), "benchmark-prefixes")
    found = _shingles_met(texts, _bitmap(prefixes), sizes, places=True).join(prefixes, "name")
    begin = F.col("before") - F.col("offset")
    there = F.array_join(F.slice(F.split("around", " "), F.greatest(begin, F.lit(0)) + 1, F.col("size")), " ")
    found = found.where((begin >= 0) & (there == F.col("window"))).select("key", (F.col("at") - F.col("offset")).alias("start"), "size", "window").distinct()
    found = stored(found, "benchmark-found")

    def united(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in rows:
            yield pd.Series([[int(x) for r in merged([(s["start"], s["start"] + s["size"]) for s in ranges]) for x in r] for ranges in batch])

    ranges = found.groupBy("key").agg(F.collect_set(F.struct("start", "size")).alias("ranges"))  # of one text
    items = found.select("key", "window").distinct().join(_items_of(parts), "window").groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return ranges.join(items, "key", "left").select("key", F.pandas_udf(united, "array<bigint>")("ranges").alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def n_words(text: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([len(words(t)) for t in batch])

    return F.pandas_udf(run, "bigint")(text)


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
    found: str = "found",
) -> DataFrame:
    """``docs`` with ``found``: the number of words of the text, the ranges of
    words covered by benchmark windows (start, end, start, end, ...) and the
    items (as text, sorted) of which a window occurs.

    A null or empty text has no words; a null or empty item has no windows.
    Windows of an item whose id is null cover words but name no item; rows
    with the same item id are one item.  All rows and columns of ``docs`` stay
    (a column ``found`` is replaced); empty tables are fine on either side.
    """
    parts = stored(segments(benchmark, item_key, item_text).distinct(), "benchmark-words")
    if (parts.agg(F.sum("n")).first()[0] or 0) <= block_words:
        items = [(r["item"], r["words"]) for r in parts.select("item", "words").collect()]
        index = docs.sparkSession.sparkContext.broadcast(build(items, rarity(docs, text, items)))
        return docs.withColumn(found, F.pandas_udf(searcher(index), FOUND)(F.col(text)))
    hits = stored(joined(docs, parts, text), "benchmark-hits")
    hits = F.broadcast(hits) if hits.count() <= BROADCAST_ROWS else hits
    own, keep = "_text_key", [c for c in docs.columns if c.lower() != found.lower()]
    while own in map(str.lower, docs.columns):
        own += "_"
    hits = hits.select(F.col("key").alias(own), F.struct("hits", "items").alias(f"{own}hits"))
    out = docs.withColumn(own, F.sha2(F.col(text), 256)).join(hits, own, "left")
    none = F.array().cast("array<bigint>"), F.array().cast("array<string>")
    value = F.struct(
        n_words(F.col(text)).alias("n_words"),
        F.coalesce(F.col(f"{own}hits")["hits"], none[0]).alias("hits"),
        F.coalesce(F.col(f"{own}hits")["items"], none[1]).alias("items"),
    )
    return out.select(*keep, value.alias(found))


def n_hit(found: Column) -> Column:
    """Words covered: the ends less the starts of the ranges."""
    return F.aggregate(
        F.transform(found["hits"], lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("bigint"), lambda a, x: a + x
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents in which a benchmark window occurs."""
    own = "_benchmark_windows"
    while own in map(str.lower, docs.columns):
        own += "_"
    judged = find_windows(docs, benchmark, found=own)
    return judged.where(F.size(F.col(own)["hits"]) == 0).select(*docs.columns)


def digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = F.col("found")
    return find_windows(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        found["n_words"].alias("n_words"),
        n_hit(found).alias("n_hit"),
        F.size(found["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
        (F.size(found["hits"]) > 0).alias("contaminated"),
    )
