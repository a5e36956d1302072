"""Exact Jaccard join of documents in the metric space of their word shingles.

Jaccard distance is a metric, so regions around pivots can be joined one by
one.  Almost all documents are at distance 1 from each other and from any
pivot that is a document, so the outermost pivots are single shingles, and a
document lies in the region of each shingle of a part of its set that two
linked documents can't both miss.  This is done twice.  First by the order of
hashes, over all documents: a prefix long enough that linked documents share
several of it (``prefix_size``); documents that share too few are linked with
nothing and leave (``candidate_classes``).  Then, over the few that remain, by
rarity: the shingles that fewest of them hold, so that shared passages and
lines tie nothing together (``rare_tokens``).  Regions that overlap are united.

A region is then joined recursively (``join_cell``): pivots are taken from
it, each document goes to its nearest pivot's Voronoi cell, boundary documents
visit all cells whose pivot is at most the radius farther, and cells are split
again until they are small.  Within a cell the triangle inequality decides
most pairs: documents linked to one pivot are in one component already, and
those whose distances to a pivot differ by more than the radius are not
linked.  Large regions are dealt to tasks in chunks that all hold the region's
pivots; only documents outside the region's main component then meet the
other chunks, in blocks.

Sets are of 64-bit hashes of shingles and a document's class (all documents
of equal sets) is known by the hash of its set.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, groupby
from operator import attrgetter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from fanwrite.llm.components import components, stored

SHINGLE = 5
PERCENT = 80  # linked: 100 * intersection >= PERCENT * union
RADIUS = 1 - PERCENT / 100 + 1e-9
SLACK = 20  # one more common shingle is asked for per so many shingles
CHUNK = 256  # classes of a region in one task
CHUNK_CHARS = 8_000_000  # and characters of their texts
PIVOTS = 4
LEAF = 12  # cells up to this size are joined pair by pair
BROADCAST_ROWS = 1_000_000  # ids (with their class) up to which they are broadcast


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's five-word shingles (fewer words: of all of them)."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.int64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: -SHINGLE if len(words) > SHINGLE else -len(words)]]
    hashes = [xxh3_64_intdigest(joined[s : e - 1]) for s, e in zip(starts, ends[min(SHINGLE, len(words)) - 1 :], strict=True)]
    return np.unique(np.array(hashes, np.uint64)).view(np.int64)


def class_of(hashes: np.ndarray) -> int:
    """A set's class, as a signed 64-bit number."""
    return int(np.uint64(xxh3_64_intdigest(hashes.tobytes())).view(np.int64))


def linked(common: int, n: int, m: int) -> bool:
    return 100 * common >= PERCENT * (n + m - common)


def least_common(n: int) -> int:
    """Shingles of a set of n that any set linked with it holds."""
    return -(-PERCENT * n // 100)


def slack(n: int) -> int:
    return 1 + n // SLACK


def prefix_size(n: int) -> int:
    """Length of a set's prefix, in the order of the hashes.

    Of linked sets, take the one whose prefix ends first.  At most n -
    least_common(n) of its shingles are missing in the other, so slack(n) of
    its prefix are common, and they lie in the other's prefix as well.
    """
    return n - least_common(n) + slack(n)


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, n, set_id, prefix``: size and class of each document's set, and the
    prefix once per class and task (null again and for empty sets)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            rows = []
            for t in batch["text"]:
                found = shingles(t)
                n = len(found)
                if not n:
                    rows.append((0, None, None))
                    continue
                name = class_of(found)
                rows.append((n, name, None if name in seen else found[: prefix_size(n)]))
                seen.add(name)
            out = pd.DataFrame(rows, columns=["n", "set_id", "prefix"], dtype=object)
            out.insert(0, "id", batch["id"])
            yield out

    known = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    return known.mapInPandas(run, "id bigint, n bigint, set_id bigint, prefix array<bigint>")


def _needed(n: Column) -> Column:
    """Common shingles that the prefixes of a set of n and any linked one have at least."""
    return F.lit(1) + F.floor(F.ceil(n * F.lit(PERCENT) / F.lit(100)) / F.lit(SLACK))


def candidate_classes(sketched: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes that share at least ``_needed`` prefix shingles with others.

    (A class whose copies are met in several tasks counts itself too: more
    classes may stay than need to, none is lost.)
    """
    tokens = sketched.where("prefix IS NOT NULL").select("set_id", F.explode("prefix").alias("token"))
    shared = tokens.groupBy("token").count().where("count > 1").select("token")
    counts = tokens.join(shared, "token").groupBy("set_id").agg(F.count("*").alias("shared"))
    return classes.join(counts, "set_id").where(F.col("shared") >= _needed(F.col("n"))).select("set_id", "id")


def rare_tokens(candidates: DataFrame) -> DataFrame:
    """``set_id, token``: of each class's n shingles the n - least_common(n) +
    1 that the fewest candidates hold (ties by hash), if another holds them too.

    Those are so many that linked sets can't both miss their rarest common
    one.  Only shared shingles are gathered per class: all unshared ones, as
    many as are missing from n, come before them in the order.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingles(t) for t in batch["text"]]
            yield pd.DataFrame({"set_id": batch["set_id"], "n": [len(f) for f in found], "tokens": found})

    tokens = candidates.mapInPandas(run, "set_id bigint, n bigint, tokens array<bigint>").select("set_id", "n", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    held = tokens.join(shared, "token").groupBy("set_id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("held"))
    unshared = F.col("n") - F.size("held")
    room = (F.col("n") - F.ceil(F.col("n") * F.lit(PERCENT) / F.lit(100)) + 1 - unshared).cast("int")
    kept = held.withColumn("room", room).where("room > 0")
    return kept.select("set_id", F.explode(F.slice("held", F.lit(1), F.col("room"))).alias("t")).select("set_id", "t.token")


def regions(tokens: DataFrame) -> DataFrame:
    """``set_id, region``: overlapping shingle regions united; lone classes are left out."""
    least = tokens.groupBy("token").agg(F.min("set_id").alias("least"))
    edges = tokens.join(least, "token").where("set_id <> least").select(F.col("set_id").alias("a"), F.col("least").alias("b"))
    return components(edges).select(F.col("node").alias("set_id"), F.col("component").alias("region"))


class Members:
    """Sets of one task, their distances and the components found so far."""

    def __init__(self, names: list[int], texts: Iterable[str], groups: list[int] | None = None) -> None:
        self.names = names
        self.sets = [set(shingles(t).tolist()) for t in texts]
        self.parent = list(range(len(names)))
        first: dict[int, int] = {}
        for i, g in enumerate(groups or []):  # classes known to be of one component
            self.parent[i] = first.setdefault(g, i)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def stars(self) -> list[tuple[int, int]]:
        """Every member of a component of several, with the least of them."""
        least: dict[int, int] = {}
        for i, name in enumerate(self.names):
            least[self.root(i)] = min(name, least.get(self.root(i), name))
        sizes = Counter(self.root(i) for i in range(len(self.names)))
        return [(name, least[r]) for i, name in enumerate(self.names) if sizes[r := self.root(i)] > 1]

    def distance(self, i: int, j: int) -> float:
        """Jaccard distance; a pair within the radius becomes a link."""
        a, b = self.sets[i], self.sets[j]
        common = len(a & b)
        if i != j and linked(common, len(a), len(b)) and (r := self.root(i)) != (s := self.root(j)):
            self.parent[r] = s
        return 1 - common / (len(a) + len(b) - common)

    def compare(self, i: int, j: int) -> None:
        """Tests a pair unless its sizes or known links decide it."""
        n, m = len(self.sets[i]), len(self.sets[j])
        if min(n, m) >= least_common(max(n, m)) and self.root(i) != self.root(j):
            self.distance(i, j)


def join_cell(members: Members, residents: list[int], visitors: list[int]) -> None:
    """Links all residents among themselves and with the visitors, up to components.

    Of linked residents let x be the one nearer to its own pivot p.  Then the
    other is at most the radius farther from p than from its own pivot, and so
    visits p's cell: the pair meets there, x as a resident.  A visitor from
    outside goes on to each cell in whose residents' window of distances it is.
    """
    everyone = residents + visitors
    if len(everyone) <= LEAF or len(residents) <= PIVOTS:
        for k, i in enumerate(residents):
            for j in residents[k + 1 :] + visitors:
                members.compare(i, j)
        return
    pivots = residents[:PIVOTS]
    far = {x: [members.distance(x, p) for p in pivots] for x in everyone}
    if len({members.root(x) for x in everyone}) == 1:
        return
    resident_in = {x: far[x].index(min(far[x])) for x in residents}
    for k in range(PIVOTS):
        inside = [x for x in residents if resident_in[x] == k and x not in pivots]
        if not inside:
            continue
        low, high = min(far[x][k] for x in inside) - RADIUS, max(far[x][k] for x in inside) + RADIUS
        guests = [x for x in residents if resident_in[x] != k and x not in pivots and far[x][k] <= min(far[x]) + RADIUS]
        guests += [x for x in visitors if low <= far[x][k] <= high]
        if len(inside) + len(guests) < len(everyone) - PIVOTS:
            join_cell(members, inside, guests)
            continue
        for n, i in enumerate(inside):  # the pivots separate nothing here: windows on the distances
            for j in inside[n + 1 :] + guests:
                if abs(far[i][k] - far[j][k]) <= RADIUS:
                    members.compare(i, j)


def _in_groups(rows: DataFrame, columns: list[str], join: Callable[[dict], list[tuple[int, int]]]) -> DataFrame:
    """Links ``a, b`` that ``join`` finds in each group; it is given the
    group's rows by class.  Rows reach a task sorted, and one group is held."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = (row for batch in batches for row in batch.itertuples(index=False))
        for _, group in groupby(every, attrgetter(*columns)):
            if edges := join({row.set_id: row for row in group}):
                yield pd.DataFrame(edges, columns=["a", "b"])

    return rows.repartition(*columns).sortWithinPartitions(*columns).mapInPandas(run, "a bigint, b bigint")


def _join_chunk(group: dict) -> list[tuple[int, int]]:
    if len(group) < 2:
        return []
    names = sorted(group)  # the least classes of a region are its pivots
    members = Members(names, (group[x].text for x in names))
    join_cell(members, list(range(len(names))), [])
    return members.stars()


def _join_block(group: dict) -> list[tuple[int, int]]:
    names = sorted(group)
    members = Members(names, (group[x].text for x in names), [group[x].part for x in names])
    outer = [i for i, x in enumerate(names) if group[x].outside]
    inner = [i for i, x in enumerate(names) if not group[x].outside]
    join_cell(members, outer, inner)
    return members.stars()


def region_components(candidates: DataFrame) -> DataFrame:
    """``set_id, group`` of the classes of each region (columns set_id, region,
    text) that are linked with others: the least class they are connected to.

    A region of up to ``CHUNK`` classes and ``CHUNK_CHARS`` characters is joined
    in one task.  A larger one is dealt out in chunks of about that size, each
    with the region's least classes as pivots.  Should the links then leave classes outside the
    region's largest part, those meet all chunks, block by block.
    """
    chunks = F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum(F.length("text")) / CHUNK_CHARS)).cast("int")
    dealt = candidates.join(candidates.groupBy("region").agg(chunks.alias("chunks")), "region")
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("set_id"), F.col("chunks")).cast("int"))
    dealt = stored(dealt, "jaccard-regions")
    small = _in_groups(dealt.where("chunks = 1"), ["region", "chunk"], _join_chunk).withColumnsRenamed({"a": "set_id", "b": "group"})
    large = dealt.where("chunks > 1")
    if large.isEmpty():
        return small
    pivots = large.withColumn("rank", F.expr("row_number() OVER (PARTITION BY region ORDER BY set_id)")).where(F.col("rank") <= PIVOTS)
    pivots = pivots.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(*dealt.columns)
    links = stored(_in_groups(large.union(pivots), ["region", "chunk"], _join_chunk), "jaccard-links")
    parts = components(links).select(F.col("node").alias("set_id"), F.col("component").alias("part"))
    known = large.join(parts, "set_id", "left").withColumn("part", F.coalesce("part", "set_id"))
    part_sizes = known.groupBy("region", "part").agg(F.count("*").alias("n"))
    main = part_sizes.groupBy("region").agg(F.max_by("part", F.struct("n", "part")).alias("main"))
    known = stored(known.join(main, "region").withColumn("outside", F.col("part") != F.col("main")), "jaccard-parts")
    outer = known.where("outside")
    blocks = outer.groupBy("region").agg(F.count("*").alias("n_outside")).withColumn("blocks", F.ceil(F.col("n_outside") / CHUNK).cast("int"))
    block = F.pmod(F.xxhash64("set_id", F.lit(1)), F.col("blocks")).cast("int")
    columns = ["region", "chunk", "block", "set_id", "part", "outside", "text"]
    sent = outer.join(blocks, "region").withColumn("block", block)
    sent = sent.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(*columns)
    # A class outside the main part is met as one that was sent, never as a chunk's own too.
    met = known.join(blocks, "region").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*columns)
    met = met.join(sent.select("region", "chunk", "block", "set_id"), ["region", "chunk", "block", "set_id"], "left_anti").withColumn("outside", F.lit(False))
    links = links.union(_in_groups(sent.union(met), ["region", "chunk", "block"], _join_block))
    return small.union(components(links).withColumnsRenamed({"node": "set_id", "component": "group"}))


def join_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component`` for every row: the size of its shingle
    set and the least key reachable by links, its own included.

    Null, empty and wordless texts have no shingles and are linked with
    nothing; so are rows without a key (their component is null).  Rows with
    equal sets are linked, repeated rows stay.  Should rows of one key have
    different texts, each is joined by its own text.  Other columns are not
    read; an empty table gives an empty result.
    """
    out = labelled(docs, key, text).select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component")
    unkeyed = docs.where(F.col(key).isNull()).select(F.col(text).alias("text"))
    return out.union(_unkeyed_sizes(unkeyed))


def labelled(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, n, set_id, component, first`` for every row with a key: its class,
    the least key of its group and the least class of the rows of that key there
    (class and ``first`` are null without shingles)."""
    sketched = stored(sketches(docs, key, text), "jaccard-sketches")
    sets = sketched.where("set_id IS NOT NULL")
    classes = sets.groupBy("set_id").agg(F.min("id").alias("id"), F.max("n").alias("n"))
    wanted = stored(candidate_classes(sketched, classes), "jaccard-wanted")
    texts = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    candidates = stored(_of_class(texts.join(_within_bound(wanted), "id")), "jaccard-candidates")
    linked_classes = region_components(candidates.join(regions(stored(rare_tokens(candidates), "jaccard-tokens")), "set_id"))
    grouped = classes.join(linked_classes, "set_id", "left").withColumn("group", F.coalesce("group", "set_id"))
    least = grouped.groupBy("group").agg(F.min(F.struct("id", "set_id")).alias("least"))
    labels = grouped.join(least, "group").select("set_id", F.col("least.id").alias("component"), F.col("least.set_id").alias("first"))
    joined = sketched.select("id", "n", "set_id").join(labels, "set_id", "left")
    return joined.select("id", "n", "set_id", F.coalesce("component", "id").alias("component"), "first")


def _of_class(rows: DataFrame) -> DataFrame:
    """One row per class, with a text of that class (rows of one id may differ)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [t is not None and class_of(shingles(t)) == c for t, c in zip(batch["text"], batch["set_id"], strict=True)]
            yield batch.loc[own, ["set_id", "text"]]

    return rows.mapInPandas(run, "set_id bigint, text string").dropDuplicates(["set_id"])


def _unkeyed_sizes(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"n": [len(shingles(t)) for t in batch["text"]]})

    none = F.lit(None).cast("bigint")
    return rows.mapInPandas(run, "n bigint").select(none, "n", none)


def _class(text: Column) -> Column:
    """The class of a text, null if it has no shingles."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([class_of(found) if len(found := shingles(t)) else None for t in batch], dtype="Int64")

    return F.pandas_udf(run, "bigint")(text)


def one_per_group(docs: DataFrame) -> DataFrame:
    """``docs`` without near copies: of each group of linked documents the one
    with the least id stays, and of rows that repeat an id and text one.
    Should rows of one id have different texts, each stays or goes by its own
    text's group; of those in one group the least class stays.  Documents
    without words and rows without an id all stay."""
    joined = stored(labelled(docs, "doc_id", "text").withColumnRenamed("id", "doc_id"), "jaccard-groups")
    copies = joined.where((F.col("component") != F.col("doc_id")) | (F.col("set_id") != F.col("first")))
    again = stored(joined.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "jaccard-again")
    if again.isEmpty():
        return docs.join(_within_bound(copies.select("doc_id")), "doc_id", "left_anti").select(*docs.columns)
    again = _within_bound(again)
    single = docs.join(_within_bound(copies.select("doc_id").distinct()), "doc_id", "left_anti").join(again, "doc_id", "left_anti")
    own = "_set_id"
    while own in docs.columns:
        own += "_"
    repeated = docs.join(again, "doc_id", "left_semi").withColumn(own, _class(F.col("text")))
    copies = copies.join(again, "doc_id", "left_semi").select("doc_id", F.col("set_id").alias(own)).distinct()
    repeated = repeated.join(_within_bound(copies), ["doc_id", own], "left_anti").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return single.select(*docs.columns).union(repeated)


def _within_bound(rows: DataFrame) -> DataFrame:
    """To be broadcast if it is small enough, else left to a shuffle join."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def groups(docs: DataFrame) -> DataFrame:
    return join_documents(docs).withColumnRenamed("component", "component_id")
