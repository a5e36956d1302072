"""Exact centroid clustering with bounds tightened by the geometry of the drift.

Lloyd's rounds on integer vectors.  Every vector carries its cluster, an upper
bound on the distance to that centroid and a lower bound on the distance to
any other.  While the upper one is below the lower one, or below half the way
to the nearest other centroid, the vector stays where it is without a distance
being computed; else it is compared with all centroids, exactly.

When centroids move, a lower bound must be loosened by what any other centroid
may have come nearer.  That is less than its full drift for most: all vectors
of a cluster lie in a sphere round their old centroid, and in the plane of that
centre and the line of the drift, a point seen from the middle of the drift at
an angle t to its direction comes nearer by drift * cos(t) at most.  The sphere
bounds the angle (``loosening``).

Only integers decide: distances are computed exactly, bounds are floating-point
numbers widened by ``SAFE``.  Sums are kept as integers on the driver, from what
each task adds up of the vectors that changed their cluster.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanwrite.llm.components import stored

SIZE = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SALT = "3"
SAFE = 1e-9
EXACT = 1 << 22  # products of 64 differences of such components are exact in doubles

Vector = tuple[int, ...]


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x): whole doubles, or Python integers beyond ``EXACT``."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(SCALE))
    if not scaled.size or np.abs(scaled).max() < EXACT:
        return scaled
    # Doubles from 2 ** 53 on are whole; a power of two scales the others without rounding.
    return np.array([[int(x) * SCALE if abs(x) >= 1 << 53 else math.floor(x * SCALE) for x in row] for row in values.tolist()], object)


def squared(vectors: np.ndarray, centroid: Vector) -> np.ndarray:
    """Exact squared distances to a centroid."""
    exact = vectors.dtype == object or max(map(abs, centroid), default=0) >= EXACT
    apart = (vectors.astype(object) if exact else vectors) - np.array(centroid, object if exact else np.float64)
    return (apart * apart).sum(axis=1)


def distances(vectors: np.ndarray, centroids: list[Vector]) -> np.ndarray:
    return np.stack([squared(vectors, c) for c in centroids], axis=1)


def root(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64))


def loosening(centre: Vector, radius: float, old: Vector, new: Vector) -> float:
    """By how much a centroid that moves from ``old`` to ``new`` may come nearer to
    a point of the sphere round ``centre``."""
    x, a, b = (np.array(p, np.float64) for p in (centre, old, new))
    drift = float(np.linalg.norm(b - a))
    if not drift:
        return 0.0
    sight = x - (a + b) / 2
    far = float(np.linalg.norm(sight))
    reach = radius * (1 + SAFE)
    if reach >= far:
        return drift * (1 + SAFE)
    cosine = float(sight @ (b - a)) / (far * drift)
    angle = math.acos(max(-1.0, min(1.0, cosine))) - math.asin(reach / far)
    return drift * min(1.0, max(0.0, math.cos(max(0.0, angle))) + SAFE) * (1 + SAFE)


class Step(NamedTuple):
    """What a round needs: centroids, half the way from each to its nearest other
    one, and what to add to the upper and take off the lower bounds of each cluster."""

    centroids: list[Vector]
    half: list[float]
    add: list[float]
    take: list[float]


def step(centroids: list[Vector], before: list[Vector] | None = None, radii: list[float] | None = None) -> Step:
    k = range(len(centroids))
    gap = [[math.dist(a, b) for b in centroids] for a in centroids]
    half = [min((gap[i][j] for j in k if j != i), default=math.inf) / 2 for i in k]
    if before is None or radii is None:
        return Step(centroids, half, [0.0 for _ in k], [0.0 for _ in k])
    add = [math.dist(a, b) * (1 + SAFE) for a, b in zip(before, centroids, strict=True)]
    take = [max((loosening(before[i], radii[i], before[j], centroids[j]) for j in k if j != i), default=0.0) for i in k]
    return Step(centroids, half, add, take)


def assign(vectors: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, at: Step) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Clusters and bounds after a round, and how many vectors were compared with
    all centroids (new ones, of cluster -1, all are)."""
    cluster, old = cluster.copy(), cluster >= 0
    upper = np.where(old, upper + np.array(at.add)[cluster], np.inf)
    lower = np.where(old, lower - np.array(at.take)[cluster], -np.inf)
    half = np.where(old, np.array(at.half)[cluster], -np.inf)

    def unsure() -> np.ndarray:
        return ~(upper * (1 + SAFE) < np.maximum(lower, half) * (1 - SAFE))

    for c, centroid in enumerate(at.centroids):  # the distance to the own centroid may be enough
        own = np.nonzero(unsure() & (cluster == c))[0]
        if len(own):
            upper[own] = root(squared(vectors[own], centroid)) * (1 + SAFE)
    scanned = np.nonzero(unsure())[0]
    if len(scanned):
        every = distances(vectors[scanned], at.centroids)
        nearest = every.argmin(axis=1)  # the first of equal ones
        cluster[scanned] = nearest
        two = np.sort(every, axis=1)
        upper[scanned] = root(two[:, 0]) * (1 + SAFE)
        lower[scanned] = root(two[:, 1]) * (1 - SAFE) if len(at.centroids) > 1 else np.inf
    return cluster, upper, lower, len(scanned)


STATE = "vec_id bigint, vector array<double>, cluster int, upper double, lower double, n bigint, radius double, scanned bigint, sums array<string>"
COLUMNS = [c.split()[0] for c in STATE.split(", ")]


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("vector")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _round(frame: DataFrame, at: Step, last: bool) -> DataFrame:
    """The state after a round: a row per vector and, for each task and cluster,
    one more with ``n``: the vectors that came less those that went, their sums,
    the greatest upper bound and how many were scanned.  The last round gives
    rows of vectors only, ``n`` being the squared distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(at.centroids)
        sums, counts, radii, scans = [[0] * SIZE for _ in range(k)], [0] * k, [0.0] * k, 0
        for batch in batches:
            batch = batch.filter(batch.column("vector").is_valid())
            if not len(batch):
                continue
            vectors = integers(matrix(batch))
            before = batch.column("cluster").to_numpy()
            cluster, upper, lower, n = assign(vectors, before, batch.column("upper").to_numpy(), batch.column("lower").to_numpy(), at)
            scans += n
            none = pa.nulls(len(batch))
            found = none
            if last:
                square = np.zeros(len(batch), object)
                for c in range(k):
                    own = np.nonzero(cluster == c)[0]
                    square[own] = [int(x) for x in squared(vectors[own], at.centroids[c])]
                found = pa.array(square.tolist(), pa.int64())
            else:
                for c in range(k):
                    if len(own := np.nonzero(cluster == c)[0]):
                        radii[c] = max(radii[c], float(upper[own].max()))
                    for rows, sign in ((np.nonzero((cluster == c) & (before != c))[0], 1), (np.nonzero((cluster != c) & (before == c))[0], -1)):
                        if len(rows):
                            counts[c] += sign * len(rows)
                            sums[c] = [s + sign * int(x) for s, x in zip(sums[c], vectors[rows].sum(axis=0), strict=True)]
            columns = [batch.column("vec_id"), batch.column("vector"), pa.array(cluster, pa.int32()), pa.array(upper), pa.array(lower), found, none, none, none]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, FIELDS, strict=True)], schema=FIELDS)
        if not last:
            rows = [(None, None, c, None, None, counts[c], radii[c], scans if c == 0 else 0, [str(s) for s in sums[c]]) for c in range(k)]
            yield pa.RecordBatch.from_pylist([dict(zip(COLUMNS, r, strict=True)) for r in rows], schema=FIELDS)

    return frame.mapInArrow(run, STATE)


FIELDS = pa.schema(
    [
        ("vec_id", pa.int64()),
        ("vector", pa.list_(pa.float64())),
        ("cluster", pa.int32()),
        ("upper", pa.float64()),
        ("lower", pa.float64()),
        ("n", pa.int64()),
        ("radius", pa.float64()),
        ("scanned", pa.int64()),
        ("sums", pa.list_(pa.string())),
    ]
)


class Change(NamedTuple):
    n: list[int]
    radius: list[float]
    sums: list[list[int]]
    scanned: int


def _changes(frame: DataFrame, k: int) -> Change:
    """The tasks' rows added up, in Spark, to one row a cluster."""
    tasks = frame.where("n IS NOT NULL").select("cluster", "n", "radius", "scanned", F.posexplode("sums").alias("i", "s"))
    sums = tasks.groupBy("cluster", "i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"), F.max("radius").alias("radius"), F.sum("scanned").alias("scanned")
    )
    out = Change([0] * k, [0.0] * k, [[0] * SIZE for _ in range(k)], 0)
    scanned = 0
    for r in sums.collect():  # clusters x components
        out.n[r["cluster"]], out.radius[r["cluster"]] = r["n"], r["radius"]
        out.sums[r["cluster"]][r["i"]] = int(r["s"])
        scanned += r["scanned"] if r["i"] == 0 else 0
    return out._replace(scanned=scanned)


def kept(table: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id, vector`` of the rows whose vector has ``SIZE`` components, all finite."""
    values = F.col(vector).cast("array<double>")
    named = table.select(F.col(key).cast("bigint").alias("vec_id"), values.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return named.where((F.size("vector") == SIZE) & finite)


def first_centroids(vectors: DataFrame, clusters: int) -> list[Vector]:
    """The vectors with the least hashes (of equal ids: the lesser vectors first)."""
    hashed = F.sha2(F.concat(F.lit(f"{SALT}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where("vec_id IS NOT NULL").orderBy(hashed, "vector").limit(clusters).select("vector").collect()
    return [tuple(int(x) for x in integers(np.array([r["vector"]], np.float64))[0]) for r in rows]


class Clustering(NamedTuple):
    """members: ``vec_id, cluster, distance``; scanned: vectors compared with all
    centroids, by round."""

    members: DataFrame
    centroids: list[Vector]
    scanned: list[int]


def cluster(table: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS) -> Clustering:
    """Clusters the vectors of ``SIZE`` finite components as whole numbers.

    Rows with another vector (null, shorter, longer, with null or non-finite
    components) take no part.  Repeated rows count each; a row without an id is
    a vector, but no first centroid.  Fewer vectors than clusters make fewer
    clusters, an empty table none.  Of equally near centroids the first one
    counts; an empty cluster keeps its centroid.  Other columns are not read.
    A squared distance beyond 64 bits fails the job.

    Two states are held at a time (memory and disk of the executors); a lost
    one is computed again from the table by the rounds so far.
    """
    vectors = kept(table, key, vector)
    centroids = first_centroids(vectors, clusters)
    if not centroids:
        empty = vectors.where("false").select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return Clustering(empty, [], [])
    nothing = {c: F.lit(None).cast(t).alias(c) for c, t in (f.split(" ", 1) for f in STATE.split(", "))}
    start = {"vec_id": F.col("vec_id"), "vector": F.col("vector"), "cluster": F.lit(-1).alias("cluster"), "upper": F.lit(0.0).alias("upper"), "lower": F.lit(0.0).alias("lower")}
    frame = vectors.select(*(nothing | start).values())
    at, held = step(centroids), None
    totals, counts, scanned = [[0] * SIZE for _ in centroids], [0] * len(centroids), []
    for _ in range(rounds):
        frame = _round(frame, at, last=False).persist(StorageLevel.MEMORY_AND_DISK)
        change = _changes(frame, len(centroids))
        if held is not None:
            held.unpersist()
        held = frame
        counts = [a + b for a, b in zip(counts, change.n, strict=True)]
        totals = [[a + b for a, b in zip(t, s, strict=True)] for t, s in zip(totals, change.sums, strict=True)]
        moved = [tuple(s // n for s in total) if n else c for total, n, c in zip(totals, counts, centroids, strict=True)]
        at = step(moved, centroids, change.radius)
        centroids = moved
        scanned.append(change.scanned)
    final = _round(frame, at, last=True).select("vec_id", "cluster", F.col("n").alias("distance"))
    members = stored(final, "clusters")
    if held is not None:
        held.unpersist()
    return Clustering(members, centroids, scanned)


def digests(table: DataFrame) -> DataFrame:
    found = cluster(table)
    sums = {r["cluster"]: r["s"] for r in found.members.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row a cluster
    rows = [(c, sums.get(c, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(found.centroids)]
    named = table.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    joined = found.members.join(F.broadcast(named), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
