"""Clustering against plain rounds in whole numbers: ties, odd vectors, bounds that hold."""

import hashlib
import math
import random

import numpy as np
import pytest

from fanwrite.llm import clusters

COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def brute(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            if inside := [v for (_, v), o in zip(kept, own) if o == j]:
                centroids[j] = [sum(x) // len(inside) for x in zip(*inside)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    inertia = [sum(d for _, c, d in found if c == j) for j in range(len(centroids))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia), shas[c]) for i, c, d in found), key=str)


def table(spark, rows, element="float"):
    schema = f"vec_id bigint, embedding array<{element}>, cluster string, vector string, n string, distance string"
    return spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in rows], schema)


def got(df):
    assert tuple(df.columns) == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(rnd, n, groups=5, width=0.3):
    centres = [[rnd.gauss(0, 1) for _ in range(64)] for _ in range(groups)]
    return [[float(np.float32(c + rnd.gauss(0, width))) for c in centres[rnd.randrange(groups)]] for _ in range(n)]


def test_whole_table(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    assert got(clusters.digests(df)) == brute(rows)


def test_odd_rows(spark):
    rnd = random.Random(1)
    good = vectors(rnd, 40)
    rows = list(enumerate(good))
    rows += [(i, good[0]) for i in range(40, 60)]  # a hot vector, ties
    rows += [(3, good[3]), (3, good[4]), (None, good[5])]  # repeated ids, no id
    rows += [(70, None), (71, []), (72, good[0][:63]), (73, [*good[0], 1.0]), (74, [None, *good[0][1:]])]
    rows += [(75, [float("nan"), *good[0][1:]]), (76, [float("-inf"), *good[0][1:]]), (77, [0.0] * 64), (78, [-1e-30] * 64)]
    assert got(clusters.digests(table(spark, rows))) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 5, 8])
def test_few_vectors(spark, n):
    rows = list(enumerate(vectors(random.Random(n), n)))
    assert got(clusters.digests(table(spark, rows, "double"))) == brute(rows)


def test_large_components(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([-1, 1]) * rnd.uniform(1e4, 1e5) for _ in range(64)]) for i in range(30)]
    assert got(clusters.digests(table(spark, rows, "double"))) == brute(rows)


def test_whole_numbers():
    values = np.array([[1.5, -0.0001, 2.0**60, -1e300, 1e308]])
    assert clusters.integers(values).tolist() == [[1536, -1, 2**70, int(-1e300) * 1024, int(1e308) * 1024]]
    assert clusters.integers(np.array([[0.5, -0.5001]])).tolist() == [[512, -513]]


def test_loosening_holds_for_every_point_of_the_sphere():
    rnd = np.random.default_rng(4)
    less = 0
    for _ in range(300):
        centre, old, new = (rnd.normal(size=64) * s for s in (1, 1, 1))
        radius = rnd.uniform(0, 6)
        bound = clusters.loosening(tuple(centre), radius, tuple(old), tuple(new))
        drift = np.linalg.norm(new - old)
        assert bound <= drift * 1.001
        less += bound < drift * 0.9
        directions = rnd.normal(size=(200, 64))
        directions = np.vstack([directions, new - centre, new - old, centre - old])
        points = centre + radius * directions / np.linalg.norm(directions, axis=1, keepdims=True)
        nearer = np.linalg.norm(points - old, axis=1) - np.linalg.norm(points - new, axis=1)
        assert nearer.max() <= bound
    assert less > 100


def test_bounds_spare_most_vectors(spark):
    rows = list(enumerate(vectors(random.Random(5), 600, groups=8, width=0.1)))
    found = clusters.cluster(table(spark, rows))
    assert found.scanned[0] == 600 and found.scanned[-1] < 60
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in found.members.collect()) == sorted(x[:3] for x in brute(rows))
