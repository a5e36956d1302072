"""Nearest neighbours: recall against brute force, ties, rows that take no part."""

import numpy as np
import pytest

from fanwrite.llm import ann


def brute(vectors, query, nearest=20):
    scores = [(-float(np.dot(v, vectors[query])), i) for i, v in vectors.items() if i != query]
    return [(i, -s) for s, i in sorted(scores)[:nearest]]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in table.collect()}
    got, compared = {}, {}
    for r in ann.neighbours(table).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
        compared[r["query_id"]] = r["candidates"]
    assert max(compared.values()) < len(vectors)  # no query is sent to the whole table
    assert np.mean(list(compared.values())) < {500: 0.9, 2000: 0.65}[len(vectors)] * len(vectors)
    assert set(got) == {i for i in vectors if i % 20 == 0}
    hits = 0
    for query, found in got.items():
        assert sorted(found) == list(range(1, 21))
        assert [found[k] for k in sorted(found)] == sorted(found.values(), key=lambda x: (-x[1], x[0]))
        assert all(abs(np.dot(vectors[i], vectors[query]) - s) < 1e-12 for i, s in found.values())
        hits += len({i for i, _ in found.values()} & {i for i, _ in brute(vectors, query)})
    assert hits / (20 * len(got)) >= 0.9


def test_recall_where_the_ascent_stops_early(spark):
    """Groups of vectors: a query's neighbours share its prefixes, and a small
    part of all vectors is asked for."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((60, 32))
    vectors = {i: centres[i % 60] + 0.5 * rng.standard_normal(32) for i in range(6000)}
    table = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id bigint, embedding array<double>")
    hits = total = 0
    got = {}
    for r in ann.search(table, table.where("vec_id % 100 = 0"), start=3).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    for query, found in got.items():
        hits += len(found & {i for i, _ in brute(vectors, query)})
        total += 20
    assert total == 1200 and hits / total >= 0.9


def test_largest_product_not_angle(spark):
    rng = np.random.default_rng(1)
    vectors = {i: rng.standard_normal(8) * rng.uniform(0.1, 9) for i in range(300)}
    table = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id bigint, embedding array<double>")
    want = {q: [i for i, _ in brute(vectors, q)] for q in range(0, 300, 20)}
    for start in (ann.START, np.inf):
        got = {}
        for r in ann.search(table, table.where("vec_id % 20 = 0"), start=start).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
        found = {q: [i for _, i in sorted(pairs)] for q, pairs in got.items()}
        assert sorted(found) == sorted(want)
        if start == np.inf:  # the exact way
            assert found == want
        assert sum(len({*found[q]} & {*want[q]}) for q in want) >= 0.9 * 20 * len(want)


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0], "x"), (20, [1.0, 0.0], "x"), (3, [1.0, 0.0], "x"), (3, [1.0, 0.0], "x"), (4, [0.5, 0.5], "x"), (5, None, "x"), (40, [0.0, 0.0], "x")]
    rows += [(60, [nan, 1.0], "x"), (80, [inf, 1.0], "x"), (100, [None, 1.0], "x"), (None, [1.0, 0.0], "x"), (120, [1.0, 2.0, 3.0], "x"), (121, [1.0, 0.0, 0.0], "x"), (140, [], "x")]
    rows += [(1000 + i, [0.9, 0.1], "x") for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string")
    got = {}
    for r in ann.neighbours(table).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    copies = [1000 + i for i in range(40)]
    assert got.pop(0) == [3, 20, *copies[:18]] and got.pop(20) == [0, 3, *copies[:18]] and got.pop(120) == [121]
    # copies that are queries themselves: the same vector's other ids follow by size
    assert sorted(got) == [1000, 1020] and got[1000][:2] == [0, 3] and got[1000][3:] == copies[1:18] and got[1020][3:] == copies[:17]
    assert ann.neighbours(spark.createDataFrame([], table.schema)).count() == 0
    assert ann.search(table, table.where("vec_id = 4"), nearest=1).first()["vec_id"] == 0


def spread(kind, n, dim, rng):
    vectors = rng.standard_normal((n, dim))
    if kind == "slanted":  # unit vectors with a shared direction
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        vectors += 0.7 * np.eye(dim)[0]
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    elif kind == "decaying":
        vectors *= np.arange(1, dim + 1) ** -0.7
    elif kind == "hot":  # a third in one narrow group
        centres = rng.standard_normal((60, dim))
        vectors = centres[np.where(np.arange(n) % 3 == 0, 0, np.arange(n) % 60)] + np.where(np.arange(n) % 3 == 0, 0.05, 0.5)[:, None] * vectors
    return vectors


@pytest.mark.parametrize("kind", ["even", "slanted", "decaying", "hot"])
def test_recall_and_share_of_the_table(spark, kind):
    """The same rule at two sizes: recall holds, the share that is compared falls."""
    shares = []
    for n in (1000, 8000):
        found = spread(kind, n, 48, np.random.default_rng(7))
        table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(found)], "vec_id bigint, embedding array<double>")
        got, compared = {}, {}
        for r in ann.search(table, table.where(f"vec_id % {n // 100} = 0")).collect():
            got.setdefault(r["query_id"], set()).add(r["vec_id"])
            compared[r["query_id"]] = r["candidates"]
        vectors = dict(enumerate(found))
        hits = sum(len(near & {i for i, _ in brute(vectors, query)}) for query, near in got.items())
        shares.append(np.mean(list(compared.values())) / n)
        print(f"{kind}, {n}: recall {hits / 2000:.3f}, share compared {shares[-1]:.3f}")
        assert len(got) == 100 and hits / 2000 >= 0.9
    assert shares[1] < 0.85 * shares[0] and shares[1] < 0.6


def test_very_small_and_very_large_vectors(spark):
    rng = np.random.default_rng(3)
    for scale in (1e-170, 1e-310, 1e160, 1e307):
        vectors = {i: rng.standard_normal(4) * scale for i in range(60)}
        table = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id bigint, embedding array<double>")
        got = ann.neighbours(table).collect()
        assert {(r["query_id"], r["rank"]) for r in got} == {(q, k) for q in (0, 20, 40) for k in range(1, 21)}
    rows = [(20, [1e-170, 0.0]), (1, [1.0, 0.0]), (2, [1e-170, 1e-300])]
    got = ann.neighbours(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(20, 1, 1, 1e-170), (20, 2, 2, 0.0)]


def test_prefixes_of_any_number_of_bits():
    vectors = np.random.default_rng(2).standard_normal((300, 16))
    strings = ann.tree_strings(vectors, 5)
    assert strings.shape == (5, 300) and strings.min() >= 0 and strings.max() < 1 << ann.BITS
    forest = ann.Forest(strings)
    for depth in range(ann.BITS + 1):
        begin, end = forest.stretches(strings[:, :10], np.full(10, depth))
        many = np.tile(strings[:, :10], 10)  # past FEW, strings are sorted instead of compared
        met = [*forest.met(strings[:, :10], np.full(10, depth)), *forest.met(many, np.full(100, depth))]
        assert all((met[q] == met[q % 10]).all() for q in range(len(met)))
        assert (met[3] == (strings >> (ann.BITS - depth) == strings[:, 3, None] >> (ann.BITS - depth)).sum(axis=0)).all()
        for q in range(10):
            for t in range(5):
                same = np.flatnonzero(strings[t] >> (ann.BITS - depth) == strings[t, q] >> (ann.BITS - depth))
                assert sorted(forest.order[t, begin[t, q] : end[t, q]]) == same.tolist()
