"""Jaccard join against brute force: chains, groups of copies, shared passages, edge rows."""

import random
import re
from itertools import combinations

import pytest

from fanwrite.llm import jaccard
from fanwrite.llm.components import components


def sets(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    found = [sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = found[i], found[j]
        if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= 80 * len(a | b):
            parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[root(i)] = min(key, least.get(root(i), key)) if key is not None else None
    return sorted(((k, len(found[i]), least[root(i)]) for i, (k, _) in enumerate(rows)), key=str)


def corpus(seed, hot=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(40)]

    def changed(words, n):
        words = list(words)
        for _ in range(n):
            words[rnd.randrange(len(words))] = word()
        return words

    texts = [[word() for _ in range(rnd.randint(0, 80))] for _ in range(60)]
    texts += [[*passage, *(word() for _ in range(rnd.randint(0, 60)))] for _ in range(40)]
    base = [word() for _ in range(120)]
    texts += [changed(base, rnd.randint(0, 5)) for _ in range(hot)]
    chain = [word() for _ in range(100)]
    for _ in range(15):
        texts.append(chain)
        chain = [*chain[4:], *(word() for _ in range(4))]
    texts += [texts[k] for k in range(0, len(texts), 5)]
    rnd.shuffle(texts)
    return [(i, " ".join(t).upper() if i % 3 == 0 else "\n".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed, chunk", [(1, 256), (2, 8)])
def test_equals_brute_force(make_docs, monkeypatch, seed, chunk):
    """With the small chunk the large regions take the path over several tasks."""
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 1_000_000 if seed == 1 else 0)
    rows = corpus(seed)
    got = sorted((tuple(r) for r in jaccard.groups(make_docs([(i, t, "en") for i, t in rows])).collect()), key=str)
    assert got == brute(rows)


def test_cells_link_what_pairs_link():
    for seed in range(12):
        texts = [t for _, t in corpus(seed, hot=50)]
        classes = {}
        for t in texts:
            if len(s := jaccard.shingles(t)):
                classes.setdefault(jaccard.class_of(s), t)
        names = sorted(classes)
        whole = jaccard.Members(names, (classes[n] for n in names))
        jaccard.join_cell(whole, list(range(len(names))), [])
        half = len(names) // 2
        split = jaccard.Members(names, (classes[n] for n in names))
        jaccard.join_cell(split, list(range(half)), list(range(half, len(names))))
        pairs = jaccard.Members(names, (classes[n] for n in names))
        halves = jaccard.Members(names, (classes[n] for n in names))
        for i, j in combinations(range(len(names)), 2):
            pairs.distance(i, j)
            if i < half:
                halves.distance(i, j)
        assert sorted(whole.stars()) == sorted(pairs.stars())
        # residents are joined with visitors, visitors not with each other (a pivot's links aside)
        assert {split.root(i) for i in range(half)} and all(pairs.root(i) == pairs.root(j) for i, j in combinations(range(half), 2) if split.root(i) == split.root(j))
        assert all(split.root(i) == split.root(j) for i, j in combinations(range(len(names)), 2) if halves.root(i) == halves.root(j))


def test_edge_rows(make_docs, no_docs):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE two"), (6, "one two three four five"), (7, long), (8, long + " end"), (None, "one two"), (4, "one two"), (9, "a b c d e f"), (9, "other text of the same id")]
    docs = make_docs([(i, t, None) for i, t in rows])
    got = sorted((tuple(r) for r in jaccard.groups(docs).collect()), key=str)
    want = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 29_996, 7), (8, 29_997, 7), (None, 1, None), (4, 1, 4), (9, 2, 9), (9, 2, 9)]
    assert got == sorted(want, key=str)
    assert jaccard.groups(no_docs).count() == 0
    kept = jaccard.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.where("doc_id IS NOT NULL").collect()) == sorted((i, t or "") for i, t in {(i, t) for i, t in rows if i is not None and i not in (5, 8)})
    assert kept.where("doc_id IS NULL").count() == 1 and jaccard.one_per_group(no_docs).count() == 0


def test_components_of_paths_stars_and_nothing(spark):
    rnd = random.Random(2)
    order = list(range(200))
    rnd.shuffle(order)
    edges = [*zip(order[:100], order[1:101]), *((order[150], x) for x in order[151:180]), (5000, 5000)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    path, star = order[:101], order[150:180]
    assert got == {x: min(path) for x in path} | {x: min(star) for x in star}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rows_of_one_id_stay_or_go_by_their_own_text(make_docs, no_docs):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (9, b), (6, c), (6, c + " end"), (6, None), (6, c), (7, c), (8, b + " x"), (8, ""), (None, a)]
    kept = [(r["doc_id"], r["text"]) for r in jaccard.one_per_group(make_docs([(i, t, "en") for i, t in rows])).collect()]
    least = [x for x in kept if x[0] == 6 and x[1]]
    assert least in ([(6, c)], [(6, c + " end")])
    assert sorted(kept, key=str) == sorted([(3, a), (5, b), *least, (6, None), (8, ""), (None, a)], key=str)


def test_the_class_column_leaves_clashing_columns_alone(make_docs):
    docs = make_docs([(1, "a b", "en"), (1, "a b", "en"), (2, "c d", "en")]).selectExpr("*", "'mine' AS _set_id")
    assert sorted((r["doc_id"], r["_set_id"]) for r in jaccard.one_per_group(docs).collect()) == [(1, "mine"), (2, "mine")]
