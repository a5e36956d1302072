"""SimHash groups against brute force: planted distances, dense and split cells, edge rows."""

import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from fanwrite.llm import simhash


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hashes = [xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(codes):
    """The least position that links reach, for every code."""
    out = list(range(len(codes)))
    near = [[j for j, d in enumerate(codes) if (c ^ d).bit_count() <= 3] for c in codes]
    changed = True
    while changed:
        changed = False
        for i, js in enumerate(near):
            least = min(out[j] for j in js)
            changed |= least < out[i]
            out[i] = least
    return out


def flipped(rnd, code, n):
    for b in rnd.sample(range(64), n):
        code ^= 1 << b
    return code


def planted(seed, n=60):
    rnd = random.Random(seed)
    codes = [0, 2**64 - 1, 1, 7, 15, 1 << 63]
    for _ in range(n):
        code = rnd.getrandbits(64)
        codes += [code, *(flipped(rnd, code, k) for k in (1, 2, 3, 4, 5))]
    chain = rnd.getrandbits(64)
    for _ in range(20):
        codes.append(chain)
        chain = flipped(rnd, chain, 3)
    dense = rnd.getrandbits(64)
    codes += [flipped(rnd, dense, rnd.randint(1, 6)) for _ in range(200)]
    codes += [dense ^ i << 5 for i in range(64)]  # all patterns of six neighbouring bits
    return list(dict.fromkeys(codes))


def signed(codes):
    return np.array(codes, np.uint64).view(np.int64)


def test_fingerprints():
    rnd = random.Random(1)
    texts = [None, "", " \t\n", "one", "One TWO", "Ärger Ünd STRASSE", "a b c d", "x " * 9, "\U0001f600 \x85 z y"]
    texts += [" ".join(rnd.choice("abc") * rnd.randint(1, 3) for _ in range(rnd.randint(3, 60))) for _ in range(100)]
    assert [simhash.fingerprint(t) for t in texts] == [fingerprint(t) for t in texts]
    assert simhash.fingerprint(None) == 0 and simhash.fingerprint("one") == xxh64_intdigest("one", 42)


def test_slices_of_long_texts(monkeypatch):
    text = " ".join(f"w{i % 377}" for i in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SLICE", 7)
    assert simhash.fingerprint(text) == whole == fingerprint(text)


def test_bands_cover_the_free_bits_once():
    masks = simhash.bands(0)
    assert sum(masks) == 2**64 - 1 and [m.bit_count() for m in masks] == [16] * 4
    inner = simhash.bands(masks[1])
    assert all(m & masks[1] == masks[1] for m in inner) and sum(m ^ masks[1] for m in inner) == 2**64 - 1 - masks[1]


def test_gray_rank_orders_codes_a_bit_apart():
    order = np.argsort(simhash.gray_rank(np.arange(256, dtype=np.uint64)))
    assert all((int(a) ^ int(b)).bit_count() == 1 for a, b in zip(order, order[1:]))


@pytest.mark.parametrize("pairs", [5, simhash.PAIRS])
def test_index_of_one_cell(monkeypatch, pairs):
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    codes = planted(2, n=30)
    index = simhash.GrayIndex(np.array(codes, np.uint64), np.zeros(len(codes), np.int64))
    index.link()
    at = [codes.index(int(c)) for c in index.codes]
    least = brute(codes)
    assert len({(int(index.label[k]), least[i]) for k, i in enumerate(at)}) == len(set(least)) == len(set(index.label.tolist()))


def test_cells_keep_apart():
    a, b = simhash.link_cells(signed([1, 3, 1, 3]), np.array([0, 0, 1, 2]))
    assert list(zip(a, b)) == [(3, 1)]
    assert not len(simhash.link_cells(signed([5]), np.array([0]))[0])


@pytest.mark.parametrize("cell", [64, simhash.CELL])
def test_links_tie_all_that_brute_force_ties(spark, cell):
    from fanwrite.llm.components import components

    codes = planted(3)
    table = spark.createDataFrame([(int(c),) for c in signed(codes)], "code bigint").repartition(5)
    found = {r["node"]: r["component"] for r in components(simhash.links(table, cell)).collect()}
    least, ints = brute(codes), signed(codes).tolist()
    got = [found.get(c, c) for c in ints]
    assert len(set(zip(got, least))) == len(set(got)) == len(set(least))


def test_documents(spark, make_docs, no_docs):
    rnd = random.Random(4)
    words = [rnd.choice("abcdefghij") + str(rnd.randint(0, 99)) for _ in range(4000)]
    rows = [(9, None, None), (8, "", "en"), (7, " \n", "en"), (6, "one two", "en"), (6, "one two", "en"), (5, "ONE  two", "de"), (None, "one\ttwo", "en"), (4, "three", "en")]
    rows += [(20, " ".join(words), "en"), (19, " ".join([*words[:-1], "end"]), "en"), (18, " ".join(words[:2000]), "en"), (None, "alone here", "en")]
    codes = [fingerprint(t) for _, t, _ in rows]
    group = brute(codes)
    want = []
    for i, (key, _, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        want.append((key, f"{codes[i]:016x}", min(keys, default=None)))
    got = [tuple(r) for r in simhash.groups(make_docs(rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert dict((k, c) for k, _, c in got if k)[7] == 7 and dict((k, c) for k, _, c in got if k)[9] == 7
    assert simhash.groups(no_docs).collect() == []


def test_whole_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    codes = [fingerprint(t) for _, t in rows]
    least = brute(codes)
    want = [(key, f"{codes[i]:016x}", rows[least[i]][0]) for i, (key, _) in enumerate(rows)]
    assert sorted(tuple(r) for r in simhash.groups(docs).collect()) == want
