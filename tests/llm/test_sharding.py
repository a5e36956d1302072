"""Sharding: the table against a plain fill, balance, few moves, no Python on the executors."""

import hashlib
from collections import Counter

import pytest

from fanwrite.llm import sharding


def plain(shards, slots):
    number = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:8], 16)
    orders = [[(number(f"{s}:offset") + j * (number(f"{s}:skip") % (slots - 1) + 1)) % slots for j in range(slots)] for s in shards]
    owner = {}
    while len(owner) < slots:
        for i, order in enumerate(orders):
            if len(owner) < slots:
                owner[next(x for x in order if x not in owner)] = i
    return [owner[s] for s in range(slots)]


def test_table_is_filled_by_turns_and_balanced():
    for n, slots in ((1, 2), (3, 7), (16, 251)):
        shards = [f"s{i}" for i in range(n)]
        table = sharding.fill_table(shards, slots)
        assert table == plain(shards, slots)
        assert max(Counter(table).values()) - min(Counter(table).values()) <= 1


def test_removing_a_shard_moves_few_other_slots():
    before = [sharding.SHARDS[i] for i in sharding.fill_table(sharding.SHARDS, sharding.SLOTS)]
    rest = sharding.SHARDS[:7] + sharding.SHARDS[8:]
    after = [rest[i] for i in sharding.fill_table(rest, sharding.SLOTS)]
    moved = sum(a != b for a, b in zip(before, after) if a != sharding.SHARDS[7])
    assert moved < 0.15 * sharding.SLOTS


def test_bad_tables_are_refused():
    for shards, slots in (((), 7), (("a", "a"), 7), (("a", "b"), 8), (("a", "b", "c"), 2)):
        with pytest.raises(ValueError):
            sharding.fill_table(shards, slots)


def test_edge_rows(spark, no_docs):
    keys = spark.createDataFrame([(1, "x"), (1, "x"), (None, "x"), (-5, "x")], "doc_id bigint, shard string")
    placed = sharding.place(keys, "doc_id")
    got = [tuple(r) for r in placed.collect()]
    table = sharding.fill_table(sharding.SHARDS, sharding.SLOTS)
    slot = lambda k: int(hashlib.md5(str(k).encode()).hexdigest()[:8], 16) % sharding.SLOTS
    want = [(k, slot(k), sharding.SHARDS[table[slot(k)]]) if k is not None else (None, None, None) for k in (1, 1, None, -5)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sharding.place(no_docs, "doc_id").count() == 0
    plan = sharding.place(spark.range(5).withColumnRenamed("id", "doc_id"), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "ExistingRDD" not in plan
