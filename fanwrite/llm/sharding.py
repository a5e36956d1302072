"""Shard placement by a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size,
an arithmetic progression ``(offset + j * skip) mod slots`` whose offset and
skip come from a hash of the shard's name; as the size is prime, each order
visits every slot.  The shards take turns claiming the first free slot of
their order until the table is full, so shard loads differ by one slot at
most and removing a shard moves few keys between the others.

The table depends on the shard names and its size only (no data), so it is
filled once when the plan is made; its ``slots`` rows are broadcast and each
key finds its shard with one hash and one lookup, without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = tuple(f"shard-{i:02d}" for i in range(16))
SLOTS = 2039  # the least prime over 2000: more than 100 slots a shard


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _md5_number(text: str) -> int:
    """The first 32 bits of the MD5; ``hash_slot`` computes the same on columns."""
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def fill_table(shards: Sequence[str], slots: int) -> list[int]:
    """Owner (index into ``shards``) of every slot.

    Repeated shard names, no shards, a size that is no prime or smaller than
    the number of shards raise ``ValueError``.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be a non-empty list of distinct names")
    if not _is_prime(slots) or slots < len(shards):
        raise ValueError("slots must be a prime number, at least the number of shards")
    at = [_md5_number(f"{s}:offset") % slots for s in shards]
    skip = [_md5_number(f"{s}:skip") % (slots - 1) + 1 for s in shards]
    owner = [-1] * slots
    for turn in range(slots):
        i = turn % len(shards)
        while owner[at[i]] >= 0:
            at[i] = (at[i] + skip[i]) % slots
        owner[at[i]] = i
    return owner


def lookup_table(spark: SparkSession, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """The filled table as rows ``slot int, shard string``."""
    owners = ",".join(map(str, fill_table(shards, slots)))
    names = F.array(*(F.lit(s) for s in shards))
    return (
        spark.range(1)
        .select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "owner"))
        .select("slot", F.element_at(names, F.col("owner").cast("int") + 1).alias("shard"))
    )


def hash_slot(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 32 bits of the MD5 of its text, modulo ``slots``."""
    return (F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") % slots).cast("int")


def place(df: DataFrame, key: str, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``key``, ``slot`` and ``shard`` of every row of ``df``.

    A null key has a null slot and shard; repeated keys keep their rows and
    get the same shard; an empty table gives an empty result.  Other columns
    are not read, so their names cannot clash.  The broadcast side has
    ``slots`` rows whatever the data.
    """
    keyed = df.select(F.col(key).alias("_key")).withColumn("slot", hash_slot(F.col("_key"), slots))
    table = F.broadcast(lookup_table(df.sparkSession, shards, slots))
    return keyed.join(table, "slot", "left").select(F.col("_key").alias(key), "slot", "shard")
