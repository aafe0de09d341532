"""Shard placement by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of
prime size (an offset and a step from the hash of its name). Shards take
turns claiming the first free slot of their order until the table is full,
so every shard owns almost the same number of slots (they differ by one at
most), and adding or losing a shard moves few of the others' slots. A row's
key hashes to a slot; the table (``size`` rows, by default the first prime
from 100 slots a shard) is broadcast, so placement is one look-up and no
shuffle.

Defined cases: a null key is placed like the text ``null``; equal keys share
a shard; one shard takes everything; no shard is an error; repeated shard
names are an error; input columns named like a result are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import rename_clashes

SLOTS_PER_SHARD = 100


def next_prime(n: int) -> int:
    """The smallest prime from ``n`` on."""
    n = max(2, n)
    while any(n % k == 0 for k in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def lookup_table(shards: list[str], size: int | None = None) -> np.ndarray:
    """The owner (position in ``shards``) of each slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shard names must be distinct, and at least one")
    size = size or next_prime(SLOTS_PER_SHARD * len(shards))
    if size < len(shards) or next_prime(size) != size:
        raise ValueError("the table size must be a prime, no smaller than the number of shards")
    hashes = [hashlib.md5(s.encode()).hexdigest() for s in shards]
    place = [int(h[:15], 16) % size for h in hashes]              # next slot in each order
    step = [int(h[16:31], 16) % max(1, size - 1) + 1 for h in hashes]
    table = np.full(size, -1, np.int32)
    filled = 0
    while filled < size:
        for s in range(min(len(shards), size - filled)):          # one turn each
            while table[place[s]] >= 0:
                place[s] = (place[s] + step[s]) % size
            table[place[s]] = s
            filled += 1
    return table


def slot_of(key: Column, size: int) -> Column:
    """The slot of a key (first 60 bits of its text's MD5, modulo the size)."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint") % size


def assign(df: DataFrame, key_col: str, shards: list[str], size: int | None = None) -> DataFrame:
    """``df`` with slot and shard."""
    table = lookup_table(shards, size)
    df = rename_clashes(df, ["slot", "shard"])
    owners = df.sparkSession.createDataFrame(
        [(i, shards[s]) for i, s in enumerate(table.tolist())], "slot bigint, shard string")
    placed = df.withColumn("slot", slot_of(F.col(f"`{key_col}`"), len(table)))
    return placed.join(F.broadcast(owners), "slot").select(*[F.col(f"`{c}`") for c in df.columns], "slot", "shard")


def write_shards(df: DataFrame, path: str, key_col: str, shards: list[str], files_per_shard: int = 1,
                 size: int | None = None) -> None:
    """Write ``df`` as one folder per shard. Each shard is dealt over
    ``files_per_shard`` tasks, so a hot key's rows do not meet in one."""
    placed = assign(df, key_col, shards, size)
    deal = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_shard))
    (placed.repartition(len(shards) * files_per_shard, "shard", deal)
     .write.partitionBy("shard").parquet(path))
