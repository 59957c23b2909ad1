"""Operator 8: constant-time sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table,
given by an offset and a step hashed from its name. The shards take turns
claiming the next free slot of their permutation until the table is full, so
each owns an equal share (or a share by weight) and losing a shard moves
few keys beside its own. A key's slot is its hash modulo the table size; the
broadcast table (fixed size, chosen before any data is read) gives the shard.

Defined results: a null key is placed like the text ``\\N``; repeated keys share
a shard; an empty input gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A prime, over 100 times the shards used in production.
TABLE_SIZE = 65_537


def _number(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "big")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], size: int = TABLE_SIZE, weights: list[float] | None = None) -> np.ndarray:
    """Slot -> index into ``shards``.

    A shard's turn comes when its claims fall behind weight x turns; with no
    weights every shard claims one slot each turn.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each once")
    if not is_prime(size) or size < len(shards):
        raise ValueError("the table size must be a prime of at least one slot a shard")
    weights = weights or [1.0] * len(shards)
    if len(weights) != len(shards) or min(weights) <= 0:
        raise ValueError("one positive weight a shard")
    top = max(weights)
    order = sorted(range(len(shards)), key=lambda i: shards[i])
    at = [_number(f"offset {s}") % size for s in shards]
    step = [_number(f"step {s}") % (size - 1) + 1 for s in shards]
    due = [0.0] * len(shards)
    table = [-1] * size
    free = size
    while free:
        for i in order:
            due[i] += weights[i] / top
            if due[i] < 1:
                continue
            due[i] -= 1
            while table[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % size
            table[at[i]] = i
            free -= 1
            if not free:
                break
    return np.array(table, np.int32)


def key_slot(key: Column, size: int) -> Column:
    """Slot of a key: 60 bits of its MD5, modulo the table size."""
    text = F.coalesce(key.cast("string"), F.lit("\\N"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def assign_shards(df: DataFrame, key: str, shards: list[str], size: int = TABLE_SIZE,
                  weights: list[float] | None = None, slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``df`` with its slot and shard; columns of those names are replaced.

    No shuffle: the table has ``size`` rows and is broadcast.
    """
    table = lookup_table(shards, size, weights)
    owners = df.sparkSession.createDataFrame(pd.DataFrame({slot_col: np.arange(size, dtype=np.int32),
                                                           shard_col: [shards[i] for i in table]}))
    rest = [c for c in df.columns if c not in (slot_col, shard_col)]
    slotted = df.select(*[df[c] for c in rest], key_slot(df[key], size).alias(slot_col))
    placed = slotted.join(F.broadcast(owners), slot_col)
    return placed.select(*rest, slot_col, shard_col)
