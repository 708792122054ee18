"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order of the slots of a prime-sized table (an
offset and a step from its name); the shards take turns claiming their next
free slot until the table is full. A row's slot is a hash of its key modulo
the table size, so placement is one broadcast lookup, the shards get nearly
equal shares, and adding or removing a shard moves few keys. The table has
``table_size`` rows whatever the data, which bounds the broadcast.

Defined cases: rows whose key columns are all NULL are placed by the content
of the row, so they spread instead of meeting in one shard; equal keys go to
the same shard; an empty table gives an empty result; result columns replace
clashing input columns.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from tradelake.llm.common import free_name

TABLE_SIZE = 65537  # prime, over 100 slots for each of up to 655 shards


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def fill_table(shards: list[str], table_size: int = TABLE_SIZE, weights: dict[str, int] | None = None) -> list[int]:
    """Index of the shard that owns each slot.

    ``weights`` gives a shard more than one claim per turn.
    """
    if not _is_prime(table_size):
        raise ValueError(f"table size {table_size} is not prime")
    if not shards or len(set(shards)) != len(shards) or len(shards) > table_size:
        raise ValueError("shards must be distinct, at least one and at most one per slot")
    turns = [max(1, (weights or {}).get(s, 1)) for s in shards]
    at = [_number(s, "offset") % table_size for s in shards]
    step = [_number(s, "step") % (table_size - 1) + 1 for s in shards]
    owner, free = [-1] * table_size, table_size
    while free:
        for k, n in enumerate(turns):
            for _ in range(min(n, free)):
                while owner[at[k]] >= 0:
                    at[k] = (at[k] + step[k]) % table_size
                owner[at[k]] = k
                free -= 1
    return owner


def slot(df: DataFrame, keys: list[str], table_size: int = TABLE_SIZE) -> Column:
    """Slot of each row: hash of the key columns, of the whole row where all keys are NULL."""
    cols = [F.col(f"`{k}`") for k in keys]
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if not dict(df.dtypes)[c].startswith("map")])
    return F.pmod(F.when(F.coalesce(*[c.cast("string") for c in cols]).isNull(), row)
                  .otherwise(F.xxhash64(*cols)), F.lit(table_size))


def assign_shards(df: DataFrame, keys: list[str], shards: list[str], table_size: int = TABLE_SIZE,
                  weights: dict[str, int] | None = None) -> DataFrame:
    """Add ``slot`` and ``shard`` (the name) to every row."""
    owner = fill_table(shards, table_size, weights)
    s = free_name(df, "__slot")
    table = df.sparkSession.createDataFrame(
        [(i, shards[k]) for i, k in enumerate(owner)], f"`{s}` bigint, `{s}_name` string")
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("slot", "shard")]
    placed = df.select(*keep, slot(df, keys, table_size).alias(s))
    return (placed.join(F.broadcast(table), s)
            .select(*keep, F.col(s).alias("slot"), F.col(f"{s}_name").alias("shard")))


def write_shards(df: DataFrame, path: str) -> None:
    """Write assigned rows as one folder per shard; large shards are written by several tasks."""
    df.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
