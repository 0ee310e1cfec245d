"""Shards from a permutation-filled lookup table.

The shards take turns; at its turn a shard claims the first free slot in its own order of preference
(offset, offset + skip, ... modulo a prime). So all shards get slots in equal number (to within one), and
when a shard is added or taken away few slots change their owner. The table depends on the shard names
alone. It has a fixed number of rows, so it is broadcast; placing a row is one lookup, without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARDS = tuple(f"shard-{i:02d}" for i in range(32))
SLOTS = 4099  # a prime above 128 slots a shard
MAX_SLOTS = 1_000_003


def _number(text: str) -> int:
    """The first 15 hexadecimal digits of the MD5 sum."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """Owner (position in ``shards``) of each slot. ``slots`` must be a prime of at most MAX_SLOTS."""
    if not 0 < len(set(shards)) == len(shards) <= slots <= MAX_SLOTS:
        raise ValueError("shard names must differ, and there must be a slot for each")
    if any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime")
    at = [_number(f"offset:{name}") % slots for name in shards]
    skip = [_number(f"skip:{name}") % (slots - 1) + 1 for name in shards]
    table, free = [-1] * slots, slots
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            table[at[i]] = i
            free -= 1
            if not free:
                return table


def assign(df: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``df`` with the columns slot and shard added (replacing columns of these names).

    Equal keys share a shard. A null key counts as empty text, repeated rows stay repeated, an empty
    table stays empty; no other column is read.
    """
    table = lookup_table(shards, slots)
    owners = df.sparkSession.createDataFrame([(i, shards[j]) for i, j in enumerate(table)], "_slot bigint, _shard string")
    digits = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 15)
    slot = F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(slots))
    placed = df.withColumn("slot", slot)
    return placed.join(F.broadcast(owners), placed["slot"] == owners["_slot"], "left").withColumn("shard", F.col("_shard")).drop("_slot", "_shard")


def write_shards(df: DataFrame, path: str, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> None:
    """Write one folder for each shard. Rows stay in the tasks that read them, so a shard is as many
    files as there are tasks with rows of it, and none of its size passes through one task."""
    assign(df, key, shards, slots).write.partitionBy("shard").parquet(path)


ORACLE = f"""
WITH RECURSIVE shards AS (
  SELECT i, printf('shard-%02d', i) AS name FROM range(32) t(i)
), orders AS (
  SELECT i, name,
    ('0x' || substr(md5('offset:' || name), 1, 15))::BIGINT % {SLOTS} AS first,
    ('0x' || substr(md5('skip:' || name), 1, 15))::BIGINT % {SLOTS - 1} + 1 AS skip
  FROM shards
), lists AS (
  SELECT list(first ORDER BY i) AS firsts, list(skip ORDER BY i) AS skips FROM orders
), fill AS (
  SELECT 0 AS turn, repeat('0', {SLOTS})::BIT AS taken, -1::BIGINT AS slot
  UNION ALL
  SELECT turn + 1, set_bit(taken, next::INT, 1), next
  FROM (
    SELECT turn, taken, list_extract(list_filter(
      list_transform(range(0, {SLOTS}), lambda j: (firsts[turn % 32 + 1] + j * skips[turn % 32 + 1]) % {SLOTS}),
      lambda s: get_bit(taken, s::INT) = 0), 1) AS next
    FROM fill, lists WHERE turn < {SLOTS}
  )
), owners AS (
  SELECT slot, printf('shard-%02d', (turn - 1) % 32) AS shard FROM fill WHERE turn > 0
)
SELECT doc_id, d.slot, shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents) d
JOIN owners USING (slot)
"""
