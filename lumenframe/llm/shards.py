"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size; shards take turns claiming the first slot in
their order that is still free. A key's slot is its hash modulo the size, so that placing takes one lookup, all shards get equal
numbers of slots up to one, and losing a shard moves little more than its own keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots of the table, a prime far above the number of shards.
SLOTS = 65_537
#: The table is broadcast, so its size is bounded: at most so many slots of 12 bytes.
MAX_SLOTS = 1 << 20


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "big")


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> np.ndarray:
    """For each slot the index of the shard that claimed it."""
    if not 0 < len(shards) <= slots <= MAX_SLOTS or len(set(shards)) != len(shards):
        raise ValueError("shards must be different, at least one, and no more than slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    at = [_number(s, "offset") % slots for s in shards]
    skip = [_number(s, "skip") % (slots - 1) + 1 for s in shards]
    table, free = np.full(slots, -1, np.int32), slots
    while free:
        for k in range(min(len(shards), free)):
            while table[at[k]] >= 0:
                at[k] = (at[k] + skip[k]) % slots
            table[at[k]] = k
            free -= 1
    return table


def place(df: DataFrame, keys: Sequence[str], shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` (int) and ``shard`` (string); columns of those names are replaced.

    Equal keys share a shard. Rows whose keys are all null are dealt by their whole content, so that they don't pile up.
    """
    own = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    key = F.xxhash64(*keys)
    if df.columns:
        simple = [f.name for f in df.schema.fields if f.dataType.typeName() != "map"]
        key = F.when(F.coalesce(*[F.col(k).cast("string") for k in keys]).isNull(), F.xxhash64(*simple)).otherwise(key)
    table = lookup_table(shards, slots)
    names = pd.DataFrame({"slot": np.arange(slots, dtype=np.int32), "shard": np.array(shards, object)[table]})
    lookup = df.sparkSession.createDataFrame(names, "slot int, shard string")
    slotted = df.withColumn("slot", F.pmod(key, F.lit(slots)).cast("int")).select(*own, "slot")
    return slotted.join(F.broadcast(lookup), "slot").select(*own, "slot", "shard")


def write_shards(placed: DataFrame, path: str, tasks_per_shard: int = 8) -> None:
    """Parquet under ``path/shard=...``; a shard is written by up to ``tasks_per_shard`` tasks, by ranges of slots."""
    salt = F.pmod(F.col("slot"), F.lit(tasks_per_shard))
    placed.repartition("shard", salt).write.partitionBy("shard").parquet(path)
