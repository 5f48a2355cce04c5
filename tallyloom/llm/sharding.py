"""Sharding by jump consistent hashing (Lamping and Veach, 2014)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import hash_bucket, running_start

# Fixed values of the published algorithm.
MULTIPLIER = 2862933555777941757


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The bucket of each 64-bit key among ``shards``, all keys at once.

    Each round moves the keys that still jump; a key jumps about ln(shards) times.
    """
    state = keys.astype(np.uint64)
    bucket = np.zeros(len(state), np.int64)
    target = np.zeros(len(state), np.int64)
    going = np.arange(len(state))
    while len(going):
        bucket[going] = target[going]
        with np.errstate(over="ignore"):
            state[going] = state[going] * np.uint64(MULTIPLIER) + np.uint64(1)
        leap = float(1 << 31) / ((state[going] >> np.uint64(33)).astype(np.float64) + 1)
        target[going] = np.floor((bucket[going] + 1) * leap).astype(np.int64)
        going = going[target[going] < shards]
    return bucket


def shard_of(key: list[str | Column], shards: int) -> Column:
    """The shard of a key, from 0, and ``grown_shard``, that among one shard more, as a
    struct; needs no table of shards, and with one more a key stays or moves into the new one."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    @F.pandas_udf("shard int, grown_shard int")
    def pick(hashed: pd.Series) -> pd.DataFrame:
        keys = hashed.to_numpy(np.int64).view(np.uint64)
        return pd.DataFrame({"shard": jump(keys, shards).astype(np.int32), "grown_shard": jump(keys, shards + 1).astype(np.int32)})

    return pick(F.xxhash64(*key))


def shard(df: DataFrame, key: list[str], shards: int, *, order: list[str] | None = None, buckets: int = 4096) -> DataFrame:
    """Adds ``shard``, ``grown_shard`` (with one shard more) and ``slot``, the row's
    gapless position in its shard.

    Only the key decides the shard: a null key is a key like any other, and rows that
    share a key share its shard. ``order`` (all columns but the key if not given)
    settles ties of the key; rows equal in all of them take their slots in any order.
    Slots are found without sorting a shard as a whole, so a key that holds most rows
    is still dealt over many tasks. Rows keep all their columns, of any length; those
    named like a result are replaced. An empty table gives an empty result.
    """
    order = order if order is not None else [c for c in df.columns if c not in key]
    picked = df.withColumn("__shard", shard_of(key, shards))
    placed = picked.withColumns({"shard": F.col("__shard.shard"), "grown_shard": F.col("__shard.grown_shard")}).drop("__shard")
    return running_start(placed, ["shard"], [*key, *order], F.lit(1), "slot", hash_bucket([*key, *order], buckets))
