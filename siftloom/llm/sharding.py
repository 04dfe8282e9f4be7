"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

The shard of a key follows from the key's hash and the number of shards alone:
there is no ring table to hold or to broadcast. When shards are appended, a key
either stays or moves to one of the new shards, and only the necessary fraction
``1 - old/new`` moves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import positional

_STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard numbers 0..shards-1 of uint64 keys; only keys that still jump are looked at."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    out = np.zeros(len(keys), np.int64)
    live = np.arange(len(keys))
    key = keys.astype(np.uint64, copy=True)
    b = np.zeros(len(keys), np.int64)
    while len(live):
        out[live] = b
        key = key * _STEP + np.uint64(1)
        b = np.floor((b + 1) * (2147483648.0 / ((key >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        go = b < shards
        live, key, b = live[go], key[go], b[go]
    return out


def stable_key(col: Column) -> Column:
    """64-bit key as a long: the first 16 hex digits of the md5 of the value as
    text. A null has the key of the empty text."""
    hex16 = F.substring(F.md5(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), 1, 16)
    return F.conv(hex16, 16, -10).cast("long")


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a long key, as an Arrow-batched column expression."""

    @pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return jump(key)


def assign_shards(docs: DataFrame, shards: int, appended: int = 0, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, shard, shard_after, moved) for each row of ``docs``.

    ``shard`` is the place among ``shards`` shards, ``shard_after`` the place once
    ``appended`` more exist. No shuffle: a projection of the id column.
    Null ids share the key of the empty text and so one shard; repeated ids give
    repeated equal rows; an empty table gives an empty one; other columns are
    not read.
    """
    d, (i,) = positional(docs, id_col)
    key = stable_key(F.col(i))
    return (
        d.select(F.col(i).alias("doc_id"), key.alias("_k"))
        .select("doc_id", shard_of(F.col("_k"), shards).alias("shard"), shard_of(F.col("_k"), shards + appended).alias("shard_after"))
        .select("doc_id", "shard", "shard_after", (F.col("shard") != F.col("shard_after")).alias("moved"))
    )
