"""Jump consistent hashing: stable keys to shards without a ring table.

A key's shard follows from the key and the number of shards alone. When shards are appended, a key either
stays or moves to a new shard, and only the share that the new shards need moves.

Defined results: the key and the number of shards alone decide, so all rows without a key go to one shard, as null is a
key like any other. Rows with one key go to one shard, repeated rows included. A null text has size 1 and the checksum of the
empty text. Very long texts count whole, and columns other than key and text are not read (``write_shards`` keeps them all and asks
for another name where one is called like the shard's). Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.llm.common import running_total

# Fixed value: the multiplier of the generator in the published method.
MULTIPLIER = 2862933555777941757


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, 0 to ``shards`` - 1, of each 64-bit key."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    left = np.arange(len(state))
    while left.size:
        shard[left] = ahead[left]
        state[left] = state[left] * np.uint64(MULTIPLIER) + np.uint64(1)
        step = 2.0**31 / ((state[left] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead[left] = ((shard[left] + 1) * step).astype(np.int64)
        left = left[ahead[left] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a 64-bit key column."""
    if shards < 1:
        raise ValueError("at least one shard")

    @F.pandas_udf("int")
    def placed(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(), shards).astype(np.int32))

    return placed(key)


def stable_key(key: Column) -> Column:
    """60 bits of the digest of a key's text; null is the key of the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``size`` (bytes of text plus one), ``text_crc32``, ``shard``, ``grown_shard`` (with
    one more shard) and ``slot``, the row's place in its shard by key, then text digest.

    Slots are numbered over ordered pieces, so no task holds a shard.
    """
    placed = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        stable_key(F.col(key)).alias("_key"),
    )
    placed = placed.withColumn("shard", shard_of(F.col("_key"), shards))
    placed = placed.withColumn("grown_shard", shard_of(F.col("_key"), shards + 1)).drop("_key")
    counted = running_total(
        placed.withColumn("_one", F.lit(1).cast("long")), ["shard"], ["doc_id", "text_crc32", "size"], "_one", "_upto"
    )
    return counted.withColumn("slot", F.col("_upto") - 1).drop("_one", "_upto")


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id", name: str = "shard") -> None:
    """Whole rows as Parquet, one folder per shard, named ``name=...``; a shard's rows come from many tasks."""
    if name in docs.columns:
        raise ValueError(f"the rows have a column {name!r}; name the shards otherwise")
    docs.withColumn(name, shard_of(stable_key(F.col(key)), shards)).write.mode("overwrite").partitionBy(name).parquet(path)
