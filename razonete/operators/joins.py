"""Joining many rows per key to a side that holds a key once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def join_unique(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join on `key` in a way that lets a hot key of `left` be split at run time.

    Spark splits a skewed partition only where both inputs come straight from a
    shuffle made for the join. A side that was just aggregated by the key is
    placed already and would be joined where it is, with all rows of a hot key
    in one task. Joining on the hash of the key as well asks for shuffles of
    the join's own; the one added moves the aggregated, small side. Where that
    side is measured small enough to broadcast, there is none.
    """
    def hashed(df: DataFrame) -> DataFrame:
        return df.withColumn("_key_hash", F.xxhash64(key))

    return hashed(left).join(hashed(right), [key, "_key_hash"], how).drop("_key_hash")
