"""Counting by key and word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import letter_tokens, strip_control


def count_by_key(table: DataFrame, key: str, *, count: str = "n") -> DataFrame:
    """Rows per trimmed, non-empty key.  Counts are combined before the shuffle, so a hot key is cheap."""
    keys = table.select(strip_control(F.col(key)).alias(key)).where(F.col(key) != "")
    return keys.groupBy(key).agg(F.count("*").alias(count))


def count_tokens(table: DataFrame, text: str, *, count: str = "n") -> DataFrame:
    """How often each word occurs in the ``text`` column; one row is one record."""
    words = table.select(F.explode(letter_tokens(F.col(text))).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count("*").alias(count))


def without(table: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``excluded``.

    Given counts, the join meets one row per key on partitions already hashed by key.
    Nothing is forced to broadcast: the threshold and AQE decide from measured sizes.
    """
    return table.join(excluded.select(key), key, "left_anti")


def last_per_key(table: DataFrame, key: str, value: str, order: str | Column) -> DataFrame:
    """One row per key with the value that comes last in ``order``."""
    return table.groupBy(key).agg(F.max_by(value, order).alias(value))
