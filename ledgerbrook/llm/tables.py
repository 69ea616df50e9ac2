"""Intermediate tables and small structures that several operators use."""

from __future__ import annotations

import gc
from urllib.parse import unquote

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_shared_path


def saved(table: DataFrame, label: str) -> DataFrame:
    """The table written to the shared folder and read again: a lost executor costs no recomputation."""
    path = new_shared_path(table.sparkSession, label)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Give back the space of a table that ``saved`` wrote, once all that reads it is written.

    It is overwritten without rows; no plan that still has to run may read it.
    """
    files = table.inputFiles()
    if files:
        empty = table.sparkSession.createDataFrame([], table.schema)
        empty.coalesce(1).write.mode("overwrite").parquet(unquote(files[0].rsplit("/", 1)[0]))


def release(spark: SparkSession) -> None:
    """Let executors delete the shuffle files of finished steps.

    Spark does so once the driver has collected the plans they belong to, which on an idle driver
    may be long after; a job of many steps would keep all their files until its end.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


BITMAP_BITS = 24


def bitmap(table: DataFrame, hashed: Column) -> np.ndarray:
    """A set of hashes as 2**24 bits, made by Spark: two megabytes however long the table is.

    Membership has false positives (a full bitmap answers yes to all), so what it selects
    may only steer work, never decide a result.
    """
    place = hashed.bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    words = table.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))).alias(
            "bits"
        )
    )
    rows = words.toArrow()
    made = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    made[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return made


def in_bitmap(made: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    place = hashed.astype(np.int64) & ((1 << BITMAP_BITS) - 1)
    return (made[place >> 6] >> (place & 63)) & 1 == 1


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every linked node: the smallest node that its links ``a, b`` lead to.

    In a pass every group hooks onto its smallest neighbouring group and chains of hooks are
    shortened by pointer jumping; links are then seen between groups.  Groups at least halve with each
    pass, and none is ever gathered in a task.
    """
    first = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    edges = saved(first.unionByName(first.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    while not edges.isEmpty():
        hooks = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("to"))
        for _ in range(2):
            ahead = hooks.select(F.col("u").alias("to"), F.col("to").alias("further"))
            hooks = hooks.join(ahead, "to").select("u", F.col("further").alias("to"))
        hooks = saved(hooks, "hooks")
        step = hooks.select(F.col("u").alias("component"), "to")
        labels = labels.join(step, "component", "left")
        labels = saved(labels.select("node", F.coalesce("to", "component").alias("component")), "labels")
        ends = hooks.select(F.col("u").alias("v"), F.col("to").alias("b"))
        edges = edges.join(hooks, "u").select(F.col("to").alias("a"), "v").join(ends, "v")
        edges = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct()
        edges = saved(edges, "edges")
    return labels
