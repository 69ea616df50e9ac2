"""Ranks and top lists.  Every order ends in a unique key, so that ranks are reproducible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# monotonically_increasing_id keeps the partition above and the row number below this bit.
_ROW_BITS = 33

# Rows of a hash bucket within which rows are first cut, at least so many times the rows that stay.
BUCKET_ROWS = 1 << 18
_SHRINK = 8


def _laid_out(table: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The table range-partitioned and sorted, with ``__part`` and ``__pos`` of each row.

    Written to a reliable checkpoint, because what is counted and what is numbered must see
    the same layout.
    """
    ensure_checkpoint_dir(table.sparkSession)
    numbered = (
        table.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__id", F.monotonically_increasing_id())
        .checkpoint()
    )
    position = F.col("__id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = numbered.withColumn("__part", F.shiftright("__id", _ROW_BITS)).withColumn("__pos", position)
    return numbered.drop("__id")


def global_rank(table: DataFrame, order: Sequence[Column], *, rank: str = "rank") -> DataFrame:
    """Ranks 1..N over the whole table, without a task that sees all rows.

    What is added to a row's position in its partition is the row count of the partitions
    before it: one number per partition, which bounds the broadcast and the one-task window.
    The result's partitions follow the rank order.  Finding the ranges reads the input
    once more than sorting it.
    """
    laid_out = _laid_out(table, order)
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid_out.groupBy("__part")
        .agg((F.max("__pos") + 1).alias("__rows"))
        .select("__part", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__offset"))
    )
    return (
        laid_out.join(F.broadcast(offsets), "__part")
        .withColumn(rank, F.col("__pos") + F.col("__offset") + 1)
        .select(*table.columns, rank)
    )


def _cut(table: DataFrame, group: list[str], order: Sequence[Column], n: int) -> DataFrame:
    """At most the first ``n`` rows of each hash bucket of a group: all that can be among the first n.

    The table is counted first, and its groups get as many buckets as a group of all rows would need, so
    that no bucket is too large for a task; a small group keeps what it has.
    """
    buckets = table.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(max(BUCKET_ROWS, _SHRINK * n))))).scalar()
    spread = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in table.columns]), buckets)
    bucket = Window.partitionBy(*[F.col(f"`{name}`") for name in group], "__bucket").orderBy(*order)
    cut = table.withColumn("__bucket", spread).withColumn("__row", F.row_number().over(bucket))
    return cut.where(F.col("__row") <= n).drop("__bucket", "__row")


def top_k(table: DataFrame, order: Sequence[Column], k: int, *, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows with ranks 1..k.

    Rows are cut within hash buckets, as many as the table needs, and what is left takes the global
    rank: one plan for any ``k``.  ``top_by_count`` does the same without a checkpoint for counts.
    """
    return global_rank(_cut(table, [], order, k), order, rank=rank).where(F.col(rank) <= k)


def rank_in_groups(
    table: DataFrame, group: str, order: Sequence[Column], *, rank: str = "rank"
) -> DataFrame:
    """Ranks 1..N inside every group, also when one group is too large for a task.

    Rows are laid out by (group, order).  The part of a group that lies in one partition
    knows its first position there and the group's rows in earlier partitions; it is
    joined by partition and group, so no join key has more rows than a partition.
    """
    laid_out = _laid_out(table, [F.col(group).asc(), *order])
    earlier = Window.partitionBy("__of").orderBy("__in").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        laid_out.groupBy(F.col("__part").alias("__in"), F.col(group).alias("__of"))
        .agg(F.count("*").alias("__rows"), F.min("__pos").alias("__first"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
    )
    same = (F.col("__part") == F.col("__in")) & F.col(group).eqNullSafe(F.col("__of"))
    ranked = laid_out.join(pieces, same)
    return ranked.select(
        *table.columns, (F.col("__pos") - F.col("__first") + F.col("__before") + 1).alias(rank)
    )


def top_n_per_group(
    table: DataFrame, group: str, order: Sequence[Column], n: int, *, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group with ranks 1..n.

    Each group is cut within hash buckets, as many as the table's rows need (Spark keeps at most ``n`` rows per
    bucket and map task where ``n`` is small), and what is left is ranked in its group: one plan
    for any ``n``.  ``rank_by_value_in_groups`` does the same without a checkpoint for the order by one value.
    """
    left = _cut(table, [group], order, n)
    return rank_in_groups(left, group, order, rank=rank).where(F.col(rank) <= n)
