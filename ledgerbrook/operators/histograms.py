"""Ranks and top lists from counts of rows: no rows are stored, and no bucket number is fixed.

The order is always the same kind: a value, largest first (NULL last), then a unique key.
A group whose rows are too many for one task is cut by its own order into pieces of about ``PIECE_ROWS``
rows.  Where the cuts lie is found in a sample that a hash of each row draws, so a piece depends on the
data alone and a lost task finds the same ones again.  The rows before a piece come from counting pieces,
and only inside a piece are rows sorted.  Spark makes the counted table once: its shuffle is reused
for the histogram, the sample and the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a piece, on average, and sampled rows of a piece.
PIECE_ROWS = 1 << 18
SAMPLES = 8

# Values of one power of two share this many cells of the outer histogram.
_CELLS = 256


def _pieces(table: DataFrame, group: str, position: Column, drawn_from: DataFrame | None = None) -> DataFrame:
    """The table with ``__at`` (its place in the group's order, ascending) and ``__piece``.

    Pieces are numbered along the order.  Of a group, one row in ``PIECE_ROWS / SAMPLES`` is
    gathered to find its cuts, of which every ``SAMPLES``-th is one: one row in ``PIECE_ROWS`` is sent to all tasks.
    """
    placed = table.withColumn("__at", position)
    sampled = placed if drawn_from is None else drawn_from.withColumn("__at", position)
    # The group is hashed too: a value that was counted keeps the filter above the count.
    drawn = F.pmod(F.xxhash64(F.col(group), "__at"), F.lit(PIECE_ROWS)) < SAMPLES
    cuts = sampled.where(drawn).groupBy(F.col(group).alias("__of")).agg(F.array_sort(F.collect_list("__at")).alias("__drawn"))
    cuts = cuts.select("__of", F.filter("__drawn", lambda at, i: i % SAMPLES == SAMPLES - 1).alias("__cuts"))
    cuts = cuts.where(F.size("__cuts") > 0)
    joined = placed.join(F.broadcast(cuts), F.col(group).eqNullSafe(F.col("__of")), "left").drop("__of")
    piece = F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(_cuts_up_to(F.col("__cuts"), F.col("__at")))
    return joined.withColumn("__piece", piece).drop("__cuts")


def _cuts_up_to(cuts: Column, at: Column) -> Column:
    """How many of the sorted cuts are at or before a place, by halving."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(cuts) + 1)).cast("int"))

    def halve(span: Column, _: Column) -> Column:
        low, high = span["low"], span["high"]
        middle = F.floor((low + high) / 2).cast("int")
        before = F.get(cuts, middle) <= at
        moved = F.struct(
            F.when(before, middle + 1).otherwise(low).alias("low"), F.when(before, high).otherwise(middle).alias("high")
        )
        return F.when(low < high, moved).otherwise(span)

    whole = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))
    return F.aggregate(steps, whole, halve, lambda span: span["low"])


def _before(order: list[Column], *by: str) -> Window:
    window = Window.partitionBy(*by) if by else Window.partitionBy()
    return window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _cell(value: Column) -> Column:
    """Cells of the outer histogram, growing with the value; some 16,000 at most (numbers up to 1 share one)."""
    return F.when(value.isNotNull(), F.floor(F.log2(F.greatest(value.cast("double"), F.lit(1.0))) * _CELLS))


def _ahead(counted: DataFrame, table: DataFrame, count: str, order: list[Column]) -> DataFrame:
    """``counted`` (``__n``, ``__rows``, one row per value or piece) with ``__ahead``: the rows of ``table`` before it.

    Rows are counted by cell over the whole table, which the one task that adds up the cells can hold
    whatever the table holds, and by value inside each cell.
    """
    cells = table.groupBy(_cell(F.col(count)).alias("__cell")).agg(F.count("*").alias("__in_cell"))
    above = F.sum("__in_cell").over(_before([F.col("__cell").desc_nulls_last()]))
    cells = cells.select(F.col("__cell").alias("__of_cell"), F.coalesce(above, F.lit(0)).alias("__above"))
    celled = counted.withColumn("__cell", _cell(F.col("__n")))
    inside = F.coalesce(F.sum("__rows").over(_before([F.col("__n").desc_nulls_last(), *order], "__cell")), F.lit(0))
    joined = celled.withColumn("__inside", inside).join(
        F.broadcast(cells), F.col("__cell").eqNullSafe(F.col("__of_cell"))
    )
    return joined.select(*counted.columns, (F.col("__above") + F.col("__inside")).alias("__ahead"))


def rank_by_count(table: DataFrame, key: str, *, count: str = "n", rank: str = "rank") -> DataFrame:
    """Ranks 1..N by ``count``, largest first (NULL last), then by ``key``, which is unique.

    A rank is the keys with a larger count, from the histogram of counts, plus the place among equal
    counts.  Few counts belong to many keys, and one may belong to most of them: such a count is
    cut along the keys.
    """
    placed = _pieces(table, count, F.col(key))
    pieces = placed.groupBy(F.col(count).alias("__n"), F.col("__piece").alias("__p")).agg(F.count("*").alias("__rows"))
    offsets = _ahead(pieces, table, count, [F.col("__p")]).drop("__rows")
    # Keys that are never NULL: the join finds the rows where the window has put them.
    offsets = offsets.select(*_known("__n"), F.col("__p").alias("__piece"), "__ahead")
    keys = ["__known", "__none", "__piece"]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("__at"))
    ranked = placed.select("*", *_known(count)).withColumn("__place", place).join(offsets, keys)
    return ranked.select(*table.columns, (F.col("__ahead") + F.col("__place")).alias(rank))


def _known(name: str) -> list[Column]:
    value = F.col(name)
    return [F.coalesce(value, F.lit(0)).alias("__known"), value.isNull().alias("__none")]


def top_by_count(table: DataFrame, key: str, k: int, *, count: str = "n", rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of ``rank_by_count``, with their ranks.

    The histogram of counts tells which counts the list needs, at most ``k`` of them.  They are joined to the
    rows as a broadcast, so rows below are dropped where they are: what is shuffled is fewer than ``k``
    rows and the ties of the smallest count needed, in pieces if they are many.
    """
    values = table.groupBy(F.col(count).alias("__n")).agg(F.count("*").alias("__rows"))
    needed = _ahead(values, table, count, []).where(F.col("__ahead") < k).select("__n", "__ahead")
    kept = table.join(F.broadcast(needed), F.col(count).eqNullSafe(F.col("__n"))).drop("__n")
    placed = _pieces(kept, count, F.col(key), drawn_from=table)
    pieces = placed.groupBy(F.col(count).alias("__n"), F.col("__piece").alias("__p")).agg(F.count("*").alias("__rows"))
    earlier = F.coalesce(F.sum("__rows").over(_before([F.col("__p")], "__n")), F.lit(0))
    # A value's first piece has none before it, and most values have no other: a row for ``PIECE_ROWS`` rows.
    pieces = F.broadcast(pieces.select("__n", "__p", earlier.alias("__earlier")).where("__p > 0"))
    same = F.col(count).eqNullSafe(F.col("__n")) & (F.col("__piece") == F.col("__p"))
    place = F.row_number().over(Window.partitionBy(count, "__piece").orderBy("__at"))
    ranked = placed.withColumn("__place", place).join(pieces, same, "left")
    ranked = ranked.select(
        *table.columns, (F.col("__ahead") + F.coalesce("__earlier", F.lit(0)) + F.col("__place")).alias(rank)
    )
    return ranked.where(F.col(rank) <= k)


def _descending(table: DataFrame, value: str) -> Column:
    """An expression that grows as a number falls, without overflow."""
    kind = table.schema[value].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.bitwise_not(F.col(value))
    if isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
        return -F.col(value)
    raise TypeError(f"{value} is no number but {kind.simpleString()}")


def rank_by_value_in_groups(
    table: DataFrame, group: str, value: str, key: str, *, first: int | None = None, rank: str = "rank"
) -> DataFrame:
    """Ranks 1..N in every group by ``value``, largest first (NULL last), then by ``key``, unique in its group.

    Groups are measured first, and each is cut into pieces in proportion to its rows; a group of
    one piece, the normal case, is ranked as it is.  With ``first``, only that many rows of each group are
    given, and pieces that begin beyond them are not sorted.
    """
    order = F.struct(F.col(value).isNull().alias("none"), _descending(table, value).alias("down"), F.col(key).alias("key"))
    placed = _pieces(table, group, order)
    pieces = placed.groupBy(F.col(group).alias("__g"), F.col("__piece").alias("__p")).agg(F.count("*").alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(_before([F.col("__p")], "__g")), F.lit(0))
    pieces = pieces.select("__g", "__p", before.alias("__offset"))
    # The first piece of a group has nothing before it, and most groups have no other: a row for ``PIECE_ROWS`` rows.
    pieces = F.broadcast(pieces.where("__p > 0" if first is None else f"__p > 0 and __offset < {int(first)}"))
    place = F.row_number().over(Window.partitionBy(group, "__piece").orderBy("__at"))
    ranked = placed.withColumn("__place", place)
    if first is not None:
        ranked = ranked.where(F.col("__place") <= first)
    same = F.col(group).eqNullSafe(F.col("__g")) & (F.col("__piece") == F.col("__p"))
    ranked = ranked.join(pieces, same, "left").where("__piece = 0 or __p is not null")
    total = F.coalesce("__offset", F.lit(0)) + F.col("__place")
    ranked = ranked.select(*table.columns, total.alias(rank))
    return ranked if first is None else ranked.where(F.col(rank) <= first)
