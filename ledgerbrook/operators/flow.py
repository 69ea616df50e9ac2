"""Daily and weekday fund flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import day_name, parse_day


def total(table: DataFrame, name: str) -> Column:
    """The sum of a column; whole numbers are summed as decimals, which 64 bits cannot overflow."""
    whole = isinstance(table.schema[name].dataType, T.IntegralType)
    return F.sum(F.col(name).cast("decimal(38,0)") if whole else F.col(name))


def daily_flow(
    balance: DataFrame,
    *,
    day: str = "report_date",
    inflow: str = "total_purchase_amt",
    outflow: str = "total_redeem_amt",
) -> DataFrame:
    """Inflow and outflow per day, missing amounts being zero.

    Both sums are combined before the one shuffle.  Sums of whole numbers are decimals.
    """

    def filled(name: str):
        return F.coalesce(total(balance, name), F.lit(0)).alias(name)

    return balance.groupBy(day).agg(filled(inflow), filled(outflow))


def weekday_flow(
    daily: DataFrame,
    *,
    day: str = "report_date",
    inflow: str = "total_purchase_amt",
    outflow: str = "total_redeem_amt",
    lenient: bool = False,
) -> DataFrame:
    """Average daily flow per weekday name, largest inflow first, then Sunday to Saturday.

    Days that are no dates are dropped; see ``functions.parse_day`` for ``lenient``.
    """
    date = F.col(day)
    if isinstance(daily.schema[day].dataType, T.StringType):
        date = parse_day(date, lenient=lenient)
    dated = daily.select(date.alias("__date"), inflow, outflow)

    def average(name: str):
        return total(daily, name).cast("double") / F.count(name)

    # Bad days form one group of their own, dropped by an aggregate: a condition on the
    # date itself would be pushed below the daily sums and parse every balance row.
    return (
        dated.groupBy(F.dayofweek("__date").alias("__dow"), day_name(F.col("__date")).alias("weekday"))
        .agg(average(inflow).alias("avg_in"), average(outflow).alias("avg_out"), F.max(F.dayofweek("__date")).alias("__ok"))
        .where(F.col("__ok").isNotNull())
        .orderBy(F.desc("avg_in"), "__dow")
        .select("weekday", "avg_in", "avg_out")
    )


def in_days(table: DataFrame, first: str, last: str, *, day: str = "report_date") -> DataFrame:
    """Rows from ``first`` to ``last`` (``yyyyMMdd``), both included; ``day`` is a date or text.

    Literals are typed after the column, so the range reaches the Parquet scan.
    """
    if isinstance(table.schema[day].dataType, T.StringType):
        return table.where(F.col(day).between(first, last))
    bounds = [F.lit(f"{d[:4]}-{d[4:6]}-{d[6:]}").cast(table.schema[day].dataType) for d in (first, last)]
    if isinstance(table.schema[day].dataType, T.DateType):
        return table.where(F.col(day).between(*bounds))
    return table.where((F.col(day) >= bounds[0]) & (F.col(day) < bounds[1] + F.expr("INTERVAL 1 DAY")))


def in_month(table: DataFrame, month: str, *, day: str = "report_date") -> DataFrame:
    """Rows of one month (``yyyyMM``): a prefix for text days, a range for dates."""
    if isinstance(table.schema[day].dataType, T.StringType):
        return table.where(F.col(day).startswith(month))
    dtype = table.schema[day].dataType
    start = F.lit(f"{month[:4]}-{month[4:]}-01").cast("date")
    return table.where(
        (F.col(day) >= start.cast(dtype)) & (F.col(day) < F.add_months(start, 1).cast(dtype))
    )


def merge_by_day(left: DataFrame, right: DataFrame, *, day: str = "report_date") -> DataFrame:
    """Two daily series side by side, for the days both have."""
    return left.join(right, day)
