"""Distinct days as bitmaps: one state from which every range of days is counted exactly.

A state has one row per user and month, ``user_id, month (yyyyMM), days``, the days of the month being bits of a
number (bit 0 is the first).  States of any parts of the records are merged by OR, so new records
cost an aggregation of their own and days seen twice count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bits(first: Column, last: Column) -> Column:
    """The bits of the days ``first`` to ``last`` of a month."""
    low = F.call_function("shiftleft", F.lit(1).cast("bigint"), (first - 1).cast("int"))
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), last.cast("int")) - low


def day_bitmaps(records: DataFrame, *, user: str = "user_id", day: str = "report_date") -> DataFrame:
    """The state of some records; ``day`` is a date or timestamp, and records without one are left out.

    Bits are combined before the one shuffle.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth(day) - 1)
    dated = records.where(F.col(day).isNotNull())
    months = dated.groupBy(F.col(user).alias("user_id"), F.date_format(day, "yyyyMM").alias("month"))
    return months.agg(F.bit_or(bit).alias("days"))


def merge_day_bitmaps(*states: DataFrame) -> DataFrame:
    """One state of all the records that the states are from."""
    whole = states[0]
    for state in states[1:]:
        whole = whole.unionByName(state)
    return whole.groupBy("user_id", "month").agg(F.bit_or("days").alias("days"))


def in_day_range(state: DataFrame, first: str, last: str) -> DataFrame:
    """The state of the days ``first`` to ``last`` (``yyyyMMdd``, both included) alone.

    The months reach the scan; only those at the ends are cut.
    """
    months = state.where((F.col("month") >= first[:6]) & (F.col("month") <= last[:6]))
    low = F.when(F.col("month") == first[:6], F.lit(int(first[6:]))).otherwise(F.lit(1))
    high = F.when(F.col("month") == last[:6], F.lit(int(last[6:]))).otherwise(F.lit(31))
    cut = months.withColumn("days", F.col("days").bitwiseAND(_bits(low, high)))
    return cut.where("days <> 0")


def period_of(month: Column, period: str) -> Column:
    """``yyyyMM``, ``yyyyQn`` or ``yyyy`` of a month."""
    year = F.substring(month, 1, 4)
    if period == "month":
        return month
    if period == "quarter":
        number = F.floor((F.substring(month, 5, 2).cast("int") + 2) / 3)
        return F.concat(year, F.lit("Q"), number.cast("string"))
    if period == "year":
        return year
    raise ValueError(f"unknown period {period!r}")


def days_per_period(state: DataFrame, period: str = "quarter") -> DataFrame:
    """``user_id, period, days``: the distinct days on which each user was seen.

    ``state`` has one row per user and month, as merged.
    """
    grouped = state.groupBy("user_id", period_of(F.col("month"), period).alias("period"))
    return grouped.agg(F.sum(F.bit_count("days")).cast("bigint").alias("days"))


def active_users_by_period(state: DataFrame, period: str = "quarter", *, min_days: int = 5) -> DataFrame:
    """``period, active_users``: how many users were seen on at least ``min_days`` days of it."""
    active = days_per_period(state, period).where(F.col("days") >= min_days)
    return active.groupBy("period").agg(F.count("*").alias("active_users"))
