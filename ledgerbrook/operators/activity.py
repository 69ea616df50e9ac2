"""Two notions of an active user, kept apart: rows with money moved, and distinct days seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import positive
from .flow import in_month


def active_days(
    balance: DataFrame,
    *,
    user: str = "user_id",
    purchase: str = "direct_purchase_amt",
    redeem: str = "total_redeem_amt",
) -> DataFrame:
    """Rows per user with a direct purchase or a redemption above zero (rows, not distinct days)."""
    types = {f.name: f.dataType for f in balance.schema}
    moved = positive(F.col(purchase), types[purchase]) | positive(F.col(redeem), types[redeem])
    return balance.where(moved).groupBy(user).agg(F.count("*").alias("active_days"))


def active_days_by_group(
    days: DataFrame, profile: DataFrame, *, group: str = "constellation", user: str = "user_id"
) -> DataFrame:
    """Whole-number average of active days per profile group, for users that have a profile.

    Both sides hold one row per user here, so no user can be hot in the join.
    """
    joined = days.join(profile.select(user, group), user)
    truncated = F.expr("sum(active_days) div count(*)").cast("bigint")
    return joined.groupBy(group).agg(truncated.alias("avg_active_days"))


def days_per_user(
    records: DataFrame, *, user: str = "user_id", day: str = "report_date", count: str = "days"
) -> DataFrame:
    """Exact number of distinct days per user.

    Removing repeats first spreads a hot user over its days, and they are dropped
    before the shuffle as well as after it.
    """
    seen = records.select(user, day).distinct()
    return seen.groupBy(user).agg(F.count("*").alias(count))


def active_user_count(
    records: DataFrame,
    month: str,
    *,
    min_days: int = 5,
    user: str = "user_id",
    day: str = "report_date",
) -> DataFrame:
    """One row: how many users were seen on at least ``min_days`` days of ``month`` (``yyyyMM``).

    The days of a month fit the bits of a number, so dates need one aggregation per
    user; days kept as text may hold anything and are counted as distinct values.
    """
    seen = in_month(records, month, day=day)
    if isinstance(records.schema[day].dataType, T.StringType):
        days = days_per_user(seen, user=user, day=day)
    else:
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth(day) - 1)
        days = seen.groupBy(user).agg(F.bit_count(F.bit_or(bit)).alias("days"))
    return days.where(F.col("days") >= min_days).agg(F.count("*").alias("active_users"))
