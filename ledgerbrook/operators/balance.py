"""Balance and flow by city."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .flow import in_days, total
from .histograms import rank_by_value_in_groups


def city_average_balance(
    balance: DataFrame,
    profile: DataFrame,
    *,
    day: str | None = None,
    city: str = "City",
    user: str = "user_id",
    amount: str = "tBalance",
) -> DataFrame:
    """Average balance per city on one day (``yyyyMMdd``) or over all rows; NULL balances are left out.

    Sums and counts are reduced to one row per user before the join, which then sees
    no hot user; a user listed twice in the profile still counts twice.
    """
    rows = balance if day is None else in_days(balance, day, day)
    per_user = rows.groupBy(user).agg(total(balance, amount).alias("__sum"), F.count(amount).alias("__count"))
    joined = profile.select(user, city).join(per_user, user)
    average = F.try_divide(F.sum("__sum").cast("double"), F.sum("__count").cast("double"))
    return joined.groupBy(city).agg(average.alias("average_balance"))


def top_users_by_city(
    balance: DataFrame,
    profile: DataFrame,
    first: str,
    last: str,
    *,
    n: int = 3,
    city: str = "City",
    user: str = "user_id",
    inflow: str = "total_purchase_amt",
    outflow: str = "total_redeem_amt",
) -> DataFrame:
    """The ``n`` users with the largest inflow plus outflow of each city, between two days.

    A user whose inflows or outflows are all NULL has a NULL flow and ranks last.
    Flows are summed per user before the join; the sums per (user, city) that follow
    need no further shuffle.
    """
    per_user = (
        in_days(balance, first, last)
        .groupBy(user)
        .agg(total(balance, inflow).alias("__in"), total(balance, outflow).alias("__out"))
    )
    flows = (
        profile.select(user, city)
        .join(per_user, user)
        .groupBy(user, city)
        .agg((F.sum("__in") + F.sum("__out")).alias("__flow"))
    )
    top = rank_by_value_in_groups(flows, city, "__flow", user, first=n)
    return top.select(city, user, F.col("__flow").cast("bigint").alias("total_flow"), "rank")


# The flows of the same query over registered views; whole amounts are summed beyond 64 bits.
USER_FLOWS_SQL = """
WITH per_user AS (
  SELECT user_id, SUM(CAST(total_purchase_amt AS DECIMAL(38,0))) AS inflow,
         SUM(CAST(total_redeem_amt AS DECIMAL(38,0))) AS outflow
  FROM user_balance_table
  WHERE report_date BETWEEN :first AND :last
  GROUP BY user_id
)
SELECT p.City, p.user_id, SUM(u.inflow) + SUM(u.outflow) AS flow
FROM user_profile_table p JOIN per_user u ON p.user_id = u.user_id
GROUP BY p.City, p.user_id
"""


def top_users_by_city_sql(spark: SparkSession, first: str, last: str, *, n: int = 3) -> DataFrame:
    """``top_users_by_city`` over the views ``user_balance_table`` and ``user_profile_table`` (whole amounts)."""
    bounds = {"first": datetime.strptime(first, "%Y%m%d").date(), "last": datetime.strptime(last, "%Y%m%d").date()}
    flows = spark.sql(USER_FLOWS_SQL, args=bounds)
    top = rank_by_value_in_groups(flows, "City", "flow", "user_id", first=n)
    return top.select("City", "user_id", F.col("flow").cast("bigint").alias("total_flow"), "rank")
