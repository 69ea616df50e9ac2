"""Analytics operators: DataFrames in, lazy DataFrames out."""

from .activity import active_days, active_days_by_group, active_user_count, days_per_user
from .balance import USER_FLOWS_SQL, city_average_balance, top_users_by_city, top_users_by_city_sql
from .counting import count_by_key, count_tokens, last_per_key, without
from .day_bitmaps import (
    active_users_by_period,
    day_bitmaps,
    days_per_period,
    in_day_range,
    merge_day_bitmaps,
)
from .flow import daily_flow, in_days, in_month, merge_by_day, total, weekday_flow
from .forecast import (
    fit_forecasters,
    forecast_flow,
    future_features,
    training_series,
    with_day_features,
)
from .forests import apply_forests, grow_forests
from .histograms import rank_by_count, rank_by_value_in_groups, top_by_count
from .ranking import global_rank, rank_in_groups, top_k, top_n_per_group

__all__ = [
    "USER_FLOWS_SQL",
    "active_days",
    "active_days_by_group",
    "active_user_count",
    "active_users_by_period",
    "apply_forests",
    "city_average_balance",
    "count_by_key",
    "count_tokens",
    "daily_flow",
    "day_bitmaps",
    "days_per_period",
    "days_per_user",
    "fit_forecasters",
    "forecast_flow",
    "future_features",
    "global_rank",
    "grow_forests",
    "in_day_range",
    "in_days",
    "in_month",
    "last_per_key",
    "merge_by_day",
    "merge_day_bitmaps",
    "rank_by_count",
    "rank_by_value_in_groups",
    "rank_in_groups",
    "top_by_count",
    "top_k",
    "top_n_per_group",
    "top_users_by_city",
    "top_users_by_city_sql",
    "total",
    "training_series",
    "weekday_flow",
    "with_day_features",
    "without",
]
