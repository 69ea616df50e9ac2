"""Readers.  Lenient line readers and typed readers give frames of the same shape."""

from .lines import (
    count_rejects,
    drop_lines_equal_to,
    first_line,
    keep_arity,
    quoted_records,
    read_lines,
    split_fields,
    without_own_header,
)
from .rejects import (
    count_reasons,
    read_rejects,
    read_screened,
    screen,
    screen_active_days_lines,
    screen_balance_lines,
    screen_daily_flow_lines,
    screen_news_lines,
)
from .tables import (
    DROP_BAD_ROWS,
    FAIL_ON_BAD,
    FAIL_WHERE_NEEDED,
    ZERO_BAD_VALUES,
    LineRules,
    active_days_from_lines,
    balance_from_lines,
    daily_flow_from_lines,
    news_from_lines,
    profile_from_lines,
    read_active_days,
    read_balance,
    read_daily_flow,
    read_daily_flow_csv,
    read_day_bitmaps,
    read_landed_balance,
    read_named_csv,
    read_news,
    read_profile,
    read_stop_words,
    register_views,
    stop_words_from_lines,
)

__all__ = [
    "DROP_BAD_ROWS",
    "FAIL_ON_BAD",
    "FAIL_WHERE_NEEDED",
    "ZERO_BAD_VALUES",
    "LineRules",
    "active_days_from_lines",
    "balance_from_lines",
    "count_reasons",
    "count_rejects",
    "daily_flow_from_lines",
    "drop_lines_equal_to",
    "first_line",
    "keep_arity",
    "news_from_lines",
    "profile_from_lines",
    "quoted_records",
    "read_active_days",
    "read_balance",
    "read_daily_flow",
    "read_daily_flow_csv",
    "read_day_bitmaps",
    "read_landed_balance",
    "read_lines",
    "read_named_csv",
    "read_news",
    "read_profile",
    "read_rejects",
    "read_screened",
    "read_stop_words",
    "register_views",
    "screen",
    "screen_active_days_lines",
    "screen_balance_lines",
    "screen_daily_flow_lines",
    "screen_news_lines",
    "split_fields",
    "stop_words_from_lines",
    "without_own_header",
]
