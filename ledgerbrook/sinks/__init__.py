"""Distributed writers for the text and CSV forms, and the Parquet layout for landed data."""

from .writers import (
    daily_flow_lines,
    key_value_lines,
    land_balance,
    land_bucketed,
    ranked_lines,
    store_day_bitmaps,
    write_csv,
    write_lines,
    write_screened,
)

__all__ = [
    "daily_flow_lines",
    "key_value_lines",
    "land_balance",
    "land_bucketed",
    "ranked_lines",
    "store_day_bitmaps",
    "write_csv",
    "write_lines",
    "write_screened",
]
