"""Column expressions.  All of them are built-in Spark functions: no Python workers."""

from .dates import day_features, day_key, day_name, future_days, parse_day
from .numbers import parse_number, positive
from .text import letter_tokens, strip_control, text_lines

__all__ = [
    "day_features",
    "day_key",
    "day_name",
    "future_days",
    "letter_tokens",
    "parse_day",
    "parse_number",
    "positive",
    "strip_control",
    "text_lines",
]
