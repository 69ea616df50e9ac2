"""Lenient number parsing without Python workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The only words that are numbers, in these spellings; a cast would take any letter case.
_NUMBER_WORD = r"^\s*[+-]?(Infinity|NaN)\s*$"
_SHORT_INTEGER = r"^\s*[+-]?[0-9]{1,18}\s*$"
_GROUPED_INTEGER = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"


def parse_number(text: Column, dtype: str) -> Column:
    """``text`` as ``dtype`` (``double``, ``bigint`` or a decimal), NULL when it is no number.

    For ``bigint``, ``1_000`` is an integer and ``1.5`` is not; an integer beyond 64
    bits raises instead of turning into a bad value (use a decimal type for those).
    """
    if dtype == "double":
        # Every such word holds an n and no other number does.
        word = (F.instr(text, "n") > 0) | (F.instr(text, "N") > 0)
        return F.when(~word | text.rlike(_NUMBER_WORD), text).try_cast(dtype)
    if dtype == "bigint":
        # A failing try_cast costs an exception (17 us); asking first costs next to nothing.
        short = F.when(text.rlike(_SHORT_INTEGER), text.cast(dtype))
        long = F.coalesce(
            F.regexp_replace(text, "[_\\s]", "").try_cast(dtype),
            F.raise_error(F.concat(F.lit("integer outside 64 bits: "), text)).cast(dtype),
        )
        # Only an underscore or too many digits can make an integer of what is left.
        odd = (F.instr(text, "_") > 0) | (F.length(text) > 18)
        return F.coalesce(short, F.when(odd & text.rlike(_GROUPED_INTEGER), long))
    return text.try_cast(dtype)


def positive(amount: Column, dtype: T.DataType) -> Column:
    """``amount > 0`` where NaN is not positive (Spark orders NaN above every number)."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return (amount > 0) & ~F.isnan(amount)
    return amount > 0
