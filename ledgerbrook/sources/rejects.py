"""Screening: every line is kept, good ones typed and the others as they stood, with the reason.

The rules are those of the dropping readers.  A screened table has the typed columns, ``reason`` (NULL
for a good row: the first rule that the line breaks) and ``line`` (NULL for a good row).  It
comes from one scan; ``sinks.write_screened`` writes good rows and rejects in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import parse_day, parse_number, strip_control
from .lines import field, read_lines, split_fields

HEADER, FIELDS, DAY = "header", "fields", "report_date"


def _screened(lines: DataFrame, sep: str, columns: list[Column], broken: list[tuple[str, Column]]) -> DataFrame:
    """Rows with ``columns`` (of ``fields``), judged by conditions on these, on ``fields`` and on the line."""
    rows = split_fields(lines.select(F.col("value").alias("line"), "value"), sep)
    # Inlined, so that each amount is parsed once for its column and its rule.
    typed = rows.select("line", "fields", F.inline(F.array(F.struct(*columns))))
    reason = F.lit(None).cast("string")
    for name, condition in reversed(broken):
        reason = F.when(F.coalesce(condition, F.lit(True)), F.lit(name)).otherwise(reason)
    names = [name for name in typed.columns if name not in ("line", "fields")]
    judged = typed.select(*names, F.explode(F.array(reason)).alias("reason"), "line")
    good = F.col("reason").isNull()
    return judged.select(
        *[F.when(good, F.col(name)).alias(name) for name in names], "reason", F.when(~good, F.col("line")).alias("line")
    )


def _bad_day(day: Column, days: str) -> list[tuple[str, Column]]:
    if days == "any":
        return []
    if days not in ("strict", "lenient"):
        raise ValueError(f"unknown rule {days!r}")
    return [(DAY, parse_day(day, lenient=days == "lenient").isNull())]


def screen_balance_lines(
    lines: DataFrame,
    *,
    amounts: Sequence[str] = ("total_purchase_amt", "total_redeem_amt"),
    days: str = "any",
) -> DataFrame:
    """Balance lines under the rules of ``DROP_BAD_ROWS``, and of ``days`` (``any``, ``strict`` or ``lenient``).

    Reasons: ``fields`` (too few), ``header`` (the purchase field holds its own name), the name of an
    amount that is no number (NaN is none), ``report_date``.
    """
    parsed = []
    for name in amounts:
        raw = field(schemas.BALANCE_POSITIONS[name])
        parsed.append(parse_number(F.when(raw == "", F.lit("0")).otherwise(raw), "double").alias(name))
    columns = [field(schemas.BALANCE_POSITIONS[name]).alias(name) for name in ("user_id", "report_date")]
    header = field(schemas.BALANCE_POSITIONS["total_purchase_amt"]) == "total_purchase_amt"
    broken = [
        (FIELDS, F.size("fields") < (schemas.BALANCE_MIN_FIELDS if amounts else 2)),
        (HEADER, F.coalesce(header, F.lit(False))),
        *[(name, F.col(name).isNull() | F.isnan(name)) for name in amounts],
        *_bad_day(F.col("report_date"), days),
    ]
    return _screened(lines, ",", [*columns, *parsed], broken)


def screen_news_lines(lines: DataFrame) -> DataFrame:
    """News lines: ``fields`` is the reason of a line that has not exactly four."""
    columns = [field(pos).alias(name) for name, pos in schemas.NEWS_POSITIONS.items()]
    return _screened(lines, ",", columns, [(FIELDS, F.size("fields") != schemas.NEWS_FIELDS)])


def screen_daily_flow_lines(lines: DataFrame, *, days: str = "lenient") -> DataFrame:
    """``date TAB inflow,outflow`` lines.  Reasons: ``fields``, ``report_date``, the name of a bad amount."""
    amounts = ["total_purchase_amt", "total_redeem_amt"]
    # Trailing commas are forgotten, as when the pair is read.
    pair = F.split(F.rtrim(field(1), F.lit(",")), ",")
    parsed = [parse_number(F.get(pair, F.lit(i)), "double").alias(name) for i, name in enumerate(amounts)]
    broken = [
        (FIELDS, F.size("fields") != 2),
        *_bad_day(F.col("report_date"), days),
        *[(name, F.col(name).isNull()) for name in amounts],
    ]
    return _screened(lines, "\t", [field(0).alias("report_date"), *parsed], broken)


def screen_active_days_lines(lines: DataFrame) -> DataFrame:
    """``user TAB days`` lines.  Reasons: ``fields``, ``active_days`` (no whole number)."""
    columns = [strip_control(field(0)).alias("user_id"), strip_control(field(1)).try_cast("bigint").alias("active_days")]
    broken = [(FIELDS, F.size("fields") != 2), ("active_days", F.col("active_days").isNull())]
    return _screened(lines, "\t", columns, broken)


SCREENS = {
    "balance": screen_balance_lines,
    "news": screen_news_lines,
    "daily-flow": screen_daily_flow_lines,
    "active-days": screen_active_days_lines,
}

# The reasons that a kind of lines can have, in the order of its rules.
REASONS = {
    "balance": [FIELDS, HEADER, "total_purchase_amt", "total_redeem_amt", "direct_purchase_amt", DAY],
    "news": [FIELDS],
    "daily-flow": [FIELDS, DAY, "total_purchase_amt", "total_redeem_amt"],
    "active-days": [FIELDS, "active_days"],
}


def count_reasons(screened: DataFrame, kind: str) -> tuple[DataFrame, Observation]:
    """The same rows; once they are written, the observation holds ``good`` and a number for each reason."""
    observation = Observation(f"screened {kind}")
    counts = [F.count_if(F.coalesce(F.col("reason") == name, F.lit(False))).alias(name) for name in REASONS[kind]]
    return screened.observe(observation, F.count_if(F.col("reason").isNull()).alias("good"), *counts), observation


def screen(spark: SparkSession, path: str | Sequence[str], kind: str, **rules) -> DataFrame:
    """The lines of some files, screened as ``balance``, ``news``, ``daily-flow`` or ``active-days``."""
    return SCREENS[kind](read_lines(spark, path), **rules)


def read_screened(spark: SparkSession, path: str) -> DataFrame:
    """The good rows of a screened folder; the rejects beside them are not read."""
    rows = spark.read.parquet(path).where("outcome = 'good'")
    return rows.drop("outcome", "reason", "line")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``reason`` and ``line`` of every reject of a screened folder."""
    return spark.read.parquet(path).where("outcome = 'reject'").select("reason", "line")
