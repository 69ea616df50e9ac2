"""The jobs a user runs: paths in, files out.

Each job is one lazy plan from reader to writer (the global rank and the forecast
checkpoint once on the way).  ``JOBS`` maps the command-line names to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as ops
from .. import schemas, sinks, sources
from ..functions import parse_day
from . import increments


def count_and_rank(news: DataFrame, *, key: str = "stock", method: str = "sort") -> DataFrame:
    """All keys by number of rows, ranked 1..N; equal counts go by key.

    ``method='sort'`` sorts the counts into files and numbers them; ``'histogram'`` ranks them by the
    number of keys with a larger count, without a checkpoint.
    """
    counts = ops.count_by_key(news, key)
    if method == "histogram":
        return ops.rank_by_count(counts, key)
    if method == "sort":
        return ops.global_rank(counts, [F.desc("n"), F.asc(key)])
    raise ValueError(f"unknown method {method!r}")


def top_words(
    news: DataFrame, stop_words: DataFrame, *, text: str = "headline", n: int = 100
) -> DataFrame:
    """The ``n`` most frequent words that are not stop words; equal counts go by word."""
    counts = ops.without(ops.count_tokens(news, text), stop_words, "word")
    return ops.top_by_count(counts, "word", n)


def _news(spark: SparkSession, news: str, quoting: str, header: str, screened: bool) -> DataFrame:
    """News lines, or the good rows of a folder that the job ``screen`` has written."""
    if screened:
        return sources.read_screened(spark, news)
    return sources.read_news(spark, news, quoting=quoting, header=header)


def run_screen(spark: SparkSession, lines: str, out: str, *, kind: str = "balance", days: str = "") -> dict[str, int]:
    """Good rows and rejects of ``balance``, ``news``, ``daily-flow`` or ``active-days`` lines, in one pass.

    ``days`` is the rule for days (``any``, ``strict``, ``lenient``) of kinds that have them.  Returns how
    many lines were good and how many went for each reason; jobs with ``screened`` read the good rows.
    """
    rules = {"days": days} if days else {}
    screened, seen = sources.count_reasons(sources.screen(spark, lines, kind, **rules), kind)
    sinks.write_screened(screened, out)
    return seen.get


def run_count_and_rank(
    spark: SparkSession,
    news: str,
    out: str,
    *,
    quoting: str = "naive",
    header: str = "count",
    method: str = "sort",
    screened: bool = False,
) -> None:
    ranked = count_and_rank(_news(spark, news, quoting, header, screened), method=method)
    if method != "sort":
        ranked = ranked.orderBy("rank")
    sinks.write_lines(sinks.ranked_lines(ranked, "stock"), out)


def run_top_words(
    spark: SparkSession,
    news: str,
    stop_words: str,
    out: str,
    *,
    n: int = 100,
    quoting: str = "naive",
    header: str = "count",
    screened: bool = False,
) -> None:
    table = _news(spark, news, quoting, header, screened)
    words = top_words(table, sources.read_stop_words(spark, stop_words), n=n)
    sinks.write_lines(sinks.ranked_lines(words.orderBy("rank"), "word"), out)


def run_daily_flow(
    spark: SparkSession, balance: str, out: str, *, form: str = "tab", screened: bool = False
) -> None:
    """``form='tab'``: bad rows dropped, doubles, text.  ``form='csv'``: bad values zero, integers, CSV.

    ``screened``: the balance is a folder that the job ``screen`` has written; its good rows count.
    """
    if screened:
        daily = ops.daily_flow(sources.read_screened(spark, balance))
        if form == "csv":
            sinks.write_csv(daily, out, order=["report_date"])
        else:
            sinks.write_lines(sinks.daily_flow_lines(daily.orderBy("report_date")), out)
    elif form == "csv":
        daily = ops.daily_flow(sources.read_balance(spark, balance, sources.ZERO_BAD_VALUES))
        sinks.write_csv(daily, out, order=["report_date"])
    else:
        daily = ops.daily_flow(sources.read_balance(spark, balance, sources.DROP_BAD_ROWS))
        sinks.write_lines(sinks.daily_flow_lines(daily.orderBy("report_date")), out)


def run_weekday_flow(spark: SparkSession, daily: str, out: str, *, lenient: bool = True) -> dict[str, int]:
    """Average flow per weekday; returns how many lines had no date."""
    table = sources.read_daily_flow(spark, daily)
    undated = parse_day(F.col("report_date"), lenient=lenient).isNull()
    dated, seen = sources.count_rejects(table, undated, "undated")
    averages = ops.weekday_flow(dated, lenient=lenient)
    sinks.write_lines(sinks.key_value_lines(averages, "weekday", ["avg_in", "avg_out"]), out)
    return {"lines without a date": seen.get["rejected"]}


def run_land_balance(spark: SparkSession, balance: str, out: str) -> None:
    """A balance CSV (columns by name) as Parquet by month, for the city jobs' ``landed`` option."""
    sinks.land_balance(sources.read_named_csv(spark, balance, schemas.BALANCE), out)


def run_active_days(spark: SparkSession, balance: str, out: str) -> None:
    rows = sources.read_balance(
        spark, balance, sources.FAIL_WHERE_NEEDED, amounts=("direct_purchase_amt", "total_redeem_amt")
    )
    days = ops.active_days(rows).orderBy(F.desc("active_days"), "user_id")
    sinks.write_lines(sinks.key_value_lines(days, "user_id", ["active_days"]), out)


def run_active_days_by_group(spark: SparkSession, days: str, profile: str, out: str) -> None:
    averages = ops.active_days_by_group(
        sources.read_active_days(spark, days), sources.read_profile(spark, profile)
    ).orderBy("constellation")
    sinks.write_lines(sinks.key_value_lines(averages, "constellation", ["avg_active_days"]), out)


def run_active_user_count(
    spark: SparkSession, balance: str, out: str, *, month: str, min_days: int = 5
) -> None:
    rows = sources.read_balance(spark, balance, sources.ZERO_BAD_VALUES, amounts=())
    sinks.write_csv(ops.active_user_count(rows, month, min_days=min_days), out)


def run_store_active_days(spark: SparkSession, balance: str, state: str) -> None:
    """Add the days of a balance CSV (columns by name) to a stored state of days per user."""
    wanted = type(schemas.BALANCE)([schemas.BALANCE[name] for name in ("user_id", "report_date")])
    sinks.store_day_bitmaps(ops.day_bitmaps(sources.read_named_csv(spark, balance, wanted)), state)


def run_active_users_by_period(
    spark: SparkSession, state: str, out: str, *, period: str = "quarter", min_days: int = 5, first: str = "", last: str = ""
) -> None:
    """Users seen on ``min_days`` days or more of each month, quarter or year, from the stored state alone."""
    days = sources.read_day_bitmaps(spark, state, first=first or None, last=last or None)
    sinks.write_csv(ops.active_users_by_period(days, period, min_days=min_days), out, order=["period"])


def run_add_balance(spark: SparkSession, balance: str, state: str) -> dict[str, int]:
    """Add the balance files that are new to stored daily sums; returns how many they were."""
    return {"files added": increments.add_balance_files(spark, balance, state)}


def run_daily_flow_of_state(spark: SparkSession, state: str, out: str) -> None:
    """Daily flow as CSV from the stored sums."""
    sinks.write_csv(increments.daily_flow_of(spark, state), out, order=["report_date"])


def _city_tables(
    spark: SparkSession, balance: str, profile: str, first: str, last: str, landed: bool
) -> tuple[DataFrame, DataFrame]:
    wanted = schemas.BALANCE["user_id"], schemas.BALANCE["report_date"]
    amounts = [schemas.BALANCE[n] for n in ("tBalance", "total_purchase_amt", "total_redeem_amt")]
    people = [schemas.PROFILE[n] for n in ("user_id", "City")]
    struct = type(schemas.BALANCE)
    if landed:
        rows = sources.read_landed_balance(spark, balance, first=first, last=last)
    else:
        rows = sources.read_named_csv(spark, balance, struct([*wanted, *amounts]))
    return (
        rows,
        sources.read_named_csv(spark, profile, struct(people)),
    )


def run_city_average_balance(
    spark: SparkSession, balance: str, profile: str, out: str, *, day: str, landed: bool = False
) -> None:
    averages = ops.city_average_balance(*_city_tables(spark, balance, profile, day, day, landed), day=day)
    sinks.write_csv(averages, out, crlf=True, order=[F.desc("average_balance"), "City"])


def run_top_users_by_city(
    spark: SparkSession,
    balance: str,
    profile: str,
    out: str,
    *,
    first: str,
    last: str,
    n: int = 3,
    sep: str = "\t",
    landed: bool = False,
) -> None:
    tables = _city_tables(spark, balance, profile, first, last, landed)
    top = ops.top_users_by_city(*tables, first, last, n=n)
    ordered = top.orderBy("City", "rank").select("City", "user_id", "total_flow")
    sinks.write_csv(ordered, out, sep=sep)


def run_forecast(
    spark: SparkSession,
    daily: str,
    out: str,
    *,
    train_first: str | None = None,
    train_last: str | None = None,
    start: str | None = None,
    horizon: int = 30,
    forest: str = "mllib",
) -> None:
    series = sources.read_daily_flow_csv(spark, daily)
    if train_first or train_last:
        series = ops.in_days(series, train_first or "00000000", train_last or "99999999")
    forecast = ops.forecast_flow(series, start=start, horizon=horizon, forest=forest)
    sinks.write_csv(forecast, out, order=["report_date"])


JOBS = {
    "screen": run_screen,
    "add-balance": run_add_balance,
    "daily-flow-of-state": run_daily_flow_of_state,
    "store-active-days": run_store_active_days,
    "active-users-by-period": run_active_users_by_period,
    "count-and-rank": run_count_and_rank,
    "top-words": run_top_words,
    "daily-flow": run_daily_flow,
    "weekday-flow": run_weekday_flow,
    "land-balance": run_land_balance,
    "active-days": run_active_days,
    "active-days-by-group": run_active_days_by_group,
    "active-user-count": run_active_user_count,
    "city-average-balance": run_city_average_balance,
    "top-users-by-city": run_top_users_by_city,
    "forecast": run_forecast,
}
