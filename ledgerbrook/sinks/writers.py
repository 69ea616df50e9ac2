"""Lines are made with column expressions; executors write them, the driver sees none of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_value_lines(table: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """``key TAB value,value...``; doubles keep the notation of their cast, such as ``2.75E7``."""
    text = F.concat_ws(",", *[F.col(name).cast("string") for name in values])
    return table.select(F.concat_ws("\t", F.col(key).cast("string"), text).alias("value"))


def daily_flow_lines(daily: DataFrame) -> DataFrame:
    """``date TAB inflow,outflow`` with both amounts as doubles."""
    amounts = ["total_purchase_amt", "total_redeem_amt"]
    doubles = daily.withColumns({name: F.col(name).cast("double") for name in amounts})
    return key_value_lines(doubles, "report_date", amounts)


def ranked_lines(ranked: DataFrame, key: str, *, count: str = "n", rank: str = "rank") -> DataFrame:
    """``TAB rank: key, count``."""
    line = F.concat(
        F.lit("\t"),
        F.col(rank).cast("string"),
        F.lit(": "),
        F.col(key),
        F.lit(", "),
        F.col(count).cast("string"),
    )
    return ranked.select(line.alias("value"))


def write_lines(lines: DataFrame, path: str, *, header: str | None = None, mode: str = "error") -> None:
    """One text file per partition, in partition order.

    ``header`` is the first line of each file; blank lines are not written then.
    """
    if header is None:
        lines.write.mode(mode).text(path)
        return
    # A header is the name of a CSV column; nothing in a line is a separator or a quote.
    options = {"header": True, "sep": "\u0001", "quote": "", "escapeQuotes": False, "emptyValue": ""}
    named = lines.select(F.col("value").alias(header))
    named.write.mode(mode).options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **options).csv(path)


def write_screened(screened: DataFrame, path: str, *, mode: str = "error") -> None:
    """Good rows and rejects, each in a folder of their own (``outcome=``), from one pass over the lines."""
    outcome = F.when(F.col("reason").isNull(), F.lit("good")).otherwise(F.lit("reject"))
    screened.withColumn("outcome", outcome).write.mode(mode).partitionBy("outcome").parquet(path)


def write_csv(
    table: DataFrame,
    path: str,
    *,
    sep: str = ",",
    header: bool = True,
    crlf: bool = False,
    order: Sequence[str | Column] = (),
    mode: str = "error",
) -> None:
    """CSV with an optional global order (the part files follow it)."""
    writer = (table.orderBy(*order) if order else table).write.mode(mode)
    options = {"header": header, "sep": sep}
    if crlf:
        options["lineSep"] = "\r\n"
    writer.options(**options).csv(path)


def land_balance(balance: DataFrame, path: str, *, day: str = "report_date", mode: str = "error") -> None:
    """Write a typed balance table as Parquet by month; ``sources.read_landed_balance`` reads it.

    The rebalance hint gathers the rows of a month into well-sized files and splits a
    month that is too large for one task.
    """
    dated = balance.withColumn("report_month", F.date_format(day, "yyyyMM"))
    dated.hint("rebalance", "report_month").write.mode(mode).partitionBy("report_month").parquet(path)


def store_day_bitmaps(state: DataFrame, path: str, *, mode: str = "append") -> None:
    """Add a state of ``operators.day_bitmaps`` to a folder, by month; ``sources.read_day_bitmaps`` merges what is there."""
    state.hint("rebalance", "month").write.mode(mode).partitionBy("month").parquet(path)


def land_bucketed(table: DataFrame, name: str, path: str, key: str, *, buckets: int) -> None:
    """Write a table in files bucketed and sorted by ``key``, and register it as ``name`` in the session's catalog.

    Tables bucketed alike join and aggregate by that key without a shuffle.  Each bucket is one task's work, so a
    table should be reduced to a row per key, or have no key with a large part of its rows.
    """
    laid_out = table.repartition(buckets, key)
    laid_out.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
