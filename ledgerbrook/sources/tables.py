"""Typed tables from lines, CSV files and the text that earlier jobs have written."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import parse_day, parse_number, positive, strip_control
from ..operators.day_bitmaps import in_day_range, merge_day_bitmaps
from .lines import (
    drop_lines_equal_to,
    field,
    keep_arity,
    quoted_records,
    read_lines,
    split_fields,
    without_own_header,
)


@dataclass(frozen=True)
class LineRules:
    """How a balance file is read.

    header      ``none``; ``named`` (drop rows whose purchase field holds its own column
                name); ``first_of_file`` (drop the first line of each file); ``repeated``
                (drop every line equal to the first line of its file)
    bad_amounts ``drop_row``, ``zero`` (each bad value on its own) or ``fail``
    short_rows  ``drop``, ``fail`` or ``null``
    as_needed   amounts after a positive one are not looked at
    """

    header: str = "named"
    bad_amounts: str = "drop_row"
    short_rows: str = "drop"
    keep_trailing_empty: bool = False
    amount_type: str = "double"
    as_needed: bool = False


# The three ways balance files are read.
DROP_BAD_ROWS = LineRules()
ZERO_BAD_VALUES = LineRules(
    header="repeated",
    bad_amounts="zero",
    short_rows="fail",
    keep_trailing_empty=True,
    amount_type="bigint",
)
FAIL_ON_BAD = LineRules(header="first_of_file", bad_amounts="fail", short_rows="fail")
# For questions that any positive amount answers.
FAIL_WHERE_NEEDED = LineRules(header="first_of_file", bad_amounts="fail", short_rows="null", as_needed=True)


def _amount(name: str, rules: LineRules):
    raw = field(schemas.BALANCE_POSITIONS[name])
    if rules.bad_amounts == "fail":
        message = F.concat(F.lit(f"{name} is not a number: "), F.coalesce(raw, F.lit("(missing)")))
        return F.coalesce(
            parse_number(raw, rules.amount_type), F.raise_error(message).cast(rules.amount_type)
        )
    parsed = parse_number(F.when(raw == "", F.lit("0")).otherwise(raw), rules.amount_type)
    if rules.bad_amounts == "zero":
        return F.coalesce(parsed, F.lit(0).cast(rules.amount_type))
    if rules.bad_amounts == "drop_row":
        return parsed
    raise ValueError(f"unknown rule {rules.bad_amounts!r}")


def balance_from_lines(
    lines: DataFrame,
    rules: LineRules = DROP_BAD_ROWS,
    *,
    amounts: Sequence[str] = ("total_purchase_amt", "total_redeem_amt"),
    header_line: str | None = None,
) -> DataFrame:
    """Lines to ``user_id``, ``report_date`` (both text) and the amounts asked for.

    Only the amounts asked for can make a row bad.  With no amounts, a row needs no
    more than its first two fields.
    """
    if rules.header == "repeated" and header_line is not None:
        lines = drop_lines_equal_to(lines, header_line)
    elif rules.header == "repeated":
        if "line_order" not in lines.columns:
            raise ValueError("the header rule 'repeated' needs the header line or line_order")
        lines = without_own_header(lines).select("value")
    needed = schemas.BALANCE_MIN_FIELDS if amounts else 2
    rows = keep_arity(
        split_fields(lines, keep_trailing_empty=rules.keep_trailing_empty),
        at_least=needed,
        otherwise=rules.short_rows,
    )
    if rules.header == "named" and amounts:
        name = "total_purchase_amt"
        rows = rows.where(field(schemas.BALANCE_POSITIONS[name]) != name)
    columns = [
        field(schemas.BALANCE_POSITIONS["user_id"]).alias("user_id"),
        field(schemas.BALANCE_POSITIONS["report_date"]).alias("report_date"),
    ]
    answered = F.lit(False)
    for name in amounts:
        amount = _amount(name, rules)
        if rules.as_needed:
            amount = F.when(~answered, amount)
            raw = parse_number(field(schemas.BALANCE_POSITIONS[name]), rules.amount_type)
            answered = answered | F.coalesce(positive(raw, T.DoubleType()), F.lit(False))
        columns.append(amount.alias(name))
    # Inlined, or a later condition on an amount would parse it a second time, in generated
    # code that outgrows what the JVM compiles (seven times slower for the failing rules).
    table = rows.select(F.inline(F.array(F.struct(*columns))))
    if rules.bad_amounts == "drop_row" and amounts:
        return table.dropna(subset=list(amounts))
    return table


def read_balance(
    spark: SparkSession,
    path: str | Sequence[str],
    rules: LineRules = DROP_BAD_ROWS,
    *,
    amounts: Sequence[str] = ("total_purchase_amt", "total_redeem_amt"),
    header_line: str | None = None,
) -> DataFrame:
    """A balance file under ``rules``.  Naming ``header_line`` saves looking for the first line of each file."""
    look = rules.header == "repeated" and header_line is None
    lines = read_lines(spark, path, skip_first_line=rules.header == "first_of_file", positions=look)
    return balance_from_lines(lines, rules, amounts=amounts, header_line=header_line)


def profile_from_lines(lines: DataFrame) -> DataFrame:
    """Lines with ``line_order`` to one row per user: the last line of a user wins."""
    rows = keep_arity(split_fields(lines), at_least=4, otherwise="fail")
    table = rows.select(
        strip_control(field(schemas.PROFILE_POSITIONS["user_id"])).alias("user_id"),
        strip_control(field(schemas.PROFILE_POSITIONS["constellation"])).alias("constellation"),
        "line_order",
    )
    return table.groupBy("user_id").agg(
        F.max_by("constellation", "line_order").alias("constellation")
    )


def read_profile(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """User → constellation from a profile file with a header line."""
    return profile_from_lines(read_lines(spark, path, skip_first_line=True, positions=True))


def news_from_lines(lines: DataFrame, *, quoting: str = "naive") -> DataFrame:
    """Lines of exactly four fields to ``headline`` and ``stock``; other lines are dropped.

    ``naive`` gives quotes no meaning, so a headline holding a comma drops its line.
    ``csv`` understands quotes and keeps it.  ``records`` also keeps headlines with line breaks
    inside quotes; it needs ``line_order``.
    """
    if quoting == "records":
        lines, quoting = quoted_records(lines), "csv"
    if quoting == "naive":
        rows = keep_arity(split_fields(lines), exact=schemas.NEWS_FIELDS)
        return rows.select(
            *[field(pos).alias(name) for name, pos in schemas.NEWS_POSITIONS.items()]
        )
    if quoting == "csv":
        corrupt = "wrong_arity"
        names = [*schemas.NEWS.fieldNames(), corrupt]
        record = F.from_csv(
            F.col("value"),
            ", ".join(f"{name} string" for name in names),
            {"columnNameOfCorruptRecord": corrupt, "escape": '"'},
        )
        # Exploded once for the same reason as in split_fields.
        rows = lines.select(F.explode(F.array(record)).alias("r")).where(f"r.{corrupt} IS NULL")
        return rows.select(
            *[F.coalesce(F.col(f"r.{name}"), F.lit("")).alias(name) for name in schemas.NEWS_POSITIONS]
        )
    raise ValueError(f"unknown quoting {quoting!r}")


def read_news(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    quoting: str = "naive",
    header: str = "count",
) -> DataFrame:
    """A news file.  ``header='count'`` treats header lines as data, ``'drop'`` skips them per file."""
    if quoting == "records":
        lines = read_lines(spark, path, positions=True)
        return news_from_lines(without_own_header(lines, repeated=False) if header == "drop" else lines, quoting=quoting)
    lines = read_lines(spark, path, skip_first_line=header == "drop")
    return news_from_lines(lines, quoting=quoting)


def stop_words_from_lines(lines: DataFrame) -> DataFrame:
    """One stop word per line, trimmed and lower-cased."""
    return lines.select(F.lower(strip_control(F.col("value"))).alias("word")).distinct()


def read_stop_words(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return stop_words_from_lines(read_lines(spark, path))


def daily_flow_from_lines(lines: DataFrame) -> DataFrame:
    """``date TAB inflow,outflow`` lines; lines without exactly two tab fields are dropped.

    Amounts of a line whose date is none, not even a lenient one, are not looked at: they are
    NULL.  A bad amount of a dated line fails.
    """
    rows = keep_arity(split_fields(lines, "\t"), exact=2).select(
        field(0).alias("report_date"), field(1).alias("value")
    )
    pairs = split_fields(rows, ",")

    def strict(position: int):
        raw = field(position)
        message = F.concat(F.lit("not a number: "), F.coalesce(raw, F.lit("(missing)")))
        amount = F.coalesce(parse_number(raw, "double"), F.raise_error(message).cast("double"))
        return F.when(parse_day(F.col("report_date"), lenient=True).isNotNull(), amount)

    return pairs.select(
        "report_date",
        strict(0).alias("total_purchase_amt"),
        strict(1).alias("total_redeem_amt"),
    )


def read_daily_flow(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Daily flow as written by the tab sink."""
    return daily_flow_from_lines(read_lines(spark, path))


def read_daily_flow_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Daily flow as written by the CSV sink (header, declared types); a bad value fails."""
    return read_named_csv(spark, path, schemas.DAILY_FLOW)


def active_days_from_lines(lines: DataFrame) -> DataFrame:
    """``user TAB days`` lines; other lines are dropped, a bad count fails the job."""
    rows = keep_arity(split_fields(lines, "\t"), exact=2)
    raw = strip_control(field(1))
    days = F.coalesce(
        raw.try_cast("bigint"),
        F.raise_error(F.concat(F.lit("not a day count: "), raw)).cast("bigint"),
    )
    return rows.select(strip_control(field(0)).alias("user_id"), days.alias("active_days"))


def read_active_days(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return active_days_from_lines(read_lines(spark, path))


def read_named_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: T.StructType,
    *,
    bad: str = "fail",
) -> DataFrame:
    """CSV whose header names the columns, in any order and letter case, cast to ``columns``.

    Of several files each must have the same header, or the job fails.  Types are declared, not inferred.  Only the
    columns asked for are parsed.  ``yyyyMMdd`` days become dates.  Empty fields are
    NULL; a value of the wrong type fails the job or becomes NULL (``bad='null'``).
    """
    paths = path if isinstance(path, str) else list(path)
    raw = spark.read.option("header", True).csv(paths)
    # Every file has to have this header: columns are found by their place in it.
    raw = spark.read.schema(raw.schema).options(header=True, enforceSchema=False).csv(paths)
    present = {name.lower(): name for name in raw.columns}
    missing = [f.name for f in columns if f.name.lower() not in present]
    if missing:
        raise ValueError(f"columns {missing} not in the header {raw.columns}")

    def typed(target: T.StructField):
        text = raw[present[target.name.lower()]]
        if isinstance(target.dataType, T.StringType):
            return text.alias(target.name)
        if isinstance(target.dataType, T.DateType):
            # Eight digits are yyyyMMdd; anything else has to be yyyy-MM-dd.
            value = F.coalesce(parse_day(text), text.try_cast("date"))
        else:
            value = text.try_cast(target.dataType)
        if bad == "fail":
            message = F.concat(F.lit(f"bad value for {target.name}: "), text)
            value = F.when(text.isNull(), F.lit(None)).otherwise(
                F.coalesce(value, F.raise_error(message).cast(target.dataType))
            )
        return value.alias(target.name)

    return raw.select(*[typed(target) for target in columns])


def read_landed_balance(
    spark: SparkSession, path: str, *, first: str | None = None, last: str | None = None
) -> DataFrame:
    """A balance table landed by month, cut to the days ``first`` .. ``last`` (``yyyyMMdd``).

    The bounds are put on the month folder too, so months outside are never listed or read.
    """
    schema = T.StructType([*schemas.BALANCE, T.StructField("report_month", T.StringType())])
    table = spark.read.schema(schema).parquet(path)
    for day, keep in ((first, "__ge__"), (last, "__le__")):
        if day is not None:
            date = F.lit(f"{day[:4]}-{day[4:6]}-{day[6:]}").cast("date")
            table = table.where(
                getattr(F.col("report_month"), keep)(day[:6])
                & getattr(F.col("report_date"), keep)(date)
            )
    return table.drop("report_month")


def register_views(**tables: DataFrame) -> None:
    """Make frames available to ``spark.sql`` under their keyword names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def read_day_bitmaps(spark: SparkSession, path: str, *, first: str | None = None, last: str | None = None) -> DataFrame:
    """The state that ``sinks.store_day_bitmaps`` has gathered, merged; of the days ``first`` .. ``last`` if given.

    Months outside are not read.
    """
    state = spark.read.option("basePath", path).parquet(path).withColumn("month", F.col("month").cast("string"))
    if first is not None or last is not None:
        state = in_day_range(state, first or "00000101", last or "99991231")
    return merge_day_bitmaps(state)
