"""Every registered query with the SQL that must give the same rows.

``QUERIES`` maps a name to a callable of (session, folder of tables); ``ORACLES`` maps
it to SQL over the same tables.  Days are ``yyyyMMdd`` text and amounts whole cents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from .. import operators as ops
from .. import sinks, sources
from ..session import new_shared_path
from . import increments, jobs
from . import standins as data
from .jobs import count_and_rank as rank_all_keys
from .jobs import top_words as rank_words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# A small stop list.
STOP_WORDS = ["a", "an", "and", "as", "by", "for", "in", "of", "on", "or", "that", "the", "to", "was"]

BALANCE_DAY = "19960917"
FLOW_MONTH = ("19960801", "19960831")


def query(sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def _stop_words(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, STOP_WORDS))).alias("word"))


def _deal(table: DataFrame, each: int) -> int:
    """Into how many files to deal rows made from ``table``: so many for each of its partitions, so that a file's size
    does not follow the table's."""
    return each * table.rdd.getNumPartitions()


def _stop_list_sql() -> str:
    return ", ".join(f"'{word}'" for word in STOP_WORDS)


# ---- fragments of SQL shared by several checks -------------------------------------

_PRICE = "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)"
_TOTAL = "CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)"

_DAILY = f"""
SELECT strftime(l_shipdate, '%Y%m%d') AS report_date,
       CAST(sum({_PRICE}) AS BIGINT) AS total_purchase_amt,
       CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN {_PRICE} END), 0) AS BIGINT)
         AS total_redeem_amt
FROM lineitem GROUP BY 1"""

_WEEKDAYS = """
SELECT dayname({day}) AS weekday,
       CAST(sum(total_purchase_amt) AS DOUBLE) / count(*) AS avg_in,
       CAST(sum(total_redeem_amt) AS DOUBLE) / count(*) AS avg_out
FROM {daily} WHERE {day} IS NOT NULL GROUP BY 1"""

_DAYS_BY_CUSTOMER = """
SELECT o_custkey AS user_id, count(*) AS active_days FROM orders
WHERE o_totalprice > 0 AND o_orderstatus IN ('O', 'F') GROUP BY 1"""

_DAYS_BY_SEGMENT = f"""
SELECT c_mktsegment AS constellation,
       CAST(sum(active_days) // count(*) AS BIGINT) AS avg_active_days
FROM ({_DAYS_BY_CUSTOMER}) d JOIN customer ON c_custkey = d.user_id GROUP BY 1"""

_LINES = """
SELECT doc_id, source, unnest(regexp_split_to_array(text, '\\r\\n|[\\r\\n]')) AS line
FROM documents"""

_WORDS = """
SELECT unnest(string_split(lower(regexp_replace(line, '[^a-zA-Z ]', '', 'g')), ' ')) AS word
FROM ({lines})"""

_TOP_WORDS = """
SELECT word, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, word) AS rank
FROM ({words}) WHERE word <> '' AND word NOT IN ({stop})
GROUP BY word ORDER BY n DESC, word LIMIT 100"""

_FLOWS = f"""
SELECT CAST(c_nationkey AS BIGINT) AS City, c_custkey AS user_id,
       CAST(sum(CASE WHEN o_orderstatus = 'O' THEN {_TOTAL} END)
            + sum(CASE WHEN o_orderstatus = 'F' THEN {_TOTAL} END) AS BIGINT) AS total_flow
FROM orders JOIN customer ON c_custkey = o_custkey
{{where}} GROUP BY 1, 2"""

_TOP_USERS = """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY City ORDER BY total_flow DESC NULLS LAST, user_id) AS rank
  FROM ({flows})) WHERE rank <= 3""".format(
    flows=_FLOWS.format(
        where="WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-08-01' AND DATE '1996-08-31'"
    )
)


_WEEKDAY_MEANS = f"""
WITH daily AS (SELECT strptime(report_date, '%Y%m%d') AS d, * FROM ({_DAILY})),
means AS (SELECT isodow(d) AS w, CAST(trunc(avg(total_purchase_amt)) AS BIGINT) AS purchase,
                 CAST(trunc(avg(total_redeem_amt)) AS BIGINT) AS redeem FROM daily GROUP BY 1),
ahead AS (SELECT (SELECT CAST(max(d) AS DATE) FROM daily) + CAST(i AS INT) AS d FROM range(1, 31) r(i))
SELECT strftime(d, '%Y%m%d') AS report_date, purchase, redeem FROM ahead JOIN means ON isodow(d) = w"""


# ---- fund flow ---------------------------------------------------------------------


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _whole(ops.daily_flow(data.lineitem_balance(spark, sf_dir)))
    return daily.withColumn("report_date", fn.day_key(F.col("report_date")))


def _whole(daily: DataFrame) -> DataFrame:
    """Sums as 64-bit numbers; one that does not fit fails."""
    amounts = ["total_purchase_amt", "total_redeem_amt"]
    return daily.withColumns({name: F.col(name).cast("bigint") for name in amounts})


@query(_DAILY)
def daily_flow(spark, sf_dir):
    return _daily(spark, sf_dir)


@query(_WEEKDAYS.format(day="strptime(report_date, '%Y%m%d')", daily=f"({_DAILY})"))
def weekday_flow(spark, sf_dir):
    return ops.weekday_flow(ops.daily_flow(data.lineitem_balance(spark, sf_dir)))


@query(_WEEKDAYS.format(day="strptime(report_date, '%Y%m%d')", daily=f"({_DAILY})"))
def weekday_flow_from_text(spark, sf_dir):
    """The same through the text that one job leaves for the next."""
    path = new_shared_path(spark, "daily-flow")
    sinks.write_lines(sinks.daily_flow_lines(_daily(spark, sf_dir)), path)
    return ops.weekday_flow(sources.read_daily_flow(spark, path))


@query(_WEEKDAYS.format(day="strptime(report_date, '%Y%m%d')", daily=f"({_DAILY})"))
def weekday_flow_bad_dates(spark, sf_dir):
    """Lines without a date between the others: their amounts are not looked at."""
    lines = sinks.daily_flow_lines(_daily(spark, sf_dir))
    bad = spark.range(3).select(F.lit("date\tin,out"))
    return ops.weekday_flow(sources.daily_flow_from_lines(lines.union(bad)), lenient=True)


def _end_of_month_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily flow in which every day of a month is called its 31st, which not all months have."""
    rows = data.lineitem_balance(spark, sf_dir).withColumn(
        "report_date", F.concat(F.date_format("report_date", "yyyyMM"), F.lit("31"))
    )
    return ops.daily_flow(rows)


_MONTH_ENDS = f"""(
SELECT substr(report_date, 1, 6) || '31' AS report_date,
       make_date(CAST(substr(report_date, 1, 4) AS INT), CAST(substr(report_date, 5, 2) AS INT), 1)
         + 30 AS rolled,
       sum(total_purchase_amt) AS total_purchase_amt, sum(total_redeem_amt) AS total_redeem_amt
FROM ({_DAILY}) GROUP BY 1, 2)"""


@query(_WEEKDAYS.format(day="try_strptime(report_date, '%Y%m%d')", daily=_MONTH_ENDS))
def weekday_flow_strict_days(spark, sf_dir):
    return ops.weekday_flow(_end_of_month_days(spark, sf_dir))


@query(_WEEKDAYS.format(day="rolled", daily=_MONTH_ENDS))
def weekday_flow_lenient_days(spark, sf_dir):
    return ops.weekday_flow(_end_of_month_days(spark, sf_dir), lenient=True)


@query(f"SELECT * FROM ({_DAILY}) WHERE report_date BETWEEN '19960201' AND '19960831'")
def time_slice(spark, sf_dir):
    daily = _whole(ops.daily_flow(ops.in_days(data.lineitem_balance(spark, sf_dir), "19960201", "19960831")))
    return daily.withColumn("report_date", fn.day_key(F.col("report_date")))


@query(_DAILY)
def daily_flow_csv_round_trip(spark, sf_dir):
    path = new_shared_path(spark, "daily-flow-csv")
    sinks.write_csv(_daily(spark, sf_dir), path, order=["report_date"])
    return sources.read_daily_flow_csv(spark, path)


@query(f"SELECT * FROM ({_DAILY}) WHERE report_date BETWEEN '19960815' AND '19961110'")
def daily_flow_landed_months(spark, sf_dir):
    """Land the balance by month, then read a range that prunes the other months."""
    path = new_shared_path(spark, "balance-by-month")
    sinks.land_balance(data.lineitem_balance(spark, sf_dir), path)
    rows = sources.read_landed_balance(spark, path, first="19960815", last="19961110")
    daily = _whole(ops.daily_flow(rows))
    return daily.withColumn("report_date", fn.day_key(F.col("report_date")))


@query(
    f"""SELECT i.report_date, total_purchase_amt, returned_amt FROM
    (SELECT report_date, total_purchase_amt FROM ({_DAILY})) i JOIN
    (SELECT strftime(l_shipdate, '%Y%m%d') AS report_date, CAST(sum({_PRICE}) AS BIGINT) AS returned_amt
     FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) o ON i.report_date = o.report_date"""
)
def merge_by_day(spark, sf_dir):
    """Two daily series, each made on its own, side by side."""
    rows = data.lineitem_balance(spark, sf_dir)
    bought = rows.groupBy("report_date").agg(F.sum("total_purchase_amt").alias("total_purchase_amt"))
    returned = (
        rows.where(F.col("total_redeem_amt").isNotNull())
        .groupBy("report_date")
        .agg(F.sum("total_redeem_amt").alias("returned_amt"))
    )
    merged = ops.merge_by_day(bought, returned)
    return merged.withColumn("report_date", fn.day_key(F.col("report_date")))


# ---- raw lines ---------------------------------------------------------------------

_GOOD_PURCHASE = f"CASE WHEN l_linenumber IN (1, 2, 4) THEN 0 ELSE {_PRICE} END"
_GOOD_REDEEM = f"CASE WHEN l_returnflag = 'R' THEN {_PRICE} ELSE 0 END"


@query(
    f"""SELECT strftime(l_shipdate, '%Y%m%d') AS report_date,
    CAST(sum({_GOOD_PURCHASE}) AS BIGINT) AS total_purchase_amt,
    CAST(sum({_GOOD_REDEEM}) AS BIGINT) AS total_redeem_amt
    FROM lineitem
    WHERE l_linenumber NOT IN (2, 4) AND l_returnflag IN ('R', 'A')
      AND NOT (l_returnflag = 'A' AND l_suppkey = 7) GROUP BY 1"""
)
def parse_lines_drop_bad_rows(spark, sf_dir):
    rows = sources.balance_from_lines(data.dirty_balance_lines(spark, sf_dir), sources.DROP_BAD_ROWS)
    return _whole(ops.daily_flow(rows))


@query(
    f"""SELECT strftime(l_shipdate, '%Y%m%d') AS report_date,
    CAST(sum({_GOOD_PURCHASE}) AS BIGINT) AS total_purchase_amt,
    CAST(sum({_GOOD_REDEEM}) AS BIGINT) AS total_redeem_amt
    FROM lineitem GROUP BY 1"""
)
def parse_lines_zero_bad_values(spark, sf_dir):
    header = "user_id,report_date"
    lines = data.dirty_balance_lines(spark, sf_dir)
    lines = lines.union(spark.range(2).select(F.lit(header)))
    rows = sources.balance_from_lines(lines, sources.ZERO_BAD_VALUES, header_line=header)
    return _whole(ops.daily_flow(rows))


@query(
    f"""SELECT CAST(l_partkey AS VARCHAR) AS user_id, count(*) AS active_days FROM lineitem
    WHERE l_returnflag IN ('A', 'R') AND {_PRICE} > 0 GROUP BY 1"""
)
def parse_lines_fail_on_bad(spark, sf_dir):
    rows = sources.balance_from_lines(
        data.clean_balance_lines(spark, sf_dir),
        sources.FAIL_ON_BAD,
        amounts=("direct_purchase_amt", "total_redeem_amt"),
    )
    return ops.active_days(rows)


_REASON = """CASE WHEN l_returnflag NOT IN ('R', 'A') THEN 'fields' WHEN l_linenumber = 4 THEN 'header'
    WHEN l_linenumber = 2 THEN 'total_purchase_amt'
    WHEN l_returnflag = 'A' AND l_suppkey = 7 THEN 'total_redeem_amt'
    WHEN l_partkey % 5 = 0 THEN 'report_date' END"""


def _screened(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the good rows and the rejects of bad lines, written in one pass."""
    path = new_shared_path(spark, "screened")
    sinks.write_screened(sources.screen_balance_lines(data.worse_balance_lines(spark, sf_dir), days="strict"), path)
    return path


@query(
    f"""SELECT reason, count(*) AS n, CAST(sum(length(CAST(l_partkey AS VARCHAR))) AS BIGINT) AS user_chars
    FROM (SELECT *, {_REASON} AS reason FROM lineitem) WHERE reason IS NOT NULL GROUP BY 1"""
)
def balance_rejects_by_reason(spark, sf_dir):
    """Rejected lines as they stood, by the first rule they break."""
    rejects = sources.read_rejects(spark, _screened(spark, sf_dir))
    user = F.length(F.substring_index("line", ",", 1))
    return rejects.groupBy("reason").agg(F.count("*").alias("n"), F.sum(user).alias("user_chars"))


@query(
    f"""SELECT strftime(l_shipdate, '%Y%m%d') AS report_date,
    CAST(sum({_GOOD_PURCHASE}) AS BIGINT) AS total_purchase_amt,
    CAST(sum({_GOOD_REDEEM}) AS BIGINT) AS total_redeem_amt
    FROM lineitem WHERE {_REASON} IS NULL GROUP BY 1"""
)
def daily_flow_of_screened_rows(spark, sf_dir):
    """The good rows of the same folder."""
    return _whole(ops.daily_flow(sources.read_screened(spark, _screened(spark, sf_dir))))


@query(
    f"""SELECT CASE WHEN line LIKE '%,%' THEN 'fields' ELSE 'good' END AS outcome, count(*) AS n
    FROM ({_LINES}) GROUP BY 1"""
)
def news_lines_by_outcome(spark, sf_dir):
    screened = sources.screen_news_lines(data.news_lines(spark, sf_dir))
    outcome = F.coalesce("reason", F.lit("good")).alias("outcome")
    return screened.groupBy(outcome).agg(F.count("*").alias("n"))


@query(ORACLES["parse_lines_zero_bad_values"])
def balance_files_with_own_headers(spark, sf_dir):
    """Files of two folders with different headers, which are repeated in between, found without a job of their own."""
    paths = []
    for part, header in enumerate(["user_id,report_date", "user,day,purchase,redeem"]):
        rows = data.dirty_balance_lines(spark, sf_dir).where(F.pmod(F.xxhash64("value"), F.lit(2)) == part)
        rows = rows.union(spark.range(3).select(F.lit(header))).repartition(_deal(rows, 3), "value")
        paths.append(new_shared_path(spark, "balance-lines"))
        sinks.write_lines(rows, paths[-1], header=header)
    return _whole(ops.daily_flow(sources.read_balance(spark, paths, sources.ZERO_BAD_VALUES)))


@query(
    ORACLES["parse_lines_zero_bad_values"].replace(
        "FROM lineitem", "FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)"
    )
)
def daily_flow_in_increments(spark, sf_dir):
    """Three runs on a growing set of files: the sums kept are those of reading each file once."""
    state = new_shared_path(spark, "flow-state")
    lines = data.dirty_balance_lines(spark, sf_dir)
    header = "user_id,report_date"
    paths = [new_shared_path(spark, "balance-lines") for _ in range(3)]
    item = F.substring_index(F.substring_index("value", ",", 5), ",", -1)
    # The third folder repeats lines of the others: they are in files of their own, so they count.
    parts = [lines.where(item == ""), lines.where(item != ""), lines.where(item == "")]
    for path, part in zip(paths, parts):
        sinks.write_lines(part.repartition(_deal(part, 2), "value"), path, header=header)
    for known in (paths[:1], paths[:2], paths, paths):
        increments.add_balance_files(spark, known, state)
    return _whole(increments.daily_flow_of(spark, state))


@query(ORACLES["parse_lines_fail_on_bad"])
def balance_files_first_lines_skipped(spark, sf_dir):
    """Files whose first lines are no balance lines, under a rule that fails on such lines."""
    path = new_shared_path(spark, "balance-lines")
    lines = data.clean_balance_lines(spark, sf_dir)
    sinks.write_lines(lines.repartition(_deal(lines, 3), "value"), path, header="user_id,report_date,and more")
    amounts = ("direct_purchase_amt", "total_redeem_amt")
    return ops.active_days(sources.read_balance(spark, path, sources.FAIL_ON_BAD, amounts=amounts))


# ---- activity ----------------------------------------------------------------------

_EVENT_DAYS = """
SELECT user_id, count(*) AS active_days FROM events
WHERE event_type IN ('purchase', 'signup') AND value > 0 GROUP BY 1"""


@query(_EVENT_DAYS)
def active_days(spark, sf_dir):
    return ops.active_days(data.events_balance(spark, sf_dir))


@query(
    f"""SELECT user_id, active_days,
    row_number() OVER (ORDER BY active_days DESC, user_id) AS rank FROM ({_EVENT_DAYS})"""
)
def active_days_ranked(spark, sf_dir):
    days = ops.active_days(data.events_balance(spark, sf_dir))
    return ops.global_rank(days, [F.desc("active_days"), F.asc("user_id")])


@query(_DAYS_BY_SEGMENT)
def active_days_by_group(spark, sf_dir):
    days = ops.active_days(data.orders_balance(spark, sf_dir))
    return ops.active_days_by_group(days, data.customer_profile(spark, sf_dir))


@query(_DAYS_BY_SEGMENT)
def active_days_by_group_from_text(spark, sf_dir):
    """The same through the text that one job leaves for the next, users being text."""
    path = new_shared_path(spark, "active-days")
    days = ops.active_days(data.orders_balance(spark, sf_dir))
    sinks.write_lines(sinks.key_value_lines(days, "user_id", ["active_days"]), path)
    profile = data.customer_profile(spark, sf_dir).withColumn("user_id", F.col("user_id").cast("string"))
    return ops.active_days_by_group(sources.read_active_days(spark, path), profile)


@query(_DAYS_BY_SEGMENT)
def active_days_by_group_from_profile_files(spark, sf_dir):
    """Through profile files with headers, in which every user stands twice: in file order, the last line counts."""
    path = new_shared_path(spark, "profile")
    rows = [
        data.profile_lines(spark, sf_dir, group).withColumn("turn", F.lit(turn))
        for turn, group in enumerate([F.lit("an old group"), F.col("c_mktsegment")])
    ]
    # Old lines come first in the first file and in a file before the last.
    rows = rows[0].unionByName(rows[1]).repartitionByRange(_deal(rows[0], 5), "turn", F.xxhash64("value"))
    sinks.write_lines(rows.sortWithinPartitions("turn").select("value"), path, header="user_id,Sex,City,constellation")
    days = ops.active_days(data.orders_balance(spark, sf_dir)).withColumn("user_id", F.col("user_id").cast("string"))
    return ops.active_days_by_group(days, sources.read_profile(spark, path))


@query(
    """SELECT count(*) AS active_users FROM (
    SELECT user_id FROM events WHERE strftime(ts, '%Y%m') = '202401'
    GROUP BY 1 HAVING count(DISTINCT CAST(ts AS DATE)) >= 5)"""
)
def active_user_count(spark, sf_dir):
    return ops.active_user_count(data.events_balance(spark, sf_dir), "202401")


@query(
    """SELECT count(*) AS active_users FROM (
    SELECT o_custkey FROM orders WHERE strftime(o_orderdate, '%Y%m') = '199608'
    GROUP BY 1 HAVING count(DISTINCT CAST(o_orderdate AS DATE)) >= 2)"""
)
def active_user_count_text_days(spark, sf_dir):
    """Days kept as text, the month being a prefix."""
    rows = data.orders_balance(spark, sf_dir).withColumn("report_date", fn.day_key(F.col("report_date")))
    return ops.active_user_count(rows, "199608", min_days=2)


@query("SELECT DISTINCT user_id, strftime(ts, '%Y%m%d') AS report_date FROM events")
def user_days(spark, sf_dir):
    """Each user and day once."""
    seen = data.events_balance(spark, sf_dir).select("user_id", "report_date").distinct()
    return seen.withColumn("report_date", fn.day_key(F.col("report_date")))


@query(
    """SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY 1
    HAVING count(DISTINCT CAST(ts AS DATE)) >= 5"""
)
def active_users(spark, sf_dir):
    """The users behind the count, over all days."""
    return ops.days_per_user(data.events_balance(spark, sf_dir)).where(F.col("days") >= 5)


@query(f"SELECT user_id || chr(9) || active_days AS value FROM ({_EVENT_DAYS})")
def active_days_text(spark, sf_dir):
    """The lines as they are written."""
    days = ops.active_days(data.events_balance(spark, sf_dir))
    return sinks.key_value_lines(days, "user_id", ["active_days"])


@query("SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY 1")
def days_per_user(spark, sf_dir):
    return ops.days_per_user(data.events_balance(spark, sf_dir))


@query(
    """SELECT o_custkey AS user_id, arg_max(o_orderpriority, o_orderdate::VARCHAR || lpad(o_orderkey::VARCHAR, 20, '0'))
    AS constellation FROM orders GROUP BY 1"""
)
def last_profile_wins(spark, sf_dir):
    """Many lookup rows per user, of which the last counts."""
    rows = data.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("constellation"),
        F.struct("o_orderdate", "o_orderkey").alias("line_order"),
    )
    return ops.last_per_key(rows, "user_id", "constellation", "line_order")


def _stored_days(spark: SparkSession, sf_dir: str) -> str:
    """The days of the orders, stored in two parts that share many days."""
    path = new_shared_path(spark, "day-bitmaps")
    orders = data.orders_balance(spark, sf_dir)
    for part in (F.col("tBalance") % 2 == 0, F.col("tBalance") % 3 != 0, F.col("tBalance") % 6 == 3):
        sinks.store_day_bitmaps(ops.day_bitmaps(orders.where(part)), path)
    return path


@query(
    """SELECT period, count(*) AS active_users FROM (
    SELECT o_custkey, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS period FROM orders
    GROUP BY 1, 2 HAVING count(DISTINCT CAST(o_orderdate AS DATE)) >= 2) GROUP BY 1"""
)
def active_users_by_quarter(spark, sf_dir):
    """From stored bitmaps of days."""
    return ops.active_users_by_period(sources.read_day_bitmaps(spark, _stored_days(spark, sf_dir)), min_days=2)


@query(
    """SELECT o_custkey AS user_id, strftime(o_orderdate, '%Y') AS period, count(DISTINCT CAST(o_orderdate AS DATE)) AS days
    FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1994-02-11' AND DATE '1997-11-20' GROUP BY 1, 2"""
)
def days_per_year_in_range(spark, sf_dir):
    """From the same stored state, cut to a range that begins and ends inside months."""
    path = _stored_days(spark, sf_dir)
    state = sources.read_day_bitmaps(spark, path, first="19940211", last="19971120")
    return ops.days_per_period(state, "year")


# ---- cities ------------------------------------------------------------------------


@query(
    f"""SELECT CAST(c_nationkey AS BIGINT) AS City, CAST(sum({_TOTAL}) AS DOUBLE) / count(*) AS average_balance
    FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE CAST(o_orderdate AS DATE) = DATE '1996-09-17' GROUP BY 1"""
)
def city_average_balance(spark, sf_dir):
    return ops.city_average_balance(
        data.orders_balance(spark, sf_dir), data.customer_profile(spark, sf_dir), day=BALANCE_DAY
    )


@query(
    f"""SELECT CAST(c_nationkey AS BIGINT) AS City, CAST(sum({_TOTAL}) AS DOUBLE) / count(*) AS average_balance
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1"""
)
def city_average_balance_all_days(spark, sf_dir):
    return ops.city_average_balance(
        data.orders_balance(spark, sf_dir), data.customer_profile(spark, sf_dir)
    )


@query(
    f"""SELECT o_custkey AS user_id, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN {_TOTAL} END)
    + sum(CASE WHEN o_orderstatus = 'F' THEN {_TOTAL} END) AS BIGINT) AS total_flow
    FROM orders WHERE strftime(o_orderdate, '%Y%m') = '199608' GROUP BY 1"""
)
def user_flow_unknown_sides(spark, sf_dir):
    """Sum of two sums in one month: unknown (NULL) for users with one side only."""
    rows = ops.in_month(data.orders_balance(spark, sf_dir), "199608")
    both = F.sum("total_purchase_amt") + F.sum("total_redeem_amt")
    return rows.groupBy("user_id").agg(both.alias("total_flow"))


@query(_TOP_USERS)
def top_users_by_city(spark, sf_dir):
    return ops.top_users_by_city(
        data.orders_balance(spark, sf_dir), data.customer_profile(spark, sf_dir), *FLOW_MONTH
    )


@query(_TOP_USERS)
def top_users_by_city_sql(spark, sf_dir):
    sources.register_views(
        user_balance_table=data.orders_balance(spark, sf_dir),
        user_profile_table=data.customer_profile(spark, sf_dir),
    )
    return ops.top_users_by_city_sql(spark, *FLOW_MONTH)


@query(_TOP_USERS.replace("<= 3", "<= 1500"))
def top_users_by_city_1500(spark, sf_dir):
    return ops.top_users_by_city(
        data.orders_balance(spark, sf_dir), data.customer_profile(spark, sf_dir), *FLOW_MONTH, n=1500
    )


@query(
    f"""SELECT *, row_number() OVER (PARTITION BY City ORDER BY total_flow DESC NULLS LAST, user_id) AS rank
    FROM ({_FLOWS.format(where='')})"""
)
def rank_users_in_city(spark, sf_dir):
    """All users of every city ranked, by the method that has no task per city."""
    flows = (
        data.orders_balance(spark, sf_dir)
        .groupBy("user_id")
        .agg((F.sum("total_purchase_amt") + F.sum("total_redeem_amt")).alias("total_flow"))
        .join(data.customer_profile(spark, sf_dir).select("user_id", "City"), "user_id")
    )
    return ops.rank_in_groups(flows, "City", [F.desc("total_flow"), F.asc("user_id")])


def _bucketed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders and customers as tables bucketed by user."""
    tables = []
    for rows in (data.orders_balance(spark, sf_dir), data.customer_profile(spark, sf_dir)):
        path = new_shared_path(spark, "bucketed")
        name = path.rpartition("/")[2].replace("-", "_")
        sinks.land_bucketed(rows, name, path, "user_id", buckets=8)
        tables.append(spark.table(name))
    return tables[0], tables[1]


@query(_TOP_USERS)
def top_users_by_city_bucketed(spark, sf_dir):
    """Sums per user and the join with the profile find both tables bucketed by user: neither shuffles."""
    return ops.top_users_by_city(*_bucketed(spark, sf_dir), *FLOW_MONTH)


@query(ORACLES["city_average_balance_all_days"])
def city_average_balance_bucketed(spark, sf_dir):
    return ops.city_average_balance(*_bucketed(spark, sf_dir))


# ---- words and keys ----------------------------------------------------------------

_SOURCES = f"""
SELECT source AS stock, count(*) AS n,
       row_number() OVER (ORDER BY count(*) DESC, source) AS rank
FROM ({_LINES}) {{where}} GROUP BY 1"""


@query(_SOURCES.format(where=""))
def count_and_rank(spark, sf_dir):
    return rank_all_keys(data.documents_news(spark, sf_dir))


@query(_SOURCES.format(where="WHERE line NOT LIKE '%,%'"))
def count_and_rank_news_lines(spark, sf_dir):
    """From raw lines: quotes mean nothing, so lines with a comma in the headline are dropped."""
    return rank_all_keys(sources.news_from_lines(data.news_lines(spark, sf_dir)))


@query(_SOURCES.format(where=""))
def count_and_rank_quoted_lines(spark, sf_dir):
    """From quoted lines, read with quotes understood: no line is dropped."""
    lines = data.news_lines(spark, sf_dir, quoted=True)
    return rank_all_keys(sources.news_from_lines(lines, quoting="csv"))


_RECORDS = """
SELECT source AS stock, array_to_string(list_filter(regexp_split_to_array(text, '\\r\\n|[\\r\\n]'),
       lambda line: line <> '')[1:3], chr(10)) AS headline FROM documents"""


@query(
    f"""SELECT stock, count(*) AS n, CAST(sum(length(headline)) AS BIGINT) AS chars,
    CAST(sum(length(headline) - length(replace(headline, chr(10), ''))) AS BIGINT) AS breaks FROM ({_RECORDS}) GROUP BY 1"""
)
def news_records_over_lines(spark, sf_dir):
    """From files in which a quoted headline goes over several lines."""
    path = new_shared_path(spark, "news-records")
    records = data.broken_news_records(spark, sf_dir)
    sinks.write_lines(records.repartition(_deal(records, 3), "value"), path)
    news = sources.read_news(spark, path, quoting="records")
    breaks = F.length("headline") - F.length(F.replace("headline", F.lit("\n"), F.lit("")))
    return news.groupBy("stock").agg(
        F.count("*").alias("n"), F.sum(F.length("headline")).alias("chars"), F.sum(breaks).alias("breaks")
    )


@query(
    f"""SELECT chr(9) || rank || ': ' || stock || ', ' || n AS value
    FROM ({_SOURCES.format(where='')})"""
)
def count_and_rank_text(spark, sf_dir):
    """The ranked lines as they are written."""
    return sinks.ranked_lines(rank_all_keys(data.documents_news(spark, sf_dir)), "stock")


@query(_TOP_WORDS.format(words=_WORDS.format(lines=_LINES), stop=_stop_list_sql()))
def top_words(spark, sf_dir):
    return rank_words(data.documents_news(spark, sf_dir), _stop_words(spark))


@query(_TOP_WORDS.format(words=_WORDS.format(lines=_LINES), stop=_stop_list_sql()).replace("100", "5000"))
def top_words_5000(spark, sf_dir):
    return rank_words(data.documents_news(spark, sf_dir), _stop_words(spark), n=5000)


@query(
    _TOP_WORDS.format(
        words=_WORDS.format(lines=f"SELECT * FROM ({_LINES}) WHERE line NOT LIKE '%,%'"),
        stop=_stop_list_sql(),
    )
)
def top_words_news_lines(spark, sf_dir):
    news = sources.news_from_lines(data.news_lines(spark, sf_dir))
    return rank_words(news, _stop_words(spark))


@query(
    _TOP_WORDS.format(
        words=_WORDS.format(lines=_LINES),
        stop="SELECT lower(trim(w)) FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark)"
        " WHERE lower(trim(w)) IS NOT NULL",
    )
)
def top_words_long_stop_list(spark, sf_dir):
    """The stop list is a table too: the words of the benchmark texts, one per line."""
    lines = data.table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("value"))
    return rank_words(data.documents_news(spark, sf_dir), sources.stop_words_from_lines(lines))


@query(
    f"SELECT word, count(*) AS n FROM ({_WORDS.format(lines=_LINES)}) WHERE word <> '' GROUP BY 1"
)
def word_counts(spark, sf_dir):
    return ops.count_tokens(data.documents_news(spark, sf_dir), "headline")


@query(
    f"""SELECT word, count(*) AS n FROM ({_WORDS.format(lines=_LINES)})
    WHERE word <> '' AND word NOT IN ({_stop_list_sql()}) GROUP BY 1"""
)
def word_counts_without_stop_words(spark, sf_dir):
    counts = ops.count_tokens(data.documents_news(spark, sf_dir), "headline")
    return ops.without(counts, _stop_words(spark), "word")


@query(
    f"""SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS rank FROM (
    SELECT word, count(*) AS n FROM ({_WORDS.format(lines=_LINES)}) WHERE word <> '' GROUP BY 1)"""
)
def word_ranks(spark, sf_dir):
    """A rank for every word there is."""
    counts = ops.count_tokens(data.documents_news(spark, sf_dir), "headline")
    return ops.global_rank(counts, [F.desc("n"), F.asc("word")])


_WORD_RANKS = ORACLES["word_ranks"]


@query(_WORD_RANKS)
def word_ranks_by_histogram(spark, sf_dir):
    """The same from the histogram of counts: a word seen once, like most, is ranked among these by its letters."""
    counts = ops.count_tokens(data.documents_news(spark, sf_dir), "headline")
    return ops.rank_by_count(counts, "word")


@query(ORACLES["count_and_rank"])
def count_and_rank_by_histogram(spark, sf_dir):
    return rank_all_keys(data.documents_news(spark, sf_dir), method="histogram")


@query(ORACLES["rank_users_in_city"])
def rank_users_in_city_by_pieces(spark, sf_dir):
    """All users of every city ranked without a checkpoint, large cities in pieces."""
    flows = (
        data.orders_balance(spark, sf_dir)
        .groupBy("user_id")
        .agg((F.sum("total_purchase_amt") + F.sum("total_redeem_amt")).alias("total_flow"))
        .join(data.customer_profile(spark, sf_dir).select("user_id", "City"), "user_id")
    )
    return ops.rank_by_value_in_groups(flows, "City", "total_flow", "user_id")


_HEADED = f"""
SELECT stock, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, stock) AS rank
FROM (SELECT source AS stock FROM ({_LINES}) WHERE line NOT LIKE '%,%'
      UNION ALL SELECT 'stock' FROM range(3)) GROUP BY 1"""


@query(_HEADED)
def count_and_rank_headers_as_data(spark, sf_dir):
    """Three folders, each with one header line, which counts as data; every partition of the lines has its own files."""
    paths = [new_shared_path(spark, "news") for _ in range(3)]
    lines = data.news_lines(spark, sf_dir)
    header = spark.range(0, 1, 1, 1).select(F.lit("id,headline,date,stock").alias("value"))
    for part, path in enumerate(paths):
        sinks.write_lines(header.union(lines.where(F.pmod(F.xxhash64("value"), F.lit(3)) == part)), path)
    return rank_all_keys(sources.read_news(spark, paths))


# ---- files that jobs leave, read back line by line ----------------------------------


def _written(spark: SparkSession, path: str, *, keep_returns: bool = False) -> DataFrame:
    """The lines of a job's output with their ``place``, 1 being the first line of the first part file.

    ``keep_returns`` breaks lines at line feeds alone.
    """
    if keep_returns:
        lines = spark.read.option("lineSep", "\n").text(path)
        order = [F.col("_metadata.file_path"), F.monotonically_increasing_id()]
        lines = lines.select("value", F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("line_order"))
    else:
        lines = sources.read_lines(spark, path, positions=True)
    ranked = ops.global_rank(lines, [F.col("line_order").asc()], rank="place")
    return ranked.select(F.col("place").cast("bigint").alias("place"), "value")


def _balance_file(spark: SparkSession, rows: DataFrame) -> str:
    path = new_shared_path(spark, "balance-csv")
    sinks.write_csv(rows.withColumn("report_date", fn.day_key(F.col("report_date"))), path)
    return path


def _profile_file(spark: SparkSession, sf_dir: str) -> str:
    path = new_shared_path(spark, "profile-csv")
    sinks.write_csv(data.customer_profile(spark, sf_dir).select("user_id", "City", "constellation"), path)
    return path


@query(
    f"""SELECT row_number() OVER (ORDER BY avg_in DESC) AS place, weekday, avg_in, avg_out
    FROM ({_WEEKDAYS.format(day="strptime(report_date, '%Y%m%d')", daily=f"({_DAILY})")})"""
)
def weekday_flow_file(spark, sf_dir):
    """The job's lines, largest inflow first."""
    daily, out = new_shared_path(spark, "daily-flow"), new_shared_path(spark, "weekday-flow")
    sinks.write_lines(sinks.daily_flow_lines(_daily(spark, sf_dir)), daily)
    jobs.run_weekday_flow(spark, daily, out)
    pair = F.split(F.substring_index("value", "\t", -1), ",")
    return _written(spark, out).select(
        "place",
        F.substring_index("value", "\t", 1).alias("weekday"),
        pair[0].cast("double").alias("avg_in"),
        pair[1].cast("double").alias("avg_out"),
    )


@query(
    f"""SELECT row_number() OVER (ORDER BY constellation) AS place,
    constellation || chr(9) || avg_active_days AS value FROM ({_DAYS_BY_SEGMENT})"""
)
def active_days_by_group_file(spark, sf_dir):
    """The job's lines, by group."""
    days, profile, out = (new_shared_path(spark, name) for name in ("active-days", "profile", "groups"))
    counted = ops.active_days(data.orders_balance(spark, sf_dir))
    sinks.write_lines(sinks.key_value_lines(counted, "user_id", ["active_days"]), days)
    lines = data.profile_lines(spark, sf_dir, F.col("c_mktsegment"))
    sinks.write_lines(lines, profile, header="user_id,Sex,City,constellation")
    jobs.run_active_days_by_group(spark, days, profile, out)
    return _written(spark, out)


@query(
    f"""SELECT place, City, average_balance, crlf FROM (
    SELECT row_number() OVER (ORDER BY average_balance DESC, City) + 1 AS place, CAST(City AS VARCHAR) AS City,
           average_balance, TRUE AS crlf FROM ({ORACLES['city_average_balance_all_days']})
    UNION ALL SELECT 1, 'City', NULL, TRUE)""".replace("JOIN customer ON c_custkey = o_custkey", """JOIN customer
      ON c_custkey = o_custkey WHERE CAST(o_orderdate AS DATE) = DATE '1996-09-10'""")
)
def city_average_file(spark, sf_dir):
    """The job's CSV with CRLF line ends, largest average first."""
    out = new_shared_path(spark, "city-average")
    balance = _balance_file(spark, data.orders_balance(spark, sf_dir))
    jobs.run_city_average_balance(spark, balance, _profile_file(spark, sf_dir), out, day="19960910")
    lines = _written(spark, out, keep_returns=True)
    cells = F.split(F.replace("value", F.lit("\r"), F.lit("")), ",")
    lines = lines.select(
        "place", cells[0].alias("City"), cells[1].try_cast("double").alias("average_balance"),
        F.endswith("value", F.lit("\r")).alias("crlf"),
    )
    # Every part file has the header; the first line stands for all.
    return lines.where("place = 1 or City <> 'City'")


@query(
    f"""SELECT row_number() OVER (ORDER BY City, rank) + 1 AS place,
    City || chr(9) || user_id || chr(9) || coalesce(CAST(total_flow AS VARCHAR), '') AS value FROM ({_TOP_USERS})
    UNION ALL SELECT 1, 'City' || chr(9) || 'user_id' || chr(9) || 'total_flow'"""
)
def top_users_file(spark, sf_dir):
    """The job's tab-separated lines, by city and rank."""
    out = new_shared_path(spark, "top-users")
    balance = _balance_file(spark, data.orders_balance(spark, sf_dir))
    first, last = FLOW_MONTH
    jobs.run_top_users_by_city(spark, balance, _profile_file(spark, sf_dir), out, first=first, last=last)
    lines = _written(spark, out).where("place = 1 or value not like 'City%'")
    return lines.select("place", F.replace("value", F.lit('""'), F.lit("")).alias("value"))


@query(
    f"""SELECT row_number() OVER (ORDER BY report_date) + 1 AS place, report_date || ',' || purchase || ',' || redeem AS value
    FROM ({_WEEKDAY_MEANS}) UNION ALL SELECT 1, 'report_date,purchase,redeem'"""
)
def forecast_file(spark, sf_dir):
    """The forecast as it is written."""
    out = new_shared_path(spark, "forecast")
    daily = ops.daily_flow(data.lineitem_balance(spark, sf_dir))
    forecast = ops.forecast_flow(daily, features=["day_of_week"], num_trees=1, bootstrap=False, feature_subset="all")
    sinks.write_csv(forecast, out, order=["report_date"])
    return _written(spark, out).where("place = 1 or value not like 'report_date%'")


# ---- calendar and forecast ---------------------------------------------------------


@query(
    """SELECT strftime(d, '%Y%m%d') AS report_date, CAST(dayofyear(d) AS INT) AS day_of_year,
    CAST(month(d) AS INT) AS month, CAST(isodow(d) AS INT) AS day_of_week
    FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)"""
)
def calendar_features(spark, sf_dir):
    days = data.lineitem_balance(spark, sf_dir).select("report_date").distinct()
    return days.withColumns(fn.day_features(F.col("report_date"))).withColumn(
        "report_date", fn.day_key(F.col("report_date"))
    )


@query(
    """SELECT strftime(d, '%Y%m%d') AS report_date, CAST(dayofyear(d) AS INT) AS day_of_year,
    CAST(month(d) AS INT) AS month, CAST(isodow(d) AS INT) AS day_of_week
    FROM (SELECT (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem) + CAST(i AS INT) AS d
          FROM range(1, 31) r(i))"""
)
def future_days(spark, sf_dir):
    daily = ops.daily_flow(data.lineitem_balance(spark, sf_dir))
    ahead = ops.future_features(daily, start=None, horizon=30, day="report_date").drop("features")
    return ahead.withColumn("report_date", fn.day_key(F.col("report_date")))


@query(_WEEKDAY_MEANS)
def forecast_by_weekday(spark, sf_dir):
    """One tree on the weekday alone, grown on all days: it predicts the weekday's mean."""
    daily = ops.daily_flow(data.lineitem_balance(spark, sf_dir))
    return ops.forecast_flow(daily, features=["day_of_week"], num_trees=1, bootstrap=False, feature_subset="all")


@query(_WEEKDAY_MEANS)
def forecast_by_weekday_hashed(spark, sf_dir):
    """The same tree, grown by aggregations."""
    daily = ops.daily_flow(data.lineitem_balance(spark, sf_dir))
    options = {"num_trees": 1, "max_depth": 6, "bootstrap": False, "feature_subset": "all", "forest": "hashed"}
    return ops.forecast_flow(daily, features=["day_of_week"], **options)


@query()
def forecast_flow_hashed(spark, sf_dir):
    """No SQL: a hundred trees whose samples are drawn by hashes.  Tests check it for three layouts."""
    return ops.forecast_flow(ops.daily_flow(data.lineitem_balance(spark, sf_dir)), forest="hashed")


@query()
def forecast_flow(spark, sf_dir):
    """No SQL: a random forest.  Tests check it against the known shape of the result."""
    return ops.forecast_flow(ops.daily_flow(data.lineitem_balance(spark, sf_dir)))
