import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerbrook import operators as ops
from ledgerbrook.operators import ranking
from ledgerbrook.plans import count_and_rank, top_words


def rows(frame):
    return [tuple(r) for r in frame.collect()]


@pytest.fixture()
def spread(spark):
    """Keep every shuffle partition, so that small tests still cross partitions."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)


# ---- ranking -----------------------------------------------------------------------


def test_global_rank_over_many_partitions(spark, spread):
    rng = random.Random(7)
    values = [(f"k{i:04d}", rng.choice([1, 1, 1, 2, 5, rng.randrange(100)])) for i in range(3000)]
    rng.shuffle(values)
    frame = spark.createDataFrame(values, "k string, n bigint").repartition(5)
    ranked = ops.global_rank(frame, [F.desc("n"), F.asc("k")])
    want = [(k, n, i + 1) for i, (k, n) in enumerate(sorted(values, key=lambda v: (-v[1], v[0])))]
    got = ranked.withColumn("p", F.spark_partition_id()).collect()
    # Collected as they lie: the partitions follow the ranks.
    assert [tuple(r)[:3] for r in got] == want
    assert len({r.p for r in got}) > 1


def test_global_rank_of_nothing_and_of_one(spark):
    frame = spark.createDataFrame([("a", 1)], "k string, n bigint")
    order = [F.desc("n"), F.asc("k")]
    assert rows(ops.global_rank(frame, order)) == [("a", 1, 1)]
    assert rows(ops.global_rank(frame.where("n > 1"), order)) == []


def test_top_k(spark):
    frame = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 7).alias("n"))
    order = [F.desc("n"), F.asc("k")]
    short = rows(ops.top_k(frame, order, 50).orderBy("rank"))
    everything = rows(ops.top_k(frame, order, 5000).orderBy("rank"))
    assert everything[:50] == short and len(everything) == 500
    assert [r[2] for r in short] == list(range(1, 51))
    assert short[0] == (6, 6, 1)


def _expected_ranks(data):
    groups = defaultdict(list)
    for g, k, v in data:
        groups[g].append((-v if v is not None else float("inf"), k, v))
    return {
        (g, k): i + 1 for g, members in groups.items() for i, (_, k, v) in enumerate(sorted(members))
    }


def test_top_n_per_group_beyond_the_threshold_and_with_a_hot_group(spark, spread):
    rng = random.Random(3)
    data = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), k, rng.randrange(50)) for k in range(4000)]
    data += [("b", 4000 + i, None) for i in range(3)]
    want = _expected_ranks(data)
    frame = spark.createDataFrame(data, "g string, k bigint, v bigint").repartition(6)
    order = [F.desc("v"), F.asc("k")]
    for n in (3, 1500):
        got = {(r.g, r.k): r.rank for r in ops.top_n_per_group(frame, "g", order, n).collect()}
        assert got == {key: rank for key, rank in want.items() if rank <= n}
    everything = {(r.g, r.k): r.rank for r in ops.rank_in_groups(frame, "g", order).collect()}
    assert everything == want


# ---- counting ----------------------------------------------------------------------


def test_count_and_rank_trims_drops_empty_and_breaks_ties(spark):
    news = spark.createDataFrame(
        [(s,) for s in [" B", "B\t", "A", "A ", "C", "", "  ", None, "C", "D"]], "stock string"
    )
    assert rows(count_and_rank(news).orderBy("rank")) == [("A", 2, 1), ("B", 2, 2), ("C", 2, 3), ("D", 1, 4)]


def test_top_words_against_a_plain_count(spark):
    rng = random.Random(1)
    vocabulary = ["stock's", "Up", "down", "the", "q3", "don't", "and", "up-beat"]
    heads = [" ".join(rng.choices(vocabulary, k=rng.randrange(8))) for _ in range(300)]
    news = spark.createDataFrame([(h,) for h in heads], "headline string")
    stop = spark.createDataFrame([("the",), ("don't",), ("and",)], "word string")
    counts = Counter()
    for head in heads:
        text = "".join(c for c in head if c.isascii() and (c.isalpha() or c == " ")).lower()
        counts.update(w for w in text.split() if w not in {"the", "don't", "and"})
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:4]
    got = rows(top_words(news, stop, n=4).orderBy("rank"))
    assert got == [(w, n, i + 1) for i, (w, n) in enumerate(want)]
    # A stop word with an apostrophe matches no word, for words have none.
    assert "dont" in counts


def test_last_per_key(spark):
    frame = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", 1)], "u long, c string, o long")
    assert sorted(rows(ops.last_per_key(frame, "u", "c", "o"))) == [(1, "b"), (2, "d")]


# ---- flow --------------------------------------------------------------------------


@pytest.fixture()
def balance(spark):
    data = [
        (1, date(2014, 8, 1), 100, 10, 5, 0),
        (1, date(2014, 8, 1), 100, 10, 0, 0),
        (1, date(2014, 8, 2), None, None, None, 7),
        (2, date(2014, 8, 1), 300, 1, 1, None),
        (2, date(2014, 9, 1), 500, 50, 50, 50),
        (3, date(2014, 8, 3), 10, 4, 0, 6),
    ]
    return spark.createDataFrame(
        data,
        "user_id long, report_date date, tBalance long, total_purchase_amt long,"
        " direct_purchase_amt long, total_redeem_amt long",
    )


@pytest.fixture()
def profile(spark):
    return spark.createDataFrame(
        [(1, 10, "x"), (2, 10, "x"), (3, 20, "y"), (4, 20, "y")], "user_id long, City long, constellation string"
    )


def test_daily_flow_counts_missing_as_zero_and_keeps_totals(balance):
    daily = ops.daily_flow(balance)
    assert sorted(rows(daily)) == [
        (date(2014, 8, 1), 21, 0),
        (date(2014, 8, 2), 0, 7),
        (date(2014, 8, 3), 4, 6),
        (date(2014, 9, 1), 50, 50),
    ]
    assert rows(daily.agg(F.sum("total_purchase_amt"), F.sum("total_redeem_amt"))) == rows(
        balance.agg(F.sum("total_purchase_amt"), F.sum("total_redeem_amt"))
    )


def test_weekday_flow_orders_by_inflow_then_sunday_first(spark):
    days = [date(2014, 8, 3) + timedelta(days=i) for i in range(13)]
    inflow = {0: 5, 6: 5, 1: 9}
    data = [(d.strftime("%Y%m%d"), float(inflow.get(i % 7, 1)), float(i)) for i, d in enumerate(days)]
    data += [("20140231", 700.0, 7.0), ("nonsense", 1e9, 1.0)]
    daily = spark.createDataFrame(data, "report_date string, total_purchase_amt double, total_redeem_amt double")
    got = rows(ops.weekday_flow(daily))
    assert [r[0] for r in got] == ["Monday", "Sunday", "Saturday", "Tuesday", "Wednesday", "Thursday", "Friday"]
    assert got[0] == ("Monday", 9.0, 4.5)
    # Saturday is there once, the other days twice.
    assert got[2] == ("Saturday", 5.0, 6.0)
    lenient = dict((r[0], r[1]) for r in rows(ops.weekday_flow(daily, lenient=True)))
    assert lenient["Monday"] == (9 + 9 + 700) / 3
    few = rows(ops.weekday_flow(daily.where("report_date = '20140803'")))
    assert few == [("Sunday", 5.0, 0.0)]


def test_weekday_filter_does_not_parse_every_balance_row(spark, balance):
    text_days = balance.withColumn("report_date", F.date_format("report_date", "yyyyMMdd"))
    plan = ops.weekday_flow(ops.daily_flow(text_days))._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Aggregate") :].split("\n", 1)[1]
    assert "try_cast" not in below and "Filter" not in below


@pytest.mark.parametrize("kind", ["date", "string", "timestamp_ntz"])
def test_day_and_month_ranges(balance, kind):
    day = F.date_format("report_date", "yyyyMMdd") if kind == "string" else F.col("report_date").cast(kind)
    table = balance.withColumn("report_date", day)
    assert ops.in_days(table, "20140801", "20140802").count() == 4
    assert ops.in_month(table, "201408").count() == 5
    assert ops.in_month(table, "201409").count() == 1


def test_ranges_reach_the_parquet_scan(spark, balance, tmp_path):
    path = str(tmp_path / "b")
    balance.write.parquet(path)
    stored = spark.read.parquet(path)
    for frame in (ops.in_days(stored, "20140801", "20140802"), ops.in_month(stored, "201408")):
        plan = ops.daily_flow(frame)._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(report_date,2014-08-01)" in plan
        assert "ReadSchema: struct<report_date:date,total_purchase_amt:bigint,total_redeem_amt:bigint>" in plan


def test_merge_by_day(spark):
    a = spark.createDataFrame([("1", 1), ("2", 2)], "report_date string, a long")
    b = spark.createDataFrame([("2", 3), ("3", 4)], "report_date string, b long")
    assert rows(ops.merge_by_day(a, b)) == [("2", 2, 3)]


# ---- activity ----------------------------------------------------------------------


def test_active_days_counts_rows_not_dates(balance):
    assert sorted(rows(ops.active_days(balance))) == [(1, 2), (2, 2), (3, 1)]


def test_active_days_ignores_nan(spark):
    frame = spark.createDataFrame(
        [(1, float("nan"), 0.0), (2, float("nan"), 1.0), (3, -1.0, 0.0)],
        "user_id long, direct_purchase_amt double, total_redeem_amt double",
    )
    assert rows(ops.active_days(frame)) == [(2, 1)]


def test_group_average_is_truncated_and_needs_a_profile(spark, profile):
    days = spark.createDataFrame([(1, 2), (2, 5), (3, 4), (9, 100)], "user_id long, active_days long")
    assert sorted(rows(ops.active_days_by_group(days, profile))) == [("x", 3), ("y", 4)]
    negative = spark.createDataFrame([(1, -2), (2, -5)], "user_id long, active_days long")
    assert rows(ops.active_days_by_group(negative, profile)) == [("x", -3)]


def test_active_user_count_counts_distinct_days(balance):
    for min_days, users in ((1, 3), (2, 1), (3, 0)):
        assert rows(ops.active_user_count(balance, "201408", min_days=min_days)) == [(users,)]
    assert sorted(rows(ops.days_per_user(balance))) == [(1, 2), (2, 2), (3, 1)]


# ---- cities ------------------------------------------------------------------------


def test_city_average_leaves_nulls_out(spark, balance, profile):
    day = dict(rows(ops.city_average_balance(balance, profile, day="20140801")))
    assert day == {10: 500 / 3}
    assert dict(rows(ops.city_average_balance(balance, profile, day="20140802"))) == {10: None}
    everything = dict(rows(ops.city_average_balance(balance, profile)))
    assert everything == {10: 250.0, 20: 10.0}


def test_doubled_profile_rows_count_twice(spark, balance, profile):
    double = profile.union(profile.where("user_id = 2"))
    naive = balance.join(double, "user_id")
    want = dict(rows(naive.where("report_date = '2014-08-01'").groupBy("City").agg(F.avg("tBalance"))))
    assert dict(rows(ops.city_average_balance(balance, double, day="20140801"))) == want
    flows = dict(
        rows(naive.groupBy("user_id").agg(F.sum("total_purchase_amt") + F.sum("total_redeem_amt")))
    )
    top = ops.top_users_by_city(balance, double, "20140101", "20141231", n=9)
    assert {r.user_id: r.total_flow for r in top.collect()} == flows


def test_top_users_dataframe_and_sql_agree(spark, balance, profile):
    balance.createOrReplaceTempView("user_balance_table")
    profile.createOrReplaceTempView("user_profile_table")
    for n in (1, 3):
        frame = rows(ops.top_users_by_city(balance, profile, "20140801", "20140831", n=n).orderBy("City", "rank"))
        sql = rows(ops.top_users_by_city_sql(spark, "20140801", "20140831", n=n).orderBy("City", "rank"))
        assert frame == sql
        assert all(r[3] <= n for r in frame)
    # User 2 has no known outflow in August, so the flow is unknown and ranks last.
    assert frame == [(10, 1, 27, 1), (10, 2, None, 2), (20, 3, 10, 1)]


def test_groups_are_cut_in_buckets_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"))
    small = ranking._cut(frame, ["g"], [F.desc("k")], 3)._jdf.queryExecution().executedPlan().toString()
    large = ranking._cut(frame, ["g"], [F.desc("k")], 5000)._jdf.queryExecution().executedPlan().toString()
    assert small.count("WindowGroupLimit") == 2
    for plan in (small, large):
        exchanges = [line for line in plan.splitlines() if "hashpartitioning(" in line]
        assert exchanges and all("__bucket" in line for line in exchanges)


def test_ranks_in_groups_join_on_partition_and_group(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"))
        plan = ops.rank_in_groups(frame, "g", [F.desc("k")])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "hashpartitioning(" in line and "__pos" not in line]
    assert "SinglePartition" not in plan and exchanges


def test_sums_beyond_64_bits(spark):
    big = 2**62
    rows_ = [(1, "20140801", big, big, 0)] * 4
    balance = spark.createDataFrame(
        rows_, "user_id bigint, report_date string, tBalance bigint, total_purchase_amt bigint, total_redeem_amt bigint"
    )
    profile = spark.createDataFrame([(1, 7)], "user_id bigint, City bigint")
    daily = ops.daily_flow(balance)
    assert daily.first().total_purchase_amt == 4 * big
    assert ops.weekday_flow(daily).first().avg_in == float(4 * big)
    assert ops.city_average_balance(balance, profile).first().average_balance == float(big)
    with pytest.raises(Exception):
        ops.top_users_by_city(balance, profile, "20140801", "20140801").collect()


# ---- forecast ----------------------------------------------------------------------


def test_forecast_repeats_weekly_and_tracks_the_weekday(spark):
    first = date(2014, 2, 1)
    level = {0: 300, 1: 290, 2: 280, 3: 260, 4: 250, 5: 150, 6: 160}
    data = []
    for i in range(212):
        day = first + timedelta(days=i)
        data.append((day.strftime("%Y%m%d"), level[day.weekday()] * 1000, level[day.weekday()] * 500))
    daily = spark.createDataFrame(data, "report_date string, total_purchase_amt long, total_redeem_amt long")
    got = ops.forecast_flow(daily, start="20140901", num_trees=20).orderBy("report_date").collect()
    assert [r.report_date for r in got] == [(date(2014, 9, 1) + timedelta(days=i)).strftime("%Y%m%d") for i in range(30)]
    for i, r in enumerate(got):
        want = level[(date(2014, 9, 1) + timedelta(days=i)).weekday()]
        assert abs(r.purchase / (want * 1000) - 1) < 0.25
        assert abs(r.redeem / (want * 500) - 1) < 0.25
    assert [(r.purchase, r.redeem) for r in got[:23]] == [(r.purchase, r.redeem) for r in got[7:]]
    # Rows in another order and layout give the same forecast.
    again = ops.forecast_flow(daily.orderBy(F.rand(5)).repartition(3), num_trees=20).orderBy("report_date")
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in got]


def test_forecast_refuses_days_that_are_none(spark):
    daily = spark.createDataFrame([("20140231", 1, 1)], "report_date string, total_purchase_amt long, total_redeem_amt long")
    with pytest.raises(Exception):
        ops.forecast_flow(daily, start="20140901")
