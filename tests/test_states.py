"""What is kept between runs: day bitmaps, sums of increments, bucketed tables."""

import random
from datetime import date, timedelta

import pytest

from conftest import plan_of
from ledgerbrook import operators as ops
from ledgerbrook import sinks, sources
from ledgerbrook.plans import increments, jobs
from test_sources import HEADER, balance_line


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def seen(spark):
    draw = random.Random(1)
    days = [date(2023, 12, 25) + timedelta(days=draw.randrange(500)) for _ in range(900)]
    return [(draw.choice([1, 2, 3, None]), day) for day in days] + [(1, None), (4, date(2024, 2, 29))]


def test_days_from_a_state_of_parts(spark, seen, tmp_path):
    path = str(tmp_path / "state")
    for part in (seen[:400], seen[300:700], seen[600:]):
        state = ops.day_bitmaps(spark.createDataFrame(part, "user_id int, report_date date"))
        sinks.store_day_bitmaps(state, path)
    state = sources.read_day_bitmaps(spark, path)
    for period, name in (("month", "%Y%m"), ("year", "%Y")):
        want = {}
        for user, day in set(seen):
            if day:
                want[user, day.strftime(name)] = want.get((user, day.strftime(name)), 0) + 1
        assert {(r.user_id, r.period): r.days for r in ops.days_per_period(state, period).collect()} == want
    first, last = date(2024, 1, 31), date(2024, 6, 30)
    cut = sources.read_day_bitmaps(spark, path, first="20240131", last="20240630")
    quarters = {(r.user_id, r.period): r.days for r in ops.days_per_period(cut, "quarter").collect()}
    want = {}
    for user, day in set(seen):
        if day and first <= day <= last:
            key = user, f"{day.year}Q{(day.month + 2) // 3}"
            want[key] = want.get(key, 0) + 1
    assert quarters == want
    with pytest.raises(ValueError):
        ops.days_per_period(state, "week")


def test_day_range_reads_its_months_only(spark, seen, tmp_path):
    path = str(tmp_path / "state")
    sinks.store_day_bitmaps(ops.day_bitmaps(spark.createDataFrame(seen, "user_id int, report_date date")), path)
    plan = plan_of(sources.read_day_bitmaps(spark, path, first="20240105", last="20240110"))
    assert "month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_empty_state(spark):
    state = ops.day_bitmaps(spark.createDataFrame([], "user_id int, report_date date"))
    assert rows(ops.merge_day_bitmaps(state, state)) == [] and rows(ops.active_users_by_period(state)) == []


def test_bitmap_jobs(spark, write, tmp_path, read_out):
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    for name, days in (("a", ["20140801", "20140802"]), ("b", ["20140802", "20140901", "20141001"])):
        text = "user_id,report_date\n" + "".join(f"{u},{day}\n" for day in days for u in (1, 2))
        jobs.run_store_active_days(spark, write(f"{name}.csv", text), state)
    jobs.run_active_users_by_period(spark, state, out, min_days=3)
    assert read_out(out) == "period,active_users\n2014Q3,2\n"


def test_increments_add_a_file_once(spark, write, tmp_path):
    state, folder = str(tmp_path / "state"), str(tmp_path / "in")
    assert rows(increments.daily_flow_of(spark, state)) == []
    first = write("in/a.csv", f"{HEADER}\n{balance_line(purchase='10')}\n{balance_line(purchase='x')}\n")
    assert increments.add_balance_files(spark, folder, state) == 1
    assert increments.add_balance_files(spark, first, state) == 0
    # The same lines in another file are other rows.
    write("in/b.csv", f"{HEADER}\n{balance_line(purchase='10')}\n{balance_line(day='20140802', redeem='7')}\n")
    assert increments.add_balance_files(spark, folder, state) == 1
    assert increments.add_balance_files(spark, [folder, first], state) == 0
    whole = ops.daily_flow(sources.read_balance(spark, folder, sources.ZERO_BAD_VALUES))
    assert rows(increments.daily_flow_of(spark, state)) == rows(whole)
    assert [(r.report_date, int(r.total_purchase_amt)) for r in whole.orderBy("report_date").collect()] == [
        ("20140801", 20), ("20140802", 10)
    ]
    averages = {r.report_date: r.avg_total_purchase_amt for r in increments.average_row_of(spark, state).collect()}
    assert averages == {"20140801": 20 / 3, "20140802": 10.0}
    with pytest.raises(ValueError):
        increments.add_balance_files(spark, folder, state, rules=sources.DROP_BAD_ROWS)


def test_an_increment_that_died_is_added_again(spark, write, tmp_path):
    state = str(tmp_path / "state")
    path = write("in/a.csv", f"{HEADER}\n{balance_line()}\n")
    # Sums without a list of files: what a run leaves that dies before its end.
    lost = spark.createDataFrame([("20140801", 5, 5, 1, "lost")], "report_date string, a int, b int, n bigint, i string")
    lost = lost.selectExpr(
        "report_date", "cast(a as decimal(38,0)) total_purchase_amt", "cast(b as decimal(38,0)) total_redeem_amt",
        "n n_rows", "i increment",
    )
    lost.write.parquet(state + "/sums")
    assert jobs.run_add_balance(spark, path, state) == {"files added": 1}
    assert [int(r.total_purchase_amt) for r in increments.daily_flow_of(spark, state).collect()] == [10]


def test_increment_job(spark, write, tmp_path, read_out):
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    jobs.run_add_balance(spark, write("a.csv", f"{HEADER}\n{balance_line()}\n"), state)
    jobs.run_daily_flow_of_state(spark, state, out)
    assert read_out(out) == "report_date,total_purchase_amt,total_redeem_amt\n20140801,10,3\n"


def test_no_exchange_below_a_bucketed_join(spark, tmp_path):
    balance = spark.range(4000).selectExpr(
        "id % 300 user_id", "date'2014-08-01' report_date", "id tBalance", "id total_purchase_amt", "id total_redeem_amt"
    )
    profile = spark.range(300).selectExpr("id user_id", "id % 7 City")
    names = []
    for name, table in (("b", balance), ("p", profile)):
        names.append(f"test_bucketed_{name}")
        sinks.land_bucketed(table, names[-1], str(tmp_path / name), "user_id", buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        found = ops.city_average_balance(*map(spark.table, names))
        plan = plan_of(found)
        below = plan[plan.index("SortMergeJoin") :]
        assert "Exchange" not in below and plan.count("Exchange") == 1
        assert rows(found) == rows(ops.city_average_balance(balance, profile))
        # Without buckets the same join shuffles both sides.
        plain = plan_of(ops.city_average_balance(spark.read.parquet(str(tmp_path / "b")), spark.read.parquet(str(tmp_path / "p"))))
        assert plain[plain.index("SortMergeJoin") :].count("Exchange") >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in names:
            spark.sql(f"DROP TABLE {name}")
