"""The ten jobs from files to files, through the command line's own functions."""

import pytest

from ledgerbrook.__main__ import _parser
from ledgerbrook import sources
from ledgerbrook.plans import jobs

BALANCE = """user_id,report_date,tBalance,y,total_purchase_amt,direct_purchase_amt,c,d,total_redeem_amt
1,20140801,500,0,100,100,0,0,0
1,20140802,600,0,50.5,50,0,0,
1,20140803,600,0,0,0,0,0,1
2,20140801,70,0,,0,0,0,30
2,20140301,80,0,5,0,0,0,0
3,20140301,81,0,7,7,0,0,0
3,20140804,81,0,20,7,0,0,10
"""
# The same without values that a strict job refuses.
CLEAN = BALANCE.replace("50.5", "50").replace(",,0,0,0,30", ",0,0,0,0,30").replace("0,50,0,0,\n", "0,50,0,0,2\n")
PROFILE = """user_id,Sex,City,constellation
1,1,101,狮子座
2,0,101,双子座
2,0,101,狮子座
3,1,102,双子座
"""
NEWS = """id,headline,date,stock
0,Stocks rise on the Fed's news,x,MS
1,"Stocks, bonds",x,MS
2,Fed news and stocks,x,MRK
3,no ticker,x,
"""


@pytest.fixture()
def files(write, tmp_path):
    return {
        "balance": write("user_balance_table.csv", BALANCE),
        "clean": write("clean.csv", CLEAN),
        "profile": write("user_profile_table.csv", PROFILE),
        "news": write("news.csv", NEWS),
        "stop": write("stop.txt", "the\nOn \nand\n"),
        "out": str(tmp_path / "out"),
    }


def test_count_and_rank(spark, files, read_out):
    jobs.run_count_and_rank(spark, files["news"], files["out"])
    assert read_out(files["out"]) == "\t1: MRK, 1\n\t2: MS, 1\n\t3: stock, 1\n"


def test_count_and_rank_understanding_quotes(spark, files, read_out):
    jobs.run_count_and_rank(spark, files["news"], files["out"], quoting="csv", header="drop")
    assert read_out(files["out"]) == "\t1: MS, 2\n\t2: MRK, 1\n"


def test_top_words(spark, files, read_out):
    jobs.run_top_words(spark, files["news"], files["stop"], files["out"], n=3)
    assert read_out(files["out"]) == "\t1: news, 2\n\t2: stocks, 2\n\t3: fed, 1\n"


def test_daily_flow_as_text(spark, files, read_out):
    jobs.run_daily_flow(spark, files["balance"], files["out"])
    # The line whose last amount is missing is too short once trailing empties are forgotten.
    assert read_out(files["out"]) == (
        "20140301\t12.0,0.0\n20140801\t100.0,30.0\n20140803\t0.0,1.0\n20140804\t20.0,10.0\n"
    )


def test_daily_flow_as_csv(spark, files, read_out):
    jobs.run_daily_flow(spark, files["balance"], files["out"], form="csv")
    assert read_out(files["out"]) == (
        "report_date,total_purchase_amt,total_redeem_amt\n"
        "20140301,12,0\n20140801,100,30\n20140802,0,0\n20140803,0,1\n20140804,20,10\n"
    )


def test_weekday_flow(spark, write, files, read_out):
    daily = write("daily", "20150105\t4.4E7,2500000.0\n20150112\t2.0,1.0\n20150106\t2.75E7,1250000.0\n")
    jobs.run_weekday_flow(spark, daily, files["out"])
    assert read_out(files["out"]) == "Tuesday\t2.75E7,1250000.0\nMonday\t2.2000001E7,1250000.5\n"


def test_active_days_then_groups(spark, files, read_out):
    jobs.run_active_days(spark, files["clean"], files["out"])
    assert read_out(files["out"]) == "1\t3\n3\t2\n2\t1\n"
    groups = files["out"] + "-groups"
    jobs.run_active_days_by_group(spark, files["out"], files["profile"], groups)
    # User 2 is listed twice and the last line counts.
    assert read_out(groups) == "双子座\t2\n狮子座\t2\n"


def test_active_days_is_strict_where_the_answer_depends_on_it(spark, files, write, read_out):
    # A day with a purchase is active, whatever its redemption is.
    jobs.run_active_days(spark, files["balance"], files["out"])
    assert read_out(files["out"]) == "1\t3\n3\t2\n2\t1\n"
    bad = write("bad.csv", BALANCE.replace("600,0,50.5,50,", "600,0,50.5,0,"))
    with pytest.raises(Exception):
        jobs.run_active_days(spark, bad, files["out"] + "-bad")


def test_active_user_count(spark, files, read_out):
    jobs.run_active_user_count(spark, files["balance"], files["out"], month="201408", min_days=2)
    assert read_out(files["out"]) == "active_users\n1\n"


def test_city_average_balance(spark, files, read_out):
    jobs.run_city_average_balance(spark, files["balance"], files["profile"], files["out"], day="20140301")
    assert read_out(files["out"]) == "City,average_balance\r\n102,81.0\r\n101,80.0\r\n"


def test_top_users_by_city(spark, files, read_out):
    jobs.run_top_users_by_city(spark, files["clean"], files["profile"], files["out"], first="20140801", last="20140831", n=1)
    assert read_out(files["out"]) == "City\tuser_id\ttotal_flow\n101\t1\t153\n102\t3\t30\n"


def test_forecast(spark, write, files, read_out):
    days = "".join(f"2014{m:02d}{d:02d},{1000 + d},{500 + m}\n" for m in range(2, 9) for d in range(1, 29))
    daily = write("daily.csv", "report_date,total_purchase_amt,total_redeem_amt\n20130701,9,9\n" + days)
    jobs.run_forecast(spark, daily, files["out"], train_first="20140201", train_last="20140831", start="20140901", horizon=3)
    got = read_out(files["out"]).splitlines()
    assert got[0] == "report_date,purchase,redeem"
    assert [line.split(",")[0] for line in got[1:]] == ["20140901", "20140902", "20140903"]
    assert all(1000 < int(line.split(",")[1]) < 1029 for line in got[1:])


def test_command_line_knows_every_job():
    options = _parser().parse_args(["top-users-by-city", "--balance", "b", "--profile", "p", "--out", "o", "--n", "5", "--first", "20140801", "--last", "20140831"])
    assert (options.job, options.n, options.first) == ("top-users-by-city", 5, "20140801")
    options = _parser().parse_args(["weekday-flow", "--daily", "d", "--out", "o", "--no-lenient"])
    assert options.lenient is False
    assert len(jobs.JOBS) == 16


def test_weekday_flow_counts_undated_lines(spark, write, files):
    daily = write("daily", "date\tin,out\n20130701\t3.0,5.0\n")
    assert jobs.run_weekday_flow(spark, daily, files["out"]) == {"lines without a date": 1}


def test_landed_balance_gives_the_same_cities(spark, write, files, read_out):
    whole = write("whole.csv", CLEAN.replace("5,50", "5"))
    jobs.run_land_balance(spark, whole, files["out"] + "-landed")
    days = {"first": "20140801", "last": "20140831", "n": 1}
    for name, source, landed in (("a", whole, False), ("b", files["out"] + "-landed", True)):
        jobs.run_top_users_by_city(spark, source, files["profile"], files["out"] + name, landed=landed, **days)
    assert read_out(files["out"] + "a") == read_out(files["out"] + "b") != ""


def test_screen_then_daily_flow(spark, files, read_out):
    screened = files["out"] + "-screened"
    counts = jobs.run_screen(spark, files["balance"], screened, days="strict")
    bad = {"total_purchase_amt": 0, "total_redeem_amt": 0, "direct_purchase_amt": 0, "report_date": 0}
    assert counts == {"good": 6, "fields": 1, "header": 1, **bad}
    jobs.run_daily_flow(spark, files["balance"], files["out"])
    jobs.run_daily_flow(spark, screened, files["out"] + "-b", screened=True)
    assert read_out(files["out"]) == read_out(files["out"] + "-b") != ""


def test_screen_keeps_rejected_lines_as_they_stood(spark, files):
    news = files["out"] + "-news"
    assert jobs.run_screen(spark, files["news"], news, kind="news") == {"good": 3, "fields": 2}
    rejects = {(r.reason, r.line) for r in sources.read_rejects(spark, news).collect()}
    assert rejects == {("fields", '1,"Stocks, bonds",x,MS'), ("fields", "3,no ticker,x,")}


def test_rank_of_screened_news_by_histogram(spark, files, read_out):
    news = files["out"] + "-news"
    jobs.run_screen(spark, files["news"], news, kind="news")
    jobs.run_count_and_rank(spark, news, files["out"], screened=True, method="histogram")
    assert read_out(files["out"]) == "\t1: MRK, 1\n\t2: MS, 1\n\t3: stock, 1\n"
    with pytest.raises(ValueError):
        jobs.run_count_and_rank(spark, news, files["out"] + "-x", screened=True, method="guess")
