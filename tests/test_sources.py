from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerbrook import schemas, sinks, sources

HEADER = "user_id,report_date,a,b,total_purchase_amt,direct_purchase_amt,c,d,total_redeem_amt,e"


def balance_line(user="1", day="20140801", purchase="10", direct="5", redeem="3", tail=",9"):
    return f"{user},{day},0,0,{purchase},{direct},0,0,{redeem}{tail}"


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_split_forgets_trailing_empty_fields_unless_told(lines):
    frame = lines("a,b,c,d,,", "a,,b", ",,,", "")
    assert [r[0] for r in sources.split_fields(frame).collect()] == [
        ["a", "b", "c", "d"],
        ["a", "", "b"],
        [""],
        [""],
    ]
    kept = sources.split_fields(frame, keep_trailing_empty=True).collect()
    assert [len(r[0]) for r in kept] == [6, 3, 4, 1]


def test_split_treats_the_separator_literally(lines):
    assert sources.split_fields(lines("a|b|"), "|").first()[0] == ["a", "b"]
    assert sources.split_fields(lines("a\tb"), "\t").first()[0] == ["a", "b"]


def test_arity_rules(lines):
    fields = sources.split_fields(lines("a,b", "a,b,c", "a"))
    assert sources.keep_arity(fields, exact=2).count() == 1
    assert sources.keep_arity(fields, at_least=2).count() == 2
    assert sources.keep_arity(fields, at_least=2, otherwise="null").count() == 3
    with pytest.raises(Exception, match="unexpected number of fields: a"):
        sources.keep_arity(fields, at_least=2, otherwise="fail").collect()
    with pytest.raises(ValueError):
        sources.keep_arity(fields)
    with pytest.raises(ValueError):
        sources.keep_arity(fields, exact=1, otherwise="ignore")


def test_drop_bad_rows(lines):
    frame = lines(
        HEADER,
        balance_line(),
        balance_line(purchase="", redeem=""),
        balance_line(purchase="abc"),
        balance_line(redeem="x"),
        balance_line(purchase=" "),
        balance_line(purchase="1e3", redeem=" 7 "),
        balance_line(direct="bad"),
        HEADER,
        balance_line(redeem="", tail=",,"),
        "1,20140801,0",
    )
    table = sources.balance_from_lines(frame)
    assert rows(table.select("total_purchase_amt", "total_redeem_amt")) == [
        (0.0, 0.0),
        (10.0, 3.0),
        (10.0, 3.0),
        (1000.0, 7.0),
    ]
    assert table.schema["total_purchase_amt"].dataType == T.DoubleType()


def test_zero_bad_values(lines):
    frame = lines(
        HEADER,
        balance_line(purchase="abc", redeem="4"),
        balance_line(purchase="1.5", redeem=""),
        balance_line(purchase="1_000", redeem=" 7 "),
        balance_line(redeem="", tail=",,"),
        HEADER,
    )
    table = sources.balance_from_lines(frame, sources.ZERO_BAD_VALUES, header_line=HEADER)
    assert rows(table.select("total_purchase_amt", "total_redeem_amt")) == [
        (0, 0),
        (0, 4),
        (10, 0),
        (1000, 7),
    ]
    short = lines("1,20140801,0")
    with pytest.raises(Exception, match="unexpected number of fields"):
        sources.balance_from_lines(short, sources.ZERO_BAD_VALUES, header_line=HEADER).collect()


@pytest.mark.parametrize("bad", ["abc", "", " "])
def test_fail_on_bad(lines, bad):
    good = sources.balance_from_lines(
        lines(balance_line(direct="2.5")), sources.FAIL_ON_BAD, amounts=("direct_purchase_amt",)
    )
    assert good.first().direct_purchase_amt == 2.5
    table = sources.balance_from_lines(
        lines(balance_line(direct=bad)), sources.FAIL_ON_BAD, amounts=("direct_purchase_amt",)
    )
    with pytest.raises(Exception, match="direct_purchase_amt is not a number"):
        table.collect()


def test_rows_ending_in_empty_fields_fail_only_where_they_are_too_short(lines):
    line = lines(balance_line(redeem="", tail=",,"))
    with pytest.raises(Exception, match="unexpected number of fields"):
        sources.balance_from_lines(line, sources.FAIL_ON_BAD).collect()


def test_unknown_rules_are_refused(lines):
    with pytest.raises(ValueError):
        sources.balance_from_lines(lines("x"), sources.LineRules(bad_amounts="guess"))
    with pytest.raises(ValueError):
        sources.news_from_lines(lines("x"), quoting="maybe")


def test_header_rules_on_files(spark, write, tmp_path):
    body = balance_line() + "\n"
    write("in/a.csv", HEADER + "\n" + body + HEADER + "\n")
    write("in/b.csv", "another first line,x,0,0,1,1,0,0,1,1\n" + body)
    folder = str(tmp_path / "in")
    named = sources.read_balance(spark, folder)
    assert named.count() == 3
    per_file = sources.LineRules(header="first_of_file", bad_amounts="zero")
    assert sources.read_balance(spark, folder, per_file).count() == 3
    repeated = sources.read_balance(spark, folder, sources.ZERO_BAD_VALUES, header_line=HEADER)
    assert repeated.count() == 3
    none = sources.LineRules(header="none", bad_amounts="zero")
    assert sources.read_balance(spark, folder, none).count() == 5
    found = sources.read_balance(spark, str(tmp_path / "in" / "a.csv"), sources.ZERO_BAD_VALUES)
    assert rows(found.select("user_id")) == [("1",)]


def test_first_line_skipping_leaves_lines_alone(spark, write):
    path = write("x.txt", 'head\n "quoted, text",1,\\2\n\ta\n')
    got = [r.value for r in sources.read_lines(spark, path, skip_first_line=True).collect()]
    assert got == [' "quoted, text",1,\\2', "\ta"]


def test_many_small_splits_keep_header_and_order(spark, write):
    """The per-file header rule and 'last line wins' must not depend on how files are split."""
    body = "".join(f"{i % 50},x,y,sign{i}\n" for i in range(2000))
    path = write("user_profile_table.csv", "user_id,sex,City,constellation\n" + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        profile = sources.read_profile(spark, path)
        assert sources.read_lines(spark, path).rdd.getNumPartitions() > 10
        got = {r.user_id: r.constellation for r in profile.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {str(i % 50): f"sign{i}" for i in range(1950, 2000)}


def test_profile_is_trimmed_and_utf8(spark, write):
    path = write("p.csv", "user_id,Sex,City,constellation\n 7 ,1,101, 双子座\t\n7,1,101,狮子座\n")
    assert rows(sources.read_profile(spark, path)) == [("7", "狮子座")]


def test_news_quoting(lines):
    frame = lines(
        "0,plain headline,x, MS ",
        '1,"a, quoted one",x,MRK',
        "2,too,many,fields,here",
        "3,short,x",
        "4,open end,x,",
        '5,"say ""hi""",x,QQQ',
        "headline,x,y,stock,,",
    )
    naive = sources.news_from_lines(frame)
    assert rows(naive) == [
        ('"say ""hi"""', "QQQ"),
        ("plain headline", " MS "),
        ("x", "stock"),
    ]
    quoted = sources.news_from_lines(frame, quoting="csv")
    assert rows(quoted) == [
        ("a, quoted one", "MRK"),
        ("open end", ""),
        ("plain headline", " MS "),
        ('say "hi"', "QQQ"),
    ]


def test_news_header_is_data_unless_dropped(spark, write):
    path = write("news.csv", "id,headline,date,stock\n1,up,x,MS\n")
    assert rows(sources.read_news(spark, path)) == [("headline", "stock"), ("up", "MS")]
    assert rows(sources.read_news(spark, path, header="drop")) == [("up", "MS")]


def test_stop_words(spark, write):
    path = write("stop.txt", "The\n and \nTHE\n\ndon't\n")
    words = {r.word for r in sources.read_stop_words(spark, path).collect()}
    assert words == {"", "and", "don't", "the"}


def test_daily_flow_text(lines):
    frame = lines("20150105\t4.4E7,2500000.0", "no tab", "a\tb\tc", "20130702\t1,2\t")
    assert rows(sources.daily_flow_from_lines(frame)) == [
        ("20130702", 1.0, 2.0),
        ("20150105", 44000000.0, 2500000.0),
    ]
    with pytest.raises(Exception, match="not a number"):
        sources.daily_flow_from_lines(lines("20130701\t1")).collect()


def test_active_days_text(lines):
    frame = lines("17\t35", "1,2,3", " 8 \t 5 ")
    assert rows(sources.active_days_from_lines(frame)) == [("17", 35), ("8", 5)]
    with pytest.raises(Exception, match="not a day count"):
        sources.active_days_from_lines(lines("1\tx")).collect()


def test_named_csv_finds_columns_by_name(spark, write):
    path = write("b.csv", "tbalance,REPORT_DATE,extra,user_id\n5,20140301,z,1\n,2014-03-02,z,2\n")
    struct = T.StructType([schemas.BALANCE[n] for n in ("user_id", "report_date", "tBalance")])
    assert rows(sources.read_named_csv(spark, path, struct)) == [
        (1, date(2014, 3, 1), 5),
        (2, date(2014, 3, 2), None),
    ]
    bad = write("bad.csv", "user_id,report_date,tBalance\n1,20140231,7\n")
    with pytest.raises(Exception, match="bad value for report_date: 20140231"):
        sources.read_named_csv(spark, bad, struct).collect()
    assert rows(sources.read_named_csv(spark, bad, struct, bad="null")) == [(1, None, 7)]
    with pytest.raises(ValueError, match="tBalance"):
        sources.read_named_csv(spark, write("c.csv", "user_id,report_date\n"), struct)


def test_rejects_are_counted(lines):
    kept, seen = sources.count_rejects(lines("1", "x", "3"), F.col("value") == "x", "rejects")
    assert kept.count() == 2
    assert seen.get["rejected"] == 1


def test_landed_months_are_pruned(spark, tmp_path):
    path = str(tmp_path / "landed")
    days = [date(2014, 7, 31), date(2014, 8, 1), date(2014, 8, 31), date(2014, 9, 1)]
    table = spark.createDataFrame([(i, d, 1, 2, 3, 4) for i, d in enumerate(days)], schemas.BALANCE)
    sinks.land_balance(table, path)
    august = sources.read_landed_balance(spark, path, first="20140801", last="20140831")
    assert [r.user_id for r in august.orderBy("user_id").collect()] == [1, 2]
    assert august.columns == table.columns
    plan = august._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_month" in plan
    assert sources.read_landed_balance(spark, path).count() == 4


def test_amounts_of_undated_daily_lines_are_not_looked_at(lines):
    table = sources.daily_flow_from_lines(lines("date\tin,out", "20140801\t1.0,2.0"))
    assert sorted(map(tuple, table.collect()), key=repr) == [("20140801", 1.0, 2.0), ("date", None, None)]
    with pytest.raises(Exception):
        sources.daily_flow_from_lines(lines("20140801\tin,out")).collect()


def test_second_amount_is_read_only_where_needed(lines):
    amounts = ("direct_purchase_amt", "total_redeem_amt")
    rules = sources.FAIL_WHERE_NEEDED
    table = sources.balance_from_lines(lines("1,20140801,0,0,0,5,,,", "2,20140801,0,0,0,0,0,0,3"), rules, amounts=amounts)
    assert sorted(map(tuple, table.collect()), key=repr) == [
        ("1", "20140801", 5.0, None), ("2", "20140801", 0.0, 3.0)
    ]
    with pytest.raises(Exception):
        sources.balance_from_lines(lines("1,20140801,0,0,0,0,,,"), rules, amounts=amounts).collect()


def test_repeated_header_needs_its_line(lines):
    with pytest.raises(ValueError):
        sources.balance_from_lines(lines("a"), sources.ZERO_BAD_VALUES)


def test_named_csv_refuses_files_with_other_headers(spark, write):
    from pyspark.sql import types as T

    write("in/a.csv", "user_id,tBalance\n1,10\n")
    path = write("in/b.csv", "tBalance,user_id\n200,2\n")
    wanted = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("tBalance", T.LongType())])
    with pytest.raises(Exception):
        sources.read_named_csv(spark, path.rsplit("/", 1)[0], wanted).collect()
