"""Screening, headers of each file, and quoted records that go over lines."""

import csv
import io
import random

import pytest

from ledgerbrook import sinks, sources
from ledgerbrook.sources import lines as line_readers
from test_sources import HEADER, balance_line


@pytest.fixture()
def small_splits(spark):
    """Splits of a few hundred bytes, each one task."""
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300)
    spark.conf.set("spark.sql.files.openCostInBytes", 300)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def records(frame):
    return sorted(r.value for r in frame.collect())


def test_records_over_lines_in_many_splits(spark, write, tmp_path, small_splits):
    draw = random.Random(3)
    want, parsed = [], []
    for name in ("a", "b", "c"):
        out = io.StringIO()
        for i in range(120):
            text = "".join(draw.choice(['"', ",", "\n", "word", " ", '""', "\n\n", "x" * 40]) for _ in range(draw.randrange(9)))
            parsed.append((text, f"{name}{i}"))
            csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL if i % 3 else csv.QUOTE_MINIMAL).writerow([i, text, "d", f"{name}{i}"])
        write(f"in/{name}.csv", out.getvalue())
    lines = sources.read_lines(spark, str(tmp_path / "in"), positions=True)
    assert lines.rdd.getNumPartitions() > 10
    news = sources.read_news(spark, str(tmp_path / "in"), quoting="records")
    assert sorted((r.headline, r.stock) for r in news.collect()) == sorted(parsed)


def test_a_record_longer_than_a_split(spark, write, small_splits):
    long = "\n".join(f"line {i}" for i in range(300))
    path = write("in/a.csv", f'1,"{long}",d,MS\n2,"short",d,MS\n')
    news = sources.read_news(spark, path, quoting="records").collect()
    assert sorted(r.headline for r in news) == [long, "short"]


def test_an_open_quote_fails(spark, write, monkeypatch):
    monkeypatch.setattr(line_readers, "RECORD_LINES", 50)
    path = write("a.csv", '1,"never closed,d,MS\n' + "2,b,d,MS\n" * 100)
    with pytest.raises(Exception, match="a quote is not closed"):
        sources.read_news(spark, path, quoting="records").collect()


def test_records_without_line_breaks_and_header(spark, write, tmp_path):
    write("in/a.csv", 'id,headline,date,stock\n1,"a, b",d,MS\n')
    write("in/b.csv", '"other\nheader",x,y,z\n2,c,d,MRK\n')
    news = sources.read_news(spark, str(tmp_path / "in"), quoting="records")
    assert news.count() == 4
    path = write("c.csv", "id,headline,date,stock\n1,two,d,MS\n")
    dropped = sources.read_news(spark, path, quoting="records", header="drop")
    assert [tuple(r) for r in dropped.collect()] == [("two", "MS")]
    assert sources.read_news(spark, write("d.csv", ""), quoting="records").collect() == []


def test_each_file_has_its_own_header(spark, write, tmp_path, small_splits):
    body = [f"row {i} " + "x" * 50 for i in range(30)]
    write("in/a.csv", "head a\n" + "\n".join(body) + "\nhead a\nhead b\n")
    write("in/b.csv", "head b\n" + "\n".join(body) + "\nhead b\nhead a\n")
    write("in/c.csv", "")
    lines = sources.read_lines(spark, str(tmp_path / "in"), positions=True)
    assert records(sources.without_own_header(lines)) == sorted(body * 2 + ["head a", "head b"])
    kept = sources.without_own_header(lines, repeated=False)
    assert records(kept) == sorted(body * 2 + ["head a", "head b"] * 2)
    assert kept.columns == lines.columns


def test_files_with_other_headers_as_balance(spark, write, tmp_path):
    write("in/a.csv", f"{HEADER}\n{balance_line()}\n{HEADER}\n")
    write("in/b.csv", f"another,header\n{balance_line()}\nanother,header\n")
    table = sources.read_balance(spark, str(tmp_path / "in"), sources.ZERO_BAD_VALUES)
    assert [r.total_purchase_amt for r in table.collect()] == [10, 10]


def test_lines_are_written_as_they_are_under_a_header(spark, tmp_path, read_out, lines):
    path = str(tmp_path / "out")
    odd = ['a,"b"', "  padded\t", "", "back\\slash", "'x'"]
    sinks.write_lines(lines(*odd).coalesce(1), path, header="the, head")
    assert read_out(path) == "\n".join(["the, head", *filter(None, odd)]) + "\n"


def screened(frame):
    return {(r.reason, r.line) for r in frame.collect()}


def test_screen_balance(lines):
    bad = {
        "fields": "1,20140801,0,0,5,5,0,0,,,",
        "header": HEADER,
        "total_purchase_amt": balance_line(purchase="abc"),
        "total_redeem_amt": balance_line(redeem="1,5"),
        "report_date": balance_line(day="20140231"),
    }
    bad["total_redeem_amt"] = balance_line(redeem="--")
    table = sources.screen_balance_lines(lines(balance_line(), *bad.values()), days="strict")
    assert screened(table) == {(None, None), *bad.items()}
    good = table.where("reason is null").first()
    assert (good.user_id, good.report_date, good.total_purchase_amt, good.total_redeem_amt) == ("1", "20140801", 10.0, 3.0)
    assert all(r.user_id is None for r in table.where("reason is not null").collect())
    # 31 February is the 3rd of March to a lenient reader; any text is a day if days are not asked for.
    assert sources.screen_balance_lines(lines(bad["report_date"]), days="lenient").first().reason is None
    assert sources.screen_balance_lines(lines(balance_line(day="x"))).first().reason is None
    with pytest.raises(ValueError):
        sources.screen_balance_lines(lines("x"), days="maybe")


def test_screen_agrees_with_the_dropping_reader(spark, lines):
    draw = random.Random(5)
    some = [
        balance_line(purchase=draw.choice(["", "1", " 2 ", "x", "1e3", "NaN"]), redeem=draw.choice(["", "7", "y"]), tail=draw.choice(["", ",9"]))
        for _ in range(300)
    ]
    frame = lines(*some, HEADER)
    want = sources.balance_from_lines(frame, sources.DROP_BAD_ROWS).collect()
    got = sources.screen_balance_lines(frame).where("reason is null").drop("reason", "line").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_screen_other_lines(lines):
    flows = lines("20140801\t1.5,2", "20140801\tx,2", "20140801\t1", "day\t1,2", "no tab")
    assert screened(sources.screen_daily_flow_lines(flows)) == {
        (None, None), ("total_purchase_amt", "20140801\tx,2"), ("total_redeem_amt", "20140801\t1"),
        ("report_date", "day\t1,2"), ("fields", "no tab"),
    }
    days = lines("1\t5", "2\tmany", "3", "4\t5\t6")
    assert screened(sources.screen_active_days_lines(days)) == {
        (None, None), ("active_days", "2\tmany"), ("fields", "3"), ("fields", "4\t5\t6")
    }


def test_screened_folder_comes_from_one_scan(spark, tmp_path, lines):
    path = str(tmp_path / "screened")
    table, seen = sources.count_reasons(sources.screen_balance_lines(lines(balance_line(), "x", "y", HEADER)), "balance")
    sinks.write_screened(table, path)
    assert {k: v for k, v in seen.get.items() if v} == {"good": 1, "fields": 2, "header": 1}
    assert sources.read_screened(spark, path).columns == ["user_id", "report_date", "total_purchase_amt", "total_redeem_amt"]
    assert sources.read_screened(spark, path).count() == 1
    rejects = sources.read_rejects(spark, path)
    assert {(r.reason, r.line) for r in rejects.collect()} == {("fields", "x"), ("fields", "y"), ("header", HEADER)}
    plan = rejects._jdf.queryExecution().executedPlan().toString()
    assert "outcome" in plan.split("PartitionFilters: [")[1].split("]")[0]
