from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerbrook import functions as fn


def evaluate(spark, column, *values):
    frame = spark.createDataFrame([(v,) for v in values], "x string")
    return [row[0] for row in frame.select(column(F.col("x"))).collect()]


def test_strip_control_removes_more_than_blanks(spark):
    got = evaluate(spark, fn.strip_control, " \t MS\r\n", "\u0000a b\u0001", " x", "")
    assert got == ["MS", "a b", " x", ""]


def test_text_lines_takes_all_line_ends(spark):
    got = evaluate(spark, fn.text_lines, "a\nb", "a\r\nb\rc\n", "", "one")
    assert got == [["a", "b"], ["a", "b", "c", ""], [""], ["one"]]


@pytest.mark.parametrize(
    ("text", "words"),
    [
        ("Thursday's Top-10 picks", ["thursdays", "top", "picks"]),
        ("a\tb c", ["ab", "c"]),
        ("  lead and  double ", ["lead", "and", "double"]),
        ("Café Ünï 123", ["caf", "n"]),
        ("\u0130stanbul \u212a", ["stanbul"]),
        ("123 456", []),
    ],
)
def test_letter_tokens(spark, text, words):
    (tokens,) = evaluate(spark, fn.letter_tokens, text)
    assert [t for t in tokens if t] == words


def test_parse_double_takes_the_double_grammar(spark):
    values = [" 7 ", "1e3", "1.5", "1d", "0x1p3", "+2", "Infinity", "-Infinity", "1e999"]
    got = evaluate(spark, lambda x: fn.parse_number(x, "double"), *values)
    inf = float("inf")
    assert got == [7.0, 1000.0, 1.5, 1.0, 8.0, 2.0, inf, -inf, inf]
    bad = ["abc", "", " ", "inf", "nan", "INFINITY", "1_000", "1,5", "12n"]
    assert evaluate(spark, lambda x: fn.parse_number(x, "double"), *bad) == [None] * len(bad)
    (nan,) = evaluate(spark, lambda x: fn.parse_number(x, "double"), "NaN")
    assert nan != nan


def test_parse_bigint_takes_whole_numbers_only(spark):
    values = [" 7 ", "+7", "-7", "1_000", "007", "1.5", "1e3", "NaN", "", "abc", "1__0", "_1"]
    got = evaluate(spark, lambda x: fn.parse_number(x, "bigint"), *values)
    assert got == [7, 7, -7, 1000, 7, None, None, None, None, None, None, None]


def test_parse_bigint_is_loud_about_overflow(spark):
    with pytest.raises(Exception, match="outside 64 bits"):
        evaluate(spark, lambda x: fn.parse_number(x, "bigint"), "99999999999999999999")
    wide = evaluate(spark, lambda x: fn.parse_number(x, "decimal(38,0)"), "99999999999999999999")
    assert [int(v) for v in wide] == [99999999999999999999]


def test_positive_knows_that_nan_is_not(spark):
    frame = spark.createDataFrame([(float("nan"),), (0.0,), (-1.0,), (0.5,), (None,)], "x double")
    got = [r[0] for r in frame.select(fn.positive(F.col("x"), T.DoubleType())).collect()]
    assert got == [False, False, False, True, None]


def test_strict_days(spark):
    values = ["20140301", "20140231", "2014-301", "2014030", "201403011", "abcd0101", "20141301", ""]
    got = evaluate(spark, fn.parse_day, *values)
    assert got == [date(2014, 3, 1)] + [None] * 7


def test_lenient_days_roll_over(spark):
    values = ["20140301", "20140231", "20141301", "20140001", "20140300", "201403011", "20140301x", "x",
              "201403010000", "20140301000001", "20140399999999999999"]
    got = evaluate(spark, lambda x: fn.parse_day(x, lenient=True), *values)
    assert got == [
        date(2014, 3, 1),
        date(2014, 3, 3),
        date(2015, 1, 1),
        date(2013, 12, 1),
        date(2014, 2, 28),
        date(2014, 3, 11),
        date(2014, 3, 1),
        None,
        date(2041, 7, 16),
        date(4752, 1, 27),
        None,
    ]


def test_day_features(spark):
    frame = spark.sql("SELECT DATE '2014-09-01' AS d UNION ALL SELECT DATE '2012-12-30'")
    rows = frame.select(*[c.alias(n) for n, c in fn.day_features(F.col("d")).items()]).collect()
    assert [tuple(r) for r in rows] == [(244, 9, 1), (365, 12, 7)]


def test_day_names_and_keys(spark):
    frame = spark.sql("SELECT explode(sequence(DATE '2014-08-31', DATE '2014-09-06')) AS d")
    names = [r[0] for r in frame.select(fn.day_name(F.col("d"))).collect()]
    # Weekday names, Sunday first.
    assert names == ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    assert frame.select(fn.day_key(F.col("d"))).first()[0] == "20140831"


def test_future_days(spark):
    start = F.lit("2014-09-01").cast("date")
    days = [r[0] for r in fn.future_days(spark.range(1), start, 30).collect()]
    assert (len(days), days[0], days[-1]) == (30, date(2014, 9, 1), date(2014, 9, 30))
