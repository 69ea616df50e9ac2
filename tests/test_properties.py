"""Results must not depend on how rows are laid out or how large one key is."""

from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerbrook import operators as ops
from ledgerbrook import sources

FIRST = date(2014, 7, 25)
amount = st.none() | st.integers(-5, 1000)
record = st.tuples(
    st.sampled_from([1, 1, 1, 2, 3, 4]), st.integers(0, 45), amount, amount, st.integers(0, 900)
)
fast = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = (
    "user_id long, report_date date, total_purchase_amt long, total_redeem_amt long, tBalance long,"
    " direct_purchase_amt long"
)


def frame_of(spark, records):
    return spark.createDataFrame(
        [(u, FIRST + timedelta(days=d), p, r, b, p) for u, d, p, r, b in records], SCHEMA
    )


def both_layouts(operator, frame):
    plain = sorted((tuple(r) for r in operator(frame).collect()), key=repr)
    spread = sorted((tuple(r) for r in operator(frame.repartition(5)).collect()), key=repr)
    assert plain == spread
    return plain


@fast
@given(records=st.lists(record, min_size=1, max_size=60))
def test_operators_against_plain_python(spark, records):
    frame = frame_of(spark, records)
    daily = both_layouts(ops.daily_flow, frame)
    assert sum(r[1] for r in daily) == sum(r[2] or 0 for r in records)
    assert sum(r[2] for r in daily) == sum(r[3] or 0 for r in records)

    active = {}
    for user, _, purchase, redeem, _ in records:
        if (purchase or 0) > 0 or (redeem or 0) > 0:
            active[user] = active.get(user, 0) + 1
    assert dict(both_layouts(ops.active_days, frame)) == active

    august = {}
    for user, day, *_ in records:
        when = FIRST + timedelta(days=day)
        if when.month == 8:
            august.setdefault(user, set()).add(when)
    want = sum(len(days) >= 3 for days in august.values())
    assert both_layouts(lambda f: ops.active_user_count(f, "201408", min_days=3), frame) == [(want,)]
    text = frame.withColumn("report_date", F.date_format("report_date", "yyyyMMdd"))
    assert ops.active_user_count(text, "201408", min_days=3).collect()[0][0] == want

    profile = spark.createDataFrame([(1, 10), (2, 10), (3, 20)], "user_id long, City long")
    flows = {}
    for user, _, purchase, redeem, _ in records:
        if user <= 3:
            sides = flows.setdefault(user, ([], []))
            sides[0].extend([purchase] if purchase is not None else [])
            sides[1].extend([redeem] if redeem is not None else [])
    total = {u: sum(a) + sum(b) if a and b else None for u, (a, b) in flows.items()}
    ranked = []
    for city, users in ((10, (1, 2)), (20, (3,))):
        present = [u for u in users if u in total]
        present.sort(key=lambda u: (total[u] is None, -(total[u] or 0), u))
        ranked += [(city, u, total[u], i + 1) for i, u in enumerate(present[:1])]
    top = both_layouts(lambda f: ops.top_users_by_city(f, profile, "20140101", "20141231", n=1), frame)
    assert top == sorted(ranked, key=repr)


@fast
@given(
    fields=st.lists(
        st.text(alphabet="0123456789.,-+eEnNaAiIfF_ \t", max_size=6).map(lambda s: s.replace(",", "")),
        min_size=2,
        max_size=2,
    )
)
def test_number_rules_against_plain_python(spark, fields):
    """Whole numbers are what ``int`` takes; other values count as zero."""

    def whole(text):
        try:
            return int(text) if text else 0
        except ValueError:
            return 0

    line = f"u,20140801,0,0,{fields[0]},0,0,0,{fields[1]},end"
    row = sources.balance_from_lines(
        spark.createDataFrame([(line,)], "value string"), sources.ZERO_BAD_VALUES, header_line=""
    ).first()
    assert (row.total_purchase_amt, row.total_redeem_amt) == (whole(fields[0]), whole(fields[1]))
