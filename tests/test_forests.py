"""Forests grown by aggregation: the same for every layout, and right against a plain tree."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from ledgerbrook import operators as ops
from ledgerbrook.operators import forests

TARGETS = {"y": "py"}


@pytest.fixture(scope="module")
def series(spark):
    draw = random.Random(2)
    rows = [(f"d{i:03d}", i % 7, draw.randrange(12), round(100 * (i % 7) + 30 * draw.random() + i, 3)) for i in range(150)]
    return rows, spark.createDataFrame(rows, "day string, a int, b int, y double")


def predictions(nodes, frame, **options):
    found = ops.apply_forests(nodes, frame, TARGETS, key="day", features=["a", "b"], **options)
    return {r.day: r.py for r in found.collect()}


def test_same_forest_from_three_layouts(spark, series):
    rows, table = series
    options = {"num_trees": 6, "max_depth": 3}
    layouts = [table.coalesce(1), table.repartition(2), table.orderBy(F.rand(3)).repartition(37)]
    forests_ = [ops.grow_forests(t, TARGETS, key="day", features=["a", "b"], **options) for t in layouts]
    nodes = [sorted(map(tuple, f.collect()), key=repr) for f in forests_]
    assert nodes[0] == nodes[1] == nodes[2] and len({n[1] for n in nodes[0]}) == 6
    given = [predictions(f, table, **options) for f in forests_]
    assert given[0] == given[1] == given[2] and len(given[0]) == 150


def plain_tree(rows, depth):
    """Predictions of one tree on all rows, with variance gain and the first best split."""
    values = [y for *_, y in rows]
    best = None
    for feature in (1, 2):
        seen = sorted({r[feature] for r in rows})
        for low, high in zip(seen, seen[1:]):
            left = [r[3] for r in rows if r[feature] <= low]
            right = [r[3] for r in rows if r[feature] > low]
            gain = sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right) - sum(values) ** 2 / len(values)
            if gain > 1e-6 and (best is None or gain > best[0] * (1 + 1e-12)):
                best = gain, feature, (low + high) / 2
    if depth == 0 or best is None:
        return {r[0]: sum(values) / len(values) for r in rows}
    _, feature, at = best
    return plain_tree([r for r in rows if r[feature] <= at], depth - 1) | plain_tree([r for r in rows if r[feature] > at], depth - 1)


def test_one_tree_is_a_plain_tree(spark, series):
    rows, table = series
    options = {"num_trees": 1, "max_depth": 4}
    nodes = ops.grow_forests(
        table, TARGETS, key="day", features=["a", "b"], bootstrap=False, feature_subset="all", **options
    )
    got, want = predictions(nodes, table, **options), plain_tree(rows, 4)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-3) for k in want)


def test_bootstrap_weights_are_poisson(spark):
    weights = spark.range(20_000).select(forests.bootstrap_weight(42, F.col("id") % 100, F.col("id")).alias("w"))
    counts = {r.w: r["count"] / 20_000 for r in weights.groupBy("w").count().collect()}
    assert all(abs(counts[n] - math.exp(-1) / math.factorial(n)) < 0.02 for n in range(4))


def test_rows_without_a_target_and_constant_features(spark):
    table = spark.createDataFrame([("a", 1, 1, 5.0), ("b", 1, 1, None), ("c", 1, 1, 7.0)], "day string, a int, b int, y double")
    nodes = ops.grow_forests(table, TARGETS, key="day", features=["a", "b"], num_trees=1, bootstrap=False)
    assert [(r.feature, r.mean) for r in nodes.collect()] == [(None, 6.0)]
    assert predictions(nodes, table, num_trees=1) == {"a": 6.0, "b": 6.0, "c": 6.0}


def test_forecast_with_hashed_forests(spark):
    days = [(f"2014{m:02d}{d:02d}", 1000 * (d % 7) + 5, 10 * m) for m in range(2, 5) for d in range(1, 29)]
    daily = spark.createDataFrame(days, "report_date string, total_purchase_amt bigint, total_redeem_amt bigint")
    options = {"start": "20140501", "horizon": 4, "num_trees": 3, "max_depth": 2, "forest": "hashed"}
    once = ops.forecast_flow(daily, **options).orderBy("report_date").collect()
    again = ops.forecast_flow(daily.orderBy(F.rand(1)).repartition(9), **options).orderBy("report_date").collect()
    assert once == again and [r.report_date for r in once] == ["20140501", "20140502", "20140503", "20140504"]
    assert "Python" not in plan_of(ops.forecast_flow(daily, **options))
    with pytest.raises(ValueError):
        ops.forecast_flow(daily, forest="oak")
