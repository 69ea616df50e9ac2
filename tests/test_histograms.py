"""Ranks and top lists from histograms, with pieces made small."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from ledgerbrook import operators as ops
from ledgerbrook.operators import histograms, ranking


@pytest.fixture(params=[1 << 18, 16])
def piece_rows(request, monkeypatch):
    monkeypatch.setattr(histograms, "PIECE_ROWS", request.param)
    return request.param


def ranked(rows):
    """Rows (key, n) with the rank by n, largest first, None last, then by key."""
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    return {key: i + 1 for i, (key, _) in enumerate(order)}


COUNTS = {
    "one count holds most keys": [(f"k{i:05d}", 1 if i % 20 else i) for i in range(1, 4000)],
    "all counts differ": [(f"k{i}", i * i) for i in range(500)],
    "missing, zero and negative": [("a", None), ("b", 0), ("c", -5), ("d", 5), ("e", None), ("f", 1), ("g", 0)],
    "large": [("a", 2**62), ("b", 2**62 + 1), ("c", 2**53), ("d", 2**53 + 1), ("e", 7)],
    "one": [("a", 1)],
    "none": [],
}


@pytest.mark.parametrize("name", COUNTS)
def test_rank_by_count(spark, name, piece_rows):
    rows = COUNTS[name]
    table = spark.createDataFrame(rows, "k string, n bigint").repartition(5)
    assert {r.k: r.rank for r in ops.rank_by_count(table, "k").collect()} == ranked(rows)


@pytest.mark.parametrize("name", COUNTS)
def test_top_by_count(spark, name, piece_rows):
    rows = COUNTS[name]
    table = spark.createDataFrame(rows, "k string, n bigint").repartition(5)
    for k in (3, 250):
        got = {r.k: r.rank for r in ops.top_by_count(table, "k", k).collect()}
        assert got == {key: rank for key, rank in ranked(rows).items() if rank <= k}


def test_a_common_count_is_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(histograms, "PIECE_ROWS", 512)
    table = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit(1).alias("n"))
    sizes = [r["count"] for r in histograms._pieces(table, "n", F.col("k")).groupBy("__piece").count().collect()]
    assert sum(sizes) == 20_000 and 20 < len(sizes) < 60 and max(sizes) < 5 * 512


def test_a_hot_group_is_cut_into_pieces(spark, monkeypatch):
    """One group of 95% of the rows: no piece, which is what a task sorts, has more than a fair part."""
    monkeypatch.setattr(histograms, "PIECE_ROWS", 512)
    group = F.when(F.col("id") % 20 == 0, F.col("id") % 7).otherwise(F.lit(99))
    table = spark.range(20_000).select(group.alias("g"), F.hash("id").alias("v"), F.col("id").alias("k"))
    order = F.struct(F.col("v").isNull(), F.bitwise_not("v"), F.col("k"))
    pieces = histograms._pieces(table, "g", order).groupBy("g", "__piece").count().collect()
    assert len([r for r in pieces if r.g == 99]) > 20 and max(r["count"] for r in pieces) < 5 * 512
    # The layout of the job itself: rows that each task gets to sort.
    shuffled = histograms._pieces(table, "g", order).repartition(40, "g", "__piece")
    loads = [r["count"] for r in shuffled.groupBy(F.spark_partition_id()).count().collect()]
    assert max(loads) < 20_000 / 5


@pytest.mark.parametrize("first", [None, 3, 1200])
def test_rank_by_value_in_groups(spark, piece_rows, first):
    draw = random.Random(7)
    rows = [(draw.choice(["a", "b", None]) if i % 20 else "hot", draw.choice([None, 1.5, 2.0, float(i)]), i) for i in range(3000)]
    rows += [("hot", 9.0, 5000 + i) for i in range(3000)]
    table = spark.createDataFrame(rows, "g string, v double, k int").repartition(5)
    want = {}
    for g in {g for g, _, _ in rows}:
        for k, rank in ranked([(k, v) for h, v, k in rows if h == g]).items():
            if first is None or rank <= first:
                want[g, k] = rank
    got = ops.rank_by_value_in_groups(table, "g", "v", "k", first=first)
    assert got.columns == ["g", "v", "k", "rank"]
    assert {(r.g, r.k): r.rank for r in got.collect()} == want


def test_decimals_and_smallest_numbers(spark):
    table = spark.sql("select 1 g, cast(v as decimal(38,0)) v, k from values (-9, 'a'), (9, 'b'), (null, 'c') t(v, k)")
    assert [r.k for r in ops.rank_by_value_in_groups(table, "g", "v", "k").orderBy("rank").collect()] == ["b", "a", "c"]
    table = spark.sql("select 1 g, v, k from values (-9223372036854775808L, 'a'), (9223372036854775807L, 'b'), (null, 'c') t(v, k)")
    assert [r.k for r in ops.rank_by_value_in_groups(table, "g", "v", "k").orderBy("rank").collect()] == ["b", "a", "c"]
    with pytest.raises(TypeError):
        ops.rank_by_value_in_groups(table, "g", "k", "k")


def test_no_checkpoint_and_one_scan(spark, tmp_path):
    path = str(tmp_path / "words")
    spark.range(3000).selectExpr("concat('w', id % 700) word").write.parquet(path)
    words = spark.read.parquet(path).groupBy("word").agg(F.count("*").alias("n"))
    for frame in (ops.rank_by_count(words, "word"), ops.top_by_count(words, "word", 10)):
        plan = plan_of(frame)
        assert "ExistingRDD" not in plan and "InMemoryTableScan" not in plan and "CartesianProduct" not in plan
        assert "REPARTITION_BY_NUM" not in plan and "rangepartitioning" not in plan
        frame.collect()
        final = plan_of(frame).split("== Initial Plan ==")[0]
        # Spark shuffles the words once; the histogram, the sample and the result read that shuffle.
        assert final.count("Scan parquet") <= 2 and final.count("ReusedExchange") >= 2, final


def test_generic_lists_measure_their_buckets(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 100)
    group = F.when(F.col("id") % 20 == 0, F.col("id") % 3).otherwise(F.lit(None))
    table = spark.range(5000).select(group.alias("g"), F.hash("id").alias("v"), F.col("id").alias("k"))
    order = [F.desc("v"), F.asc("k")]
    want = {r.k for r in table.orderBy(*order).limit(30).collect()}
    assert {r.k for r in ops.top_k(table, order, 30).collect()} == want
    got = {(r.g, r.k): r.rank for r in ops.top_n_per_group(table, "g", order, 5).collect()}
    every = {(r.g, r.k): r.rank for r in ops.rank_in_groups(table, "g", order).collect()}
    assert got == {key: rank for key, rank in every.items() if rank <= 5}


def test_rows_are_shuffled_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(3000).selectExpr("id k", "id % 50 n", "id % 7 g").write.parquet(path)
    table = spark.read.parquet(path)
    for frame in (ops.rank_by_count(table, "k"), ops.rank_by_value_in_groups(table, "g", "n", "k")):
        row_shuffles = [line for line in plan_of(frame).splitlines() if "Exchange hashpartitioning" in line and "__piece" in line]
        assert all("isnull" not in line and "coalesce" not in line for line in row_shuffles)
        # The rows' own, and those of counts by piece.
        assert len(row_shuffles) <= 3, row_shuffles
