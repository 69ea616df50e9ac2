"""Queries that write lines to files and read them again: a larger table makes more files, not larger ones."""

import os

import pytest

from conftest import plan_of
from ledgerbrook import sinks, sources
from ledgerbrook.plans import registry

PARTS = 8


@pytest.fixture()
def tables(spark, tmp_path):
    """Tables of several files, each of which is a partition."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, 1 << 20)
    item = spark.range(0, 4000, 1, PARTS).selectExpr(
        "id % 97 AS l_partkey", "id AS l_suppkey", "cast(1 + id % 7 AS int) AS l_linenumber",
        "id / 4 AS l_extendedprice", "substr('RAN', cast(1 + id % 3 AS int), 1) AS l_returnflag",
        "timestamp'1996-01-01' + make_dt_interval(cast(id % 50 AS int)) AS l_shipdate",
    )
    item.write.parquet(f"{tmp_path}/lineitem.parquet")
    docs = spark.range(0, 1000, 1, PARTS).selectExpr(
        "id AS doc_id", "concat('line ', id, '\n', 'and ', id) AS text", "'en' AS lang", "concat('s', id % 3) AS source"
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    yield str(tmp_path)
    for name, value in before.items():
        spark.conf.set(name, value)


def files_of(folder):
    """The number of lines in each file."""
    names = [name for name in os.listdir(folder) if name.startswith("part-")]
    return [sum(1 for _ in open(os.path.join(folder, name), encoding="utf-8")) for name in names]


QUERIES = [
    "balance_files_with_own_headers",
    "count_and_rank_headers_as_data",
    "daily_flow_in_increments",
    "balance_files_first_lines_skipped",
    "news_records_over_lines",
]


@pytest.mark.parametrize("name", QUERIES)
def test_no_file_holds_more_than_a_partition(spark, tables, monkeypatch, name):
    written, write = [], sinks.write_lines

    def noted(lines, path, **options):
        written.append(path.removeprefix("file://"))
        write(lines, path, **options)

    monkeypatch.setattr(sinks, "write_lines", noted)
    assert registry.QUERIES[name](spark, tables).count() > 0
    for folder in written:
        sizes = files_of(folder)
        assert len(sizes) >= PARTS
        assert max(sizes) <= 1.25 * sum(sizes) / PARTS


def test_lines_stay_where_they_were_read_when_their_header_is_found(spark, write, tmp_path):
    write("in/a.csv", "head\n1\nhead\n2\n")
    write("in/b.csv", "other\nhead\n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    kept = sources.without_own_header(sources.read_lines(spark, str(tmp_path / "in"), positions=True))
    assert "BroadcastHashJoin" in plan_of(kept) and "SortMergeJoin" not in plan_of(kept)
    assert sorted(r.value for r in kept.collect()) == ["1", "2", "head"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
