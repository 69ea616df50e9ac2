"""The registered text queries on the small tables, with their SQL, and the pipeline's stages."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SMALL
from ledgerbrook.llm import registry


def shown(rows):
    return sorted((tuple(row) for row in rows), key=repr)


def test_each_operator_has_a_query():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {f"{name.split('_')[0]}_" for name in registry.QUERIES}
    assert set(registry.QUERIES) | {"pipeline"} <= names


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations", "labels", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    frame = registry.QUERIES[name](spark, SMALL)
    cursor = connection.execute(registry.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert shown(frame.select(*columns).collect()) == shown(cursor.fetchall())


@pytest.mark.parametrize("name", sorted(registry.VIEWS))
def test_view_matches_its_sql(spark, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    cursor = connection.execute(registry.VIEW_ORACLES[name])
    columns = [c[0] for c in cursor.description]
    frame = registry.VIEWS[name](spark, SMALL)
    assert sorted(columns) == sorted(frame.columns)
    assert shown(frame.select(*columns).collect()) == shown(cursor.fetchall())
    assert name in entry.queries() and name in entry.oracle_sql()


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumnRenamed("source", "key")
    odd = spark.createDataFrame([(None, None, None, None, None)] * 2, docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.limit(5))
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert 0 < docs.count() <= before
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert docs.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    assert docs.where("doc_id is null").count() == 0


def test_pipeline_keeps_one_of_a_group(spark):
    rows = [(i, "same text of a few words that is long enough", "en", "s", 44) for i in (3, 2, 2, None)]
    rows += [(4, None, "en", "s", 0), (4, None, "en", "s", 0), (5, "something else altogether for this one", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.jaccard_dedup(spark, docs, SMALL)
    assert len([r for r in kept.collect() if r.text and r.text.startswith("same")]) == 1
    assert kept.where("text is null").count() == 2 and kept.where("doc_id = 5").count() == 1


def test_pipeline_on_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0
