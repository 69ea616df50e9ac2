"""A corpus made ready for training: five stages, each written as Parquet and read as the next one's input.

Every stage takes (spark, docs, sf_dir).  All but the last return the columns of ``docs``, whatever
they are; ``text`` and ``n_chars`` follow what a stage does to a text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerbrook.llm import bpe, decontaminate, jaccard_join, quality, suffix_dedup
from ledgerbrook.llm.tables import saved


def _packed(docs: DataFrame) -> DataFrame:
    """``row`` (all columns) and ``text``: nothing an operator adds can clash with a column."""
    return docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), F.col("text"))


def _with_text(docs: DataFrame, columns: list[str], text: Column) -> DataFrame:
    """The columns of ``row`` again, with another text."""
    docs = docs.withColumn("text", text)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return docs.select(*[new.get(name, F.col(f"row.`{name}`")).alias(name) for name in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail the rules go, and so do documents that are rejected."""
    judged = quality.judge(_packed(docs)).where("kept")
    return _with_text(judged, docs.columns, F.col("clean_text"))


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays; of repeated rows, one."""
    key = F.xxhash64("doc_id", "text")
    named = docs.select(F.struct(F.col("doc_id"), key.alias("key")).alias("id"), "text")
    groups = jaccard_join.jaccard_components(named, id="id")
    stay = groups.where("id <=> component_id").groupBy(F.col("id.key").alias("key"))
    stay = stay.agg(F.max("n_shingles").alias("n"))
    rows = _packed(docs).select("row", F.xxhash64("row.doc_id", "text").alias("key")).join(stay, "key")
    number = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row")))
    rows = rows.withColumn("number", number).where("number = 1 or n = 0")
    return rows.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated 200-byte strings go from the texts; a character of which bytes are left goes, too."""
    cut = suffix_dedup.remove_repeated_bytes(_packed(docs), id="row")
    return _with_text(cut, docs.columns, _valid(F.col("kept")))


def _valid(raw: Column) -> Column:
    """Bytes as text, without the bytes that make no character."""
    marked = F.call_function("make_valid_utf8", raw.cast("string"))
    return F.when(F.call_function("is_valid_utf8", raw.cast("string")), raw.cast("string")).otherwise(
        F.replace(marked, F.lit("�"), F.lit(""))
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with a digest of what they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    give = ["n_tokens", "ids", "decoded_sha256"]
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"], give=give)


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_dedup", jaccard_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

# The join's components and the byte pairs are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
