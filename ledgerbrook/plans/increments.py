"""Daily sums that grow with the input: a run reads only files that no earlier run has added.

A state folder holds ``sums`` (one row per day and increment: sums and the number of rows) and ``files``
(each file that an increment has read).  An increment counts once its files are listed, in one file
that is written last: a run that died half-way leaves sums that nobody reads, and the next
run adds its files.  One run at a time writes to a state.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as ops
from .. import sources

_AMOUNTS = ("total_purchase_amt", "total_redeem_amt")
_FILES = "file string, increment string"


_SUMS = (
    "report_date string, total_purchase_amt decimal(38,0), total_redeem_amt decimal(38,0), n_rows bigint, increment string"
)


def _opened(spark: SparkSession, state: str, name: str, schema: str) -> DataFrame:
    """One of the tables of a state, which is empty at first."""
    path = f"{state.rstrip('/')}/{name}"
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def added_files(spark: SparkSession, state: str) -> DataFrame:
    """``file, increment`` of everything that counts."""
    return _opened(spark, state, "files", _FILES)


def new_files(spark: SparkSession, paths: str | Sequence[str], state: str) -> list[str]:
    """The files below ``paths`` that are not in the state.  Spark lists them on the driver in any case."""
    listed = spark.read.text(paths if isinstance(paths, str) else list(paths)).inputFiles()
    found = spark.createDataFrame([(name,) for name in sorted(set(listed))], "file string")
    return sorted(row.file for row in found.join(added_files(spark, state), "file", "left_anti").collect())


def add_balance_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    state: str,
    *,
    rules: sources.LineRules = sources.ZERO_BAD_VALUES,
    header_line: str | None = None,
) -> int:
    """Add the sums of the files that are new; returns how many there were.

    Amounts are whole numbers (``rules.amount_type`` is ``bigint``), so that sums do not depend on what was
    added when.
    """
    if rules.amount_type != "bigint":
        raise ValueError("increments need whole amounts")
    files = new_files(spark, paths, state)
    if not files:
        return 0
    rows = sources.read_balance(spark, files, rules, header_line=header_line)
    sums = rows.groupBy("report_date").agg(
        *[ops.total(rows, name).alias(name) for name in _AMOUNTS], F.count("*").alias("n_rows")
    )
    name = uuid.uuid4().hex
    _opened(spark, state, "sums", _SUMS)
    sums.withColumn("increment", F.lit(name)).write.mode("append").parquet(f"{state.rstrip('/')}/sums")
    listed = spark.createDataFrame([(file, name) for file in files], _FILES).coalesce(1)
    listed.write.mode("append").parquet(f"{state.rstrip('/')}/files")
    return len(files)


def flow_state(spark: SparkSession, state: str) -> DataFrame:
    """``report_date``, sums and number of rows of every increment that counts."""
    files = added_files(spark, state)
    sums = _opened(spark, state, "sums", _SUMS)
    # One row per increment; whichever side is small is for Spark to see.
    return sums.join(files.select("increment").distinct(), "increment", "left_semi").drop("increment")


def daily_flow_of(spark: SparkSession, state: str) -> DataFrame:
    """``ops.daily_flow`` of all files added so far, from their sums."""
    return ops.daily_flow(flow_state(spark, state))


def average_row_of(spark: SparkSession, state: str) -> DataFrame:
    """Average inflow and outflow of a row, per day: sums and counts merge, averages would not."""
    days = flow_state(spark, state).groupBy("report_date")
    rows = F.sum("n_rows").cast("double")
    return days.agg(*[(F.sum(name).cast("double") / rows).alias(f"avg_{name}") for name in _AMOUNTS])
