"""Logical tables laid over the TPC-H-like Parquet tables, and raw lines made from them.

Amounts are whole cents, as in the balance file.  Everything here is a projection:
no shuffle, and only the columns a query uses are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import day_key, text_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: str) -> Column:
    return F.floor(F.col(amount) * 100 + 0.5)


def lineitem_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per line item: every price flows in, returned prices also flow out."""
    price = cents("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("user_id"),
        F.col("l_shipdate").cast("date").alias("report_date"),
        price.alias("total_purchase_amt"),
        F.when(F.col("l_returnflag") == "R", price).alias("total_redeem_amt"),
    )


def orders_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order: open orders flow in, finished ones flow out, others move nothing (NULL)."""
    price = cents("o_totalprice")
    opened = F.when(F.col("o_orderstatus") == "O", price)
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("report_date"),
        price.alias("tBalance"),
        opened.alias("total_purchase_amt"),
        opened.alias("direct_purchase_amt"),
        F.when(F.col("o_orderstatus") == "F", price).alias("total_redeem_amt"),
    )


def events_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per event: purchases count as direct purchases, sign-ups as redemptions."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.col("ts").cast("date").alias("report_date"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("direct_purchase_amt"),
        F.when(F.col("event_type") == "signup", F.col("value")).alias("total_redeem_amt"),
    )


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: the nation is the city, the market segment the group."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_nationkey").cast("bigint").alias("City"),
        F.col("c_mktsegment").alias("constellation"),
        cents("c_acctbal").alias("tBalance"),
    )


def documents_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per line of a document: the line is the headline, the source the stock."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("stock"), F.explode(text_lines(F.col("text"))).alias("headline")
    )


def news_lines(spark: SparkSession, sf_dir: str, *, quoted: bool = False) -> DataFrame:
    """Raw four-field news lines, the stock padded with blanks and a tab."""
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.explode(text_lines(F.col("text"))).alias("line")
    )
    headline = F.col("line")
    if quoted:
        headline = F.concat(F.lit('"'), F.replace("line", F.lit('"'), F.lit('""')), F.lit('"'))
    stock = F.concat(F.lit(" "), F.col("source"), F.lit("\t "))
    return lines.select(F.concat_ws(",", "doc_id", headline, "lang", stock).alias("value"))


def clean_balance_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw balance lines in which every field is well formed."""
    item = table(spark, sf_dir, "lineitem")
    price = cents("l_extendedprice").cast("string")
    zero = F.lit("0")
    return item.select(
        F.concat_ws(
            ",",
            "l_partkey",
            day_key(F.col("l_shipdate")),
            zero,
            zero,
            price,
            F.when(F.col("l_returnflag") == "A", price).otherwise(zero),
            zero,
            zero,
            F.when(F.col("l_returnflag") == "R", price).otherwise(zero),
        ).alias("value")
    )


def dirty_balance_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw balance lines of 11 fields with empty, padded and bad values and repeated headers.

    By line number, the purchase is: 1 empty, 2 a word, 3 padded with blanks, 4 the header's
    own name.  Returned items redeem the price, accepted ones have a bad redeem value when
    shipped to supplier 7, and the others end in nothing but empty fields.
    """
    item = table(spark, sf_dir, "lineitem")
    price = cents("l_extendedprice").cast("string")
    number = F.col("l_linenumber")
    purchase = (
        F.when(number == 1, F.lit(""))
        .when(number == 2, F.lit("abc"))
        .when(number == 3, F.concat(F.lit(" "), price, F.lit(" ")))
        .when(number == 4, F.lit("total_purchase_amt"))
        .otherwise(price)
    )
    redeem = (
        F.when(F.col("l_returnflag") == "R", price)
        .when((F.col("l_returnflag") == "A") & (F.col("l_suppkey") == 7), F.lit("x1"))
        .when(F.col("l_returnflag") == "A", F.lit("0"))
        .otherwise(F.lit(""))
    )
    filler = F.lit("9")
    empty = F.lit("")
    return item.select(
        F.concat_ws(
            ",",
            "l_partkey",
            day_key(F.col("l_shipdate")),
            filler,
            filler,
            purchase,
            filler,
            filler,
            filler,
            redeem,
            empty,
            empty,
        ).alias("value")
    )


def worse_balance_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dirty_balance_lines``, and every fifth user's lines are of a month that is none."""
    return dirty_balance_lines(spark, sf_dir).select(
        F.regexp_replace("value", "^([0-9]*[05]),[0-9]{4}[0-9]{2}", "$1,199613").alias("value")
    )


def profile_lines(spark: SparkSession, sf_dir: str, group: Column) -> DataFrame:
    """Raw profile lines of the customers, with some group."""
    person = F.concat_ws(",", "c_custkey", F.lit("1"), "c_nationkey", group, F.lit(""))
    return table(spark, sf_dir, "customer").select(person.alias("value"))


def broken_news_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quoted record per document, its headline being the first three lines of the text with the breaks in it.

    A row holds a whole record, so that a text file of them holds records of several lines.
    """
    lines = F.slice(F.filter(text_lines(F.col("text")), lambda line: line != ""), 1, 3)
    headline = F.concat(F.lit('"'), F.replace(F.array_join(lines, "\n"), F.lit('"'), F.lit('""')), F.lit('"'))
    record = F.concat_ws(",", "doc_id", headline, "lang", "source")
    return table(spark, sf_dir, "documents").select(record.alias("value"))
