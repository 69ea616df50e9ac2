"""Logical tables.  Readers declare these types and never infer them."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and positions of the balance file.
BALANCE_POSITIONS = {
    "user_id": 0,
    "report_date": 1,
    "total_purchase_amt": 4,
    "direct_purchase_amt": 5,
    "total_redeem_amt": 8,
}
BALANCE_MIN_FIELDS = 9

# Positions in the profile file.
PROFILE_POSITIONS = {"user_id": 0, "constellation": 3}

# The news file has four fields; the two unused ones have no known name.
NEWS_FIELDS = 4
NEWS_POSITIONS = {"headline": 1, "stock": 3}

BALANCE = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("report_date", T.DateType()),
        T.StructField("tBalance", T.LongType()),
        T.StructField("total_purchase_amt", T.LongType()),
        T.StructField("direct_purchase_amt", T.LongType()),
        T.StructField("total_redeem_amt", T.LongType()),
    ]
)

PROFILE = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("City", T.LongType()),
        T.StructField("constellation", T.StringType()),
    ]
)

NEWS = T.StructType(
    [
        T.StructField("field_0", T.StringType()),
        T.StructField("headline", T.StringType()),
        T.StructField("field_2", T.StringType()),
        T.StructField("stock", T.StringType()),
    ]
)

DAILY_FLOW = T.StructType(
    [
        T.StructField("report_date", T.StringType()),
        T.StructField("total_purchase_amt", T.LongType()),
        T.StructField("total_redeem_amt", T.LongType()),
    ]
)
