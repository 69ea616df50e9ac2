"""Fund-flow, activity, balance and headline analytics on PySpark DataFrames."""

__version__ = "0.1.0"
