"""Ordered output: top-k by a column, a nested field or a derived key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, *order: str | Column) -> DataFrame:
    """The first ``k`` rows in an order; nested fields are named with dots."""
    return df.orderBy(*order).limit(k)


def top_k_by_key(df: DataFrame, k: int, key: Column, *ties: str | Column) -> DataFrame:
    """As ``top_k`` on an expression that is not part of the result."""
    return df.withColumn("__key", key).orderBy("__key", *ties).limit(k).drop("__key")


def report_order(df: DataFrame, key: str = "charge_point_id") -> DataFrame:
    return df.orderBy(F.asc(key))
