"""Small reusable transforms on order values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.exact import round2


def with_order_value(df: DataFrame) -> DataFrame:
    """Add ``total_order_value``; NULL when either part is NULL."""
    total = round2(F.col("product_revenue") + F.col("freight_revenue"))
    return df.withColumn("total_order_value", total)


def negative_order_values(df: DataFrame) -> DataFrame:
    return df.filter(F.col("total_order_value") < 0)


def valid_order_values(df: DataFrame) -> DataFrame:
    """Orders with a known, non-negative total, computed on the way."""
    return df.transform(with_order_value).filter(F.col("total_order_value") >= 0)
