"""Top rows, overall and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of every group.

    The filter on the rank lets Spark cut each group to ``k`` rows before the shuffle (window group limit), so a group
    that holds a third of the table sends only ``k`` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def newest(df: DataFrame, n: int, date: str = "date_scraping", tie: str = "id_offre") -> DataFrame:
    """Most recent rows; missing dates count as the most recent."""
    return df.orderBy(F.col(date).desc_nulls_first(), F.col(tie)).limit(n)


def top_counts(df: DataFrame, key: str, n: int | None = None, count: str = "count") -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    counted = df.groupBy(key).agg(F.count("*").alias(count)).orderBy(F.col(count).desc(), key)
    return counted if n is None else counted.limit(n)
