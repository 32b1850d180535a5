"""Partitions of a fact by the month of its timestamp (L2), and the predicates by
which a time range prunes them (F-5, F-4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Partition columns that a fact gets beside its own.
YEAR, MONTH = "part_year", "part_month"
MONTH_PARTS = (YEAR, MONTH)


def with_month(df: DataFrame, ts_col: str = "date") -> DataFrame:
    """The frame with its partition columns."""
    return df.withColumn(YEAR, F.year(ts_col)).withColumn(MONTH, F.month(ts_col))


def has_month(df: DataFrame) -> bool:
    return all(c in df.columns for c in MONTH_PARTS)


def month_range(start: Column, end: Column) -> Column:
    """Which partitions may hold timestamps from ``start`` to ``end``."""
    y, m = F.col(YEAR), F.col(MONTH)
    after = (y > F.year(start)) | ((y == F.year(start)) & (m >= F.month(start)))
    before = (y < F.year(end)) | ((y == F.year(end)) & (m <= F.month(end)))
    # the years alone as well: they are what most stores can list by
    return y.between(F.year(start), F.year(end)) & after & before
