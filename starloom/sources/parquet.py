"""Parquet staging (S2): read, then conform to the declared schema by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.operators.conform import conform
from starloom.schemas import TableSchema
from starloom.session import configure
from starloom.sources.delimited import render_path


def stage_parquet(
    spark: SparkSession, path: str, schema: TableSchema, validate: str = "lazy", params: dict | None = None
) -> DataFrame:
    configure(spark)
    if params:
        path = render_path(path, **params)
    return conform(spark.read.parquet(path), schema, validate=validate)
