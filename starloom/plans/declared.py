"""Declared tables in the session catalog (C2, C3): created if absent from a
``TableSchema``, with ``VARCHAR(n)`` and NOT NULL, and filled by ``insertInto``.

Unlike ``plans.tables``, which versions directories, these are ordinary Spark tables
that SQL can name. Spark itself checks what is written to them: a text beyond its
declared length fails the write. NOT NULL is part of the declared schema; Spark's file
tables do not check it, so ``insert_rows`` guards those columns in the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.schemas import Col, TableSchema
from starloom.session import configure


def _type(c: Col) -> str:
    if isinstance(c.dtype, T.StringType) and c.max_len is not None:
        return f"VARCHAR({c.max_len})"
    return c.dtype.simpleString().upper()


def table_ddl(schema: TableSchema, name: str | None = None, partition_by: Sequence[str] = (), location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` of a declared schema."""
    unknown = [c for c in partition_by if c not in schema.names]
    if unknown:
        raise ValueError(f"{schema.name} has no columns {unknown}")
    columns = ", ".join(f"`{c.name}` {_type(c)}" + ("" if c.nullable else " NOT NULL") for c in schema.columns)
    out = f"CREATE TABLE IF NOT EXISTS {quoted(name or schema.name)} ({columns}) USING parquet"
    if partition_by:
        out += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
    if location is not None:
        out += " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return out


def quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def create_table(
    spark: SparkSession, schema: TableSchema, name: str | None = None, partition_by: Sequence[str] = (),
    location: str | None = None, recreate: bool = False,
) -> str:
    """The table's name. Its database is created if absent; ``recreate`` drops the table
    first (C3), which leaves the files of a table with a ``location`` where they are."""
    configure(spark)
    name = name or schema.name
    database, _, _ = name.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    if recreate:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    spark.sql(table_ddl(schema, name, partition_by, location))
    return name


def insert_rows(df: DataFrame, schema: TableSchema, name: str | None = None, overwrite: bool = False) -> DataFrame:
    """Insert a frame by its columns' names, not their places, under Spark's strict
    rules for types; a NULL in a NOT NULL column fails the write. Returns the table."""
    spark = df.sparkSession
    name = name or schema.name
    table = spark.table(quoted(name))
    missing = [c for c in schema.names if c not in df.columns]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")

    def guarded(c: Col):
        value = F.col(f"`{c.name}`")
        if c.nullable:
            return value.alias(c.name)
        message = F.lit(f"NULL in the NOT NULL column {name}.{c.name}")
        return F.when(value.isNull(), F.raise_error(message)).otherwise(value).alias(c.name)

    # a partitioned table has its partition columns last
    own = {c.name: guarded(c) for c in schema.columns}
    df.select(*[own[n] for n in table.columns]).write.insertInto(quoted(name), overwrite=overwrite)
    return spark.table(quoted(name))
