"""Delimited staging (S1), run-parameter paths (S4) and the load-error report.

Options follow the reference's ``COPY ... delimiter '|' IGNOREHEADER 1`` with no
quote, NULL or error-limit option: quoting off (a stray ``"`` must not swallow a
delimiter), ``\\N`` as the NULL marker, and FAILFAST. The CSV parser's column
pruning is switched off in the session (``starloom.session``) so a bad value in
a column the query does not use still fails the read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.schemas import TableSchema
from starloom.session import configure

NULL_MARKER = "\\N"
RAW = "_raw_line"
#: Anything but control characters and blanks: a line without is no row.
_INK = "[^\\x00-\\x20]"


def render_path(template: str, **params) -> str:
    """``s3_key.format(**context)``: fill run parameters into a path."""
    return template.format(**params)


def _csv_options(sep: str, header: bool) -> dict[str, str]:
    return {
        "sep": sep,
        "header": str(header).lower(),
        "quote": "",
        "nullValue": NULL_MARKER,
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


def stage_delimited(
    spark: SparkSession, path: str | list[str], schema: TableSchema, sep: str = "|", header: bool = True,
    params: dict | None = None,
) -> DataFrame:
    """Typed read of delimited files with the declared schema; any bad line fails."""
    configure(spark)
    if params:
        path = [render_path(p, **params) for p in path] if isinstance(path, list) else render_path(path, **params)
    return (
        spark.read.schema(schema.struct())
        .options(**_csv_options(sep, header))
        .option("mode", "FAILFAST")
        .csv(path)
    )


def numbered_lines(spark: SparkSession, path: str | list[str], wanted: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The lines of text files that ``wanted`` keeps of a frame (value, ...), as read, with
    their number from 1 in their file and ``header_number``, that of the file's first
    line that is not blank.

    A file is read in splits by many tasks. A line's place in its split is known where
    it is read; the lines of each split are counted, one row per split, and the kept
    lines alone meet the sum of the splits before theirs.
    """
    lines = spark.read.text(path).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    inked = F.min(F.when(F.col("value").rlike(_INK), F.col("_at")))
    splits = lines.groupBy("file_path", "_start").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_lines"), (inked - F.min("_at")).alias("_inked")
    )
    file = Window.partitionBy("file_path").orderBy("_start")
    before = F.coalesce(F.sum("_lines").over(file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.withColumn("_before", before).withColumn(
        "header_number", F.min(F.col("_before") + F.col("_inked") + 1).over(Window.partitionBy("file_path"))
    )
    return (
        wanted(lines).join(splits, ["file_path", "_start"])
        .withColumn("line_number", F.col("_before") + F.col("_at") - F.col("_first") + 1)
        .drop("_start", "_at", "_first", "_lines", "_inked", "_before")
    )


def load_errors(
    spark: SparkSession, path: str | list[str], schema: TableSchema, sep: str = "|", header: bool = True
) -> DataFrame:
    """Lines that do not fit the declared schema, newest file first: (file_path,
    file_modified, line_number, raw_line, column_name, reason). The reason is the first
    of: a wrong number of fields, a value that is not of its column's type, NULL in a
    NOT NULL column, a text beyond its column's length.

    The line is the file's own, NULL markers and blanks included, its number counts
    from 1 over all lines. Blank lines are no rows and so no errors, as in staging.
    The files are read twice, for the lines and for the counts; only bad lines move.
    """
    configure(spark)
    fields = [T.StructField(n, T.StringType(), True) for n in schema.names]
    texts = T.StructType([*fields, T.StructField(RAW, T.StringType(), True)])
    options = {**_csv_options(sep, False), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW}

    def of(name: str) -> Column:
        return F.col("_row").getField(name)

    rules = [(of(RAW).isNotNull(), F.lit(None).cast("string"), "wrong number of fields")]
    for c in schema.columns:
        value = of(c.name)
        typed = value.try_cast(c.dtype)
        rules.append((value.isNotNull() & typed.isNull(), F.lit(c.name), f"not a {c.dtype.simpleString()}"))
        if not c.nullable:
            rules.append((value.isNull(), F.lit(c.name), "NULL in a NOT NULL column"))
        if c.max_len is not None and isinstance(c.dtype, T.StringType):
            rules.append((F.char_length(value) > c.max_len, F.lit(c.name), f"longer than {c.max_len}"))
    found = F.lit(None).cast("struct<column_name: string, reason: string>")
    for bad, column, reason in reversed(rules):
        found = F.when(bad, F.struct(column.alias("column_name"), F.lit(reason).alias("reason"))).otherwise(found)

    def bad_lines(lines: DataFrame) -> DataFrame:
        parsed = lines.where(F.col("value").rlike(_INK)).withColumn("_row", F.from_csv("value", F.lit(texts.toDDL()), options))
        return parsed.withColumn("_found", found).where("_found is not null").drop("_row")

    lines = numbered_lines(spark, path, bad_lines)
    if header:
        lines = lines.where("line_number <> header_number")
    return lines.select(
        "file_path", "file_modified", "line_number", F.col("value").alias("raw_line"), "_found.column_name", "_found.reason"
    ).orderBy(F.col("file_modified").desc(), "file_path", "line_number")
