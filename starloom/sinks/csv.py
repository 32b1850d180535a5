"""CSV export (X1, X2): header, no index, overwrite, bytes as a pandas export.

Timestamps as ``yyyy-MM-dd HH:mm:ss``, with a fraction where it is not zero, quotes doubled, NULL and '' both empty,
leading and trailing blanks kept. Spark writes one directory of part files per
table from the executors; ``single_file`` coalesces to one task and is meant for
small tables only. ``export_csv_file`` writes one file of any size: the parts are
written by all tasks and put behind one another by the store, or copied as a stream
where the store cannot.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import configure

CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

CSV_READ_OPTIONS = {
    "header": "true",
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "mode": "FAILFAST",
}


def timestamp_text(ts: Column) -> Column:
    """A timestamp as text; the fraction appears only where it is not zero."""
    whole = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return F.when(F.date_format(ts, "SSSSSS") == "000000", whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def with_timestamp_text(df: DataFrame) -> DataFrame:
    """The frame with its timestamp columns as text."""
    stamps = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType)}
    cols = [F.col(f"`{c}`") for c in df.columns]
    return df.select(*[timestamp_text(x).alias(c) if c in stamps else x for c, x in zip(df.columns, cols, strict=True)])


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    out = df.coalesce(1) if single_file else df
    with_timestamp_text(out).write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)


def export_csv_file(df: DataFrame, path: str) -> str:
    """One CSV file at ``path`` itself, with the bytes of ``export_csv(single_file=True)``;
    how the parts came together (``concat`` or ``copy``).

    Parts without a header lie in a scratch folder beside it until the file stands
    whole under a name of its own, which then takes the place of an older export. So a
    reader sees the old file or the new one. A copy holds one buffer at a time.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    work = jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}-{uuid.uuid4().hex[:12]}")
    folder = jvm.org.apache.hadoop.fs.Path(work, "parts")
    try:
        with_timestamp_text(df).write.options(**{**CSV_WRITE_OPTIONS, "header": "false"}).csv(folder.toString())
        head = spark.createDataFrame([tuple(df.columns)], ", ".join(f"c{i} string" for i in range(len(df.columns))))
        top = jvm.org.apache.hadoop.fs.Path(work, "header")
        head.coalesce(1).write.options(**{**CSV_WRITE_OPTIONS, "header": "false"}).csv(top.toString())
        parts = [f for p in (top, folder) for f in _part_files(fs, p)]
        whole, how = parts[0], "concat"
        if len(parts) > 1:
            try:
                fs.concat(whole, _java_array(spark, jvm.org.apache.hadoop.fs.Path, parts[1:]))
            except UnsupportedOperationException:
                whole, how = jvm.org.apache.hadoop.fs.Path(work, "whole"), "copy"
                out = fs.create(whole, False)
                for f in parts:
                    stream = fs.open(f)
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
                    stream.close()
                out.close()
        if fs.exists(at):
            fs.delete(at, True)
        if not fs.rename(whole, at):
            raise OSError(f"cannot move the export to {path}")
        return how
    finally:
        fs.delete(work, True)


def _part_files(fs, folder) -> list:
    found = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-") and s.getLen() > 0]
    return sorted(found, key=lambda p: p.getName())


def _java_array(spark: SparkSession, kind, items: list):
    out = spark.sparkContext._gateway.new_array(kind, len(items))
    for i, item in enumerate(items):
        out[i] = item
    return out


def read_exported_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read an export back; a line that does not fit the schema fails the read.

    A file of any size is read by many tasks. Spark's ``multiLine`` reads it in one, so
    it is asked for nowhere: where no record goes over a line's end, lines are records,
    and otherwise lines are put together to records first (``_records``).
    """
    configure(spark)
    lines = _lines(spark, path)
    # a blank line or a lone carriage return is told apart only by whole records
    seen = lines.agg(F.max((_quotes() % 2 == 1) | F.col("value").rlike(r"^[\x00-\x20]*$|\r"))).first()[0]
    if not seen:
        line = {**CSV_READ_OPTIONS, "multiLine": "false", "lineSep": "\n"}
        return spark.read.schema(schema).options(**line).csv(path)
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    names = ", ".join("`{}` {}".format(f.name.replace("`", "``"), f.dataType.simpleString()) for f in fields)
    options = {k: v for k, v in CSV_READ_OPTIONS.items() if k != "header"} | {"lineSep": "\n"}
    return _records(lines).select(F.from_csv("record", names, options).alias("r")).select("r.*")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Each line with its file, the file's block that a task reads, and a number rising in it."""
    return spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("no"),
    )


def _quotes() -> Column:
    return F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))


def _records(lines: DataFrame) -> DataFrame:
    """The records of files with a header, whose quoted values may hold line ends.

    A line begins a record where the quotes before it in its file are even. They are
    summed in each block, and over the blocks of a file (a row a block); so is the
    number of the record that the line belongs to.
    """
    file, block = ["file"], ["file", "block"]
    earlier = Window.partitionBy(*file).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy(*block).orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def before(df: DataFrame, column: str, name: str) -> DataFrame:
        sums = df.groupBy(*block).agg(F.sum(column).alias("n"))
        return df.join(F.broadcast(sums.select(*block, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(name))), block)

    quoted = before(lines.withColumn("quotes", _quotes()), "quotes", "outside")
    ahead = F.col("outside") + F.sum("quotes").over(so_far) - F.col("quotes")
    begun = before(quoted.withColumn("begins", F.when(ahead % 2 == 0, 1).otherwise(0)), "begins", "records")
    numbered = begun.withColumn("record_no", F.col("records") + F.sum("begins").over(so_far))
    parts = F.sort_array(F.collect_list(F.struct("block", "no", "value")))
    text = F.concat_ws("\n", F.transform(parts, lambda x: x["value"]))
    # the first is the header; Spark skips empty lines
    whole = numbered.where("record_no > 1").groupBy("file", "record_no").agg(text.alias("record"))
    return whole.where("record <> ''").select("record")


def export_all(tables: Iterable[tuple[str, DataFrame]], prefix: str) -> list[str]:
    """Export each (name, frame) to ``prefix/name.csv``."""
    written = []
    for name, df in tables:
        path = f"{prefix.rstrip('/')}/{name}.csv"
        export_csv(df, path)
        written.append(path)
    return written
