"""Intermediate tables in the cluster's shared folder.

``spark.checkpoint.dir`` is read from the session. Only a local master may do
without it (tests); on a cluster a machine-local folder would be a different
folder on every executor, so its absence raises.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


ARROW_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor shares")
        path = tempfile.mkdtemp(prefix="starloom-llm-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lost executor costs
    no recomputation, and every later branch sees the same rows."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def trim() -> None:
    """Give freed memory back to the system. Spark keeps a Python worker for later tasks,
    and what one has freed but not returned counts while the JVM works."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many more underscores as make it differ from the columns."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, so that Python tasks can import it
    wherever the driver found it, and bound the bytes of text that a task holds at
    once: the session's Arrow batches are cut at ``ARROW_BYTES`` if they were larger."""
    import os
    import shutil

    size = spark.conf.get(_BATCH)
    if size.rstrip("b").isdigit() and int(size.rstrip("b")) > ARROW_BYTES:
        spark.conf.set(_BATCH, str(ARROW_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_starloom_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="starloom-package-")  # read by the driver alone
    copy = os.path.join(folder, "package", "starloom")
    shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "starloom"), "zip", os.path.dirname(copy)))
    sc._starloom_shipped = True


def least_frequent(counted: DataFrame, column: str, bound: int) -> int:
    """The smallest count that at most ``bound`` rows reach, so that the rows with it
    or more are a table of bounded size. Reads one number for each distinct count,
    of which there are about the square root of the total at most."""
    from pyspark.sql import functions as F

    sizes = counted.groupBy(F.col(column).alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("n"))
    total, least = 0, None
    for r in sizes.toLocalIterator():
        total += r["rows"]
        if total > bound:
            return least if least is not None else r["n"] + 1
        least = r["n"]
    return 1
