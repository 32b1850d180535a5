"""Document sources and sinks: JSON-lines collections (S6, X3) and market-chart
documents flattened into rows (S7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.calendar import millis_to_timestamp
from starloom.session import configure

SERIES = (("prices", "price"), ("market_caps", "market_cap"), ("total_volumes", "total_volumes"))

MARKET_CHART = T.StructType(
    [T.StructField("coin", T.StringType())]
    + [T.StructField(s, T.ArrayType(T.ArrayType(T.DoubleType()))) for s, _ in SERIES]
)


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None,
    where: dict | None = None, drop_id: bool = True,
) -> DataFrame:
    """A document collection with an equality filter (``find(query)``), ``_id``
    dropped. ``{field: None}`` finds the documents whose field is null or absent. A
    broken line or a value of the wrong type fails the read."""
    configure(spark)
    reader = spark.read.option("mode", "FAILFAST")
    reader = reader.schema(schema) if schema is not None else reader
    df = reader.json(path)
    for field, value in (where or {}).items():
        df = df.where(F.col(field).isNull() if value is None else F.col(field) == F.lit(value))
    return df.drop("_id") if drop_id else df


def append_documents(df: DataFrame, path: str) -> None:
    """``insert_many``: append the frame's rows as JSON documents."""
    df.write.mode("append").json(path)


def _points(docs_series: list[str]):
    """All points of a document's series, tagged by series and sorted by time;
    points without a time meet nothing."""
    def tag(i: int):
        return lambda p: F.struct(p[0].alias("t"), F.lit(i).alias("s"), p[1].alias("v"))

    every = [F.coalesce(F.transform(F.col(c), tag(i)), F.array()) for i, c in enumerate(docs_series)]
    return F.array_sort(F.filter(F.concat(*every), lambda p: p["t"].isNotNull()))


def _merged(group):
    """The product of one timestamp's values in the three series."""
    def of(i: int):
        return F.filter(group, lambda p: p["s"] == i)

    def row(a, b, c):
        return F.struct(a["t"].alias("t"), a["v"].alias("a"), b["v"].alias("b"), c["v"].alias("c"))

    return F.flatten(F.transform(of(0), lambda a: F.flatten(F.transform(of(1), lambda b: F.transform(of(2), lambda c: row(a, b, c))))))


def flatten_market_chart(docs: DataFrame) -> DataFrame:
    """One row per timestamp present in all three series of a document.

    The reference merges one document's three frames on date and then stacks the
    documents: an inner join within each document, so a timestamp missing from a
    series drops and a repeated one multiplies, and equal timestamps of different
    documents never meet. Here each document is merged inside its row: the points
    sorted by time, cut where the time changes, and each cut multiplied out. No
    shuffle, and no group beyond a document. Null series are empty.
    """
    sorted_ = docs.select("coin", _points([c for c, _ in SERIES]).alias("_p"))
    p = F.col("_p")
    # places (from 1) where a new time begins
    new = F.filter(
        F.transform(p, lambda x, i: F.when((i == 0) | (x["t"] != F.get(p, i - 1)["t"]), i + 1)), lambda i: i.isNotNull()
    )
    cut = sorted_.select("coin", "_p", new.alias("_b"))
    ends = lambda k: F.coalesce(F.get(F.col("_b"), k + 1), F.size("_p") + 1)
    groups = F.transform("_b", lambda b, k: _merged(F.slice(p, b, ends(k) - b)))
    # outer: a plain explode would repeat the merge in a filter below it
    rows = cut.select("coin", F.explode_outer(F.flatten(groups)).alias("_r")).where("_r is not null")
    return rows.select(
        millis_to_timestamp(F.col("_r.t")).alias("date"),
        *[F.col(f"_r.{x}").alias(n) for x, (_, n) in zip("abc", SERIES, strict=True)],
        "coin",
    )
