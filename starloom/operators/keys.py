"""Dense surrogate keys (K1) and keys that continue an existing table (K2).

``row_number() OVER (ORDER BY ...)`` moves every row into one task. Instead about
``SAMPLE`` order keys per bucket, drawn at a share that the row count gives, are
sorted and cut into bucket bounds. No task merges the sample: it goes to the driver
as drawn, a number of rows that the buckets fix, whatever the number of input tasks.
The bounds come back as constants, and a row finds its bucket by halving them. So the
bucket is a function of the row alone: counting the buckets and numbering the rows in
them agree whatever the optimizer prunes, reuses or computes twice. A bucket's rows
are numbered in its own task and get the row count of all buckets before it, one row
per bucket, which is broadcast.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import shuffle_partitions

_BUCKET, _OFF, _N = "_sk_bucket", "_sk_off", "_sk_n"

#: Sampled order keys per bucket.
SAMPLE = 20
#: Up to this many bounds are compared by nested conditions, which Spark compiles; more
#: are one array, which it halves by an interpreted fold, some ten times as slow.
NESTED = 512

_JSON = {
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "allowNonNumericNumbers": "true",
}


def _cols(order_by: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def _sample(keys: DataFrame, buckets: int) -> DataFrame:
    """About ``SAMPLE * buckets`` rows (all, where there are fewer), each drawn for itself."""
    total = keys.count()
    return keys.sample(min(1.0, SAMPLE * buckets / max(total, 1)), seed=17)


def _bounds(keys: DataFrame, buckets: int) -> list[Column] | Column:
    """At most ``buckets - 1`` ascending order keys that cut the rows into about equal
    parts, as constants, or as one array of more than ``NESTED``. Any ascending bounds give the
    same numbering, so they may be random, and a value may lose precision in the text between."""
    spark = keys.sparkSession
    drawn = _sample(keys, buckets).toArrow()
    step = max(1, -(-drawn.num_rows // buckets))
    local = spark.createDataFrame(drawn).agg(F.sort_array(F.collect_list("k")).alias("k"))
    cut = F.array_distinct(F.filter("k", lambda _, i: (i % step == 0) & (i > 0)))
    text = local.select(F.to_json(cut, _JSON)).first()[0]
    kind = keys.schema["k"].dataType
    if len(cuts := _elements(text)) > NESTED:
        return F.from_json(F.lit(text), T.ArrayType(kind), _JSON)
    return [F.from_json(F.lit(x), kind, _JSON) for x in cuts]


def _elements(text: str) -> list[str]:
    """The texts of a JSON array's elements, as they stand."""
    out, at, read = [], 1, json.JSONDecoder().raw_decode
    while text[at] != "]":
        end = read(text, at)[1]
        out.append(text[at:end])
        at = end + (text[end] == ",")
    return out


def _bucket(key: Column, bounds: list[Column] | Column, most: int) -> Column:
    """How many of at most ``most`` ascending bounds are not above the key."""
    if isinstance(bounds, Column):
        return bucket_of(key, bounds, most)

    def half(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < bounds[mid], half(lo, mid)).otherwise(half(mid + 1, hi))

    return half(0, len(bounds))


def bucket_of(key: Column, bounds: Column, most: int) -> Column:
    """How many of at most ``most`` ascending bounds are not above the key, by halving."""

    def half(at: Column, _: Column) -> Column:
        mid = F.shiftright(at["lo"] + at["hi"], 1)
        open_, below = at["lo"] < at["hi"], key < F.get(bounds, mid)
        return F.struct(
            F.when(open_ & ~below, mid + 1).otherwise(at["lo"]).alias("lo"),
            F.when(open_ & below, mid).otherwise(at["hi"]).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))
    steps = F.array(*[F.lit(i) for i in range(max(1, most.bit_length()))])
    # never null, or the join on it would compute it a second time to filter nulls
    return F.coalesce(F.aggregate(steps, start, half, lambda at: at["lo"]), F.lit(0))


def with_surrogate_key(
    df: DataFrame,
    name: str,
    order_by: Sequence[Column | str],
    start: int | Column = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = start, start+1, ... in the order of ``order_by`` (ascending,
    NULLs first). Rows that tie in the order get distinct keys in an unspecified
    order, and are numbered in one task; give a unique order to make keys
    reproducible and to spread a hot value."""
    n = partitions or shuffle_partitions(df.sparkSession)
    order = _cols(order_by)
    key = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    keys = df.select(key.alias("k"))
    placed = df.withColumn(_BUCKET, _bucket(key, _bounds(keys, n), n - 1) if n > 1 else F.lit(0))
    # a bucket a task, which is also how the numbering window needs the rows
    dealt = placed.repartitionById(n, F.col(_BUCKET))
    counts = placed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias(_N))
    before = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_BUCKET, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF))
    local = F.row_number().over(Window.partitionBy(_BUCKET).orderBy(*order)) - 1
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        dealt.withColumn(name, local)
        .join(F.broadcast(offsets), _BUCKET)
        .withColumn(name, (first + F.col(_OFF) + F.col(name)).cast("long"))
        .drop(_BUCKET, _OFF)
    )


def next_key(existing: DataFrame, name: str) -> Column:
    """max(key)+1 of an existing table as a lazy scalar (0 when it is empty)."""
    return existing.agg(F.coalesce(F.max(name) + 1, F.lit(0)).cast("long")).scalar()


def append_with_keys(
    existing: DataFrame, new_rows: DataFrame, name: str, order_by: Sequence[Column | str]
) -> DataFrame:
    """Key the new rows so they continue after the existing table's keys (K2)."""
    return with_surrogate_key(new_rows, name, order_by, start=next_key(existing, name))
