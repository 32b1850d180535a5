"""Join helpers: a broadcast taken only behind checked bounds, and joins whose
hot keys' products are split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import scratch_path, shuffle_partitions

# Largest side we are willing to ship to every executor. The coin alias list of a
# real market-data source is in the tens of thousands of rows.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 << 20


def _bytes(df: DataFrame) -> Column:
    """The bytes of a row's texts and fixed-size values."""
    size = F.lit(8 * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
    return size


def fits(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes of text
    and fixed-size values: one aggregate, combined per task."""
    n, total = df.agg(F.count(F.lit(1)), F.sum(_bytes(df))).first()
    return n <= max_rows and (total or 0) <= max_bytes


def maybe_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast hint when the bounds hold; otherwise a normal (shuffle) join side."""
    return F.broadcast(df) if fits(df) else df


#: Rows of one side that one cell of a split product holds, about.
PRODUCT_BLOCK = 1024
#: A cell may be longer on one side, so that the other is copied less, but not beyond this
#: many times ``PRODUCT_BLOCK`` rows.
LONG = 16
#: Copies of one row that are made together.
REPEAT_BLOCK = 4096
#: Rows of a hot key with more copies than this have their pairs' copies dealt to all tasks.
FEW = 8

_LEFT, _RIGHT = "_left_copies", "_right_copies"


def repeat_rows(df: DataFrame, count_col: str, block: int = REPEAT_BLOCK, spread: int | None = None) -> DataFrame:
    """Each row ``count_col`` times (rows with a count below 1 are dropped).

    Copies are made in blocks: one row per block of at most ``block`` copies, then
    expanded, so no array grows past ``max(count / block, block)``. With ``spread`` the
    blocks are dealt to that many tasks before they are expanded, so that the copies of
    one row are made by all of them.
    """
    n = F.col(count_col).cast("long")
    last = F.floor((n - 1) / block).cast("long")
    blocks = df.where(n > 0).select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_blk"))
    if spread:
        blocks = blocks.repartition(spread, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), "_blk")
    size = F.least(F.lit(block).cast("long"), n - F.col("_blk") * block).cast("int")
    return blocks.select("*", F.explode(F.array_repeat(F.lit(0), size)).alias("_rep")).drop("_blk", "_rep")


def product_counts(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, _n, _m)``: rows of both sides per key they share, combined per task."""
    return _key_sums(left, F.count(F.lit(1)), right, F.count(F.lit(1)), keys)


def _key_sums(left: DataFrame, n: Column, right: DataFrame, m: Column, keys: list[str]) -> DataFrame:
    return left.groupBy(*keys).agg(n.alias("_n")).join(right.groupBy(*keys).agg(m.alias("_m")), keys)


def _grid(left_bytes: float, right_bytes: float, block: int) -> list[Column]:
    """``_p, _q``: the parts that the left and right rows (``_n``, ``_m``) of a key are cut into,
    for cells of about ``block`` by ``block`` pairs. A left row is copied ``_q`` times and a right
    one ``_p`` times, so the side whose rows are wider is cut into more parts."""
    n, m = F.col("_n"), F.col("_m")
    cells = n * m / (block * block)
    cut = F.greatest(F.lit(1.0), F.least(cells, F.sqrt(cells * n * left_bytes / (m * right_bytes))))
    p, q = F.greatest(cut, n / (LONG * block)), F.greatest(cells / cut, m / (LONG * block))
    return [F.ceil(p).cast("int").alias("_p"), F.ceil(q).cast("int").alias("_q")]


def product_join(
    left: DataFrame, right: DataFrame, keys: list[str], block: int = PRODUCT_BLOCK, right_keys: DataFrame | None = None
) -> DataFrame:
    """Inner equi join whose hot keys' products are split over many tasks.

    Adaptive execution splits by bytes read, but a key with n and m rows makes
    n * m. Both sides are counted per key (``right_keys``: a frame with the right side's
    keys, row by row, that is cheaper to count). Keys whose product is at most ``block``
    squared are joined as ever. The others are written to the shared folder first, in a
    job of its own, as mostly there are none. Their rows are factorised: equal rows become one
    with their number, combined per task, and are written too. They are cut into a grid: a row
    is dealt to a part of its own side by its hash and repeated for
    each part of the other, so each cell multiplies about ``block`` by ``block`` rows, or as many
    pairs where one side's rows are wider (``_grid``).
    Rows of at most ``FEW`` copies on both sides give their pairs' copies
    where they meet, and what is shuffled is the two sides, not the product. A pair of
    others stands for the product of its two numbers, and its copies are made at the
    end, in blocks that are dealt to all tasks.
    """
    spark = left.sparkSession
    spread = shuffle_partitions(spark)

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    counts = product_counts(left, right if right_keys is None else right_keys, keys)
    hot = stored(counts.where(F.col("_n") * F.col("_m") > block * block).select(*keys), "hot-keys")
    if hot.isEmpty():
        return left.join(right, keys)
    # what is known of the hot keys goes to the rows, if it is small, and not the rows to it
    small = fits(hot)

    def near(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    def factorised(df: DataFrame, copies: str, name: str) -> DataFrame:
        columns = [F.col(f"`{c}`") for c in df.columns]
        return stored(df.join(near(hot), keys, "left_semi").groupBy(*columns).agg(F.count(F.lit(1)).alias(copies)), name)

    def dealt(df: DataFrame, parts: DataFrame, own: str, other: str, own_cell: str, other_cell: str) -> DataFrame:
        row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        return (
            df.join(near(parts), keys)
            .withColumn(own_cell, F.pmod(row, F.col(own)).cast("int"))
            .withColumn(other_cell, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .drop("_p", "_q")
        )

    # a fixed number of tasks: what they read is small, so it must not be merged again
    cell = [*keys, "_i", "_j"]

    def pairs(a: DataFrame, n: Column, b: DataFrame, m: Column) -> DataFrame:
        parts = _key_sums(a, n, b, m, keys).select(*keys, *_grid(wide_a, wide_b, block))
        return (
            dealt(a, parts, "_p", "_q", "_i", "_j").repartition(spread, *cell)
            .join(dealt(b, parts, "_q", "_p", "_j", "_i").repartition(spread, *cell), cell).drop("_i", "_j")
            .withColumn(_LEFT, F.col(_LEFT) * F.col(_RIGHT)).drop(_RIGHT)
        )

    a, b = factorised(left, _LEFT, "hot-left"), factorised(right, _RIGHT, "hot-right")
    out = left.join(near(hot), keys, "left_anti").join(right.join(near(hot), keys, "left_anti"), keys)
    least_a, most_a, wide_a = a.agg(F.min(_LEFT), F.max(_LEFT), F.avg(_bytes(a))).first()
    least_b, most_b, wide_b = b.agg(F.min(_RIGHT), F.max(_RIGHT), F.avg(_bytes(b))).first()
    few_a, few_b, rows = a.where(F.col(_LEFT) <= FEW), b.where(F.col(_RIGHT) <= FEW), F.count(F.lit(1))
    many = []
    if most_a > FEW:
        many.append(pairs(a.where(F.col(_LEFT) > FEW), rows, b, rows))
    if most_b > FEW and least_a <= FEW:
        many.append(pairs(few_a, rows, b.where(F.col(_RIGHT) > FEW), rows))
    for found in many:
        out = out.unionByName(repeat_rows(found, _LEFT, spread=spread).drop(_LEFT))
    if least_a <= FEW and least_b <= FEW:
        # cut by their copies, so that a cell gives about block by block rows
        found = pairs(few_a, F.sum(_LEFT), few_b, F.sum(_RIGHT))
        out = out.unionByName((found if most_a == most_b == 1 else repeat_rows(found, _LEFT)).drop(_LEFT))
    return out
