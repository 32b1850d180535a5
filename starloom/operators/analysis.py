"""Analysis over the facts: same-time join (J5), monthly statistics (A1-A3),
calendar and text orderings (O1, O2), previews and top-k (O3, O4).

Calendar parts may come from the date dimension (``date_dim`` given, the
reference's join) or from the fact's own ``date``: every fact ``date_key`` was
taken from a dimension row with an equal ``date``, so both give the same
result and the second skips a shuffle of the fact on ``date_key``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import product_join, repeat_rows
from starloom.operators.keys import with_surrogate_key
from starloom.operators.partitions import MONTH, YEAR, has_month

PRICE_T = "decimal(18,5)"


def _with_month_year(fact: DataFrame, date_dim: DataFrame | None) -> DataFrame:
    if date_dim is None and has_month(fact):  # of a partitioned fact, which then reads no date
        return fact.withColumn("month", F.col(MONTH).cast("string")).withColumn("year", F.col(YEAR))
    if date_dim is None:
        return fact.withColumn("month", F.month("date").cast("string")).withColumn("year", F.year("date"))
    dt = date_dim.select("date_key", "month", "year")
    return fact.drop("month", "year").join(dt, "date_key")


def monthly_price_stats(fact: DataFrame, date_dim: DataFrame | None = None) -> DataFrame:
    """MIN/MAX of price, market cap and volume per coin name, symbol, year, month (A1)."""
    g = _with_month_year(fact, date_dim).groupBy("coin_name", "coin_symbol", "year", "month")
    out = g.agg(
        F.max("price").cast(PRICE_T).alias("max_usd_price"),
        F.min("price").cast(PRICE_T).alias("min_usd_price"),
        F.max("market_cap").cast(PRICE_T).alias("max_mcap"),
        F.min("market_cap").cast(PRICE_T).alias("min_mcap"),
        F.max("total_volumes").cast(PRICE_T).alias("max_total_vol"),
        F.min("total_volumes").cast(PRICE_T).alias("min_total_vol"),
    )
    return out.select(
        "coin_name", "coin_symbol", "month", F.col("year").cast("string").alias("year"),
        "max_usd_price", "min_usd_price", "max_mcap", "min_mcap", "max_total_vol", "min_total_vol",
    )


def monthly_price_minmax(fact: DataFrame, date_dim: DataFrame | None = None) -> DataFrame:
    """Older form: MIN/MAX of price per coin name, year, month (A2)."""
    g = _with_month_year(fact, date_dim).groupBy("coin_name", "year", "month")
    out = g.agg(
        F.max("price").cast(PRICE_T).alias("max_usd_price"),
        F.min("price").cast(PRICE_T).alias("min_usd_price"),
    )
    return out.select(
        "coin_name", "month", F.col("year").cast("string").alias("year"), "max_usd_price", "min_usd_price"
    )


def monthly_price_avg(fact: DataFrame, date_dim: DataFrame | None = None) -> DataFrame:
    """AVG of price per coin name, year, month as SUM(price) in DOUBLE / COUNT(price) (A3)."""
    g = _with_month_year(fact, date_dim).groupBy("coin_name", "year", "month")
    out = g.agg((F.sum("price").cast("double") / F.count("price")).alias("avg_usd_price"))
    return out.select("coin_name", "month", F.col("year").cast("string").alias("year"), "avg_usd_price")


# -- Monthly statistics without the bag-mode fan-out -------------------------
#
# In bag mode each staging row becomes one fact row per dimension row with the
# same timestamp, so the fact grows with the square of the rows at a hot
# timestamp. The monthly statistics do not need that product:
#   * MIN and MAX ignore duplicates, and every staging row meets at least its
#     own dimension row, so they are the same over the coin-matched staging rows
#     (``coin_stats_matches``) as over the fact, in both modes;
#   * AVG over the fact weights each staging row by the number of dimension rows
#     at its timestamp; the weighted decimal sum is exact, so
#     SUM(price * n) / SUM(n) gives the fact's average bit for bit.
# Both stay linear in the input whatever the key skew.


def date_multiplicity(date_rows: DataFrame) -> DataFrame:
    """Dimension rows per timestamp (``date``, ``dim_rows``); counted per task
    before the shuffle, so a hot timestamp costs one row per task."""
    return date_rows.groupBy("date").agg(F.count(F.lit(1)).alias("dim_rows"))


def monthly_price_avg_weighted(matches: DataFrame, multiplicity: DataFrame | None) -> DataFrame:
    """A3 of the fact from coin-matched staging rows: each row weighted by its
    timestamp's dimension-row count (bag mode), or by 1 (``None``, set mode)."""
    if multiplicity is None:
        return monthly_price_avg(matches)
    # one row per task, coin and timestamp before any shuffle, whatever a timestamp holds
    per_date = matches.groupBy("coin_name", "date").agg(F.sum("price").alias("_s"), F.count("price").alias("_c"))
    w = per_date.join(multiplicity, "date")
    w = w.withColumn("month", F.month("date").cast("string")).withColumn("year", F.year("date"))
    total, rows = F.sum(F.col("_s") * F.col("dim_rows")), F.sum(F.col("_c") * F.col("dim_rows"))
    out = w.groupBy("coin_name", "year", "month").agg((total.cast("double") / rows).alias("avg_usd_price"))
    return out.select("coin_name", "month", F.col("year").cast("string").alias("year"), "avg_usd_price")


def ranked(df: DataFrame, order_by: Sequence[Column | str], name: str = "sort_rank") -> DataFrame:
    """Make an output order testable: rank 1.. in ``order_by`` order, distributed (O1, O2)."""
    return with_surrogate_key(df, name, order_by, start=1)


def monthly_sorted(stats: DataFrame) -> DataFrame:
    """Calendar order: coin_name, coin_symbol, CAST(year AS INT), CAST(month AS INT) (O1)."""
    return ranked(
        stats, ["coin_name", "coin_symbol", F.col("year").cast("int"), F.col("month").cast("int")]
    )


def monthly_sorted_text(minmax: DataFrame) -> DataFrame:
    """Text order of the older table: coin_name, year, month as text ('1','10','2') (O2)."""
    return ranked(minmax, ["coin_name", "year", "month"])


def preview(df: DataFrame, n: int = 10, order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """``SELECT * ... LIMIT n`` made deterministic by an order (top-k, O3)."""
    cols = list(order_by) if order_by is not None else df.columns
    return df.orderBy(*cols).limit(n)


def fact_head(matches: DataFrame, date_dim: DataFrame, k: int, columns: Sequence[str]) -> DataFrame:
    """The first ``k`` rows, in the order of ``columns`` (``date_key`` first), of
    the fact ``matches JOIN date_dim ON date`` - without building that join.

    Every dimension row whose date has a match yields at least one fact row, so
    the first ``k`` fact rows can only carry the ``k`` smallest such keys. Those
    (a top-k, at most ``k`` rows, broadcast) are joined to the matches, and only
    their rows are sorted. Exact, and linear in the input.
    """
    if not columns or columns[0] != "date_key":
        raise ValueError("fact_head orders by date_key first")
    dates = matches.select("date").distinct()
    first = (
        date_dim.select("date_key", "date").join(dates, "date", "left_semi")
        .orderBy("date_key").limit(k)
    )
    rows = matches.join(F.broadcast(first), "date")
    return rows.select(*columns).orderBy(*columns).limit(k)


def same_time(
    coin_stats: DataFrame, tweets_hist: DataFrame, date_dim: DataFrame | None = None
) -> DataFrame:
    """Tweets and price statistics of the same coin at the same timestamp.

    Joined on ``(date_key, coin_key)``; with ``date_dim`` the date comes from the
    dimension as in the reference, otherwise from the statistics row itself.
    """
    c = coin_stats.select(
        "date_key", "coin_key", F.col("date").alias("_c_date"), "coin_symbol",
        "price", "market_cap", "total_volumes",
    )
    t = tweets_hist.select("date_key", "coin_key", "tweet")
    j = c.join(t, ["date_key", "coin_key"])
    if date_dim is not None:
        j = j.join(date_dim.select("date_key", "date"), "date_key")
    else:
        j = j.withColumnRenamed("_c_date", "date")
    return j.select("date", "coin_symbol", "tweet", "price", "market_cap", "total_volumes")


def same_time_from_matches(
    stats_matches: DataFrame, tweet_matches: DataFrame, multiplicity: DataFrame | None
) -> DataFrame:
    """J5 without building the facts.

    A fact row's ``date_key`` names a dimension row with the same ``date``, and
    the output carries no other dimension attribute. So the fact join yields,
    for each (date, coin), every pair of matched price and tweet rows once per
    dimension row at that timestamp. Join the unfanned matches on
    ``(date, coin_key)`` and repeat each pair by the timestamp's multiplicity
    (bag mode; ``None`` = set mode, once). The bag equals ``same_time`` over the
    facts, without surrogate keys or the per-fact fan-out.
    """
    j = _pairs(stats_matches, tweet_matches, multiplicity)
    if multiplicity is not None:
        j = repeat_rows(j, "dim_rows")
    return j.select(*SAME_TIME)


SAME_TIME = ["date", "coin_symbol", "tweet", "price", "market_cap", "total_volumes"]


def _pairs(stats_matches: DataFrame, tweet_matches: DataFrame, multiplicity: DataFrame | None) -> DataFrame:
    """Every price row with every tweet of its coin and timestamp, and in bag mode
    the timestamp's dimension rows, which join the prices before they multiply."""
    s = stats_matches.select("date", "coin_key", "coin_symbol", "price", "market_cap", "total_volumes")
    if multiplicity is not None:
        s = s.join(multiplicity, "date")
    return product_join(s, tweet_matches.select("date", "coin_key", "tweet"), ["date", "coin_key"])


def same_time_top(
    stats_matches: DataFrame, tweet_matches: DataFrame, multiplicity: DataFrame | None, k: int = 5
) -> DataFrame:
    """The first ``k`` rows of J5 (O4): every pair yields a row at least, so they
    come from the first ``k`` pairs, which alone are repeated."""
    first = _pairs(stats_matches, tweet_matches, multiplicity).orderBy(*SAME_TIME).limit(k)
    if multiplicity is not None:
        first = repeat_rows(first, "dim_rows")
    return top_k(first.select(*SAME_TIME), k)


def top_k(df: DataFrame, k: int = 5) -> DataFrame:
    """``... LIMIT k`` ordered by every output column (O4), planned as a top-k."""
    return df.orderBy(*df.columns).limit(k)
