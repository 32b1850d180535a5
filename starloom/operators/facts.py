"""Fact loading: staging rows matched to coins and to the date dimension.

The reference matches a coin by ``a = x OR a = y``. An OR condition plans as a
nested-loop join, so each coin is expanded into its distinct aliases and the
match becomes one equi join against that (checked-size, broadcast) alias list.
``array_distinct`` keeps a coin whose id equals its name from matching twice.
The coin join runs first (no shuffle, drops unmatched rows early), then the
date join (a shuffle on ``date``; the products of hot timestamps are split).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import maybe_broadcast, product_join
from starloom.schemas import COIN_STATS_HIST, COIN_STATS_HIST_BY_ID, TWEETS_HIST

_ALIAS = "_coin_alias"


def coin_aliases(coin_dim: DataFrame, alias_cols: Sequence[str], upper: bool) -> DataFrame:
    norm = (lambda c: F.upper(F.col(c))) if upper else F.col
    return (
        coin_dim.select(
            "coin_key",
            "name",
            "symbol",
            F.explode(F.array_distinct(F.array(*[norm(c) for c in alias_cols]))).alias(_ALIAS),
        )
        .where(F.col(_ALIAS).isNotNull())
    )


def match_coins(
    stg: DataFrame, coin_dim: DataFrame, stg_col: str, alias_cols: Sequence[str], upper: bool,
    broadcast: bool | None = None,
) -> DataFrame:
    """Inner join of staging rows to every coin whose alias equals ``stg_col``.

    ``broadcast=None`` checks the alias list's row bound here; a caller that has
    already bounded the coin list (e.g. on the raw file) passes the answer.
    """
    aliases = coin_aliases(coin_dim, alias_cols, upper)
    if broadcast is None:
        aliases = maybe_broadcast(aliases)
    elif broadcast:
        aliases = F.broadcast(aliases)
    key: Column = F.upper(stg[stg_col]) if upper else stg[stg_col]
    return stg.join(aliases, key == aliases[_ALIAS]).drop(_ALIAS)


def _with_date_key(
    matched: DataFrame, date_dim: DataFrame, date_mode: str = "bag", dates: DataFrame | None = None
) -> DataFrame:
    """J1. In bag mode the dimension has one row per staging row, so a timestamp's
    rows multiply: the products of hot timestamps are split over many tasks. They are
    counted in ``dates``, if given: the dimension's dates without their keys. In
    set mode each row meets one, and Spark picks the strategy by size."""
    dd = date_dim.select("date_key", "date")
    return product_join(matched, dd, ["date"], right_keys=dates) if date_mode == "bag" else matched.join(dd, "date")


def coin_stats_matches(
    hourly_stg: DataFrame, coin_dim: DataFrame, broadcast_coins: bool | None = None
) -> DataFrame:
    """The rows of ``coin_stats_hist`` before the date join: each hourly row once
    per matching coin (case-insensitive coin id OR name), without ``date_key``."""
    m = match_coins(hourly_stg, coin_dim, "coin", ["coin_id", "name"], upper=True, broadcast=broadcast_coins)
    return m.where(F.col("name").isNotNull()).select(
        "coin_key", "date", F.col("name").alias("coin_name"), F.col("symbol").alias("coin_symbol"),
        "price", "market_cap", "total_volumes",
    )


def build_coin_stats_hist(
    hourly_stg: DataFrame, date_dim: DataFrame, coin_dim: DataFrame, date_mode: str = "bag",
    broadcast_coins: bool | None = None, dates: DataFrame | None = None,
) -> DataFrame:
    """Hourly statistics per coin: case-insensitive match on coin id OR name."""
    m = _with_date_key(coin_stats_matches(hourly_stg, coin_dim, broadcast_coins), date_dim, date_mode, dates)
    return m.select(*COIN_STATS_HIST.names)


def build_coin_stats_hist_by_id(
    hourly_stg: DataFrame, date_dim: DataFrame, coin_dim: DataFrame, date_mode: str = "bag",
    broadcast_coins: bool | None = None, dates: DataFrame | None = None,
) -> DataFrame:
    """Older rule: exact ``coin = coin_id`` only, no symbol column."""
    m = match_coins(hourly_stg, coin_dim, "coin", ["coin_id"], upper=False, broadcast=broadcast_coins)
    m = _with_date_key(m, date_dim, date_mode, dates).where(F.col("name").isNotNull())
    return m.select(
        "date_key", "coin_key", "date", F.col("name").alias("coin_name"),
        "price", "market_cap", "total_volumes",
    ).select(*COIN_STATS_HIST_BY_ID.names)


def tweets_matches(
    tweets_stg: DataFrame, coin_dim: DataFrame, broadcast_coins: bool | None = None
) -> DataFrame:
    """The rows of ``snscrape_tweets_hist`` before the date join: each tweet once
    per matching coin (case-sensitive name OR symbol), without ``date_key``."""
    m = match_coins(tweets_stg, coin_dim, "crypto", ["name", "symbol"], upper=False, broadcast=broadcast_coins)
    return m.where(F.col("tweet_id").isNotNull()).select(
        "coin_key", F.col("datetime").alias("date"), "tweet_id",
        F.col("name").alias("coin_name"), F.col("text").alias("tweet"),
        "username", F.col("crypto").alias("search_term"),
    )


def build_tweets_hist(
    tweets_stg: DataFrame, date_dim: DataFrame, coin_dim: DataFrame, date_mode: str = "bag",
    broadcast_coins: bool | None = None, dates: DataFrame | None = None,
) -> DataFrame:
    """Tweets per coin: case-sensitive match on name OR symbol."""
    m = _with_date_key(tweets_matches(tweets_stg, coin_dim, broadcast_coins), date_dim, date_mode, dates)
    return m.select(*TWEETS_HIST.names)
