"""Dimensions: calendar rows from a timestamp column (D1), the coin list
and the date dimension fed by two sources (U1), in bag or set mode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.calendar import date_parts
from starloom.operators.keys import with_surrogate_key

DATE_MODES = ("bag", "set")
DATE_DIM_COLUMNS = ["date_key", "date", "hour", "day", "week", "month", "year", "weekday"]


def _check_mode(date_mode: str) -> None:
    if date_mode not in DATE_MODES:
        raise ValueError(f"date_mode must be one of {DATE_MODES}, got {date_mode!r}")


def build_date_dim(df: DataFrame, ts_col: str, keep: list[str] | None = None) -> DataFrame:
    """``SELECT ts AS date, extract(hour|day|week|month|year|dayofweek) ...``."""
    parts = date_parts(F.col("date"))
    return df.select(F.col(ts_col).alias("date"), *(keep or [])).select(
        "date", *(keep or []), *(v.alias(k) for k, v in parts.items())
    )


def build_coin_dim(coin_stg: DataFrame) -> DataFrame:
    """Coins with a non-NULL id, keyed 0.. in id order (D2 + K1)."""
    coins = coin_stg.where(F.col("coin_id").isNotNull()).select("coin_id", "symbol", "name")
    keyed = with_surrogate_key(coins, "coin_key", ["coin_id", "symbol", "name"])
    return keyed.select("coin_key", "coin_id", "symbol", "name")


def date_rows(tweets_stg: DataFrame, hourly_stg: DataFrame, hourly_id: str | None = "src_id") -> DataFrame:
    """Timestamps of both staging tables, tagged by source (0 = tweets, 1 = hourly)."""
    hid = F.col(hourly_id).cast("long") if hourly_id else F.lit(None).cast("long")
    return tweets_stg.select(
        F.lit(0).alias("source"), F.col("datetime").alias("date"), F.col("tweet_id").cast("long").alias("id")
    ).unionByName(hourly_stg.select(F.lit(1).alias("source"), F.col("date"), hid.alias("id")))


def build_date_dim_from_sources(
    tweets_stg: DataFrame,
    hourly_stg: DataFrame,
    date_mode: str = "bag",
    hourly_id: str | None = "src_id",
) -> DataFrame:
    """The date dimension as the reference loads it.

    bag: one row per staging row, tweets first then hourly, keys in
    ``(source, date, id)`` order - the same keys the overwrite-then-append load
    gives. set: one row per distinct timestamp, keys in date order.
    """
    _check_mode(date_mode)
    rows = date_rows(tweets_stg, hourly_stg, hourly_id)
    if date_mode == "bag":
        keyed = with_surrogate_key(rows, "date_key", ["source", "date", "id"])
    else:
        keyed = with_surrogate_key(rows.select("date").distinct(), "date_key", ["date"])
    return build_date_dim(keyed, "date", keep=["date_key"]).select(*DATE_DIM_COLUMNS)
