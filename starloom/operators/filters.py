"""Row restrictions of the market-data source: last N days (F-4), a from-to
range (F-5) and a list of coins (F-6)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.partitions import has_month, month_range

# Coin lists up to this size go into an IN list, which scans can use; longer ones
# become a semi join with the list. Rows, columns and their order are the same.
IN_LIST_MAX = 1000


def _ts(value: str | dt.datetime | Column) -> Column:
    """A bound as a zone-less UTC timestamp; one with an offset is moved to UTC."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def last_n_days(
    df: DataFrame, days: int, as_of: str | dt.datetime | Column | None = None, ts_col: str = "date"
) -> DataFrame:
    """Rows from ``as_of - days`` to ``as_of`` inclusive; ``as_of`` defaults to the
    newest timestamp in the data (a lazy scalar, never the wall clock)."""
    end = df.agg(F.max(ts_col)).scalar() if as_of is None else _ts(as_of)
    start = end - F.make_dt_interval(F.lit(days))
    if as_of is not None and ts_col == "date" and has_month(df):
        df = df.where(month_range(start, end))
    return df.where((F.col(ts_col) >= start) & (F.col(ts_col) <= end))


def time_range(
    df: DataFrame, start: str | dt.datetime | Column, end: str | dt.datetime | Column, ts_col: str = "date"
) -> DataFrame:
    """Rows with ``start <= ts <= end`` (both ends inclusive, our choice). A frame with
    the partition columns of ``date`` (``operators.partitions``) is pruned by them."""
    first, last = _ts(start), _ts(end)
    if ts_col == "date" and has_month(df):
        df = df.where(month_range(first, last))
    return df.where(F.col(ts_col).between(first, last))


def coin_subset(df: DataFrame, coins: Sequence[str], col: str = "coin") -> DataFrame:
    coins = list(dict.fromkeys(coins))
    if len(coins) <= IN_LIST_MAX:
        return df.where(F.col(col).isin(coins))
    wanted = df.sparkSession.createDataFrame([(c,) for c in coins], "_wanted string")
    return df.join(wanted, df[col] == wanted["_wanted"], "left_semi")
