"""Declared table schemas: column order, types, NOT NULL and maximum text length.

Types follow SURVEY §1.3: zone-less timestamps, BIGINT ids, fixed decimals,
text with a character limit, and LongType surrogate keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Col:
    name: str
    dtype: T.DataType
    nullable: bool = True
    max_len: int | None = None


@dataclass(frozen=True)
class TableSchema:
    name: str
    columns: tuple[Col, ...]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def not_null(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    def struct(self) -> T.StructType:
        """Read schema. File sources do not enforce ``nullable``; ``conform`` does."""
        return T.StructType([T.StructField(c.name, c.dtype, True) for c in self.columns])

    def column(self, name: str) -> Col:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)


TS = T.TimestampNTZType()
BIGINT = T.LongType()
INT = T.IntegerType()
KEY = T.LongType()
PRICE = T.DecimalType(18, 5)
AMOUNT = T.DecimalType(18, 2)
STR = T.StringType()


def _t(name: str, *cols: Col) -> TableSchema:
    return TableSchema(name, tuple(cols))


TWEETS_STG = _t(
    "tweets.snscrape_tweets_stg",
    Col("datetime", TS, False),
    Col("tweet_id", BIGINT, False),
    Col("text", STR, False, 10000),
    Col("username", STR, True, 256),
    Col("crypto", STR, True, 256),
)

HOURLY_STG = _t(
    "crypto.cg_hourly_stg",
    Col("date", TS, False),
    Col("price", PRICE, False),
    Col("market_cap", AMOUNT, False),
    Col("total_volumes", AMOUNT, False),
    Col("coin", STR, False, 256),
)

COIN_LIST_STG = _t(
    "crypto.cg_coin_list_stg",
    Col("coin_id", STR, True, 256),
    Col("symbol", STR, False, 256),
    Col("name", STR, False, 256),
)

COIN_DIM = _t(
    "crypto.cg_coin_list",
    Col("coin_key", KEY, False),
    Col("coin_id", STR, True, 256),
    Col("symbol", STR, False, 256),
    Col("name", STR, False, 256),
)

DATE_DIM = _t(
    "dim.date_dim",
    Col("date_key", KEY, False),
    Col("date", TS, False),
    Col("hour", INT),
    Col("day", INT),
    Col("week", INT),
    Col("month", STR, True, 256),
    Col("year", INT),
    Col("weekday", STR, True, 256),
)

COIN_STATS_HIST = _t(
    "crypto.coin_stats_hist",
    Col("date_key", KEY, False),
    Col("coin_key", KEY, False),
    Col("date", TS, False),
    Col("coin_name", STR, False, 256),
    Col("coin_symbol", STR, False, 256),
    Col("price", PRICE, False),
    Col("market_cap", AMOUNT, False),
    Col("total_volumes", AMOUNT, False),
)

# Older form built by the exact-id rule: no coin_symbol.
COIN_STATS_HIST_BY_ID = _t(
    "crypto.coin_stats_hist",
    Col("date_key", KEY, False),
    Col("coin_key", KEY, False),
    Col("date", TS, False),
    Col("coin_name", STR, False, 256),
    Col("price", PRICE, False),
    Col("market_cap", AMOUNT, False),
    Col("total_volumes", AMOUNT, False),
)

TWEETS_HIST = _t(
    "tweets.snscrape_tweets_hist",
    Col("date_key", KEY, False),
    Col("coin_key", KEY, False),
    Col("date", TS, False),
    Col("tweet_id", BIGINT, False),
    Col("coin_name", STR, True, 256),
    Col("tweet", STR, False, 10000),
    Col("username", STR, True, 256),
    Col("search_term", STR, True, 256),
)

MONTHLY_STATS = _t(
    "crypto.usd_price_per_month_stats",
    Col("coin_name", STR, True, 256),
    Col("coin_symbol", STR, True, 20),
    Col("month", STR, True, 10),
    Col("year", STR, True, 10),
    Col("max_usd_price", PRICE),
    Col("min_usd_price", PRICE),
    Col("max_mcap", PRICE),
    Col("min_mcap", PRICE),
    Col("max_total_vol", PRICE),
    Col("min_total_vol", PRICE),
)

# Older form: by coin name only, price measures only.
MONTHLY_MINMAX = _t(
    "crypto.usd_price_per_month_stats",
    Col("coin_name", STR, True, 256),
    Col("month", STR, True, 10),
    Col("year", STR, True, 10),
    Col("max_usd_price", PRICE),
    Col("min_usd_price", PRICE),
)

# The reference inserts into this table without creating it; the measure type
# is ours: SUM(price) as DOUBLE over COUNT(price).
MONTHLY_AVG = _t(
    "crypto.avg_price_per_month",
    Col("coin_name", STR, True, 256),
    Col("month", STR, True, 10),
    Col("year", STR, True, 10),
    Col("avg_usd_price", T.DoubleType()),
)

ALL = {
    "snscrape_tweets_stg": TWEETS_STG,
    "cg_hourly_stg": HOURLY_STG,
    "cg_coin_list_stg": COIN_LIST_STG,
    "cg_coin_list": COIN_DIM,
    "date_dim": DATE_DIM,
    "coin_stats_hist": COIN_STATS_HIST,
    "coin_stats_hist_by_id": COIN_STATS_HIST_BY_ID,
    "snscrape_tweets_hist": TWEETS_HIST,
    "usd_price_per_month_stats": MONTHLY_STATS,
    "usd_price_per_month_minmax": MONTHLY_MINMAX,
    "avg_price_per_month": MONTHLY_AVG,
}
