"""Staging frames of the reference's three inputs, derived from the driver's
tables by plain projections and joins (see FIXTURES.md). Every row of
``nation``, ``orders`` and ``conversations`` is used; texts are whole.

coin_stg    <- nation:  25 coins, one with NULL id, each symbol shared by five coins
hourly_stg  <- orders:  one price snapshot per order; the coin text is the exact
                        id, a case variant of the id, or a case variant of the name
tweets_stg  <- conversations joined to orders: one tweet per conversation turn,
                        stamped with the order's snapshot time; the search term is a
                        symbol, an exact name, or a name in the wrong case
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.calendar import epoch_millis

# Fixed fixture parameters (must equal the oracle SQL in starloom/plans/oracle.py).
SNAPSHOT_EVERY_HOURS = 4     # six snapshots a day: hours 0, 4, ..., 20
SNAPSHOTS_PER_DAY = 6
NULL_COIN_NATION = 24        # this nation's coin has no id
TURNS_PER_ORDER_BLOCK = 8    # conversation turn t of conversation c -> order c*8 + t
TWEET_ID_FACTOR = 1000       # tweet_id = conv_id * 1000 + turn
CHART_ID_BLOCK = 4096        # a market-chart document covers one coin in a block of 4096 order ids


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _snapshot(orders_key: str = "o_orderkey", date: str = "o_orderdate"):
    hours = (F.col(orders_key) % SNAPSHOTS_PER_DAY * SNAPSHOT_EVERY_HOURS).cast("int")
    return F.timestamp_add("HOUR", hours, F.col(date))


def coin_stg(nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey")
    return nation.select(
        F.when(key == NULL_COIN_NATION, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("nation-"), key.cast("string"))).alias("coin_id"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("symbol"),
        F.col("n_name").alias("name"),
    )


def hourly_stg(orders: DataFrame, with_src_id: bool = True) -> DataFrame:
    k = F.col("o_orderkey")
    prefix = (
        F.when(k % 8 == 0, F.lit("nation-")).when(k % 4 == 0, F.lit("Nation-")).otherwise(F.lit("nation_"))
    )
    cols = [
        _snapshot().alias("date"),
        F.col("o_totalprice").cast("decimal(18,5)").alias("price"),
        (F.col("o_totalprice") * 1000).cast("decimal(18,2)").alias("market_cap"),
        (F.col("o_totalprice") * 10).cast("decimal(18,2)").alias("total_volumes"),
        F.concat(prefix, (F.col("o_custkey") % 25).cast("string")).alias("coin"),
    ]
    if with_src_id:
        cols.append(k.alias("src_id"))
    return orders.select(*cols)


def _order_of():
    """The order whose snapshot time a conversation turn has."""
    return F.col("conv_id") * TURNS_PER_ORDER_BLOCK + F.col("turn")


def tweet_orders(conversations: DataFrame, orders: DataFrame) -> DataFrame:
    """The rows of ``orders`` that a conversation turn meets, with the columns that
    ``tweets_stg`` reads: it gives the same rows from these."""
    turns = conversations.select(_order_of().alias("_okey"))
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return o.join(turns, o["o_orderkey"] == turns["_okey"], "left_semi")


def tweets_stg(conversations: DataFrame, orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    cust = F.col("o_custkey")
    crypto = (
        F.when(k % 3 == 0, F.concat(F.lit("R"), (cust % 5).cast("string")))
        .when(k % 3 == 1, F.concat(F.lit("NATION_"), (cust % 25).cast("string")))
        .otherwise(F.concat(F.lit("nation_"), (cust % 25).cast("string")))
    )
    c = conversations.select(
        "conv_id", "turn", "text",
        _order_of().alias("_okey"),
    )
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return c.join(o, c["_okey"] == o["o_orderkey"]).select(
        _snapshot().alias("datetime"),
        (F.col("conv_id") * TWEET_ID_FACTOR + F.col("turn")).cast("long").alias("tweet_id"),
        F.col("text"),
        F.concat(F.lit("user"), cust.cast("string")).alias("username"),
        crypto.alias("crypto"),
    )


def staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    return {
        "coin_stg": coin_stg(table(spark, sf_dir, "nation")),
        "hourly_stg": hourly_stg(orders),
        "tweets_stg": tweets_stg(table(spark, sf_dir, "conversations"), orders),
    }


def market_chart_docs(hourly: DataFrame) -> DataFrame:
    """Market-chart documents (coin, chunk, prices, market_caps, total_volumes) of
    ``[epoch ms, value]`` pairs: one per coin and block of ``CHART_ID_BLOCK``
    source ids, so no document holds more than that many snapshots however
    large the data grows."""
    ms = epoch_millis("date").cast("double")

    def series(v: str):
        pts = F.collect_list(F.struct(F.col("src_id").alias("i"), F.array(ms, F.col(v).cast("double")).alias("p")))
        return F.transform(F.array_sort(pts), lambda s: s["p"])

    return hourly.groupBy("coin", F.floor(F.col("src_id") / CHART_ID_BLOCK).alias("chunk")).agg(
        series("price").alias("prices"),
        series("market_cap").alias("market_caps"),
        series("total_volumes").alias("total_volumes"),
    )
