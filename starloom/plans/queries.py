"""Registered queries: one per operator of SURVEY §2, each ``(spark, sf_dir) -> DataFrame``.

Every query derives the reference's three inputs from the driver's tables
(``fixtures``) and runs the operator chain on them as one lazy plan. File
round trips write to a fresh folder under the cluster's checkpoint directory.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions.calendar import epoch_millis, iso_text, millis_to_timestamp, text_to_epoch_seconds
from starloom.operators import analysis as A
from starloom.operators import quality as Q
from starloom.operators.conform import ConstraintError, conform
from starloom.operators.dims import build_coin_dim, build_date_dim, build_date_dim_from_sources, date_rows
from starloom.operators.facts import (
    build_coin_stats_hist,
    build_coin_stats_hist_by_id,
    build_tweets_hist,
    coin_aliases,
    coin_stats_matches,
    tweets_matches,
)
from starloom.operators.joins import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, fits
from starloom.operators.filters import coin_subset, last_n_days, time_range
from starloom.operators.keys import append_with_keys, with_surrogate_key
from starloom.operators.partitions import MONTH, MONTH_PARTS, YEAR, with_month
from starloom.plans import fixtures as fx
from starloom.plans.declared import create_table, insert_rows
from starloom.plans.pipeline import (
    EXPORTS,
    T_COIN_DIM,
    T_COIN_STATS,
    T_DATE_DIM,
    T_MONTHLY,
    T_TWEETS_HIST,
    Sources,
    run_pipeline,
)
from starloom.plans.ranges import append_with_range
from starloom.plans.tables import Catalog, load_dimension, load_fact, write_table
from starloom.session import configure, scratch_path
from starloom.sinks.csv import export_csv, export_csv_file, read_exported_csv, with_timestamp_text
from starloom.sources.delimited import load_errors, stage_delimited
from starloom.sources.documents import MARKET_CHART, append_documents, flatten_market_chart, read_documents
from starloom.sources.parquet import stage_parquet

Query = Callable[[SparkSession, str], DataFrame]


class Model:
    """The staging frames, dimensions and facts of one run, as lazy plans.

    Dimension keys are deterministic because every order key ends in a unique
    id, so each branch of a plan that recomputes a dimension sees the same keys.
    The coin list is bounded once, on the raw list, for the broadcast decision.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, date_mode: str = "bag"):
        configure(spark)
        self.spark, self.sf_dir, self.date_mode = spark, sf_dir, date_mode

    @cached_property
    def _orders(self) -> DataFrame:
        return fx.table(self.spark, self.sf_dir, "orders")

    @cached_property
    def coin_stg(self) -> DataFrame:
        return fx.coin_stg(fx.table(self.spark, self.sf_dir, "nation"))

    @cached_property
    def hourly_src(self) -> DataFrame:
        """Hourly staging rows with their source id (key order only)."""
        return fx.hourly_stg(self._orders)

    @cached_property
    def hourly_stg(self) -> DataFrame:
        return self.hourly_src.drop("src_id")

    @cached_property
    def tweets_stg(self) -> DataFrame:
        return fx.tweets_stg(fx.table(self.spark, self.sf_dir, "conversations"), self._orders)

    @cached_property
    def tweets_src(self) -> DataFrame:
        """The same rows for plans that read them several times: the orders that a tweet
        meets are looked up once and stored, so that the others are not shuffled each time."""
        conversations = fx.table(self.spark, self.sf_dir, "conversations")
        path = scratch_path(self.spark, "tweet-orders")
        met = fx.tweet_orders(conversations, self._orders)
        met.write.parquet(path)
        return fx.tweets_stg(conversations, self.spark.read.schema(met.schema).parquet(path))

    @cached_property
    def coin_dim(self) -> DataFrame:
        return build_coin_dim(self.coin_stg)

    @cached_property
    def date_dim(self) -> DataFrame:
        return build_date_dim_from_sources(self.tweets_src, self.hourly_src, self.date_mode)

    @cached_property
    def dates(self) -> DataFrame | None:
        """The dimension's dates in bag mode, row by row and without keys: to be counted."""
        if self.date_mode == "set":
            return None
        return date_rows(self.tweets_src, self.hourly_src).select("date")

    @cached_property
    def small_coin_list(self) -> bool:
        # Each coin yields at most two aliases.
        return fits(self.coin_stg, BROADCAST_MAX_ROWS // 2, BROADCAST_MAX_BYTES // 2)

    @cached_property
    def coin_list(self) -> DataFrame:
        """The coins of the dimension without keys, for results that show none."""
        return self.coin_stg.where(F.col("coin_id").isNotNull()).withColumn("coin_key", F.lit(None).cast("long"))

    def coin_matches(self, keyed: bool = True) -> DataFrame:
        """Fact rows before the date join (``coin_stats_hist`` without ``date_key``)."""
        coins = self.coin_dim if keyed else self.coin_list
        return coin_stats_matches(self.hourly_src, coins, self.small_coin_list)

    def tweet_matches(self) -> DataFrame:
        """Fact rows before the date join (``snscrape_tweets_hist`` without ``date_key``)."""
        return tweets_matches(self.tweets_src, self.coin_dim, self.small_coin_list)

    def multiplicity(self) -> DataFrame | None:
        """Dimension rows per timestamp in bag mode; ``None`` in set mode (one each)."""
        if self.date_mode == "set":
            return None
        return A.date_multiplicity(date_rows(self.tweets_src, self.hourly_src))

    def coin_stats(self) -> DataFrame:
        return build_coin_stats_hist(self.hourly_src, self.date_dim, self.coin_dim, self.date_mode, self.small_coin_list, self.dates)

    def tweets(self) -> DataFrame:
        return build_tweets_hist(self.tweets_src, self.date_dim, self.coin_dim, self.date_mode, self.small_coin_list, self.dates)


# -- sources ---------------------------------------------------------------

HOURLY_CSV_WRITE = {"sep": "|", "header": "true", "nullValue": "\\N"}


def write_pipe_file(df: DataFrame, path: str) -> None:
    """A frame as the pipe file that staging reads; timestamps keep their fraction."""
    with_timestamp_text(df).write.options(**HOURLY_CSV_WRITE).csv(path)


def q_stage_delimited(spark, sf_dir):
    m = Model(spark, sf_dir)
    path = scratch_path(spark, "hourly-csv")
    write_pipe_file(m.hourly_stg, path)
    return stage_delimited(spark, path + "/{name}", S.HOURLY_STG, params={"name": "*.csv"})


def q_stage_parquet(spark, sf_dir):
    m = Model(spark, sf_dir)
    path = scratch_path(spark, "tweets-parquet")
    m.tweets_stg.write.parquet(path)
    return stage_parquet(spark, path, S.TWEETS_STG)


def q_load_errors(spark, sf_dir):
    """Hourly rows written as the pipe file, with the price text of every
    case-variant-id row spoiled and some coins left out; the report must list
    exactly those lines, with column and reason."""
    m = Model(spark, sf_dir)
    path = scratch_path(spark, "hourly-bad-csv")
    price = F.col("price").cast("string")
    spoiled = m.hourly_src.withColumn("price", F.when(F.col("coin").startswith("Nation-"), F.concat(price, F.lit("x"))).otherwise(price))
    spoiled = spoiled.withColumn("coin", F.when(F.col("src_id") % 16 != 3, F.col("coin")))
    write_pipe_file(spoiled.drop("src_id"), path)
    return load_errors(spark, path, S.HOURLY_STG).select("raw_line", "column_name", "reason")


LINES_PER_FILE = 4096


def q_load_error_lines(spark, sf_dir):
    """The same lines with blanks and NULL markers, in one file per block of source ids
    and in their order: each bad line as it stands, with its number in its file."""
    m = Model(spark, sf_dir)
    path = scratch_path(spark, "hourly-lines")
    price = F.col("price").cast("string")
    rows = m.hourly_src.withColumns({
        "block": F.floor(F.col("src_id") / LINES_PER_FILE),
        "price": F.when(F.col("coin").startswith("Nation-"), F.concat(F.lit(" "), price, F.lit("x "))).otherwise(price),
        "coin": F.when(F.col("src_id") % 16 != 3, F.col("coin")),
    })
    rows = with_timestamp_text(rows).repartition("block").sortWithinPartitions("block", "src_id").drop("src_id")
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows.write.partitionBy("block").options(**HOURLY_CSV_WRITE, **keep).csv(path)
    return load_errors(spark, f"{path}/block=*", S.HOURLY_STG).select(
        F.regexp_extract("file_path", "block=([0-9]+)", 1).cast("long").alias("block"),
        "line_number", "raw_line", "column_name", "reason",
    )


def q_read_documents(spark, sf_dir):
    m = Model(spark, sf_dir)
    path = scratch_path(spark, "tweets-json")
    m.tweets_stg.withColumn("_id", F.col("tweet_id").cast("string")).write.json(path)
    schema = S.TWEETS_STG.struct().add("_id", "string")
    return read_documents(spark, path, schema, where={"crypto": "R1"}).select(*S.TWEETS_STG.names)


def q_append_documents(spark, sf_dir):
    """Tweets appended to a collection in two goes, and read back."""
    m = Model(spark, sf_dir)
    path = scratch_path(spark, "tweets-appended")
    for odd in (0, 1):
        append_documents(m.tweets_stg.where(F.col("tweet_id") % 2 == odd), path)
    return read_documents(spark, path, S.TWEETS_STG.struct())


def q_flatten_market_chart(spark, sf_dir):
    """Several documents of a coin, whose timestamps overlap."""
    m = Model(spark, sf_dir)
    path = scratch_path(spark, "market-chart-json")
    fx.market_chart_docs(m.hourly_src).write.json(path)
    return flatten_market_chart(read_documents(spark, path, MARKET_CHART))


def q_conform(spark, sf_dir):
    return conform(Model(spark, sf_dir).tweets_stg, S.TWEETS_STG, validate="eager")


def q_last_n_days(spark, sf_dir):
    return last_n_days(Model(spark, sf_dir).hourly_stg, 30)


def q_time_range(spark, sf_dir):
    return time_range(Model(spark, sf_dir).hourly_stg, "1996-01-01 00:00:00", "1996-06-30 20:00:00")


COIN_LIST = ["nation-1", "Nation-4", "nation_7", "nation-16", "nation_23"]


def q_coin_subset(spark, sf_dir):
    return coin_subset(Model(spark, sf_dir).hourly_stg, COIN_LIST)


def q_coin_subset_long(spark, sf_dir):
    """A list beyond the IN-list bound: the same columns in the same order."""
    return coin_subset(Model(spark, sf_dir).hourly_stg, [f"nation_{i}" for i in range(1200)])


# -- dimensions ------------------------------------------------------------

def q_coin_dim(spark, sf_dir):
    return Model(spark, sf_dir).coin_dim


def _keyed_date_dim(df: DataFrame, ts_col: str, id_col: str) -> DataFrame:
    keyed = with_surrogate_key(df.select(ts_col, id_col), "date_key", [ts_col, id_col])
    return build_date_dim(keyed, ts_col, keep=["date_key"]).select(*S.DATE_DIM.names)


def q_date_dim_tweets(spark, sf_dir):
    return _keyed_date_dim(Model(spark, sf_dir).tweets_stg, "datetime", "tweet_id")


def q_date_dim_crypto(spark, sf_dir):
    return _keyed_date_dim(Model(spark, sf_dir).hourly_src, "date", "src_id")


def q_date_dim_events(spark, sf_dir):
    """D1 on a second calendar input: the microsecond stamps of ``events``."""
    configure(spark)
    ev = fx.table(spark, sf_dir, "events").select(F.col("ts"), F.col("event_id"))
    return _keyed_date_dim(ev, "ts", "event_id")


def q_date_dim(spark, sf_dir):
    return Model(spark, sf_dir, "bag").date_dim


def q_date_dim_set(spark, sf_dir):
    return Model(spark, sf_dir, "set").date_dim


def q_load_dimension_append(spark, sf_dir):
    """Tweets dates loaded with ``mode='delete'``, hourly dates appended with
    keys continuing from the table (K2), as the reference's two loads."""
    m = Model(spark, sf_dir)
    cat = Catalog(spark, scratch_path(spark, "catalog"))
    first = _keyed_date_dim(m.tweets_stg, "datetime", "tweet_id")
    load_dimension(cat, "dim.date_dim", first, mode="delete", batch_id="tweets")
    for _ in range(2):  # a repeated append gives the same keys
        existing = cat.read("dim.date_dim", without_batch="crypto")
        crypto = append_with_keys(existing, m.hourly_src.select("date", "src_id"), "date_key", ["date", "src_id"])
        crypto = build_date_dim(crypto, "date", keep=["date_key"]).select(*S.DATE_DIM.names)
        out = load_dimension(cat, "dim.date_dim", crypto, mode="append", batch_id="crypto")
    return out


def q_load_dimension_ranges(spark, sf_dir):
    """Two appends at once: both claim their key ranges before either is written."""
    m = Model(spark, sf_dir)
    cat = Catalog(spark, scratch_path(spark, "catalog"))
    load = {"tweets": (m.tweets_stg, ["datetime", "tweet_id"]), "crypto": (m.hourly_src, ["date", "src_id"])}
    keyed = {b: append_with_range(cat, "dim.date_dim", df.select(order), "date_key", order, b) for b, (df, order) in load.items()}
    for batch in ("crypto", "tweets"):
        dates = build_date_dim(keyed[batch], load[batch][1][0], keep=["date_key"]).select(*S.DATE_DIM.names)
        out = load_dimension(cat, "dim.date_dim", dates, mode="append", batch_id=batch)
    return out


# -- facts -----------------------------------------------------------------

def q_coin_stats_hist(spark, sf_dir):
    return Model(spark, sf_dir, "bag").coin_stats()


def q_coin_stats_hist_set(spark, sf_dir):
    return Model(spark, sf_dir, "set").coin_stats()


def q_coin_stats_hist_by_id(spark, sf_dir):
    m = Model(spark, sf_dir, "bag")
    return build_coin_stats_hist_by_id(m.hourly_src, m.date_dim, m.coin_dim, m.date_mode, m.small_coin_list, m.dates)


def q_tweets_hist(spark, sf_dir):
    return Model(spark, sf_dir, "bag").tweets()


def q_tweets_hist_set(spark, sf_dir):
    return Model(spark, sf_dir, "set").tweets()


def _same_time(spark, sf_dir, mode):
    """J5 over the facts, computed from the unfanned matches (``same_time_from_matches``)."""
    m = Model(spark, sf_dir, mode)
    return A.same_time_from_matches(m.coin_matches(), m.tweet_matches(), m.multiplicity())


def q_same_time(spark, sf_dir):
    return _same_time(spark, sf_dir, "bag")


def q_same_time_set(spark, sf_dir):
    return _same_time(spark, sf_dir, "set")


def q_same_time_top5(spark, sf_dir):
    m = Model(spark, sf_dir, "bag")
    return A.same_time_top(m.coin_matches(), m.tweet_matches(), m.multiplicity(), 5)


def q_load_fact_append(spark, sf_dir):
    """A fact loaded in two batches, the appended one twice."""
    m = Model(spark, sf_dir, "set")
    cat = Catalog(spark, scratch_path(spark, "catalog"))
    fact = m.coin_stats()
    load_fact(cat, "crypto.coin_stats_hist", fact.where("coin_key % 2 = 0"), mode="delete", batch_id="even")
    for _ in range(2):
        out = load_fact(cat, "crypto.coin_stats_hist", fact.where("coin_key % 2 = 1"), mode="append", batch_id="odd")
    return out


MONTH_RANGE = ("1996-03-10 00:00:00", "1997-01-31 23:59:59")


def _partitioned_fact(spark, sf_dir):
    """``coin_stats_hist`` in two batches, partitioned by month."""
    m = Model(spark, sf_dir, "set")
    cat = Catalog(spark, scratch_path(spark, "catalog"))
    fact = with_month(m.coin_stats())
    load_fact(cat, "crypto.coin_stats_hist", fact.where("coin_key % 2 = 0"), "delete", "even", MONTH_PARTS, S.COIN_STATS_HIST)
    load_fact(cat, "crypto.coin_stats_hist", fact.where("coin_key % 2 = 1"), "append", "odd", MONTH_PARTS, S.COIN_STATS_HIST)
    return cat, fact


def q_load_fact_partitioned(spark, sf_dir):
    cat, _ = _partitioned_fact(spark, sf_dir)
    return cat.read("crypto.coin_stats_hist").select(*S.COIN_STATS_HIST.names, *MONTH_PARTS)


def q_load_fact_replace_month(spark, sf_dir):
    """One month of one batch is loaded again with other prices."""
    cat, fact = _partitioned_fact(spark, sf_dir)
    again = fact.where((F.col(YEAR) == 1996) & (F.col(MONTH) == 5) & (F.col("coin_key") % 2 == 1))
    again = again.withColumn("price", F.col("price") + 1)
    out = load_fact(cat, "crypto.coin_stats_hist", again, "replace", "odd", MONTH_PARTS, S.COIN_STATS_HIST)
    return out.select(*S.COIN_STATS_HIST.names)


def q_time_range_partitioned(spark, sf_dir):
    """F-5 over the partitioned fact: only the months of the range are read."""
    cat, _ = _partitioned_fact(spark, sf_dir)
    return time_range(cat.read("crypto.coin_stats_hist"), *MONTH_RANGE).select(*S.COIN_STATS_HIST.names)


def q_monthly_price_stats_partitioned(spark, sf_dir):
    """A1 over some months of the partitioned fact, by its partition columns."""
    cat, _ = _partitioned_fact(spark, sf_dir)
    return A.monthly_price_stats(time_range(cat.read("crypto.coin_stats_hist"), *MONTH_RANGE))


def q_write_conformed(spark, sf_dir):
    """The tweets written with their declared rules counted by the write; a second
    write that breaks them leaves the first, which is read back."""
    m = Model(spark, sf_dir)
    cat = Catalog(spark, scratch_path(spark, "catalog"))
    write_table(m.tweets_stg, cat.path("tweets"), schema=S.TWEETS_STG)
    try:
        write_table(_broken_tweets(m), cat.path("tweets"), schema=S.TWEETS_STG)
    except ConstraintError:
        return cat.read("tweets")
    raise AssertionError("a write that breaks declared rules must not count")


def q_write_violations(spark, sf_dir):
    """What such a write reports: rows per rule."""
    m = Model(spark, sf_dir)
    cat = Catalog(spark, scratch_path(spark, "catalog"))
    try:
        write_table(_broken_tweets(m), cat.path("tweets"), schema=S.TWEETS_STG)
    except ConstraintError as e:
        return spark.createDataFrame(e.violations, "column_name string, rule string, violations long")
    raise AssertionError("a write that breaks declared rules must not count")


def _broken_tweets(m: Model) -> DataFrame:
    """Every seventh tweet without a text, every eleventh by a name of 257 characters."""
    return m.tweets_stg.withColumns({
        "text": F.when(F.col("tweet_id") % 7 != 0, F.col("text")),
        "username": F.when(F.col("tweet_id") % 11 == 0, F.repeat(F.lit("u"), 257)).otherwise(F.col("username")),
    })


# -- aggregates and orderings ---------------------------------------------

def q_monthly_price_stats(spark, sf_dir):
    """A1 over the bag-mode fact, computed without building the fan-out: MIN/MAX
    are equal over the coin-matched staging rows (see ``analysis``)."""
    return A.monthly_price_stats(Model(spark, sf_dir, "bag").coin_matches(keyed=False))


def q_monthly_price_stats_set(spark, sf_dir):
    return A.monthly_price_stats(Model(spark, sf_dir, "set").coin_matches(keyed=False))


def q_monthly_price_minmax(spark, sf_dir):
    return A.monthly_price_minmax(Model(spark, sf_dir, "bag").coin_matches(keyed=False))


def q_monthly_price_avg(spark, sf_dir):
    """A3 over the bag-mode fact: staging rows weighted by their timestamp's
    dimension-row count instead of materialising the fan-out."""
    m = Model(spark, sf_dir, "bag")
    return A.monthly_price_avg_weighted(m.coin_matches(keyed=False), m.multiplicity())


def q_monthly_price_avg_set(spark, sf_dir):
    return A.monthly_price_avg_weighted(Model(spark, sf_dir, "set").coin_matches(keyed=False), None)


def q_monthly_price_stats_fact(spark, sf_dir):
    """A1 as the reference computes it: fact joined to the date dimension by key."""
    m = Model(spark, sf_dir, "set")
    return A.monthly_price_stats(m.coin_stats(), m.date_dim)


def _pipeline(spark, sf_dir, **options):
    """The whole job over the fixtures, written as the files it stages."""
    m = Model(spark, sf_dir, "set")
    path = scratch_path(spark, "pipeline")
    write_pipe_file(m.coin_stg, f"{path}/coins")
    write_pipe_file(m.hourly_stg, f"{path}/hourly/2024")
    m.tweets_stg.write.parquet(f"{path}/tweets")
    src = Sources(f"{path}/coins", f"{path}/hourly/{{year}}", f"{path}/tweets", {"year": 2024})
    return run_pipeline(spark, src, f"{path}/wh", date_mode="set", **options)


def q_pipeline_monthly(spark, sf_dir):
    """Stage, dimensions, checks, facts, checks, aggregate; its monthly table."""
    return _pipeline(spark, sf_dir).table(T_MONTHLY)


_EXPORTED = {
    T_TWEETS_HIST: (S.TWEETS_HIST, "tweet"), T_COIN_STATS: (S.COIN_STATS_HIST, "coin_name"),
    T_DATE_DIM: (S.DATE_DIM, "weekday"), T_COIN_DIM: (S.COIN_DIM, "name"), T_MONTHLY: (S.MONTHLY_STATS, "coin_name"),
}


def q_export_all(spark, sf_dir):
    """The five exported tables read back: their rows and the characters of a text."""
    prefix = scratch_path(spark, "export")
    _pipeline(spark, sf_dir, export_prefix=prefix)
    out = None
    for name, table in EXPORTS:
        schema, text = _EXPORTED[table]
        back = read_exported_csv(spark, f"{prefix}/{name}.csv", schema.struct())
        part = back.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.char_length(text)).cast("long").alias("n_chars"),
        ).select("table_name", "n_rows", "n_chars")
        out = part if out is None else out.unionByName(part)
    return out


def q_monthly_sorted(spark, sf_dir):
    return A.monthly_sorted(q_monthly_price_stats(spark, sf_dir))


def q_monthly_sorted_text(spark, sf_dir):
    return A.monthly_sorted_text(q_monthly_price_minmax(spark, sf_dir))


def q_preview_coin_dim(spark, sf_dir):
    return A.preview(Model(spark, sf_dir).coin_dim, 10, ["coin_key"])


def q_preview_coin_stats(spark, sf_dir):
    """First 10 fact rows in key order, without building the bag-mode fact."""
    m = Model(spark, sf_dir)
    return A.fact_head(m.coin_matches(), m.date_dim, 10, S.COIN_STATS_HIST.names)


def q_preview_tweets(spark, sf_dir):
    m = Model(spark, sf_dir)
    return A.fact_head(m.tweet_matches(), m.date_dim, 10, S.TWEETS_HIST.names)


# -- functions, checks, sinks ---------------------------------------------

def q_epoch_roundtrip(spark, sf_dir):
    configure(spark)
    ev = fx.table(spark, sf_dir, "events").select("event_id", "ts")
    iso = ev.withColumn("iso_text", iso_text("ts"))
    return iso.select(
        "event_id", "ts", "iso_text",
        text_to_epoch_seconds("iso_text").alias("epoch_seconds"),
        epoch_millis("ts").alias("epoch_millis"),
        millis_to_timestamp(epoch_millis("ts")).alias("ts_from_millis"),
    )


def _stored_facts(spark, sf_dir):
    """Facts and dimensions written once, with faults: some keys NULL, and some
    dimension rows taken away."""
    m = Model(spark, sf_dir, "set")
    cat = Catalog(spark, scratch_path(spark, "catalog"))
    coin = F.when(F.col("coin_key") != 3, F.col("coin_key"))
    date = F.when(F.col("date_key") % 11 != 0, F.col("date_key"))
    out = {}
    for name, df in (("coin_stats_hist", m.coin_stats()), ("tweets_hist", m.tweets())):
        out[name] = load_fact(cat, name, df.withColumn("coin_key", coin).withColumn("date_key", date))
    out["coin_dim"] = load_dimension(cat, "coin_dim", m.coin_dim.where("coin_key % 5 <> 0"))
    out["date_dim"] = load_dimension(cat, "date_dim", m.date_dim.where("date_key % 7 <> 3"))
    return m, out


def q_null_key_report(spark, sf_dir):
    m, t = _stored_facts(spark, sf_dir)
    parts = [
        Q.null_key_report(m.coin_stg, ["coin_id", "symbol", "name"], "coin_stg"),
        Q.null_key_report(t["coin_dim"], ["coin_key"], "coin_dim"),
        Q.null_key_report(t["date_dim"], ["date_key"], "date_dim"),
        Q.null_key_report(t["coin_stats_hist"], ["coin_key", "date_key"], "coin_stats_hist"),
        Q.null_key_report(t["tweets_hist"], ["coin_key", "date_key"], "tweets_hist"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "key_column", F.col("null_rows").cast("long").alias("null_rows"))


def q_fk_orphans(spark, sf_dir):
    _, t = _stored_facts(spark, sf_dir)
    dims = {"coin_key": t["coin_dim"], "date_key": t["date_dim"]}
    return Q.fk_orphan_report({n: t[n] for n in ("coin_stats_hist", "tweets_hist")}, dims)


def q_fk_orphans_dense(spark, sf_dir):
    """Q4 by the bounds and the missing keys of the dimensions."""
    _, t = _stored_facts(spark, sf_dir)
    dims = {"coin_key": t["coin_dim"], "date_key": t["date_dim"]}
    return Q.dense_fk_orphan_report({n: t[n] for n in ("coin_stats_hist", "tweets_hist")}, dims)


def _bag_sides(spark, sf_dir):
    """What the bag-mode facts are products of, stored once, with NULL keys in both."""
    m = Model(spark, sf_dir, "bag")
    cat = Catalog(spark, scratch_path(spark, "catalog"))
    coin = F.when(F.col("coin_key") != 3, F.col("coin_key"))
    date = F.when(F.col("date_key") % 11 != 0, F.col("date_key"))
    dates = load_dimension(cat, "date_dim", m.date_dim.select("date_key", "date"))
    coins = load_dimension(cat, "coin_dim", m.coin_dim)
    matched = {
        name: load_fact(cat, name, df.select(coin.alias("coin_key"), "date"))
        for name, df in (("coin_stats_hist", m.coin_matches()), ("tweets_hist", m.tweet_matches()))
    }
    return matched, dates.select(date.alias("date_key"), "date"), coins, dates


def q_bag_null_key_report(spark, sf_dir):
    """Q1 of the bag-mode facts without building them."""
    matched, dates, _, _ = _bag_sides(spark, sf_dir)
    a, b = (Q.product_null_key_report(df, dates, ["date"], ["coin_key", "date_key"], n) for n, df in matched.items())
    return a.unionByName(b)


def q_bag_fk_orphans(spark, sf_dir):
    """Q4 of the bag-mode facts without building them."""
    matched, dates, coins, all_dates = _bag_sides(spark, sf_dir)
    dims = {"coin_key": coins.where("coin_key % 5 <> 0"), "date_key": all_dates.where("date_key % 7 <> 3")}
    a, b = (Q.product_fk_orphan_report(df, dates, ["date"], dims, n) for n, df in matched.items())
    return a.unionByName(b)


def q_declared_table(spark, sf_dir):
    """The hourly rows through a declared catalog table: an insert, one that is too long
    and fails, and an overwrite of the whole."""
    m = Model(spark, sf_dir)
    name = f"starloom_{uuid.uuid4().hex[:12]}"
    create_table(spark, S.HOURLY_STG, name, location=scratch_path(spark, "declared"))
    insert_rows(m.hourly_stg.limit(10), S.HOURLY_STG, name)
    try:
        insert_rows(m.hourly_stg.withColumn("coin", F.repeat("coin", 64)), S.HOURLY_STG, name, overwrite=True)
    except Exception as e:
        if "EXCEED_LIMIT_LENGTH" not in str(e):
            raise
        return insert_rows(m.hourly_stg, S.HOURLY_STG, name, overwrite=True)
    raise AssertionError("a text beyond its declared length must fail the write")


def q_find_null(spark, sf_dir):
    """``find({username: null})``: documents whose field is null or absent."""
    m = Model(spark, sf_dir)
    path = scratch_path(spark, "tweets-null")
    some = F.when(F.col("tweet_id") % 5 != 0, F.col("username"))
    m.tweets_stg.withColumn("username", some).write.json(path)
    return read_documents(spark, path, S.TWEETS_STG.struct(), where={"username": None})


def q_run_checks(spark, sf_dir):
    """A list of checks under both policies: how many rows each shows, and whether
    the strict policy stops at it."""
    m = Model(spark, sf_dir, "set")
    checks = {
        "coins without id": m.coin_stg.where("coin_id is null"),
        "prices below zero": m.hourly_stg.where("price < 0"),
        "tweets of unknown coins": m.tweets_stg.join(
            coin_aliases(m.coin_list, ["name", "symbol"], upper=False), F.col("crypto") == F.col("_coin_alias"), "left_anti"
        ),
    }
    shown = Q.run_checks(list(checks.values()), show=3)
    rows = []
    for (name, check), sample in zip(checks.items(), shown, strict=True):
        try:
            Q.run_checks([check], fail_if_rows=True)
            failed = False
        except Q.CheckFailed:
            failed = True
        rows.append((name, len(sample), failed))
    return spark.createDataFrame(rows, "check_name string, shown long, failed boolean")


def q_csv_roundtrip_events(spark, sf_dir):
    """Microseconds survive an export."""
    configure(spark)
    path = scratch_path(spark, "events-export")
    events = fx.table(spark, sf_dir, "events").select("event_id", "ts")
    export_csv(events, path)
    return read_exported_csv(spark, path, events.schema)


def q_csv_one_file(spark, sf_dir):
    """The hourly rows exported as one file that all tasks write."""
    m = Model(spark, sf_dir)
    path = scratch_path(spark, "hourly-export") + ".csv"
    export_csv_file(m.hourly_stg, path)
    return read_exported_csv(spark, path, S.HOURLY_STG.struct())


def q_csv_roundtrip(spark, sf_dir):
    m = Model(spark, sf_dir)
    path = scratch_path(spark, "tweets-export")
    export_csv(m.tweets_stg, path)
    return read_exported_csv(spark, path, S.TWEETS_STG.struct())


QUERIES: dict[str, Query] = {
    "stage_delimited": q_stage_delimited,
    "stage_parquet": q_stage_parquet,
    "load_errors": q_load_errors,
    "load_error_lines": q_load_error_lines,
    "read_documents": q_read_documents,
    "append_documents": q_append_documents,
    "flatten_market_chart": q_flatten_market_chart,
    "conform": q_conform,
    "last_n_days": q_last_n_days,
    "time_range": q_time_range,
    "coin_subset": q_coin_subset,
    "coin_subset_long": q_coin_subset_long,
    "coin_dim": q_coin_dim,
    "date_dim_tweets": q_date_dim_tweets,
    "date_dim_crypto": q_date_dim_crypto,
    "date_dim_events": q_date_dim_events,
    "date_dim": q_date_dim,
    "date_dim_set": q_date_dim_set,
    "load_dimension_append": q_load_dimension_append,
    "load_dimension_ranges": q_load_dimension_ranges,
    "coin_stats_hist": q_coin_stats_hist,
    "coin_stats_hist_set": q_coin_stats_hist_set,
    "coin_stats_hist_by_id": q_coin_stats_hist_by_id,
    "tweets_hist": q_tweets_hist,
    "tweets_hist_set": q_tweets_hist_set,
    "load_fact_append": q_load_fact_append,
    "load_fact_partitioned": q_load_fact_partitioned,
    "load_fact_replace_month": q_load_fact_replace_month,
    "time_range_partitioned": q_time_range_partitioned,
    "monthly_price_stats_partitioned": q_monthly_price_stats_partitioned,
    "write_conformed": q_write_conformed,
    "write_violations": q_write_violations,
    "tweets_and_stats_same_time": q_same_time,
    "tweets_and_stats_same_time_set": q_same_time_set,
    "tweets_and_stats_top5": q_same_time_top5,
    "monthly_price_stats": q_monthly_price_stats,
    "monthly_price_stats_set": q_monthly_price_stats_set,
    "monthly_price_stats_fact": q_monthly_price_stats_fact,
    "pipeline_monthly": q_pipeline_monthly,
    "monthly_price_minmax": q_monthly_price_minmax,
    "monthly_price_avg": q_monthly_price_avg,
    "monthly_price_avg_set": q_monthly_price_avg_set,
    "monthly_sorted": q_monthly_sorted,
    "monthly_sorted_text": q_monthly_sorted_text,
    "preview_coin_dim": q_preview_coin_dim,
    "preview_coin_stats": q_preview_coin_stats,
    "preview_tweets": q_preview_tweets,
    "epoch_roundtrip": q_epoch_roundtrip,
    "null_key_report": q_null_key_report,
    "fk_orphans": q_fk_orphans,
    "fk_orphans_dense": q_fk_orphans_dense,
    "bag_null_key_report": q_bag_null_key_report,
    "bag_fk_orphans": q_bag_fk_orphans,
    "declared_table": q_declared_table,
    "find_null": q_find_null,
    "run_checks": q_run_checks,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_one_file": q_csv_one_file,
    "csv_roundtrip_events": q_csv_roundtrip_events,
    "export_all": q_export_all,
}
