"""Operators on tiny frames: conform rules, keys, calendar, alias joins,
checks, orderings, and the plans they produce."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions.calendar import date_parts, epoch_millis, iso_text, millis_to_timestamp, text_to_epoch_seconds
from starloom.operators import analysis as A
from starloom.operators import quality as Q
from starloom.operators.conform import ConstraintError, conform, violation_report
from starloom.operators.dims import build_coin_dim, build_date_dim, build_date_dim_from_sources
from starloom.operators.facts import build_coin_stats_hist, build_tweets_hist, match_coins
from starloom.operators.filters import coin_subset, last_n_days, time_range
from starloom.operators.keys import append_with_keys, with_surrogate_key
from starloom.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- conform ---------------------------------------------------------------

def _tweets(spark, text, tid=1):
    return spark.createDataFrame([(dt.datetime(2020, 1, 1), tid, text, "u", "c")], S.TWEETS_STG.struct())


def test_over_long_text_raises(spark):
    t = S.TWEETS_STG
    hourly_like = spark.createDataFrame([("x" * 257, "s", "n")], "coin_id string, symbol string, name string")
    with pytest.raises(ConstraintError):
        conform(hourly_like, S.COIN_LIST_STG, validate="eager")
    assert conform(_tweets(spark, "x" * 10000), t, validate="eager").count() == 1


def test_lazy_check_raises_inside_the_plan(spark):
    bad = spark.createDataFrame([(None, "s", "n"), ("a", None, "n")], "coin_id string, symbol string, name string")
    with pytest.raises(Exception, match="ConstraintError"):
        conform(bad, S.COIN_LIST_STG, validate="lazy").collect()


def test_violation_report_counts_each_rule(spark):
    bad = spark.createDataFrame([("a", None, "n"), ("b", None, "x" * 300)], "coin_id string, symbol string, name string")
    rep = {(r["column_name"], r["rule"]): r["violations"] for r in violation_report(bad, S.COIN_LIST_STG).collect()}
    assert rep[("symbol", "not_null")] == 2
    assert rep[("name", "max_length_256")] == 1
    assert rep[("coin_id", "max_length_256")] == 0


def test_decimal_overflow_into_price_scale_raises(spark):
    df = spark.createDataFrame([(Decimal("12345678901234.12"),)], "v decimal(18,2)")
    with pytest.raises(Exception):
        df.select(F.col("v").cast("decimal(18,5)")).collect()


# -- keys ------------------------------------------------------------------

def test_keys_are_dense_and_follow_the_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 3).alias("g"))
    keyed = with_surrogate_key(df, "k", ["g", "v"])
    ref = df.select("g", "v", (F.row_number().over(Window.orderBy("g", "v")) - 1).alias("k"))
    assert keyed.select("g", "v", "k").exceptAll(ref).count() == 0
    assert sorted(r["k"] for r in keyed.select("k").collect()) == list(range(5000))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=0, max_size=60), st.integers(1, 9))
def test_keys_property(spark, values, parts):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, i long")
    keyed = with_surrogate_key(df, "k", ["v", "i"], start=3, partitions=parts).collect()
    expected = {(v, i): n + 3 for n, (v, i) in enumerate(sorted((v, i) for i, v in enumerate(values)))}
    assert {(r["v"], r["i"]): r["k"] for r in keyed} == expected


def test_keys_continue_after_existing_table(spark):
    existing = spark.createDataFrame([(0,), (1,), (2,)], "k long")
    new = spark.createDataFrame([("b",), ("a",)], "x string")
    assert [(r["x"], r["k"]) for r in append_with_keys(existing, new, "k", ["x"]).orderBy("k").collect()] == [("a", 3), ("b", 4)]
    empty = spark.createDataFrame([], "k long")
    assert [r["k"] for r in append_with_keys(empty, new, "k", ["x"]).orderBy("k").collect()] == [0, 1]


def test_date_dim_plan_has_no_single_partition_exchange_over_rows(spark):
    st_ = fx.staging(spark, SF)
    dd = build_date_dim_from_sources(st_["tweets_stg"], st_["hourly_stg"], "bag")
    dd.collect()
    lines = plan_text(dd).split("\n")
    assert any("shufflepartitionidpassthrough" in ln for ln in lines)
    assert not any("BroadcastNestedLoopJoin" in ln for ln in lines)
    # Every single-partition exchange sits on the per-partition counts (one row
    # per range partition), never on row data.
    singles = [i for i, ln in enumerate(lines) if "Exchange SinglePartition" in ln]
    assert singles
    for i in singles:
        below = next(ln for ln in lines[i + 1:] if "HashAggregate" in ln or "Scan" in ln or "Exchange" in ln)
        assert "HashAggregate(keys=[_sk_bucket" in below, below


# -- calendar --------------------------------------------------------------

def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 1, 1, 5),), (dt.datetime(2020, 12, 31, 5),)], "date timestamp_ntz")
    rows = build_date_dim(df, "date").orderBy("date").collect()
    assert [(r["week"], r["weekday"], r["month"], r["hour"], r["year"]) for r in rows] == [
        (52, "0", "1", 5, 2017), (53, "4", "12", 5, 2020)
    ]
    assert set(date_parts("date")) == {"hour", "day", "week", "month", "year", "weekday"}


def test_epoch_conversions(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 1, 22, 0, 0, 0, 123456),), (dt.datetime(2017, 1, 22),)], "ts timestamp_ntz")
    out = df.select(
        iso_text("ts").alias("iso"), epoch_millis("ts").alias("ms"),
        millis_to_timestamp(epoch_millis("ts")).alias("back"), text_to_epoch_seconds(iso_text("ts")).alias("s"),
    ).collect()
    assert [r["iso"] for r in out] == ["2017-01-22T00:00:00.123456", "2017-01-22T00:00:00"]
    assert [r["ms"] for r in out] == [1485043200123, 1485043200000]
    assert out[0]["back"] == dt.datetime(2017, 1, 22, 0, 0, 0, 123000)
    assert out[0]["s"] == pytest.approx(1485043200.123456)


# -- joins -----------------------------------------------------------------

def _coins(spark):
    return build_coin_dim(spark.createDataFrame(
        [("btc", "BTC", "Bitcoin"), ("Same", "s", "same"), ("eth", "ETH", "Ethereum"), ("x2", "ETH", "EthClone")],
        S.COIN_LIST_STG.struct(),
    ))


def test_coin_whose_id_equals_its_name_matches_once(spark):
    stg = spark.createDataFrame([("SAME",), ("bitcoin",), ("nope",)], "coin string")
    rows = match_coins(stg, _coins(spark), "coin", ["coin_id", "name"], upper=True).collect()
    assert sorted(r["coin"] for r in rows) == ["SAME", "bitcoin"]


def test_shared_symbol_matches_every_coin_and_case_matters(spark):
    stg = spark.createDataFrame([("ETH",), ("ethereum",), ("Ethereum",)], "crypto string")
    rows = match_coins(stg, _coins(spark), "crypto", ["name", "symbol"], upper=False).collect()
    assert sorted((r["crypto"], r["name"]) for r in rows) == [("ETH", "EthClone"), ("ETH", "Ethereum"), ("Ethereum", "Ethereum")]


def test_alias_join_equals_or_join_and_plans_as_hash_join(spark):
    m = fx.staging(spark, SF)
    coin_dim = build_coin_dim(m["coin_stg"])
    dd = build_date_dim_from_sources(m["tweets_stg"], m["hourly_stg"], "bag")
    fact = build_coin_stats_hist(m["hourly_stg"], dd, coin_dim)
    h, c, d = m["hourly_stg"].alias("h"), coin_dim.alias("c"), dd.alias("d")
    or_join = h.join(d, F.col("d.date") == F.col("h.date")).join(
        c, (F.upper("h.coin") == F.upper("c.coin_id")) | (F.upper("h.coin") == F.upper("c.name"))
    ).select(F.col("d.date_key"), F.col("c.coin_key"), F.col("h.date"), F.col("c.name").alias("coin_name"),
             F.col("c.symbol").alias("coin_symbol"), "h.price", "h.market_cap", "h.total_volumes")
    assert fact.exceptAll(or_join).count() == 0 and or_join.exceptAll(fact).count() == 0
    fact.collect()
    assert "BroadcastNestedLoopJoin" not in plan_text(fact)
    tw = build_tweets_hist(m["tweets_stg"], dd, coin_dim)
    tw.collect()
    assert "BroadcastNestedLoopJoin" not in plan_text(tw)


def test_set_mode_fact_is_distinct_bag_fact(spark):
    m = fx.staging(spark, SF)
    coin_dim = build_coin_dim(m["coin_stg"])
    bag = build_coin_stats_hist(m["hourly_stg"], build_date_dim_from_sources(m["tweets_stg"], m["hourly_stg"], "bag"), coin_dim)
    st_ = build_coin_stats_hist(m["hourly_stg"], build_date_dim_from_sources(m["tweets_stg"], m["hourly_stg"], "set"), coin_dim)
    b, s_ = bag.drop("date_key").distinct(), st_.drop("date_key")
    assert b.exceptAll(s_).count() == 0 and s_.exceptAll(b).count() == 0
    a1_bag, a1_set = A.monthly_price_stats(bag), A.monthly_price_stats(st_)
    assert a1_bag.exceptAll(a1_set).count() == 0 and a1_set.exceptAll(a1_bag).count() == 0


# -- checks ----------------------------------------------------------------

def test_null_key_check_raises_and_empty_passes(spark):
    stg = fx.coin_stg(spark.read.parquet(f"{SF}/nation.parquet"))
    with pytest.raises(Q.NullKeyError):
        Q.check_no_nulls(stg, ["coin_id"], "cg_coin_list_stg")
    empty = spark.createDataFrame([], "coin_key long")
    assert Q.check_no_nulls(empty, ["coin_key"], "cg_coin_list")[0]["null_rows"] == 0


def test_orphan_key_is_reported(spark):
    dim = spark.createDataFrame([(0,), (1,)], "coin_key long")
    fact = spark.createDataFrame([(0,), (1,), (7,), (7,)], "coin_key long")
    rows = Q.fk_orphans(fact, dim, "coin_key").collect()
    assert [(r["coin_key"], r["rows"]) for r in rows] == [(7, 2)]
    with pytest.raises(Q.OrphanKeyError):
        Q.check_foreign_keys(fact, "f", {"coin_key": dim})


def test_run_checks_fail_if_rows(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert len(Q.run_checks([df, df.limit(0)])) == 2
    with pytest.raises(Q.CheckFailed):
        Q.run_checks([df.limit(0), df], fail_if_rows=True)


# -- orderings and filters -------------------------------------------------

def test_text_month_order_differs_from_calendar_order(spark):
    df = spark.createDataFrame([("c", "s", "2017", m) for m in ("1", "10", "2")], "coin_name string, coin_symbol string, year string, month string")
    text = [r["month"] for r in A.monthly_sorted_text(df).orderBy("sort_rank").collect()]
    cal = [r["month"] for r in A.monthly_sorted(df).orderBy("sort_rank").collect()]
    assert text == ["1", "10", "2"] and cal == ["1", "2", "10"]


def test_filters(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2020, 1, d), c) for d, c in [(1, "a"), (10, "b"), (20, "a"), (31, "c")]], "date timestamp_ntz, coin string"
    )
    assert last_n_days(df, 11).count() == 2
    assert last_n_days(df, 10, as_of="2020-01-20 00:00:00").count() == 2
    assert time_range(df, "2020-01-10", "2020-01-20").count() == 2
    assert coin_subset(df, ["a", "c"]).count() == 3
    assert coin_subset(df, ["a"] + [f"z{i}" for i in range(1500)]).count() == 2


def test_top_k_and_preview_are_ordered(spark):
    df = spark.range(100).select((F.col("id") * 37 % 100).alias("v"))
    assert [r["v"] for r in A.top_k(df, 3).collect()] == [0, 1, 2]
    assert [r["v"] for r in A.preview(df, 2).collect()] == [0, 1]


def test_linear_monthly_stats_equal_the_fan_out(spark):
    from starloom.operators.dims import date_rows
    from starloom.operators.facts import coin_stats_matches

    m = fx.staging(spark, SF)
    coin_dim = build_coin_dim(m["coin_stg"])
    dd = build_date_dim_from_sources(m["tweets_stg"], m["hourly_stg"], "bag")
    fact = build_coin_stats_hist(m["hourly_stg"], dd, coin_dim)
    matches = coin_stats_matches(m["hourly_stg"], coin_dim)

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    assert same(A.monthly_price_stats(fact), A.monthly_price_stats(matches))
    assert same(A.monthly_price_stats(fact, dd), A.monthly_price_stats(fact))
    mult = A.date_multiplicity(date_rows(m["tweets_stg"], m["hourly_stg"]))
    assert same(A.monthly_price_avg(fact), A.monthly_price_avg_weighted(matches, mult))


def test_repeat_rows_in_blocks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 0), ("d", 10)], "k string, n long")
    out = A.repeat_rows(df, "n", block=4).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in out} == {"a": 1, "b": 3, "d": 10}
    assert A.repeat_rows(df, "n", block=4).columns == ["k", "n"]


def test_same_time_from_matches_equals_fact_join(spark):
    from starloom.operators.dims import date_rows
    from starloom.operators.facts import coin_stats_matches, tweets_matches

    m = fx.staging(spark, SF)
    coin_dim = build_coin_dim(m["coin_stg"])
    for mode in ("bag", "set"):
        dd = build_date_dim_from_sources(m["tweets_stg"], m["hourly_stg"], mode)
        facts = A.same_time(
            build_coin_stats_hist(m["hourly_stg"], dd, coin_dim, mode), build_tweets_hist(m["tweets_stg"], dd, coin_dim, mode)
        )
        mult = A.date_multiplicity(date_rows(m["tweets_stg"], m["hourly_stg"])) if mode == "bag" else None
        fast = A.same_time_from_matches(coin_stats_matches(m["hourly_stg"], coin_dim), tweets_matches(m["tweets_stg"], coin_dim), mult)
        assert facts.exceptAll(fast).count() == 0 and fast.exceptAll(facts).count() == 0


def test_keys_split_a_hot_timestamp_across_partitions(spark):
    # One timestamp holds a third of all rows; the range partitioning on
    # (date, id) still spreads it, so no task numbers more than a fair share.
    n = 30000
    hot = dt.datetime(2020, 1, 1)
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(
            F.timestamp_add("HOUR", (F.col("id") % 1000).cast("int"), F.lit(hot))
        ).cast("timestamp_ntz").alias("date"),
        F.col("id"),
    )
    keyed = with_surrogate_key(df, "k", ["date", "id"], partitions=8)
    sizes = [r["c"] for r in keyed.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("c")).collect()]
    assert sum(sizes) == n and len(sizes) == 8
    assert max(sizes) < 2 * n / 8
    assert sorted(r["k"] for r in keyed.select("k").collect()) == list(range(n))


def test_coin_join_falls_back_to_a_shuffle_join_beyond_the_bound(spark, monkeypatch):
    from starloom.operators import facts, joins

    stg = spark.createDataFrame([("btc",), ("eth",), ("nope",)], "coin string")
    dim = _coins(spark)
    small = match_coins(stg, dim, "coin", ["coin_id", "name"], upper=True)
    small.collect()

    def coin_join(df):
        return [ln for ln in plan_text(df).split("\n") if "Join" in ln and "_coin_alias" in ln]

    assert any("BroadcastHashJoin" in ln for ln in coin_join(small))
    monkeypatch.setattr(facts, "maybe_broadcast", lambda df: F.broadcast(df) if joins.fits(df, 1) else df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = match_coins(stg, dim, "coin", ["coin_id", "name"], upper=True)
        big.collect()
        assert coin_join(big) and not any("BroadcastHashJoin" in ln for ln in coin_join(big))
        assert sorted(map(tuple, big.collect())) == sorted(map(tuple, small.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fact_head_equals_preview_of_the_fact(spark):
    from starloom.operators.facts import coin_stats_matches, tweets_matches

    m = fx.staging(spark, SF)
    coin_dim = build_coin_dim(m["coin_stg"])
    for mode in ("bag", "set"):
        dd = build_date_dim_from_sources(m["tweets_stg"], m["hourly_stg"], mode)
        fact = build_tweets_hist(m["tweets_stg"], dd, coin_dim, mode)
        for k in (1, 7, 10_000):
            want = [tuple(r) for r in A.preview(fact, k).collect()]
            got = [tuple(r) for r in A.fact_head(tweets_matches(m["tweets_stg"], coin_dim), dd, k, S.TWEETS_HIST.names).collect()]
            assert got == want
        cs = build_coin_stats_hist(m["hourly_stg"], dd, coin_dim, mode)
        got = A.fact_head(coin_stats_matches(m["hourly_stg"], coin_dim), dd, 10, S.COIN_STATS_HIST.names).collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in A.preview(cs, 10).collect()]
