"""Randomised properties: alias join == OR join, CSV export round trip."""

import datetime as dt
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators.dims import build_coin_dim
from starloom.operators.facts import match_coins
from starloom.sinks.csv import export_csv, read_exported_csv

WORDS = st.sampled_from(["btc", "BTC", "Btc", "eth", "ETH", "x", "X", "same", "SAME", ""])


@settings(max_examples=10, deadline=None)
@given(
    st.lists(st.tuples(st.one_of(st.none(), WORDS), WORDS, WORDS), min_size=1, max_size=8),
    st.lists(st.one_of(st.none(), WORDS), min_size=0, max_size=12),
    st.booleans(),
)
def test_alias_join_equals_or_join(spark, coins, texts, upper):
    coin_dim = build_coin_dim(spark.createDataFrame(coins, S.COIN_LIST_STG.struct()))
    stg = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, coin string")
    alias_cols = ["coin_id", "name"] if upper else ["name", "symbol"]
    got = match_coins(stg, coin_dim, "coin", alias_cols, upper=upper).select("i", "coin_key")
    norm = F.upper if upper else (lambda c: c)
    s, c = stg.alias("s"), coin_dim.alias("c")
    cond = None
    for a in alias_cols:
        term = norm(F.col("s.coin")) == norm(F.col(f"c.{a}"))
        cond = term if cond is None else cond | term
    want = s.join(c, cond).select("s.i", "c.coin_key")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


TEXT = st.text(alphabet=st.sampled_from(list('ab ,"|\n\t\\xé')), min_size=1, max_size=12)


@settings(max_examples=6, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_csv_export_round_trip(spark, tmp_path_factory, texts):
    schema = "d timestamp_ntz, p decimal(18,5), t string"
    rows = [(dt.datetime(2020, 1, 1, i % 24), Decimal(i) / 7, t) for i, t in enumerate(texts)]
    rows = [(d, p.quantize(Decimal("0.00001")), t) for d, p, t in rows]
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path_factory.mktemp("csv") / "out")
    export_csv(df, path)
    back = read_exported_csv(spark, path, schema)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-2, max_value=40), min_size=1, max_size=8), st.integers(1, 9))
def test_repeat_rows_makes_exactly_n_copies(spark, counts, block):
    from starloom.operators.analysis import repeat_rows

    df = spark.createDataFrame([(i, n) for i, n in enumerate(counts)], "i long, n long")
    got = {r["i"]: r["c"] for r in repeat_rows(df, "n", block=block).groupBy("i").agg(F.count("*").alias("c")).collect()}
    assert got == {i: n for i, n in enumerate(counts) if n > 0}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=3), min_size=1, max_size=40), st.integers(1, 6))
def test_keys_with_ties_are_still_dense_and_ordered(spark, values, parts):
    from starloom.operators.keys import with_surrogate_key

    df = spark.createDataFrame([(v,) for v in values], "v long")
    rows = with_surrogate_key(df, "k", ["v"], partitions=parts).collect()
    assert sorted(r["k"] for r in rows) == list(range(len(values)))
    by_key = [r["v"] for r in sorted(rows, key=lambda r: r["k"])]
    assert by_key == sorted(values)
