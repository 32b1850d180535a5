"""Work that must not grow faster than the input, or lie in one task."""

import pytest
from pyspark.sql import functions as F

from starloom.operators import joins, keys
from starloom.operators.joins import product_join
from starloom.operators.keys import with_surrogate_key
from starloom.sinks.csv import export_csv_file, read_exported_csv


def test_a_product_of_different_rows_is_not_shuffled(spark, monkeypatch):
    left = spark.range(300).select(F.lit(1).alias("d"), F.col("id").alias("a"))
    right = spark.range(400).select(F.lit(1).alias("d"), F.col("id").alias("b"))
    monkeypatch.setattr(joins, "repeat_rows", lambda *a, **k: pytest.fail("the product is dealt anew"))
    out = product_join(left, right, ["d"], block=64)
    assert out.agg(F.count(F.lit(1)), F.countDistinct("a", "b")).first()[:] == (120_000, 120_000)


@pytest.mark.parametrize("few", [1, 3, 100])
def test_few_and_many_copies_equal_a_join(spark, monkeypatch, few):
    monkeypatch.setattr(joins, "FEW", few)
    left = spark.createDataFrame([(1, i, None) for i in range(1, 7) for _ in range(i)] + [(2, 0, "x"), (None, 1, "y")], "d int, a int, s string")
    right = spark.createDataFrame([(1, i) for i in range(1, 6) for _ in range(i * i)] + [(2, 1), (3, 1), (None, 2)], "d int, b int")
    want, got = left.join(right, "d"), product_join(left, right, ["d"], block=4, right_keys=right.select("d"))
    assert got.columns == want.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_numbering_is_compiled(spark, monkeypatch):
    rows = [(i % 5 or None, float(i * 7 % 50) / 3, f"a,\"{i}[]") for i in range(50)]
    df = spark.createDataFrame(rows, "g int, x double, s string")
    nested = with_surrogate_key(df, "k", ["g", "x", "s"], partitions=7)
    assert "aggregate(" not in nested._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(keys, "NESTED", 2)
    folded = with_surrogate_key(df, "k", ["g", "x", "s"], partitions=7)
    assert "aggregate(" in folded._jdf.queryExecution().optimizedPlan().toString()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    for keyed in (nested, folded):
        assert [tuple(r)[:3] for r in keyed.orderBy("k").collect()] == order


@pytest.mark.parametrize("text", ["plain", "line\nend, \"quoted\"\n\n", "a\r\nb\rc", '"\n"', " "])
def test_one_file_is_read_by_many_tasks(spark, tmp_dir, text):
    df = spark.range(3000).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit(text), F.col("id").cast("string"))).alias("s"),
                                  F.when(F.col("id") % 3 > 0, F.lit(text)).alias("t")).repartition(3)
    path = f"{tmp_dir}/one.csv"
    export_csv_file(df, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = read_exported_csv(spark, path, df.schema)
        plan = got._jdf.queryExecution().executedPlan().toString()
        if "FileScan csv" in plan:
            assert got.rdd.getNumPartitions() > 3
        assert ("FileScan csv" in plan) == (text in ("plain", " ")) and "multiLine=true" not in plan
        assert got.exceptAll(df).count() == df.exceptAll(got).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_tweets_look_their_orders_up_once(spark):
    """Other orders are left out of what is read again; repeated and null keys as before."""
    from datetime import datetime

    from starloom.plans import fixtures as fx

    day = datetime(1996, 1, 1)
    orders = spark.createDataFrame(
        [(i, i % 7 or None, day) for i in range(60)] + [(8, 1, day), (8, 1, day), (9, 2, None), (None, 3, day)],
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    )
    turns = spark.createDataFrame(
        [(c, t, f"{c} {t}") for c in (0, 1, 5, None, 90) for t in (0, 1, None)] + [(1, 0, "again"), (1, 0, "again")],
        "conv_id long, turn long, text string",
    )
    met = fx.tweet_orders(turns, orders)
    assert sorted(r["o_orderkey"] for r in met.collect()) == [0, 1, 8, 8, 8, 9, 9, 40, 41]
    want, got = fx.tweets_stg(turns, orders), fx.tweets_stg(turns, met)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() == 15


def test_wide_rows_of_a_hot_key_are_copied_less(spark):
    sides = spark.createDataFrame([(593, 3850), (5000, 5000), (3, 2_000_000), (1 << 20, 2), (40, 30)], "_n long, _m long")
    wide, even = ([tuple(r) for r in sides.select(*joins._grid(w, 24.0, 1024)).collect()] for w in (600.0, 24.0))
    assert wide[0] == (3, 1)  # of 593 texts each goes to one cell; before, to four
    assert even[1] == (5, 5) and wide[1][0] > wide[1][1]
    assert wide[2][1] >= 2_000_000 / (16 * 1024) and wide[3][0] >= 64 and wide[4] == (1, 1)
    for (n, m), (p, q) in zip(sides.collect(), wide, strict=True):
        assert n / p <= 16 * 1024 and m / q <= 16 * 1024 and n * m / (p * q) <= 1024 * 1024


def test_rows_of_hot_keys_stay_where_they_are(spark):
    """Only the dealing by cells moves them, not the look-up of their keys' parts."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(300).select((F.col("id") % 2).alias("d"), F.col("id").alias("a"), F.repeat(F.lit("x"), 99).alias("s"))
        right = spark.range(400).select((F.col("id") % 2).alias("d"), F.col("id").alias("b"))
        out = product_join(left, right, ["d"], block=64)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") >= 4
        assert out.count() == 2 * 150 * 200 and out.dropDuplicates(["a", "b"]).count() == 2 * 150 * 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
