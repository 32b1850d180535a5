"""What must not be lost: rows, fractions, zones, column order, tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from starloom.functions.calendar import text_to_epoch_seconds
from starloom.operators.filters import coin_subset, time_range
from starloom.operators.joins import fits, product_join
from starloom.operators.keys import append_with_keys, with_surrogate_key
from starloom.plans.tables import Catalog, load_dimension, write_table
from starloom.sinks.csv import export_csv, read_exported_csv
from starloom.sources.documents import MARKET_CHART, flatten_market_chart, read_documents


def _dense(df, n):
    got = df.agg(F.countDistinct("k").alias("d"), F.min("k").alias("lo"), F.max("k").alias("hi")).first()
    assert tuple(got) == (n, 0, n - 1)


def test_keys_do_not_depend_on_what_the_optimizer_keeps_or_reuses(spark):
    n = 300_000
    df = spark.range(n).select(
        (F.col("id") * 7919 % n).alias("x"), F.col("id").cast("string").alias("y"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 97).alias("g"),  # a third of the rows share one value
    )
    keyed = with_surrogate_key(df, "k", ["g", "x"])
    _dense(keyed, n)
    _dense(keyed.select("k"), n)
    _dense(keyed.select("x", "k"), n)
    _dense(with_surrogate_key(df.withColumn("m", F.create_map("x", "y")), "k", ["g", "x"]).select("k"), n)
    twice = keyed.select("x", "k").join(keyed.select("x", F.col("k").alias("k2")), "x")
    assert twice.where("k <> k2").count() == 0
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        _dense(with_surrogate_key(df, "k", ["g", "x"]).select("k"), n)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_a_hot_product_is_spread(spark):
    left = spark.range(15_000).select(F.when(F.col("id") < 5000, 0).otherwise(F.col("id")).alias("d"), F.col("id").alias("a"))
    right = left.select("d", F.col("a").alias("b"))
    out = product_join(left, right, ["d"], block=512)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    total = 5000 * 5000 + 10_000
    assert sum(sizes) == total
    # the hot key over all eight tasks, the other keys beside it
    assert sum(n > total / 16 for n in sizes) == 8 and max(sizes) < 2 * total / 8


def test_product_join_equals_a_join(spark):
    left = spark.createDataFrame([(i % 3 or None, i) for i in range(60)] * 2, "d int, a int")
    right = spark.createDataFrame([(i % 3 or None, i) for i in range(45)], "d int, b int")
    want, got = left.join(right, "d"), product_join(left, right, ["d"], block=4)
    assert got.columns == want.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def _sizes(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_equal_rows_on_both_sides_are_spread(spark):
    """One row 8000 times against one row 8000 times: 64,000,000 pairs of one cell."""
    left = spark.range(8000).select(F.lit(1).alias("d"), F.lit("x").alias("a"))
    right = spark.range(8000).select(F.lit(1).alias("d"), F.lit("y").alias("b"))
    out = product_join(left, right, ["d"])
    sizes = _sizes(out)
    assert sum(sizes) == 64_000_000 and len(sizes) == 8 and max(sizes) < 1.2 * 64_000_000 / 8
    assert out.columns == ["d", "a", "b"]


def test_cells_of_a_hot_product_are_bounded(spark, monkeypatch):
    """The largest cell holds about block by block pairs, however often rows repeat."""
    from starloom.operators import joins

    cells = []
    repeat = joins.repeat_rows
    monkeypatch.setattr(joins, "repeat_rows", lambda df, *a, **k: cells.append(df) or repeat(df, *a, **k))
    left = spark.range(40_000).select(F.lit(1).alias("d"), (F.col("id") % 2000).alias("a"))
    right = spark.range(10_000).select(F.lit(1).alias("d"), (F.col("id") % 500).alias("b"))
    out = product_join(left, right, ["d"], block=128)
    assert out.agg(F.count(F.lit(1)), F.countDistinct("a", "b")).first()[:] == (400_000_000, 1_000_000)
    pairs = cells[0].select("a", "b", "_left_copies")
    assert pairs.count() == 1_000_000 and pairs.where("_left_copies <> 400").count() == 0
    cell = cells[0].groupBy(F.pmod(F.xxhash64("d", "a", F.lit(20).cast("long")), F.lit(16)), F.pmod(F.xxhash64("d", "b", F.lit(20).cast("long")), F.lit(4)))
    assert cell.count().agg(F.max("count")).first()[0] < 2 * 128 * 128


def test_hot_and_other_keys_equal_a_join(spark):
    left = spark.createDataFrame([(i % 4 or None, i % 7, "é") for i in range(300)] + [(9, 1, None)], "d int, a int, s string")
    right = spark.createDataFrame([(1, i % 3) for i in range(200)] + [(2, 5), (None, 6), (9, None)], "d int, b int")
    want, got = left.join(right, "d"), product_join(left, right, ["d"], block=8)
    assert got.columns == want.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_broadcast_bound_counts_bytes(spark):
    df = spark.createDataFrame([("x" * 100,)] * 50, "s string")
    assert fits(df, 50, 6000) and not fits(df, 49, 6000) and not fits(df, 50, 5000)


def test_export_keeps_microseconds(spark, tmp_dir):
    rows = [(1, dt.datetime(2024, 1, 1, 0, 0, 0, 123456)), (2, dt.datetime(2024, 1, 1)), (3, None)]
    df = spark.createDataFrame(rows, "i int, ts timestamp_ntz")
    export_csv(df, f"{tmp_dir}/o", single_file=True)
    text = next(open(f"{tmp_dir}/o/{f}").read() for f in os.listdir(f"{tmp_dir}/o") if f.endswith(".csv"))
    assert "1,2024-01-01 00:00:00.123456\n" in text and "2,2024-01-01 00:00:00\n" in text
    assert sorted(map(str, read_exported_csv(spark, f"{tmp_dir}/o", df.schema).collect())) == sorted(map(str, df.collect()))


def test_long_and_short_coin_lists_give_the_same_columns(spark):
    df = spark.createDataFrame([("d", 1, "a"), ("d", 2, "b"), ("d", 3, None)], "date string, price int, coin string")
    short, long = coin_subset(df, ["a", "a"]), coin_subset(df, ["a"] + [f"x{i}" for i in range(1500)])
    assert short.columns == long.columns == df.columns and short.collect() == long.collect()


def test_zones_are_moved_to_utc(spark):
    stamps = ["2024-01-01T00:00:00+02:00", "2024-01-01T00:00:00+0200", "2023-12-31T22:00:00Z", "2023-12-31T22:00:00", "2023-12-31 22:00:00.5", None]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in stamps], "s string").select(text_to_epoch_seconds("s")).collect()]
    assert got == [1704060000.0] * 4 + [1704060000.5, None]
    df = spark.createDataFrame([(dt.datetime(2023, 12, 31, 22),)], "date timestamp_ntz")
    zone = dt.timezone(dt.timedelta(hours=2))
    assert time_range(df, dt.datetime(2024, 1, 1, tzinfo=zone), "2024-01-01T00:00:00+02:00").count() == 1


def test_broken_documents_fail_the_read(spark, tmp_dir):
    for i, line in enumerate(['{"a": 1', '{"a": "text"}']):
        with open(f"{tmp_dir}/{i}.json", "w") as f:
            f.write('{"a": 1}\n' + line + "\n")
        with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
            read_documents(spark, f"{tmp_dir}/{i}.json", "a int").collect()


def test_documents_of_one_coin_stay_apart(spark):
    chart = lambda t, v: ("c", [[t, v]], [[t, v + 1]], [[t, v + 2]])
    docs = spark.createDataFrame([chart(1000.0, 1.0), chart(1000.0, 5.0), ("c", None, [], [[1.0, 2.0]])], MARKET_CHART)
    flat = flatten_market_chart(docs)
    assert sorted((r["price"], r["market_cap"], r["total_volumes"]) for r in flat.collect()) == [(1.0, 2.0, 3.0), (5.0, 6.0, 7.0)]
    assert "Exchange" not in flat._jdf.queryExecution().executedPlan().toString()
    many = spark.createDataFrame([("c", [[2.0, 1.0], [1.0, 2.0], [2.0, 3.0], [None, 9.0]], [[2.0, 4.0], [3.0, 5.0], [None, 9.0]],
                                   [[2.0, 6.0], [2.0, None], [1.0, 8.0]])], MARKET_CHART)
    got = sorted(((r["price"], r["market_cap"], r["total_volumes"]) for r in flatten_market_chart(many).collect()), key=str)
    assert got == sorted([(1.0, 4.0, 6.0), (1.0, 4.0, None), (3.0, 4.0, 6.0), (3.0, 4.0, None)], key=str)


@pytest.mark.parametrize("root", ["with blank", "plain", "rel"])
def test_a_table_may_be_read_while_it_is_overwritten(spark, tmp_dir, root, monkeypatch):
    where = f"{tmp_dir}/{root}"
    if root == "rel":
        where = os.path.relpath(where)
    cat = Catalog(spark, where)
    load_dimension(cat, "x.t", spark.range(10).toDF("k"), mode="append", batch_id="a:1/2 %")
    for mode in ("append", "delete"):
        more = cat.read("x.t").withColumn("k", F.col("k") + 100)
        load_dimension(cat, "x.t", more, mode=mode, batch_id="a:1/2 %")
    assert sorted(r["k"] for r in cat.read("x.t").collect()) == list(range(200, 210))
    assert cat.vacuum("x.t") == 2 and cat.read("x.t").count() == 10 and cat.vacuum("x.t") == 0


def test_a_failed_write_leaves_the_old_rows(spark, tmp_dir):
    cat = Catalog(spark, tmp_dir)
    load_dimension(cat, "x.t", spark.range(5).toDF("k"))
    for mode in ("delete", "append"):
        with pytest.raises(Exception, match="spoiled"):
            write_table(cat.read("x.t").select(F.raise_error(F.lit("spoiled")).cast("long").alias("k")), cat.path("x.t"), mode)
        assert cat.read("x.t").count() == 5
    with pytest.raises(FileNotFoundError):
        cat.read("x.none")


def test_a_repeated_append_gives_the_same_keys(spark, tmp_dir):
    cat = Catalog(spark, tmp_dir)
    load_dimension(cat, "d", spark.createDataFrame([("a",), ("b",)], "x string").transform(lambda d: with_surrogate_key(d, "k", ["x"])))
    new = spark.createDataFrame([("c",), ("d",)], "x string")
    for _ in range(3):
        rows = append_with_keys(cat.read("d", without_batch="b"), new, "k", ["x"])
        out = load_dimension(cat, "d", rows, mode="append", batch_id="b")
        assert sorted((r["k"], r["x"]) for r in out.collect()) == [(0, "a"), (1, "b"), (2, "c"), (3, "d")]


def test_an_unreadable_table_is_not_an_absent_one(spark, tmp_dir):
    cat = Catalog(spark, tmp_dir)
    load_dimension(cat, "x.t", spark.range(5).toDF("k"))
    for folder, _, names in os.walk(cat.path("x.t")):
        for n in names:
            if n.endswith(".parquet"):
                with open(f"{folder}/{n}", "w") as f:
                    f.write("no parquet")
    assert cat.exists("x.t")
    with pytest.raises(Exception, match="FAILED_READ|CANNOT_READ|not a Parquet"):
        cat.read("x.t").count()
