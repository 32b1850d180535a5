"""Partitioned facts, writes that count their rules, and the plans of dense keys."""

import os

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators import analysis as A
from starloom.operators.conform import ConstraintError
from starloom.operators.filters import last_n_days, time_range
from starloom.operators.keys import SAMPLE, _sample, with_surrogate_key
from starloom.operators.partitions import MONTH_PARTS, with_month
from starloom.plans.queries import Model
from starloom.plans.tables import Catalog, load_fact, write_table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files(root):
    return {f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for d, _, names in os.walk(root) for n in names if n.endswith(".parquet")}


def same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def fact(spark):
    return Model(spark, SF, "set").coin_stats().cache()


def test_months_are_pruned_and_equal_the_whole_fact(spark, fact, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    table = load_fact(cat, "f", with_month(fact), partition_by=MONTH_PARTS)
    assert same(table.select(fact.columns), fact)
    bounds = ("1996-03-10 00:00:00", "1997-01-31 23:59:59")
    some = time_range(table, *bounds)
    filters = next(line for line in plan(some).splitlines() if "PartitionFilters" in line)
    assert "part_year" in filters.split("PartitionFilters: [")[1].split("]")[0]
    assert same(some.select(fact.columns), time_range(fact, *bounds))
    read = {f.split("/part_year=")[1][:4] for f in some.inputFiles()}
    assert read >= {"1996", "1997"}  # the whole table's files; what is scanned is less
    some.collect()
    scanned = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scanned
    days = last_n_days(table, 40, "1996-06-01 00:00:00")
    assert "part_year" in plan(days) and same(days.select(fact.columns), last_n_days(fact, 40, "1996-06-01 00:00:00"))
    monthly = A.monthly_price_stats(some)
    assert "ReadSchema" in plan(monthly) and same(monthly, A.monthly_price_stats(time_range(fact, *bounds)))
    assert "date" not in plan(A.monthly_price_stats(table)).split("ReadSchema: struct<")[1].split(">")[0]


def test_a_replaced_month_leaves_other_files(spark, fact, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    whole = with_month(fact)
    load_fact(cat, "f", whole.where("coin_key % 2 = 0"), "delete", "even", MONTH_PARTS)
    load_fact(cat, "f", whole.where("coin_key % 2 = 1"), "append", "odd", MONTH_PARTS)
    before = files(str(tmp_path))
    month = whole.where("part_year = 1996 and part_month = 5 and coin_key % 2 = 1").withColumn("price", F.lit(0).cast("decimal(18,5)"))
    n = month.count()
    assert n
    for _ in range(2):  # a repeated run replaces its own
        table = load_fact(cat, "f", month.limit(n), "replace", "odd", MONTH_PARTS)
    after = files(str(tmp_path))
    assert {k: v for k, v in after.items() if k in before} == before
    assert table.where("price = 0").count() == n and table.count() == fact.count()
    expected = fact.where("not (date >= '1996-05-01' and date < '1996-06-01' and coin_key % 2 = 1)")
    assert same(table.where("price <> 0").select(fact.columns), expected)
    assert same(cat.read("f", without_batch="odd").select(fact.columns), fact.where("coin_key % 2 = 0"))
    assert "part_year" in plan(table.where("part_year = 1996")).split("PartitionFilters: [")[1].split("]")[0]
    # the superseded attempt goes; the whole one is still needed for its other months
    assert cat.vacuum("f") == 1
    assert same(cat.read("f").select(fact.columns), table.select(fact.columns))
    # a new whole attempt of the batch covers the replaced month
    again = load_fact(cat, "f", whole.where("coin_key % 2 = 1"), "append", "odd", MONTH_PARTS)
    assert same(again.select(fact.columns), fact)


def test_replacing_needs_partitions(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    df = spark.createDataFrame([(1, 2)], "k int, p int")
    write_table(df, cat.path("t"), batch_id="b")
    with pytest.raises(ValueError):
        write_table(df, cat.path("t"), "replace", "b")
    with pytest.raises(ValueError):
        write_table(df, cat.path("t"), "replace", "b", ["p"])
    assert cat.read("t").count() == 1
    with pytest.raises(ValueError, match="int or a date"):
        write_table(df.withColumn("p", F.lit("007")), cat.path("t"), partition_by=["p"])


def test_a_partitioned_write_without_rows(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    df = spark.createDataFrame([(1, 2), (None, None)], "k int, p int")
    write_table(df.limit(0), cat.path("t"), partition_by=["p"], batch_id="a")
    write_table(df, cat.path("t"), "append", partition_by=["p"], batch_id="b")
    assert sorted(map(tuple, cat.read("t").collect()), key=str) == [(1, 2), (None, None)]


def test_a_hot_month_is_several_files(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    df = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("s"), F.when(F.col("id") < 190_000, 1).otherwise(F.col("id") % 5).cast("int").alias("p"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_table(df.repartition(8), cat.path("t"), partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    per = {}
    for f in files(str(tmp_path)):
        per[f.split("/p=")[1][0]] = per.get(f.split("/p=")[1][0], 0) + 1
    assert per["1"] >= 4 and all(per[p] <= 2 for p in "0234")


def test_a_write_counts_its_rules_in_one_read(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    good = Model(spark, SF).tweets_stg
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    write_table(good.mapInArrow(seen, good.schema), cat.path("t"), schema=S.TWEETS_STG)
    assert reads.value == good.count() == cat.read("t").count()
    bad = good.withColumn("text", F.when(F.col("tweet_id") % 7 != 0, F.col("text"))).withColumn("username", F.repeat(F.lit("é"), 257))
    for mode in ("delete", "append"):
        with pytest.raises(ConstraintError, match="text not_null: .* rows, username max_length_256") as e:
            write_table(bad, cat.path("t"), mode, schema=S.TWEETS_STG)
        assert e.value.violations == [("text", "not_null", good.where("tweet_id % 7 = 0").count()), ("username", "max_length_256", good.count())]
        assert same(cat.read("t"), good)
    write_table(good.limit(0), cat.path("e"), schema=S.TWEETS_STG)
    assert cat.read("e").count() == 0 and cat.vacuum("t") == 0
    with pytest.raises(ConstraintError, match="missing"):
        write_table(good.drop("text"), cat.path("t"), schema=S.TWEETS_STG)


def test_no_task_merges_rows_for_keys(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"), F.col("id").cast("string").alias("y"))
    text = plan(with_surrogate_key(df, "k", ["x", "y"]))
    assert "TakeOrdered" not in text and "from_json" not in text
    lines = text.splitlines()
    alone = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(alone) == 1  # the counts, one row a bucket
    assert "HashAggregate(keys=[_sk_bucket" in lines[alone[0] + 1]


@pytest.mark.parametrize("tasks", [2, 50, 400])
def test_the_sample_does_not_grow_with_tasks(spark, tasks):
    drawn = _sample(spark.range(0, 100_000, 1, tasks).select("id"), 50).count()
    assert 0.8 * SAMPLE * 50 < drawn < 1.2 * SAMPLE * 50


def test_many_buckets_keep_the_order(spark):
    rows = [(None if i % 5 == 0 else i % 7, float("nan") if i % 11 == 0 else i / 3, f"é{i}", i) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b double, c string, i int").repartition(6)
    got = with_surrogate_key(df, "k", ["a", "b", "c"], partitions=150).orderBy("k").select("i").collect()
    assert [r["i"] for r in got] == [r["i"] for r in df.orderBy("a", "b", "c").select("i").collect()]
