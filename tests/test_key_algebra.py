"""Reports on products by their counts, dense keys, key ranges, exports as one file."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from starloom.operators import quality as Q
from starloom.operators.joins import product_join
from starloom.plans.queries import Model
from starloom.plans.ranges import append_with_range, claim_range
from starloom.plans.tables import Catalog, load_dimension
from starloom.sinks.csv import export_csv, export_csv_file

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def sides(spark, seed):
    rnd = random.Random(seed)
    left = [(rnd.choice([None, 1, 2, 3, 4]), rnd.choice([None, 0, 1, 2, 3])) for _ in range(80)]
    right = [(rnd.choice([None, 1, 2, 3, 9]), rnd.choice([None, 0, 1, 2, 5])) for _ in range(60)]
    return spark.createDataFrame(left, "d int, coin_key int"), spark.createDataFrame(right, "d int, date_key int")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_reports_on_a_product_equal_those_on_its_rows(spark, seed):
    left, right = sides(spark, seed)
    fact = left.join(right, "d")
    assert fact.where("coin_key is null").count() and fact.where("date_key is null").count()
    keys = ["coin_key", "date_key", "d"]
    assert rows(Q.product_null_key_report(left, right, ["d"], keys, "f")) == rows(Q.null_key_report(fact, keys, "f"))
    dims = {"coin_key": spark.createDataFrame([(1,), (3,)], "coin_key int"), "date_key": spark.createDataFrame([(0,), (2,)], "date_key int"),
            "d": spark.createDataFrame([(1,)], "d int")}
    got, want = Q.product_fk_orphan_report(left, right, ["d"], dims, "f"), Q.fk_orphan_report({"f": fact}, dims)
    assert rows(got) == rows(want)
    none = left.where("false")
    assert {r["null_rows"] for r in Q.product_null_key_report(none, right, ["d"], keys, "f").collect()} == {0}
    assert {r["orphan_rows"] for r in Q.product_fk_orphan_report(none, right, ["d"], dims, "f").collect()} == {0}


def test_reports_on_the_bag_fact(spark):
    m = Model(spark, SF, "bag")
    coin = F.when(F.col("coin_key") != 3, F.col("coin_key")).alias("coin_key")
    left, right = m.coin_matches().select(coin, "date"), m.date_dim.select("date_key", "date")
    fact = product_join(left, right, ["date"])
    keys = ["coin_key", "date_key"]
    report = Q.product_null_key_report(left, right, ["date"], keys, "f")
    assert rows(report) == rows(Q.null_key_report(fact, keys, "f"))
    assert sum(r["null_rows"] for r in report.collect()) > 0


def test_a_product_too_large_to_build(spark):
    """A hot key of 4,000,000 by 3,000,000 rows; what is joined are counts."""
    left = spark.range(4_000_000).select((F.col("id") % 1).alias("d"), F.when(F.col("id") % 2 == 0, 7).alias("coin_key"))
    right = spark.range(3_000_000).select((F.col("id") % 1).alias("d"), F.col("id").alias("date_key"))
    report = Q.product_null_key_report(left, right, ["d"], ["coin_key", "date_key"], "f")
    text = plan(report)
    below = text[text.index("Join") :]
    assert below.count("partial_count(1)") == 2 and below.index("partial_count") < below.index("Range")
    assert rows(report) == [("f", "coin_key", 2_000_000 * 3_000_000), ("f", "date_key", 0)]


def test_dense_keys_and_their_gaps(spark):
    def of(keys, **kw):
        return Q.dense_keys(spark.createDataFrame([(k,) for k in keys], "k long"), "k", **kw)

    assert of(range(10)) == Q.DenseKeys(0, 9, [])
    assert of([5, 6, 6, 8, 9, 12, None]) == Q.DenseKeys(5, 12, [(7, 7), (10, 11)])
    assert of([]) is None and of([None]) is None and of([1, 100]) is None
    assert of([i for i in range(1000) if i % 3], missing_max=100) is None
    block = Q._BLOCK
    wide = spark.range(3 * block).where(f"id < {block - 5} or id >= {block + 7}").where(f"id <> {2 * block} and id <> 3").toDF("k")
    assert Q.dense_keys(wide, "k") == Q.DenseKeys(0, 3 * block - 1, [(3, 3), (block - 5, block + 6), (2 * block, 2 * block)])


@pytest.mark.parametrize("missing_max", [16_384, 3])
def test_dense_report_equals_the_anti_join(spark, missing_max):
    """With few gaps allowed one dimension falls back; both ways give the same rows."""
    rnd = random.Random(4)
    facts = {
        n: spark.createDataFrame([(rnd.choice([None, -1, *range(60)]), rnd.choice([None, *range(-2, 40)])) for _ in range(500)], "a int, b long")
        for n in ("f", "g")
    }
    dims = {
        "a": spark.createDataFrame([(i,) for i in range(3, 55) if i % 5], "a int"),
        "b": spark.createDataFrame([(i,) for i in range(30) if i not in (4, 5, 17)], "b long"),
    }
    got = Q.dense_fk_orphan_report(facts, dims, missing_max)
    assert rows(got) == rows(Q.fk_orphan_report(facts, dims))
    assert ("Join" in plan(got)) == (missing_max == 3)


def test_a_dense_check_moves_no_fact_row(spark):
    fact = spark.range(100_000).select((F.col("id") % 5000).alias("k"))
    text = plan(Q.dense_fk_orphan_report({"f": fact}, {"k": spark.range(4000).toDF("k")}))
    assert "Join" not in text and "hashpartitioning" not in text and "from_json" not in text
    assert rows(Q.dense_fk_orphan_report({"f": fact}, {"k": spark.range(4000).toDF("k")})) == [("f", "k", 20_000)]


def test_interleaved_appends_get_disjoint_keys(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    load_dimension(cat, "d", spark.range(5).select(F.col("id").alias("k"), F.col("id").cast("string").alias("x")))
    a = spark.createDataFrame([("a",), ("b",)], "x string")
    b = spark.createDataFrame([("c",), ("d",), ("e",)], "x string")
    keyed_a = append_with_range(cat, "d", a, "k", ["x"], "A")
    keyed_b = append_with_range(cat, "d", b, "k", ["x"], "B")  # before A is written
    load_dimension(cat, "d", keyed_b, mode="append", batch_id="B")
    load_dimension(cat, "d", keyed_a, mode="append", batch_id="A")
    again = append_with_range(cat, "d", a, "k", ["x"], "A")  # a retry reuses its range
    out = load_dimension(cat, "d", again, mode="append", batch_id="A")
    assert rows(out.select("k", "x"))[5:] == [(5, "a"), (6, "b"), (7, "c"), (8, "d"), (9, "e")]
    # a batch that has grown takes another range; an overwritten table starts anew
    more = a.union(spark.createDataFrame([("z",)], "x string"))
    assert rows(append_with_range(cat, "d", more, "k", ["x"], "A").select("k")) == [(10,), (11,), (12,)]
    load_dimension(cat, "d", spark.createDataFrame([], "k long, x string"))
    assert rows(append_with_range(cat, "d", a, "k", ["x"], "A").select("k")) == [(0,), (1,)]
    assert rows(append_with_range(cat, "new", a, "k", ["x"], 1).select("k")) == [(0,), (1,)]


def test_many_writers_claim_at_once(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    got, errors = {}, []

    def claim(i):
        try:
            got[i] = claim_range(cat, "t", f"batch {i}", 10 + i, base=100)
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=claim, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    ranges = sorted((r.start, r.end) for r in got.values())
    assert not errors and len(got) == 8 and ranges[0][0] == 100
    assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:])) and ranges[-1][1] == 100 + sum(range(10, 18))


def test_an_unfinished_claim_stops_later_ones(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    claim_range(cat, "t", "a", 5)
    (tmp_path / "public/t/_ranges/_g=00000000/0000000001").write_text('{"batch"')
    with pytest.raises(TimeoutError, match="0000000001"):
        claim_range(cat, "t", "b", 5, wait_s=0.2)


def test_one_file_has_the_bytes_of_one_task(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, f'a "q" {i},\n x ' if i % 3 else None, "" if i % 2 else " y ") for i in range(1000)], "i int, t string, `odd, name` string"
    ).repartitionByRange(7, "i")
    export_csv(df.sortWithinPartitions("i"), str(tmp_path / "one"), single_file=True)
    want = next((tmp_path / "one").glob("part-*")).read_bytes()
    for _ in range(2):  # an older export is replaced
        assert export_csv_file(df.sortWithinPartitions("i"), str(tmp_path / "all.csv")) == "copy"
        assert (tmp_path / "all.csv").read_bytes() == want
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == ["all.csv", "one"]
    export_csv_file(df.limit(0), str(tmp_path / "none.csv"))
    export_csv(df.limit(0), str(tmp_path / "empty"), single_file=True)
    assert (tmp_path / "none.csv").read_bytes() == next((tmp_path / "empty").glob("part-*")).read_bytes()


def test_a_failed_export_leaves_the_old_file(spark, tmp_path):
    export_csv_file(spark.range(3), str(tmp_path / "x.csv"))
    old = (tmp_path / "x.csv").read_bytes()
    with pytest.raises(Exception, match="spoiled"):
        export_csv_file(spark.range(3).select(F.raise_error(F.lit("spoiled")).cast("long").alias("id")), str(tmp_path / "x.csv"))
    assert (tmp_path / "x.csv").read_bytes() == old and not [p for p in tmp_path.iterdir() if p.is_dir()]
