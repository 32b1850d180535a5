"""Staging, load errors, documents, market charts and CSV export on small files."""

import datetime as dt
import glob
import json
import os
from decimal import Decimal

import pytest

from starloom import schemas as S
from starloom.sinks.csv import export_csv, read_exported_csv
from starloom.sources.delimited import load_errors, render_path, stage_delimited
from starloom.sources.documents import MARKET_CHART, append_documents, flatten_market_chart, read_documents
from starloom.sources.parquet import stage_parquet

BAD_HOURLY = (
    "date|price|market_cap|total_volumes|coin\n"
    "2017-01-01 00:00:00|1.123456|2.5|3|a\n"
    "bad|1|2|3|b\n"
    "2017-01-01 00:00:00|99999999999999999999|2|3|c\n"
    "2017-01-01|1|2\n"
)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_load_errors_lists_the_three_bad_lines(spark, tmp_dir):
    _write(f"{tmp_dir}/h/part.csv", BAD_HOURLY)
    rows = load_errors(spark, f"{tmp_dir}/h", S.HOURLY_STG).collect()
    assert sorted(r["raw_line"] for r in rows) == sorted(BAD_HOURLY.splitlines()[2:])
    assert all(r["file_path"].endswith("part.csv") for r in rows)


def test_failfast_raises_even_for_count(spark, tmp_dir):
    _write(f"{tmp_dir}/h/part.csv", BAD_HOURLY)
    with pytest.raises(Exception):
        stage_delimited(spark, f"{tmp_dir}/h", S.HOURLY_STG).count()


def test_decimal_reads_round_to_scale(spark, tmp_dir):
    _write(f"{tmp_dir}/ok/part.csv", BAD_HOURLY.splitlines()[0] + "\n" + BAD_HOURLY.splitlines()[1] + "\n")
    row = stage_delimited(spark, f"{tmp_dir}/ok", S.HOURLY_STG).first()
    assert row["price"] == Decimal("1.12346")
    assert row["date"] == dt.datetime(2017, 1, 1)


def test_coin_csv_edge_values(spark, tmp_dir):
    text = 'coin_id|symbol|name\n|s1|n1\n\\N|s2|n2\n""|s3|n3\nx"y|s4|n4\n'
    _write(f"{tmp_dir}/c/part.csv", text)
    rows = stage_delimited(spark, f"{tmp_dir}/c", S.COIN_LIST_STG).orderBy("symbol").collect()
    assert [r["coin_id"] for r in rows] == [None, None, '""', 'x"y']
    assert [r["name"] for r in rows] == ["n1", "n2", "n3", "n4"]


def test_render_path_from_run_parameters(spark, tmp_dir):
    _write(f"{tmp_dir}/2024-01-02/part.csv", BAD_HOURLY.splitlines()[0] + "\n" + BAD_HOURLY.splitlines()[1] + "\n")
    assert render_path("{root}/{ds}", root=tmp_dir, ds="2024-01-02") == f"{tmp_dir}/2024-01-02"
    df = stage_delimited(spark, "{root}/{ds}", S.HOURLY_STG, params={"root": tmp_dir, "ds": "2024-01-02"})
    assert df.count() == 1


def test_stage_parquet_conforms_by_name(spark, tmp_dir):
    df = spark.createDataFrame(
        [("u", 7, "hello", "c", dt.datetime(2020, 1, 1))], "username string, tweet_id int, text string, crypto string, datetime timestamp_ntz"
    )
    df.write.parquet(f"{tmp_dir}/p")
    out = stage_parquet(spark, f"{tmp_dir}/p", S.TWEETS_STG)
    assert out.columns == S.TWEETS_STG.names
    assert dict(out.dtypes)["tweet_id"] == "bigint"
    assert out.first()["text"] == "hello"


def test_read_documents_filters_and_drops_id(spark, tmp_dir):
    _write(f"{tmp_dir}/d/a.json", json.dumps({"_id": "1", "coin": "a", "v": 1}) + "\n" + json.dumps({"_id": "2", "coin": "b", "v": 2}) + "\n")
    out = read_documents(spark, f"{tmp_dir}/d", where={"coin": "b"})
    assert "_id" not in out.columns
    assert [r["v"] for r in out.collect()] == [2]


def test_append_documents_appends(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1)], "coin string, v long")
    append_documents(df, f"{tmp_dir}/coll")
    append_documents(df, f"{tmp_dir}/coll")
    assert read_documents(spark, f"{tmp_dir}/coll").count() == 2


def test_market_chart_keeps_timestamps_in_all_three_series(spark):
    t1, t2 = 1_500_000_000_000.0, 1_500_003_600_000.0
    docs = spark.createDataFrame(
        [("btc", [[t1, 1.0], [t2, 2.0]], [[t1, 10.0]], [[t1, 5.0], [t2, 6.0]])], MARKET_CHART
    )
    rows = flatten_market_chart(docs).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["coin"], r["price"], r["market_cap"], r["total_volumes"]) == ("btc", 1.0, 10.0, 5.0)
    assert r["date"] == dt.datetime(2017, 7, 14, 2, 40)


CSV_TEXT_SCHEMA = "d timestamp_ntz, p decimal(18,5), t string, n string, e string"


def test_csv_bytes_match_a_pandas_export(spark, tmp_dir):
    df = spark.createDataFrame(
        [(dt.datetime(2017, 1, 22), Decimal("10.74535"), 'a "q"\nline2', None, "")], CSV_TEXT_SCHEMA
    )
    export_csv(df, f"{tmp_dir}/x", single_file=True)
    (part,) = glob.glob(f"{tmp_dir}/x/part-*.csv")
    with open(part) as f:
        body = f.read()
    assert body == 'd,p,t,n,e\n2017-01-22 00:00:00,10.74535,"a ""q""\nline2",,\n'


def test_csv_roundtrip_keeps_blanks_and_newlines(spark, tmp_dir):
    df = spark.createDataFrame(
        [(dt.datetime(2017, 1, 22, 5), Decimal("1.5"), "  a ", "x", "y"), (dt.datetime(2017, 1, 23), Decimal("2"), 'q"\nz', "x", "y")],
        CSV_TEXT_SCHEMA,
    )
    export_csv(df, f"{tmp_dir}/rt")
    back = read_exported_csv(spark, f"{tmp_dir}/rt", CSV_TEXT_SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_pruned_bad_column_still_fails(spark, tmp_dir):
    _write(f"{tmp_dir}/h/part.csv", BAD_HOURLY)
    with pytest.raises(Exception):
        stage_delimited(spark, f"{tmp_dir}/h", S.HOURLY_STG).select("coin").count()


def test_market_chart_repeated_timestamps_multiply_as_a_merge(spark):
    t1, t2 = 1_500_000_000_000.0, 1_500_003_600_000.0
    docs = spark.createDataFrame(
        [
            ("btc", [[t1, 1.0], [t2, 2.0]], [[t1, 10.0], [t2, 20.0]], [[t2, 6.0]]),     # unique: in-row path
            ("eth", [[t1, 1.0], [t1, 2.0]], [[t1, 10.0]], [[t1, 5.0], [t1, 6.0]]),      # repeated: join path
        ],
        MARKET_CHART,
    )
    rows = flatten_market_chart(docs).collect()
    btc = [(r["price"], r["market_cap"], r["total_volumes"]) for r in rows if r["coin"] == "btc"]
    eth = sorted((r["price"], r["market_cap"], r["total_volumes"]) for r in rows if r["coin"] == "eth")
    assert btc == [(2.0, 20.0, 6.0)]
    assert eth == [(1.0, 10.0, 5.0), (1.0, 10.0, 6.0), (2.0, 10.0, 5.0), (2.0, 10.0, 6.0)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_document_filter_reaches_the_json_scan(spark, tmp_dir):
    _write(f"{tmp_dir}/d/a.json", json.dumps({"_id": "1", "coin": "a", "v": 1}) + "\n")
    out = read_documents(spark, f"{tmp_dir}/d", schema="_id string, coin string, v long", where={"coin": "a"})
    out.collect()
    assert "PushedFilters: [IsNotNull(coin), EqualTo(coin,a)]" in _plan(out)


def test_time_filter_and_projection_reach_the_parquet_scan(spark, tmp_dir):
    from starloom.operators.filters import time_range

    df = spark.createDataFrame(
        [(dt.datetime(2020, 1, d), Decimal("1.5"), Decimal("2.5"), Decimal("3.5"), "c") for d in (1, 15, 28)],
        S.HOURLY_STG.struct(),
    )
    df.write.parquet(f"{tmp_dir}/h")
    staged = stage_parquet(spark, f"{tmp_dir}/h", S.HOURLY_STG, validate="none")
    out = time_range(staged, "2020-01-10", "2020-01-20").select("date", "price")
    assert out.count() == 1
    out.collect()
    plan = _plan(out)
    assert "GreaterThanOrEqual(date," in plan and "LessThanOrEqual(date," in plan
    assert "ReadSchema: struct<date:timestamp_ntz,price:decimal(18,5)>" in plan
