"""Declared tables: types, lengths and NOT NULL hold where rows are written."""

import uuid

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.plans.declared import create_table, insert_rows, table_ddl
from starloom.plans.queries import Model

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def name(spark, tmp_path):
    db = f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path}/wh'")
    yield f"{db}.t"
    spark.sql(f"DROP DATABASE {db} CASCADE")


def same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_types_lengths_and_nulls(spark, name):
    m = Model(spark, SF)
    create_table(spark, S.TWEETS_STG, name)
    create_table(spark, S.TWEETS_STG, name)  # if absent
    out = insert_rows(m.tweets_stg.select(*reversed(S.TWEETS_STG.names)), S.TWEETS_STG, name)
    assert [(f.name, f.dataType) for f in out.schema] == [(c.name, c.dtype) for c in S.TWEETS_STG.columns]
    assert same(out, m.tweets_stg)
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE {name}").collect()}
    assert described["text"] == "varchar(10000)" and described["username"] == "varchar(256)"
    long = m.tweets_stg.withColumn("username", F.repeat(F.lit("é"), 257))
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        insert_rows(long, S.TWEETS_STG, name)
    with pytest.raises(Exception, match="NULL in the NOT NULL column .*text"):
        insert_rows(m.tweets_stg.withColumn("text", F.lit(None).cast("string")), S.TWEETS_STG, name)
    with pytest.raises(Exception, match="(?i)cannot.*(cast|safely|write)|INCOMPATIBLE_DATA"):
        insert_rows(m.tweets_stg.withColumn("tweet_id", F.lit("x")), S.TWEETS_STG, name)
    assert same(spark.table(name), m.tweets_stg)
    with pytest.raises(ValueError):
        insert_rows(m.tweets_stg.drop("text"), S.TWEETS_STG, name)


def test_overwrite_append_and_recreate(spark, name):
    coins = Model(spark, SF).coin_stg
    create_table(spark, S.COIN_LIST_STG, name)
    for overwrite, n in ((False, 1), (False, 2), (True, 1)):
        assert insert_rows(coins, S.COIN_LIST_STG, name, overwrite).count() == n * coins.count()
    create_table(spark, S.COIN_LIST_STG, name, recreate=True)
    assert spark.table(name).count() == 0


def test_partitioned_tables_prune(spark, name):
    create_table(spark, S.DATE_DIM, name, partition_by=["year", "month"])
    dim = Model(spark, SF).date_dim
    out = insert_rows(dim, S.DATE_DIM, name)
    assert same(out.select(S.DATE_DIM.names), dim)
    text = out.where("year = 1996 and month = '5'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text
    with pytest.raises(ValueError):
        table_ddl(S.DATE_DIM, name, partition_by=["no"])


def test_ddl_text():
    assert table_ddl(S.COIN_LIST_STG, "a.b", location="/x'y") == (
        "CREATE TABLE IF NOT EXISTS `a`.`b` (`coin_id` VARCHAR(256), `symbol` VARCHAR(256) NOT NULL, `name` VARCHAR(256) NOT NULL) "
        "USING parquet LOCATION '/x\\'y'"
    )
