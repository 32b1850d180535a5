"""DuckDB SQL equivalent to each registered query (the correctness oracle).

The fixture CTEs repeat ``starloom.plans.fixtures`` in SQL. The facts are built in
full by plain joins against the coins' spellings and the date dimension, and the
aggregates read those facts, so each Spark query is checked against a formulation
that shares none of its plan.
"""

from __future__ import annotations

FIXTURE_CTES = """
coin_stg AS (
  SELECT CASE WHEN n_nationkey = 24 THEN NULL ELSE 'nation-' || CAST(n_nationkey AS VARCHAR) END AS coin_id,
         'R' || CAST(n_regionkey AS VARCHAR) AS symbol, n_name AS name
  FROM nation),
hourly_src AS (
  SELECT o_orderdate + to_hours(CAST(o_orderkey % 6 AS INTEGER) * 4) AS "date",
         CAST(o_totalprice AS DECIMAL(18,5)) AS price,
         CAST(o_totalprice * 1000 AS DECIMAL(18,2)) AS market_cap,
         CAST(o_totalprice * 10 AS DECIMAL(18,2)) AS total_volumes,
         CASE WHEN o_orderkey % 8 = 0 THEN 'nation-' WHEN o_orderkey % 4 = 0 THEN 'Nation-' ELSE 'nation_' END
           || CAST(o_custkey % 25 AS VARCHAR) AS coin,
         o_orderkey AS src_id
  FROM orders),
hourly_stg AS (SELECT "date", price, market_cap, total_volumes, coin FROM hourly_src),
tweets_stg AS (
  SELECT o_orderdate + to_hours(CAST(o_orderkey % 6 AS INTEGER) * 4) AS datetime,
         CAST(c.conv_id * 1000 + c.turn AS BIGINT) AS tweet_id, c.text AS text,
         'user' || CAST(o_custkey AS VARCHAR) AS username,
         CASE WHEN o_orderkey % 3 = 0 THEN 'R' || CAST(o_custkey % 5 AS VARCHAR)
              WHEN o_orderkey % 3 = 1 THEN 'NATION_' || CAST(o_custkey % 25 AS VARCHAR)
              ELSE 'nation_' || CAST(o_custkey % 25 AS VARCHAR) END AS crypto
  FROM conversations c JOIN orders ON o_orderkey = c.conv_id * 8 + c.turn),
coin_dim AS (
  SELECT CAST(row_number() OVER (ORDER BY coin_id, symbol, name) - 1 AS BIGINT) AS coin_key, coin_id, symbol, name
  FROM coin_stg WHERE coin_id IS NOT NULL),
date_src AS (
  SELECT 0 AS src, datetime AS "date", tweet_id AS id FROM tweets_stg
  UNION ALL SELECT 1 AS src, "date", src_id AS id FROM hourly_src),
date_dim AS (
  SELECT CAST(row_number() OVER (ORDER BY src, "date", id) - 1 AS BIGINT) AS date_key, "date",
         CAST(hour("date") AS INTEGER) AS "hour", CAST(day("date") AS INTEGER) AS "day",
         CAST(week("date") AS INTEGER) AS week, CAST(month("date") AS VARCHAR) AS "month",
         CAST(year("date") AS INTEGER) AS "year", CAST(dayofweek("date") AS VARCHAR) AS weekday
  FROM date_src),
date_dim_set AS (
  SELECT CAST(row_number() OVER (ORDER BY "date") - 1 AS BIGINT) AS date_key, "date",
         CAST(hour("date") AS INTEGER) AS "hour", CAST(day("date") AS INTEGER) AS "day",
         CAST(week("date") AS INTEGER) AS week, CAST(month("date") AS VARCHAR) AS "month",
         CAST(year("date") AS INTEGER) AS "year", CAST(dayofweek("date") AS VARCHAR) AS weekday
  FROM (SELECT DISTINCT "date" FROM date_src))
"""


# The words that stand for a coin: in hourly rows its id or name in any case, in
# tweets its name or symbol as written. UNION leaves each word once a coin.
SPELLINGS = """
hourly_word AS (
  SELECT coin_key, UPPER(coin_id) AS word FROM coin_dim
  UNION SELECT coin_key, UPPER(name) FROM coin_dim),
tweet_word AS (
  SELECT coin_key, name AS word FROM coin_dim
  UNION SELECT coin_key, symbol FROM coin_dim)"""


def _fact_ctes(dd: str) -> str:
    return f"""{SPELLINGS},
coin_stats_hist AS (
  SELECT k.date_key, w.coin_key, s."date", c.name AS coin_name, c.symbol AS coin_symbol,
         s.price, s.market_cap, s.total_volumes
  FROM (SELECT *, UPPER(coin) AS word FROM hourly_stg) AS s
  INNER JOIN hourly_word AS w USING (word)
  INNER JOIN coin_dim AS c USING (coin_key)
  INNER JOIN {dd} AS k USING ("date")),
tweets_hist AS (
  SELECT k.date_key, w.coin_key, k."date", s.tweet_id, c.name AS coin_name, s.text AS tweet, s.username,
         s.crypto AS search_term
  FROM tweets_stg AS s
  INNER JOIN tweet_word AS w ON w.word = s.crypto
  INNER JOIN coin_dim AS c USING (coin_key)
  INNER JOIN {dd} AS k ON k."date" = s.datetime)"""


def _with(*extra: str) -> str:
    return "WITH " + ",".join([FIXTURE_CTES, *extra]) + "\n"


FACTS = _fact_ctes("date_dim")
FACTS_SET = _fact_ctes("date_dim_set")  # same names, set-mode dimension

# A fact with its calendar month, found through the key.
_IN_MONTH = """(SELECT f.*, k."month" AS in_month, k."year" AS in_year
  FROM coin_stats_hist AS f INNER JOIN (SELECT date_key, "month", "year" FROM {dd}) AS k USING (date_key))"""


def _extremes(column: str, name: str) -> str:
    return ", ".join(f"CAST({fn}({column}) AS DECIMAL(18,5)) AS {fn}_{name}" for fn in ("max", "min"))


MONTHLY_STATS = (
    """SELECT coin_name, coin_symbol, in_month AS "month", CAST(in_year AS VARCHAR) AS "year", """
    + ", ".join([_extremes("price", "usd_price"), _extremes("market_cap", "mcap"), _extremes("total_volumes", "total_vol")])
    + f" FROM {_IN_MONTH} GROUP BY ALL"
)
MONTHLY_MINMAX = (
    f"""SELECT coin_name, in_month AS "month", CAST(in_year AS VARCHAR) AS "year", {_extremes("price", "usd_price")}
FROM {_IN_MONTH} GROUP BY ALL"""
)
MONTHLY_AVG = (
    f"""SELECT coin_name, in_month AS "month", CAST(in_year AS VARCHAR) AS "year",
  CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_usd_price FROM {_IN_MONTH} GROUP BY ALL"""
)

# Both facts at one dimension row and coin.
SAME_TIME = """
SELECT (SELECT k."date" FROM {dd} AS k WHERE k.date_key = both_facts.date_key) AS "date",
       coin_symbol, tweet, price, market_cap, total_volumes
FROM (SELECT date_key, coin_key, coin_symbol, price, market_cap, total_volumes FROM coin_stats_hist)
  NATURAL JOIN (SELECT date_key, coin_key, tweet FROM tweets_hist) AS both_facts
"""

# The stored facts and dimensions with faults (``queries._stored_facts``).
FAULTS = """
bad_coin_stats AS (SELECT * REPLACE (NULLIF(coin_key, 3) AS coin_key,
  CASE WHEN date_key % 11 <> 0 THEN date_key END AS date_key) FROM coin_stats_hist),
bad_tweets AS (SELECT * REPLACE (NULLIF(coin_key, 3) AS coin_key,
  CASE WHEN date_key % 11 <> 0 THEN date_key END AS date_key) FROM tweets_hist),
fewer_coins AS (SELECT * FROM coin_dim WHERE coin_key % 5 <> 0),
fewer_dates AS (SELECT * FROM date_dim_set WHERE date_key % 7 <> 3)"""

MONTH_RANGE = """"date" BETWEEN TIMESTAMP '1996-03-10 00:00:00' AND TIMESTAMP '1997-01-31 23:59:59'"""

FAULTS_BAG = FAULTS.replace("date_dim_set", "date_dim")

ALL_HIST_COLS = "date_key, coin_key, \"date\", coin_name, coin_symbol, price, market_cap, total_volumes"
ALL_TWEET_COLS = "date_key, coin_key, \"date\", tweet_id, coin_name, tweet, username, search_term"

ISO = """CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END"""


def _nulls(table: str, keys: list[str], name: str | None = None) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name or table}' AS table_name, '{k}' AS key_column, "
        f"CAST(COUNT(*) FILTER (WHERE {k} IS NULL) AS BIGINT) AS null_rows FROM {table}"
        for k in keys
    )


def _orphans(table: str, key: str, dim: str, name: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, '{key}' AS fk, CAST(COUNT(*) AS BIGINT) AS orphan_rows FROM {table} f "
        f"WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{key})"
    )


ORPHANS = " UNION ALL ".join([
    _orphans("bad_coin_stats", "coin_key", "fewer_coins", "coin_stats_hist"),
    _orphans("bad_coin_stats", "date_key", "fewer_dates", "coin_stats_hist"),
    _orphans("bad_tweets", "coin_key", "fewer_coins", "tweets_hist"),
    _orphans("bad_tweets", "date_key", "fewer_dates", "tweets_hist"),
])


def _exported(name: str, rows: str, text: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows, "
        f"CAST(SUM(LENGTH({text})) AS BIGINT) AS n_chars FROM {rows}"
    )


SQL: dict[str, str] = {
    "stage_delimited": _with() + "SELECT * FROM hourly_stg",
    "stage_parquet": _with() + "SELECT * FROM tweets_stg",
    "read_documents": _with() + "SELECT * FROM tweets_stg WHERE crypto = 'R1'",
    "flatten_market_chart": _with(
        """p AS (SELECT coin, src_id // 4096 AS chunk, "date", CAST(price AS DOUBLE) AS price FROM hourly_src),
m AS (SELECT coin, src_id // 4096 AS chunk, "date", CAST(market_cap AS DOUBLE) AS market_cap FROM hourly_src),
v AS (SELECT coin, src_id // 4096 AS chunk, "date", CAST(total_volumes AS DOUBLE) AS total_volumes FROM hourly_src)"""
    ) + """SELECT p."date", p.price, m.market_cap, v.total_volumes, p.coin
FROM p JOIN m ON p.coin = m.coin AND p.chunk = m.chunk AND p."date" = m."date"
JOIN v ON p.coin = v.coin AND p.chunk = v.chunk AND p."date" = v."date\"""",
    "conform": _with() + "SELECT * FROM tweets_stg",
    "last_n_days": _with() + """SELECT * FROM hourly_stg
WHERE "date" >= (SELECT MAX("date") FROM hourly_stg) - INTERVAL 30 DAY AND "date" <= (SELECT MAX("date") FROM hourly_stg)""",
    "time_range": _with() + """SELECT * FROM hourly_stg
WHERE "date" BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-06-30 20:00:00'""",
    "coin_subset": _with() + """SELECT * FROM hourly_stg
WHERE coin IN ('nation-1', 'Nation-4', 'nation_7', 'nation-16', 'nation_23')""",
    "coin_dim": _with() + "SELECT * FROM coin_dim",
    "date_dim_tweets": _with() + """SELECT CAST(row_number() OVER (ORDER BY datetime, tweet_id) - 1 AS BIGINT) AS date_key,
  datetime AS "date", CAST(hour(datetime) AS INTEGER) AS "hour", CAST(day(datetime) AS INTEGER) AS "day",
  CAST(week(datetime) AS INTEGER) AS week, CAST(month(datetime) AS VARCHAR) AS "month",
  CAST(year(datetime) AS INTEGER) AS "year", CAST(dayofweek(datetime) AS VARCHAR) AS weekday
FROM tweets_stg""",
    "date_dim_crypto": _with() + """SELECT CAST(row_number() OVER (ORDER BY "date", src_id) - 1 AS BIGINT) AS date_key,
  "date", CAST(hour("date") AS INTEGER) AS "hour", CAST(day("date") AS INTEGER) AS "day",
  CAST(week("date") AS INTEGER) AS week, CAST(month("date") AS VARCHAR) AS "month",
  CAST(year("date") AS INTEGER) AS "year", CAST(dayofweek("date") AS VARCHAR) AS weekday
FROM hourly_src""",
    "date_dim_events": """SELECT CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS BIGINT) AS date_key,
  ts AS "date", CAST(hour(ts) AS INTEGER) AS "hour", CAST(day(ts) AS INTEGER) AS "day",
  CAST(week(ts) AS INTEGER) AS week, CAST(month(ts) AS VARCHAR) AS "month",
  CAST(year(ts) AS INTEGER) AS "year", CAST(dayofweek(ts) AS VARCHAR) AS weekday
FROM events""",
    "date_dim": _with() + "SELECT * FROM date_dim",
    "date_dim_set": _with() + "SELECT * FROM date_dim_set",
    "load_dimension_append": _with() + "SELECT * FROM date_dim",
    "load_dimension_ranges": _with() + "SELECT * FROM date_dim",
    "coin_stats_hist": _with(FACTS) + "SELECT * FROM coin_stats_hist",
    "coin_stats_hist_set": _with(FACTS_SET) + "SELECT * FROM coin_stats_hist",
    "coin_stats_hist_by_id": _with() + """SELECT k.date_key, c.coin_key, "date", c.name AS coin_name, s.price, s.market_cap, s.total_volumes
FROM (SELECT *, coin AS coin_id FROM hourly_stg) AS s INNER JOIN coin_dim AS c USING (coin_id) INNER JOIN date_dim AS k USING ("date")
WHERE c.name IS NOT NULL""",
    "tweets_hist": _with(FACTS) + "SELECT * FROM tweets_hist",
    "tweets_hist_set": _with(FACTS_SET) + "SELECT * FROM tweets_hist",
    "tweets_and_stats_same_time": _with(FACTS) + SAME_TIME.format(dd="date_dim"),
    "tweets_and_stats_same_time_set": _with(FACTS_SET) + SAME_TIME.format(dd="date_dim_set"),
    "tweets_and_stats_top5": _with(FACTS) + "SELECT * FROM (" + SAME_TIME.format(dd="date_dim")
    + ") s ORDER BY \"date\", coin_symbol, tweet, price, market_cap, total_volumes LIMIT 5",
    "monthly_price_stats": _with(FACTS) + MONTHLY_STATS.format(dd="date_dim"),
    "monthly_price_stats_set": _with(FACTS_SET) + MONTHLY_STATS.format(dd="date_dim_set"),
    "monthly_price_minmax": _with(FACTS) + MONTHLY_MINMAX.format(dd="date_dim"),
    "monthly_price_avg": _with(FACTS) + MONTHLY_AVG.format(dd="date_dim"),
    "monthly_price_avg_set": _with(FACTS_SET) + MONTHLY_AVG.format(dd="date_dim_set"),
    "monthly_sorted": _with(FACTS, "s AS (" + MONTHLY_STATS.format(dd="date_dim") + ")")
    + """SELECT *, CAST(row_number() OVER (ORDER BY coin_name NULLS FIRST, coin_symbol NULLS FIRST,
  CAST("year" AS INTEGER) NULLS FIRST, CAST("month" AS INTEGER) NULLS FIRST) AS BIGINT) AS sort_rank FROM s""",
    "monthly_sorted_text": _with(FACTS, "s AS (" + MONTHLY_MINMAX.format(dd="date_dim") + ")")
    + """SELECT *, CAST(row_number() OVER (ORDER BY coin_name NULLS FIRST, "year" NULLS FIRST, "month" NULLS FIRST) AS BIGINT)
  AS sort_rank FROM s""",
    "preview_coin_dim": _with() + "SELECT * FROM coin_dim ORDER BY coin_key LIMIT 10",
    "preview_coin_stats": _with(FACTS) + f"SELECT * FROM coin_stats_hist ORDER BY {ALL_HIST_COLS} LIMIT 10",
    "preview_tweets": _with(FACTS) + f"SELECT * FROM tweets_hist ORDER BY {ALL_TWEET_COLS} LIMIT 10",
    "epoch_roundtrip": f"""WITH e AS (SELECT event_id, ts, {ISO} AS iso_text FROM events)
SELECT event_id, ts, iso_text,
       CAST(epoch_us(CAST(iso_text AS TIMESTAMP)) AS DOUBLE) / 1e6 AS epoch_seconds,
       CAST(epoch_us(ts) // 1000 AS BIGINT) AS epoch_millis,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts_from_millis
FROM e""",
    "null_key_report": _with(FACTS_SET, FAULTS) + " UNION ALL ".join([
        _nulls("coin_stg", ["coin_id", "symbol", "name"]),
        _nulls("fewer_coins", ["coin_key"], "coin_dim"),
        _nulls("fewer_dates", ["date_key"], "date_dim"),
        _nulls("bad_coin_stats", ["coin_key", "date_key"], "coin_stats_hist"),
        _nulls("bad_tweets", ["coin_key", "date_key"], "tweets_hist"),
    ]),
    "fk_orphans": _with(FACTS_SET, FAULTS) + ORPHANS,
    "fk_orphans_dense": _with(FACTS_SET, FAULTS) + ORPHANS,
    "bag_null_key_report": _with(FACTS, FAULTS_BAG) + " UNION ALL ".join([
        _nulls("bad_coin_stats", ["coin_key", "date_key"], "coin_stats_hist"),
        _nulls("bad_tweets", ["coin_key", "date_key"], "tweets_hist"),
    ]),
    "bag_fk_orphans": _with(FACTS, FAULTS_BAG) + ORPHANS,
    "declared_table": _with() + "SELECT * FROM hourly_stg",
    "find_null": _with() + "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS username) FROM tweets_stg WHERE tweet_id % 5 = 0",
    "run_checks": _with(SPELLINGS) + """
SELECT check_name, CAST(LEAST(n, 3) AS BIGINT) AS shown, n > 0 AS failed FROM (
  SELECT 'coins without id' AS check_name, COUNT(*) AS n FROM coin_stg WHERE coin_id IS NULL
  UNION ALL SELECT 'prices below zero', COUNT(*) FROM hourly_stg WHERE price < 0
  UNION ALL SELECT 'tweets of unknown coins', COUNT(*) FROM tweets_stg
    WHERE crypto NOT IN (SELECT word FROM tweet_word))""",
    "load_errors": _with() + """
SELECT concat_ws('|', strftime("date", '%Y-%m-%d %H:%M:%S'), CAST(price AS VARCHAR) || CASE WHEN spoiled THEN 'x' ELSE '' END,
         CAST(market_cap AS VARCHAR), CAST(total_volumes AS VARCHAR), CASE WHEN src_id % 16 <> 3 THEN coin ELSE '\\N' END) AS raw_line,
       CASE WHEN spoiled THEN 'price' ELSE 'coin' END AS column_name,
       CASE WHEN spoiled THEN 'not a decimal(18,5)' ELSE 'NULL in a NOT NULL column' END AS reason
FROM (SELECT *, starts_with(coin, 'Nation-') AS spoiled FROM hourly_src) WHERE spoiled OR src_id % 16 = 3""",
    "load_error_lines": _with() + """
SELECT src_id // 4096 AS block, CAST(line AS BIGINT) AS line_number,
       concat_ws('|', strftime("date", '%Y-%m-%d %H:%M:%S'), CASE WHEN spoiled THEN ' ' || price || 'x ' ELSE CAST(price AS VARCHAR) END,
         CAST(market_cap AS VARCHAR), CAST(total_volumes AS VARCHAR), CASE WHEN src_id % 16 <> 3 THEN coin ELSE '\\N' END) AS raw_line,
       CASE WHEN spoiled THEN 'price' ELSE 'coin' END AS column_name,
       CASE WHEN spoiled THEN 'not a decimal(18,5)' ELSE 'NULL in a NOT NULL column' END AS reason
FROM (SELECT *, starts_with(coin, 'Nation-') AS spoiled,
             1 + row_number() OVER (PARTITION BY src_id // 4096 ORDER BY src_id) AS line FROM hourly_src)
WHERE spoiled OR src_id % 16 = 3""",
    "append_documents": _with() + "SELECT * FROM tweets_stg",
    "coin_subset_long": _with() + "SELECT * FROM hourly_stg WHERE coin LIKE 'nation!_%' ESCAPE '!'",
    "load_fact_append": _with(FACTS_SET) + "SELECT * FROM coin_stats_hist",
    "load_fact_partitioned": _with(FACTS_SET) + """SELECT *, CAST(year("date") AS INTEGER) AS part_year,
  CAST(month("date") AS INTEGER) AS part_month FROM coin_stats_hist""",
    "load_fact_replace_month": _with(FACTS_SET) + """
SELECT * REPLACE (CAST(CASE WHEN coin_key % 2 = 1 AND strftime("date", '%Y-%m') = '1996-05' THEN price + 1 ELSE price END
  AS DECIMAL(18,5)) AS price) FROM coin_stats_hist""",
    "time_range_partitioned": _with(FACTS_SET) + f"SELECT * FROM coin_stats_hist WHERE {MONTH_RANGE}",
    "monthly_price_stats_partitioned": _with(FACTS_SET.replace("coin_stats_hist AS", "whole AS", 1),
        f"coin_stats_hist AS (SELECT * FROM whole WHERE {MONTH_RANGE})") + MONTHLY_STATS.format(dd="date_dim_set"),
    "write_conformed": _with() + "SELECT * FROM tweets_stg",
    "write_violations": _with() + """
SELECT * FROM (
  SELECT 'text' AS column_name, 'not_null' AS rule, CAST(COUNT(*) AS BIGINT) AS violations FROM tweets_stg WHERE tweet_id % 7 = 0
  UNION ALL SELECT 'username', 'max_length_256', COUNT(*) FROM tweets_stg WHERE tweet_id % 11 = 0)
WHERE violations > 0""",
    "monthly_price_stats_fact": _with(FACTS_SET) + MONTHLY_STATS.format(dd="date_dim_set"),
    "pipeline_monthly": _with(FACTS_SET) + MONTHLY_STATS.format(dd="date_dim_set"),
    "csv_one_file": _with() + "SELECT * FROM hourly_stg",
    "csv_roundtrip_events": "SELECT event_id, ts FROM events",
    "export_all": _with(FACTS_SET, "m AS (" + MONTHLY_STATS.format(dd="date_dim_set") + ")") + " UNION ALL ".join([
        _exported("snscrape_tweets_hist", "tweets_hist", "tweet"), _exported("coin_stats_hist", "coin_stats_hist", "coin_name"),
        _exported("date_dim", "date_dim_set", "weekday"), _exported("cg_coin_list", "coin_dim", "name"),
        _exported("cg_usd_min_anx_max", "m", "coin_name"),
    ]),
    "csv_roundtrip": _with() + "SELECT * FROM tweets_stg",
}
