"""Bad lines as they stand in the file, with their number, over splits of a file."""

import random

import pytest

from starloom import schemas as S
from starloom.sources.delimited import load_errors, stage_delimited


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


GOOD = "2024-01-02 03:04:05|1.50000|10.00|3.00|coin"
BAD = {
    "2024-01-02 03:04:05|1x|\\N|3.00|coin": ("price", "not a decimal(18,5)"),
    " 2024-01-02 03:04:05| 1.5 |\\N|3.00|coin ": ("market_cap", "NULL in a NOT NULL column"),
    "2024-01-02 03:04:05|1.5|10.00|3.00": (None, "wrong number of fields"),
    "a|b|c|d|e|f": (None, "wrong number of fields"),
    'never|"1.5|10.00|3.00|coin': ("date", "not a timestamp_ntz"),
    "2024-01-02 03:04:05|1.5|10.00|3.00|": ("coin", "NULL in a NOT NULL column"),
    "2024-01-02 03:04:05|1.5|10.00|3.00|" + "é" * 257: ("coin", "longer than 256"),
}


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("header", [True, False])
def test_every_bad_line_with_its_number(spark, tmp_path, small_splits, end, header):
    rnd = random.Random(1)
    want = {}
    for f in range(3):
        lines = [""] * f + (["date|price|market_cap|total_volumes|coin"] if header else [])
        for _ in range(400 * (f + 1)):
            lines.append(rnd.choice([GOOD, GOOD, GOOD, "", "  ", *BAD]))
        (tmp_path / f"{f}.csv").write_bytes(end.join(lines).encode() + (end.encode() if f else b""))
        for i, line in enumerate(lines):
            if line in BAD:
                want[f, i + 1] = (line, *BAD[line])
    df = load_errors(spark, str(tmp_path), S.HOURLY_STG, header=header)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    rows = df.collect()
    got = {(int(r["file_path"][-5]), r["line_number"]): (r["raw_line"], r["column_name"], r["reason"]) for r in rows}
    assert got == want and len(rows) == len(want)
    order = [(-r["file_modified"].timestamp(), r["file_path"], r["line_number"]) for r in rows]
    assert order == sorted(order)


def test_lines_without_errors_and_an_empty_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date|price|market_cap|total_volumes|coin\n" + f"{GOOD}\n" * 5)
    (tmp_path / "b.csv").write_text("")
    assert load_errors(spark, str(tmp_path), S.HOURLY_STG).collect() == []
    assert stage_delimited(spark, str(tmp_path), S.HOURLY_STG).count() == 5


def test_only_bad_lines_move(spark, tmp_path):
    """What is shuffled of the lines comes after the filter; the other branch is counts."""
    (tmp_path / "a.csv").write_text("h\n" + f"{GOOD}\n" * 5)
    plan = load_errors(spark, str(tmp_path), S.HOURLY_STG)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    parses = [i for i, line in enumerate(lines) if "Filter" in line and "from_csv" in line]
    assert parses and "BroadcastNestedLoopJoin" not in plan
    for i in parses:  # lines are filtered before they meet the counts or are sorted
        above = next(line for line in reversed(lines[:i]) if "Exchange" in line)
        assert "partitioning(file_" in above and above.index("Exchange") < lines[i].index("Filter")
