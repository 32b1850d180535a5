"""Conversation repair against an exhaustive search, and its matrices."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from starloom.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
INITIALS = {"s": 1, "u": 2, "a": 3}


def exhaustive(rows):
    """(cost, audit, repaired lines) of (initial, fault, role, text) rows, by trying every edit."""

    @lru_cache(None)
    def best(i, done, inserted):
        ways = []
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", done):
            ways.append((0, "", ()))
        # of what was said only the last role matters
        nxt = {"": "u", "s": "u", "u": "a", "a": "u"}[done[-1:]]
        said = {"u": "user", "a": "assistant"}[nxt]
        keep = (done + nxt)[-4:] if len(done) < 4 else short(done + nxt)
        if inserted < 3:
            c, a, t = best(i, keep, inserted + 1)
            ways.append((c + 2, "I" + a, ((said, ""), *t)))
        if i < len(rows):
            initial, fault, role, text = rows[i]
            c, a, t = best(i + 1, done, 0)
            ways.append((c + 3, "D" + a, t))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if initial == nxt or (initial == "s" and not done):
                    c, a, t = best(i + 1, short(done + initial), 0)
                    ways.append((c + extra, "K" + a, ((role, text), *t)))
                c, a, t = best(i + 1, keep, 0)
                ways.append((c + 2 + extra, "R" + a, ((said, text), *t)))
        return min(ways, key=lambda w: w[:2]) if ways else (10**9, "", ())

    def short(done):
        """An equivalent beginning of bounded length."""
        return {"s": "s", "u": "u", "a": "ua"}[done[-1]] if done[0] != "s" or len(done) == 1 else "s" + {"u": "u", "a": "ua"}[done[-1]]

    return best(0, "", 0)


def expected(rows, damage=True):
    """The contract, row by row, for (conv_id, turn, role, text) rows."""
    out = {}
    for c, t, role, text in rows:
        conv = out.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damage else 5
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        conv += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    result = {}
    for c, conv in out.items():
        conv.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        seen, faulty, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for t, role, text in conv:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = (
                "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None
            )
            seen.add((role, text))
            n.update({fault: n[fault] + 1} if fault else {})
            faulty.append((role[:1] if role[:1] in ("s", "u", "a") else "?", fault, role, text))
        turns = {t for t, _, _ in conv if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(faulty, faulty[1:]))
        cost, audit, said = exhaustive(tuple(faulty))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        result[c] = (c, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, sha)
    return result


def check(spark, rows, **options):
    got = R.repair_conversations(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()
    want = expected(rows, damage=options.get("damage", True) is not None)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r) == want[r["conv_id"]]


def test_choices_are_the_cheapest_and_least():
    rnd = random.Random(3)
    names = {R.FINE: None, R.BLANK: "blank", R.DUPLICATE: "duplicate", R.CUT_OFF: "truncated"}
    for _ in range(1500):
        rows = [(rnd.randint(0, 3), rnd.choice([0, 0, 0, 1, 2, 3])) for _ in range(rnd.randint(0, 8))]
        if rows and rnd.random() < 0.3:
            rows = [rows[0]] * rnd.randint(1, 9) + rows[:2]
        want = exhaustive(tuple(("?sua"[i], names[f], "", "") for i, f in rows))
        assert R.repair(rows) == want[:2], rows


def test_powers_and_blocks_agree_with_single_steps():
    rnd = random.Random(4)
    for sym in [*range(8), R.GONE]:
        for length in (1, 2, 3, 7, 64, 1001):
            costs, step = tuple(rnd.randint(0, 9) for _ in range(4)), None
            step = costs
            for _ in range(length):
                step = R._apply(R.power(sym, 0), step)
            assert R.advance(sym, length, costs) == step == R._apply(R.run_matrix(sym, length), costs)
    runs = [(rnd.randint(0, 8), rnd.randint(1, 9)) for _ in range(12)]
    end = R.ending()
    assert R.before(runs, end)[0] == R._apply(R._times(R.block_matrix(runs[:5]), R.block_matrix(runs[5:])), end)


def test_a_run_of_any_length():
    assert R.repair([(0, R.BLANK)] * 200_000) == (600_000, "D" * 200_000)
    cost, audit = R.repair([(2, R.FINE), (3, R.FINE)] + [(2, R.DUPLICATE)] * 150_000 + [(2, R.FINE), (3, R.FINE)])
    assert (cost, audit) == (450_000, "KK" + "D" * 150_000 + "KK")


def test_query_against_the_contract(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = expected(rows)
    got = {r["conv_id"]: tuple(r) for r in R.op12_conversation_repair(spark, d).collect()}
    assert got == want
    assert any(w[2] for w in want.values()) and any(w[3] for w in want.values()) and any(w[1] for w in want.values())


def test_nulls_ties_repeats_and_odd_roles(spark):
    rnd = random.Random(5)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "userland"]
    texts = ["Ja.", "Nein", "  \t", "", None, "Was?\n ", "x!", "é。", "Ja."]
    rows = [
        (rnd.choice([None, 1, 2, 3, 4, 5, -6]), rnd.choice([None, 0, 1, 2, 3, 5, 9]), rnd.choice(roles), rnd.choice(texts))
        for _ in range(60)
    ]
    check(spark, rows)
    check(spark, rows, damage=None)
    check(spark, rows[:3] * 5)


@pytest.mark.parametrize("block", [1, 3])
def test_a_conversation_over_many_blocks(spark, monkeypatch, block):
    """Half of all rows in one conversation, blocks of a few rows, over all partitions."""
    monkeypatch.setattr(R, "BLOCK", block)  # of the driver; tasks deal by ranges alone
    rnd = random.Random(block)
    rows = [(7, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", "b", "c?", " "]) + str(t % 5) * (t % 3)) for t in range(40)]
    rows += [(t % 9, t // 9, rnd.choice(["user", "assistant"]), f"{t}.") for t in range(40)]
    check(spark, rows)


def test_block_rows_cut_at_the_bound(monkeypatch):
    """Blocks of two rows give the audit and counts of one block."""
    import pyarrow as pa

    rnd = random.Random(8)
    rows = [(False, 1, True, t // 2, rnd.randint(0, 3), rnd.randint(0, 3), rnd.choice([1, 1, 3])) for t in range(21)]

    def result(size):
        monkeypatch.setattr(R, "BLOCK", size)
        batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=list("abcdefg"))
        blocks = list(R._block_rows(iter([batch]), 0))
        costs, conv = R.ending(), R._Conversation(False, 1)
        behind = []
        for b in reversed(blocks):
            behind.append(list(costs))
            costs = R._apply(R._matrix_of(b[6]), costs)
        import numpy as np

        for b, c in zip(blocks, reversed(behind)):
            runs = list(zip(b[4], np.frombuffer(b[5], "<i8").tolist()))
            before = R.before(runs, tuple(c))
            entered = [R.unroll(runs, before, s) for s in R.STATES]
            conv.piece(*b[7:], before[0][R.START], [a for a, _ in entered], [e for _, e in entered])
        conv._closed()
        return len(blocks), (conv.faults, conv.illegal, conv.cost, conv.all, conv.turns, conv.first_turn, conv.last_turn)

    one, many = result(1 << 16), result(2)
    assert one[0] == 1 and many[0] == 11 and one[1] == many[1]


def test_empty_table_extra_columns_and_all_rows_dropped(spark):
    assert R.repair_conversations(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next((c, t) for c in range(9) for t in range(99) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(*gone, "user", "Hi.", 1, "x")], SCHEMA + ", copies int, cn string")
    r = R.repair_conversations(df).collect()
    assert [tuple(x) for x in r] == [(gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_very_long_text_and_turns_at_the_ends_of_a_long(spark):
    rows = [(1, -(2**63), "user", "x" * 300_000 + "."), (1, 2**63 - 1, "assistant", "y.")]
    (r,) = R.repair_conversations(spark.createDataFrame(rows, SCHEMA), damage=None).collect()
    assert r["gaps"] is None and r["audit"] == "KK"
    assert r["repaired_sha256"] == hashlib.sha256(("user:" + rows[0][3] + "\nassistant:y.").encode()).hexdigest()
