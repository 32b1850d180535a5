"""Repair of the turn structure of conversations by run-length dynamic programming.

A repaired conversation's role initials read ``(s?(ua)+)?``. Edits: Keep (0), Rerole to
user or assistant (2), Delete (3, required for blank and duplicate rows), Insert an
empty user or assistant turn anywhere (2); a truncated row that stays adds 1. Of the
cheapest edits the one whose initials are ASCII-least is taken.

*Symbols.* A row counts by its role initial and its first fault only. Four states say
what may follow (nothing yet, after s, after u, after a), so a row is a 4 by 4
min-plus matrix, insertions before it included. Equal consecutive symbols are one run.
A run of length L is advanced by the cached 1st, 2nd, 4th, ... powers of its matrix.

*Any length of conversation.* Rows are dealt by ranges of (conversation, turn, role,
text digest), so a conversation of any size is cut into blocks over many tasks; equal
rows are first collapsed to one row with a count. A block stores its runs and its
matrix. Only the matrices of conversations of several blocks are put in a line, from
the last to the first, to give each block the cost of all that follows it. Blocks then
unroll their choices by themselves, once for each state they may be entered in, and a
conversation's row picks the pieces that fit.

*Digest.* SHA-256 runs over the repaired lines in order, so a conversation's rows pass
one task, as a sorted stream that holds the audit, one character an edit, but no text.

Nulls: a null role or text is one space (the text is then blank), a null turn sorts
first, rows with a null id are one conversation. Rows of one turn are taken by role
(its bytes), then by the text's MD5. Only lower-case first letters s, u, a count as
initials; an empty role has none. ``gaps`` is null where it is beyond a long. Very
long texts are held one Arrow batch at a time. An empty table gives no rows. Columns
other than the four named ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.scratch import partitions, ship, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FAR = 1 << 60
#: Rows of a block, and rows of a run whose choices are unrolled together.
BLOCK = 1 << 16

START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = range(4)
#: The state after the user or assistant turn that a state allows.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
TURN = {AFTER_U: "user", AFTER_A: "assistant"}
#: The state after a kept row by its role initial (0 other, 1 s, 2 u, 3 a).
KEPT = ({}, {START: AFTER_S}, {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, {AFTER_U: AFTER_A})
#: Faults of a row, the first one that holds.
FINE, BLANK, DUPLICATE, CUT_OFF = range(4)
GONE = 8  # symbol of a row that must go; others are 2 * initial + truncated

Matrix = tuple[tuple[int, ...], ...]
Costs = tuple[int, ...]


def symbol(initial: int, fault: int) -> int:
    return GONE if fault in (BLANK, DUPLICATE) else 2 * initial + (fault == CUT_OFF)


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(min(a[i][k] + b[k][j] for k in STATES), FAR) for j in STATES) for i in STATES)


def _apply(m: Matrix, costs: Costs) -> Costs:
    return tuple(min(min(m[i][k] + costs[k] for k in STATES), FAR) for i in STATES)


IDENTITY: Matrix = tuple(tuple(0 if i == j else FAR for j in STATES) for i in STATES)


@lru_cache(None)
def inserts() -> Matrix:
    """The least cost of insertions from one state to another."""
    one = tuple(tuple(0 if i == j else INSERT if NEXT[i] == j else FAR for j in STATES) for i in STATES)
    two = _times(one, one)
    return _times(two, two)


@lru_cache(None)
def choices(sym: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """``(letter, cost, next state)`` of the edits that use a row up, letters ascending."""
    out = [("D", DELETE, state)]
    if sym != GONE:
        initial, extra = divmod(sym, 2)
        if state in KEPT[initial]:
            out.append(("K", KEEP + TRUNCATED * extra, KEPT[initial][state]))
        out.append(("R", REROLE + TRUNCATED * extra, NEXT[state]))
    return tuple(out)


@lru_cache(None)
def power(sym: int, k: int) -> Matrix:
    """The matrix of 2 ** k rows of one symbol."""
    if k:
        half = power(sym, k - 1)
        return _times(half, half)
    row = [[FAR] * 4 for _ in STATES]
    for i in STATES:
        for _, cost, j in choices(sym, i):
            row[i][j] = min(row[i][j], cost)
    return _times(inserts(), tuple(map(tuple, row)))


def run_matrix(sym: int, length: int) -> Matrix:
    out = IDENTITY
    for k in range(length.bit_length()):
        if length >> k & 1:
            out = _times(power(sym, k), out)
    return out


@lru_cache(1 << 16)
def _short_advance(sym: int, length: int, costs: Costs) -> Costs:
    return _advance(sym, length, costs)


def _advance(sym: int, length: int, costs: Costs) -> Costs:
    for k in range(length.bit_length()):
        if length >> k & 1:
            costs = _apply(power(sym, k), costs)
    return costs


def advance(sym: int, length: int, costs: Costs) -> Costs:
    """The costs before a run, given those behind it. Only differences are cached."""
    low = min(costs)
    found = _short_advance(sym, length, tuple(c - low for c in costs))
    return tuple(c + low for c in found)


def ending() -> Costs:
    """The costs behind the last row: whole turns end, others take insertions."""
    return _apply(inserts(), (0, FAR, FAR, 0))


def block_matrix(runs: list[tuple[int, int]]) -> Matrix:
    out = IDENTITY
    for sym, length in runs:
        out = _times(out, run_matrix(sym, length))
    return out


def before(runs: list[tuple[int, int]], behind: Costs) -> list[Costs]:
    """The costs before each run and, last, behind them all."""
    out = [behind]
    for sym, length in reversed(runs):
        out.append(advance(sym, length, out[-1]))
    return out[::-1]


def unroll(runs: list[tuple[int, int]], costs: list[Costs], state: int) -> tuple[str, int]:
    """The ASCII-least cheapest edits of a block entered in a state, and the state left."""
    out: list[str] = []
    for (sym, length), behind in zip(runs, costs[1:], strict=True):
        while length:
            part = min(length, BLOCK)
            length -= part
            line = [advance(sym, length, behind)]
            for _ in range(part):
                line.append(advance(sym, 1, line[-1]))
            for now, then in zip(line[:0:-1], line[-2::-1], strict=True):
                letter = None
                while letter is None:
                    for name, cost, to in choices(sym, state):
                        if name > "I" and INSERT + now[NEXT[state]] == now[state]:
                            break
                        if cost + then[to] == now[state]:
                            letter, state = name, to
                            break
                    if letter is None:
                        out.append("I")
                        state = NEXT[state]
                out.append(letter)
    return "".join(out), state


def closing(state: int) -> str:
    """The insertions behind the last row."""
    out = ""
    while state not in (START, AFTER_A):
        out, state = out + "I", NEXT[state]
    return out


def repair(rows: list[tuple[int, int]]) -> tuple[int, str]:
    """``(cost, audit)`` of the rows' (initial, fault)."""
    runs: list[list[int]] = []
    for r in rows:
        if runs and runs[-1][0] == symbol(*r):
            runs[-1][1] += 1
        else:
            runs.append([symbol(*r), 1])
    costs = before(runs, ending())
    audit, state = unroll(runs, costs, START)
    return costs[0][START], audit + closing(state)


# -- over a table -----------------------------------------------------------

_CONV = ["cn", "cv"]
_PLACE = ["tn", "tv", "role", "digest"]
_BLANKS = " \t\n\x0b\x0c\r"

_BLOCKS = (
    "cn boolean, cv long, part int, seq long, syms binary, lengths binary, matrix array<long>, blank long, "
    "duplicate long, truncated long, illegal long, first_initial int, last_initial int, first_turn long, "
    "last_turn long, turns long"
)
_PIECES = (
    "cn boolean, cv long, part int, seq long, blank long, duplicate long, truncated long, illegal long, "
    "first_initial int, last_initial int, first_turn long, last_turn long, turns long, cost long, "
    "audits array<string>, ends array<int>"
)
_RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _named(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _arrow(schema: str) -> pa.Schema:
    types = {
        "boolean": pa.bool_(), "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
        "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()),
    }
    return pa.schema([(c.split()[0], types[c.split()[1]]) for c in schema.split(", ")])


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded length; texts and binaries count by their size."""
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += sum(len(v) for v in r if isinstance(v, (str, bytes)))
        if len(held) >= most or n >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch], most: int = 8192) -> Iterator[tuple]:
    for b in batches:
        for lo in range(0, b.num_rows, most):
            part = b.slice(lo, most)
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def keyed(table: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``cn, cv, tn, tv`` (null marks and values of conversation and turn), ``role, text``."""
    c, t = F.col(f"`{conv}`").cast("long"), F.col(f"`{turn}`").cast("long")
    return table.select(
        c.isNull().alias("cn"), F.coalesce(c, F.lit(0).cast("long")).alias("cv"),
        t.isNotNull().alias("tn"), F.coalesce(t, F.lit(0).cast("long")).alias("tv"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of ``keyed`` after the damage that crc32(conversation:turn) mod 20 decides,
    with ``copies`` 2 where a row is repeated."""
    conv = F.when(F.col("cn"), F.lit(" ")).otherwise(F.col("cv").cast("string"))
    turn = F.when(F.col("tn"), F.col("tv").cast("string")).otherwise(F.lit(" "))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    text = (
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    return rows.where(kind != 0).select(
        *_CONV, "tn", "tv",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0).cast("int")


def symbols(rows: DataFrame) -> DataFrame:
    """One row for equal rows: ``cn, cv, tn, tv, role, digest``, ``initial``, the fault of
    the first of them and how many there are. The others are duplicates, or blank."""
    end = F.rtrim(F.col("text"), F.lit(_BLANKS))
    light = rows.select(
        *_CONV, "tn", "tv", "role", F.unhex(F.md5(F.col("text"))).alias("digest"), "copies",
        F.when(end == "", BLANK).when(F.right(end, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(CUT_OFF).cast("int").alias("own"),
    ).groupBy(*_CONV, *_PLACE).agg(F.sum("copies").alias("n"), F.max("own").alias("own"))
    said = [*_CONV, "role", "digest"]
    first = light.groupBy(*said).agg(F.min(F.struct("tn", "tv")).alias("first"))
    fault = (
        F.when(F.col("own") == BLANK, BLANK)
        .when(F.col("first") != F.struct("tn", "tv"), DUPLICATE)
        .otherwise(F.col("own")).cast("int")
    )
    return light.join(first, said).select(*_CONV, *_PLACE, _initial(F.col("role")).alias("initial"), fault.alias("fault"), "n")


_LEGAL = {(1, 2), (2, 3), (3, 2)}


def _block_rows(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[tuple]:
    """Blocks of a task's sorted rows (cn, cv, tn, tv, initial, fault, n)."""
    at, seq = None, 0
    runs: list[list[int]] = []

    def block():
        syms = bytes(s for s, _ in runs)
        lengths = np.array([n for _, n in runs], dtype="<i8").tobytes()
        matrix = [c for line in block_matrix([(s, n) for s, n in runs]) for c in line]
        return (*at, part, seq, syms, lengths, matrix, *faults, illegal, first, last, first_turn, last_turn, turns)

    for cn, cv, tn, tv, initial, fault, n in _rows(batches):
        if at != (cn, cv) or size >= BLOCK:
            if at is not None:
                yield block()
                seq += 1
            at, runs, size, faults, illegal, first, last = (cn, cv), [], 0, [0, 0, 0], 0, initial, None
            first_turn = last_turn = None
            turns = 0
        size += 1
        if last is not None and (last, initial) not in _LEGAL:
            illegal += 1
        illegal += n - 1
        last = initial
        if tn and (last_turn is None or tv != last_turn):
            turns += 1
            last_turn = tv
            first_turn = tv if first_turn is None else first_turn
        if fault != FINE:
            faults[fault - 1] += 1
        again = BLANK if fault == BLANK else DUPLICATE
        faults[again - 1] += n - 1
        for sym, m in ((symbol(initial, fault), 1), (symbol(initial, again), n - 1)):
            if m and runs and runs[-1][0] == sym:
                runs[-1][1] += m
            elif m:
                runs.append([sym, m])
    if at is not None:
        yield block()


def _matrix_of(flat: list[int]) -> Matrix:
    return tuple(tuple(flat[4 * i : 4 * i + 4]) for i in STATES)


def _behind_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of blocks sorted from a conversation's last to its first: the costs behind each."""
    at, costs = None, ending()
    for cn, cv, part, seq, flat in _rows(batches):
        if at != (cn, cv):
            at, costs = (cn, cv), ending()
        yield cn, cv, part, seq, list(costs)
        costs = _apply(_matrix_of(flat), costs)


def _piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for *head, syms, lengths, behind, counts in _rows(batches):
        runs = list(zip(syms, np.frombuffer(lengths, dtype="<i8").tolist(), strict=True))
        costs = before(runs, tuple(behind) if behind is not None else ending())
        entered = [unroll(runs, costs, s) for s in (STATES if behind is not None else (START,))]
        yield (*head, *counts.values(), costs[0][START], [a for a, _ in entered], [e for _, e in entered])


class _Conversation:
    """The row of one conversation, from its pieces and then its texts, each in order."""

    def __init__(self, cn: bool, cv: int):
        self.id, self.state, self.cost = None if cn else cv, START, 0
        self.faults, self.illegal, self.turns = [0, 0, 0], 0, 0
        self.last = self.first_turn = self.last_turn = None
        self.audit: list[str] = []
        self.edits, self.place, self.spoken = None, START, False
        self.sha = hashlib.sha256()

    def piece(self, blank, duplicate, truncated, illegal, first, last, first_turn, last_turn, turns, cost, audits, ends):
        self.cost = self.cost if self.audit else cost
        self.audit.append(audits[self.state])
        self.state = ends[self.state]
        self.faults = [a + b for a, b in zip(self.faults, (blank, duplicate, truncated), strict=True)]
        self.illegal += illegal + (self.last is not None and (self.last, first) not in _LEGAL)
        self.last = last
        if turns:
            self.turns += turns - (self.last_turn == first_turn)
            self.first_turn = first_turn if self.first_turn is None else self.first_turn
            self.last_turn = last_turn

    def _closed(self) -> None:
        if self.edits is None:
            self.all = "".join(self.audit) + (closing(self.state) if self.audit else "")
            self.edits, self.audit = iter(self.all), [""]

    def _say(self, role: str, text: str) -> None:
        if self.spoken:
            self.sha.update(b"\n")
        self.spoken = True
        self.sha.update(role.encode("utf-8", "surrogatepass") + b":")
        self.sha.update(text.encode("utf-8", "surrogatepass"))

    def _inserted(self) -> None:
        self.place = NEXT[self.place]
        self._say(TURN[self.place], "")

    def text(self, role: str, text: str, initial: int, copies: int) -> None:
        self._closed()
        for _ in range(copies):
            while (edit := next(self.edits)) == "I":
                self._inserted()
            if edit == "K":
                self.place = KEPT[initial][self.place]
                self._say(role, text)
            elif edit == "R":
                self.place = NEXT[self.place]
                self._say(TURN[self.place], text)

    def row(self) -> tuple:
        self._closed()
        for _ in self.edits:
            self._inserted()
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        gaps = gaps if gaps < 1 << 63 else None
        return (self.id, gaps, *self.faults, self.illegal, self.cost, self.all, self.sha.hexdigest())


def _result_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of sorted rows (cn, cv, kind, piece, role, text, initial, copies): kind 0 is a
    piece, 1 a text, 2 only names the conversation."""
    at, now = None, None
    for cn, cv, kind, piece, role, text, initial, copies in _rows(batches, 1024):
        if at != (cn, cv):
            if now is not None:
                yield now.row()
            at, now = (cn, cv), _Conversation(cn, cv)
        if kind == 0:
            now.piece(**piece)
        elif kind == 1:
            now.text(role, text, initial, copies)
    if now is not None:
        yield now.row()


_COUNTS = [
    "blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial", "first_turn", "last_turn", "turns",
]


def repair_conversations(
    table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    damage=damaged,
) -> DataFrame:
    """One row per conversation of ``table``: faults, cost, audit and the digest of the
    repaired conversation. ``damage`` maps the keyed rows to those to repair, with the
    column ``copies`` (``None``: repair them as they are)."""
    spark = table.sparkSession
    ship(spark)
    rows = keyed(table, conv, turn, role, text)
    names = rows.select(*_CONV).distinct()
    rows = damage(rows) if damage is not None else rows.withColumn("copies", F.lit(1).cast("long"))

    def mapped(df: DataFrame, f, schema: str) -> DataFrame:
        kind = _arrow(schema)
        return df.mapInArrow(lambda batches: _batches(f(batches), kind), schema)

    dealt = symbols(rows).repartitionByRange(partitions(spark), *_CONV, *_PLACE).sortWithinPartitions(*_CONV, *_PLACE)
    blocks = stored(
        mapped(
            dealt.select(*_CONV, "tn", "tv", "initial", "fault", "n"),
            lambda batches: _block_rows(batches, TaskContext.get().partitionId()),
            _BLOCKS,
        ),
        "blocks",
    )
    # only conversations of several blocks need what follows a block
    long = blocks.groupBy(*_CONV).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*_CONV)
    lines = blocks.select(*_CONV, "part", "seq", "matrix").join(long, _CONV, "left_semi")
    lines = lines.repartition(*_CONV).sortWithinPartitions(*_CONV, F.desc("part"), F.desc("seq"))
    behind = mapped(lines, _behind_rows, "cn boolean, cv long, part int, seq long, behind array<long>")
    full = blocks.join(behind, [*_CONV, "part", "seq"], "left").select(
        *_CONV, "part", "seq", "syms", "lengths", "behind", F.struct(*_COUNTS).alias("counts")
    )
    pieces = mapped(full, _piece_rows, _PIECES)

    none = {n: F.lit(None) for n in ("part", "seq", "piece", "tn", "tv", "role", "digest", "text", "initial", "copies")}
    order = [*_CONV, "kind", "part", "seq", *_PLACE]

    def record(df: DataFrame, kind: int, **own) -> DataFrame:
        return df.select(*_CONV, F.lit(kind).alias("kind"), *[c.alias(n) for n, c in {**none, **own}.items()])

    own_piece = F.struct(
        *[F.col(n).alias(n.replace("_initial", "")) for n in [*_COUNTS, "cost", "audits", "ends"]]
    )
    texts = {n: F.col(n) for n in ("tn", "tv", "role", "text", "copies")}
    stream = (
        record(pieces, 0, part=F.col("part"), seq=F.col("seq"), piece=own_piece)
        .unionByName(record(rows, 1, **texts, digest=F.unhex(F.md5(F.col("text"))), initial=_initial(F.col("role"))))
        .unionByName(record(names, 2))
    )
    sorted_stream = stream.repartition(*_CONV).sortWithinPartitions(*order)
    return mapped(
        sorted_stream.select(*_CONV, "kind", "piece", "role", "text", "initial", "copies"), _result_rows, _RESULT
    )


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """All conversations, damaged as the contract says and repaired."""
    return repair_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))


__all__ = ["repair", "repair_conversations", "damaged", "run_matrix", "power", "advance", "unroll", "op12_conversation_repair"]
