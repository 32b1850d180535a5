"""SentencePiece encoding and decoding over a relational lattice.

*Units.* A text gets a leading blank and is cut into units: a run of blanks with
the letters, or the other characters, that follow it. No piece of the model
reaches across such a border (checked when the model is read), so the best path
through a text is the best paths through its units, one after the other. A unit
is as long as its run.

*Lattice.* Over the distinct units of the corpus only: explode every substring
of at most the longest piece's length, equi-join to the piece table, group the
edges by unit, and fold Viterbi over them, ordered by their end, for the units of an
Arrow batch together. An edge is one number with room for units of up to ``UNIT``
characters; the few longer ones take the same Viterbi in their task. Scores are the model's; a character that is no piece becomes its
UTF-8 bytes' pieces at ``UNKNOWN_PENALTY`` below the lowest score (or the unknown
piece where the model has no byte pieces). Ties go to the longer last piece.

*Documents.* The most frequent units, at most ``FREQUENT`` of them at any size, are
sent to the tasks, which encode them in place. The rare rest meet the unit table in a join, and each document then gets
its own few back. So neither a frequent unit nor the corpus's vocabulary is ever
in one task.

A BPE model's scores are merge ranks. Viterbi maximises their sum, which is not
the library's greedy merge order: ids can differ from the library's; decoding
gives back the exact text for any model with byte pieces.

Null texts give null ids; empty texts no ids. Repeated rows give repeated rows.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.scratch import least_frequent, partitions, ship, stored
from starloom.llm.textnum import hashes, parts

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
UNIT = 63
UNKNOWN_PENALTY = 10.0
#: Bound of the units sent to the tasks.
FREQUENT = 1 << 19
BATCH = 1 << 20
#: Units whose lattices are folded together.
FOLD = 4096
#: Bytes of text whose units are counted together before they leave a task, and bytes of
#: text or codes that become ids together.
COUNT_BYTES = 4 << 20
PART = 2 << 20


# Bits of an edge's cost, piece id, start and end, from the lowest.
_COST, _ID, _PLACE = 26, 18, 6


@dataclass(frozen=True)
class Pieces:
    """The piece table: ``text`` with blanks for the model's space marks."""

    text: list[str]
    score: list[float]
    normal: list[bool]
    byte: list[int]  # id of each byte's piece, empty if the model has none
    unknown: int

    @property
    def longest(self) -> int:
        return max(len(t) for t, n in zip(self.text, self.normal, strict=True) if n)

    def costs(self) -> list[int]:
        """Each piece's negative score, and last an unknown character's, as whole
        numbers: exact where the scores are whole, else to six places, and cut at the
        largest that an edge holds."""
        known = [-s for s, n in zip(self.score, self.normal, strict=True) if n]
        if min(known) < 0:
            raise ValueError("a piece's score is above 0")
        scale = 1 if all(float(x).is_integer() for x in known) else 1_000_000
        # a score beyond any sum of others within a unit only says: last of all
        most = (1 << _COST) - 1 - round(UNKNOWN_PENALTY * scale)
        out = [min(most, round(-s * scale)) if n else 0 for s, n in zip(self.score, self.normal, strict=True)]
        out.append(max(out) + round(UNKNOWN_PENALTY * scale))
        if len(out) > 1 << _ID:
            raise ValueError("the model has too many pieces")
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(t, i, c) for i, (t, c, n) in enumerate(zip(self.text, self.costs()[:-1], self.normal, strict=True)) if n]
        return spark.createDataFrame(rows, "piece string, id int, cost long")


def read_model(path: str = MODEL_PATH) -> Pieces:
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    text = [m.id_to_piece(i).replace("▁", " ") for i in range(n)]
    normal = [not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i)) for i in range(n)]
    byte = {t: i for i, t in enumerate(text) if m.is_byte(i)}
    order = [byte.get(f"<0x{b:02X}>") for b in range(256)]
    for t, ok in zip(text, normal, strict=True):
        if ok and len(units(t)) != 1:
            raise ValueError(f"a piece reaches across units: {t!r}")
    return Pieces(text, [m.get_score(i) for i in range(n)], normal, [] if None in order else order, m.unk_id())


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """0 blank, 1 letter or mark, 2 other, by code point."""
    kind = np.fromiter(
        (1 if chr(i).isalpha() or unicodedata.category(chr(i))[0] == "M" else 2 for i in range(0x110000)),
        dtype=np.uint8, count=0x110000,
    )
    kind[0x20] = 0
    return kind


def _cut(texts: list[str]):
    """``(name, first, data, begin, end)``: a 64-bit hash of every unit, the first
    unit of each text (with the number of units as a last entry), and where the
    units stand in ``data``, the texts' UTF-8 in a row."""
    joined = "".join(texts)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    data = joined.encode("utf-8", "surrogatepass") + b" " * 8
    where = np.cumsum([0, *map(len, texts)], dtype=np.int64)
    if not len(code):
        nothing = np.empty(0, dtype=np.int64)
        return nothing.astype(np.uint64), where, data, nothing, nothing
    kind = _kinds()[code]
    edge = np.zeros(len(code) + 1, dtype=bool)
    edge[1:-1] = (kind[1:] != kind[:-1]) & (kind[:-1] != 0)
    edge[where] = True
    edge[-1] = False
    start = np.flatnonzero(edge)
    first = np.searchsorted(start, where)
    raw = np.frombuffer(data, dtype=np.uint8)[:-8]
    # the byte at which each code point begins
    begin = start if len(raw) == len(code) else np.flatnonzero((raw & 0xC0) != 0x80)[start]
    end = np.append(begin[1:], len(raw))
    return hashes(data, begin, end), first, data, begin, end


def units(text: str) -> list[str]:
    """The units of one text that has its leading blank."""
    if not text:
        return []
    _, _, data, begin, end = _cut([text])
    return [_text(data[a:b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


def _text(raw: bytes) -> str:
    return raw.decode("utf-8", "surrogatepass")


def _groups(texts: list[str | None]):
    """The texts with their leading blank, in bounded groups: (first index, texts)."""
    lo, held, total = 0, [], 0
    for i, t in enumerate(texts):
        t = " " + t if t else ""
        if held and total + len(t) > BATCH:
            yield lo, held
            lo, held, total = i, [], 0
        held.append(t)
        total += len(t)
    if held:
        yield lo, held


def count_units(texts: DataFrame) -> DataFrame:
    """``unit, n`` over a one-column frame of texts."""
    ship(texts.sparkSession)

    def run(batches):
        for b in parts(batches, 0, COUNT_BYTES):
            names, counts, spelled = [], [], []
            for _, held in _groups(b.column(0).to_pylist()):
                name, _, data, begin, end = _cut(held)
                name, first, n = np.unique(name, return_index=True, return_counts=True)
                names.append(name)
                counts.append(n)
                spelled += [data[x:y] for x, y in zip(begin[first].tolist(), end[first].tolist(), strict=True)]
            if not spelled:
                continue
            every, first, back = np.unique(np.concatenate(names), return_index=True, return_inverse=True)
            total = np.bincount(back, weights=np.concatenate(counts)).astype(np.int64)
            column = pa.array([spelled[i] for i in first.tolist()], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([column, pa.array(total)], names=["unit", "n"])

    return texts.mapInArrow(run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def long_path(unit: str, known: dict[str, tuple[int, int]], longest: int, unknown: int) -> list[tuple[int, int]]:
    """``(piece, start)`` along the best path through a unit of any length, with -1
    for a character that is no piece; ties as in the fold."""
    cost, back = [0], [(0, 0)]
    for end in range(1, len(unit) + 1):
        least = None
        for start in range(max(0, end - longest), end):
            piece, c = known.get(unit[start:end], (-1, unknown))
            if (piece >= 0 or start == end - 1) and (least is None or cost[start] + c < least):
                least, edge = cost[start] + c, (piece, start)
        cost.append(least)
        back.append(edge)
    path, at = [], len(unit)
    while at:
        path.append(back[at])
        at = back[at][1]
    return path[::-1]


def _id_lists(n: np.ndarray, ids: np.ndarray, packed: bool) -> pa.Array:
    """Lists of ids one after the other, as arrays or, ``packed``, as their bytes."""
    first = np.append(0, np.cumsum(n)).astype(np.int32)
    if packed:
        return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(first * 4), pa.py_buffer(ids.astype("<i4").tobytes())])
    return pa.ListArray.from_arrays(pa.array(first), pa.array(ids.astype(np.int32)))


def _unknown(pieces: Pieces, character: str) -> list[int]:
    return [pieces.byte[x] for x in character.encode()] if pieces.byte else [pieces.unknown]


def _id_type(packed: bool) -> str:
    return f"unit string, ids {'binary' if packed else 'array<int>'}"


def _long_units(distinct: DataFrame, pieces: Pieces, packed: bool) -> DataFrame:
    ship(distinct.sparkSession)
    costs = pieces.costs()
    longest = pieces.longest

    def run(batches):
        known = {t: (i, c) for i, (t, c, n) in enumerate(zip(pieces.text, costs[:-1], pieces.normal, strict=True)) if n}
        for b in batches:
            out, size = [], []
            for unit in b.column(0).to_pylist():
                done = len(out)
                for piece, start in long_path(unit, known, longest, costs[-1]):
                    out += [piece] if piece >= 0 else _unknown(pieces, unit[start])
                size.append(len(out) - done)
            ids = _id_lists(np.array(size, dtype=np.int64), np.array(out, dtype=np.int64), packed)
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=["unit", "ids"])

    return distinct.mapInArrow(run, _id_type(packed))


def _best_paths(edge: np.ndarray, owner: np.ndarray, units: int):
    """``(n, edges)``: the number of edges of each unit's best path, and these edges. Of
    equal ones the edge that is least as a number is taken. ``owner`` tells an
    edge's unit; every place of a unit ends an edge."""
    end = edge >> (_COST + _ID + _PLACE)
    order = np.lexsort((edge, owner, end))
    edge, owner = edge[order], owner[order]
    cut = np.append(0, np.cumsum(np.bincount(end)))
    last = len(cut) - 2
    cost, back = np.zeros((last + 1, units), dtype=np.int64), np.zeros((last + 1, units), dtype=np.int64)
    length = np.zeros(units, dtype=np.int64)
    for place in range(1, last + 1):
        e, u = edge[cut[place] : cut[place + 1]], owner[cut[place] : cut[place + 1]]
        value = cost[(e >> (_COST + _ID)) & ((1 << _PLACE) - 1), u] + (e & ((1 << _COST) - 1))
        first = np.flatnonzero(np.diff(u, prepend=-1))
        least = np.minimum.reduceat(value, first)
        hit = np.flatnonzero(value == np.repeat(least, np.diff(np.append(first, len(u)))))
        hit = hit[np.flatnonzero(np.diff(u[hit], prepend=-1))]
        cost[place, u[hit]], back[place, u[hit]], length[u[hit]] = value[hit], e[hit], place
    # back from the last place to the first
    steps, at, n = [], length, np.zeros(units, dtype=np.int64)
    which = np.flatnonzero(at)
    while len(which):
        e = back[at[which], which]
        steps.append((which, e))
        n[which] += 1
        at[which] = (e >> (_COST + _ID)) & ((1 << _PLACE) - 1)
        which = which[at[which] > 0]
    out = np.empty(int(n.sum()), dtype=np.int64)
    place = np.cumsum(n) - 1
    for i, (which, e) in enumerate(steps):
        out[place[which] - i] = e
    return n, out


def encode_units(distinct: DataFrame, pieces: Pieces, packed: bool = False) -> DataFrame:
    """``distinct`` (one row per ``unit``) with its ``ids``: the lattice and its fold,
    and for units beyond an edge's room the same path without it. ``packed`` gives
    the ids' bytes, four each, lowest first."""
    over = F.length("unit") > UNIT
    short, long = _short_units(distinct.where(~over), pieces, packed), distinct.where(over)
    # most corpora have none: no task then holds the piece table for them
    return short if long.isEmpty() else short.unionByName(_long_units(long, pieces, packed))


def _short_units(distinct: DataFrame, pieces: Pieces, packed: bool) -> DataFrame:
    spark = distinct.sparkSession
    ship(spark)
    # one task's units stay together through the join, so grouping them is no shuffle
    words = distinct.repartition(partitions(spark), "unit")
    spans = words.select("unit", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("s")).select(
        "unit", "s",
        F.explode(F.sequence(F.lit(1), F.least(F.lit(pieces.longest), F.length("unit") - F.col("s")))).alias("k"),
    )
    spans = spans.withColumn("piece", F.expr("substring(unit, s + 1, k)"))
    # the piece table is the model's, whatever the corpus
    found = spans.join(F.broadcast(pieces.table(spark)), "piece", "left").where("id is not null or k = 1")
    # an edge as one number: end, start, piece (the table's size for a character
    # that is no piece) and cost, so that edges sort by their end
    size, cost = len(pieces.text), pieces.costs()[-1]
    edge = F.expr(
        f"shiftleft(cast(s + k as long), {_COST + _ID + _PLACE}) + shiftleft(cast(s as long), {_COST + _ID})"
        f" + shiftleft(cast(coalesce(id, {size}) as long), {_COST}) + coalesce(cost, {cost})"
    )
    lattice = found.groupBy("unit").agg(F.collect_list(edge).alias("edges"))

    def fold(batches):
        for b in (whole.slice(lo, FOLD) for whole in batches for lo in range(0, whole.num_rows, FOLD)):
            edges = b.column(1)
            owner = np.repeat(np.arange(b.num_rows), pc.list_value_length(edges).to_numpy())
            n, path = _best_paths(edges.flatten().to_numpy(), owner, b.num_rows)
            ids = (path >> _COST) & ((1 << _ID) - 1)
            strange = np.flatnonzero(ids == size)
            if len(strange):
                # a character that is no piece becomes its bytes' pieces
                unit = np.repeat(np.arange(b.num_rows), n)
                start = (path >> (_COST + _ID)) & ((1 << _PLACE) - 1)
                own = [_unknown(pieces, b.column(0)[unit[i]].as_py()[start[i]]) for i in strange]
                more = np.ones(len(ids), dtype=np.int64)
                more[strange] = [len(x) for x in own]
                n = np.bincount(unit, weights=more, minlength=b.num_rows).astype(np.int64)
                ids = np.repeat(ids, more)
                ids[ids == size] = [x for o in own for x in o]
            yield pa.RecordBatch.from_arrays([b.column(0), _id_lists(n, ids, packed)], names=["unit", "ids"])

    return lattice.mapInArrow(fold, _id_type(packed))


class Decoder:
    """The texts of id sequences, without their leading blank."""

    def __init__(self, pieces: Pieces):
        self.parts = [t.encode("utf-8", "surrogatepass") for t in pieces.text]
        for b, i in enumerate(pieces.byte):
            self.parts[i] = bytes([b])

    def raw(self, ids: list[int]) -> bytes:
        return b"".join(map(self.parts.__getitem__, ids)).removeprefix(b" ")

    def text(self, ids: list[int]) -> str:
        return self.raw(ids).decode("utf-8", "replace")


class _Codes:
    """The frequent units by hash, and the ids of each."""

    def __init__(self, best: pa.Table):
        """Of ``unit, ids`` rows (packed ids), the most frequent first; no row becomes an object."""
        unit, ids = (best.column(c).combine_chunks() for c in ("unit", "ids"))
        if not len(unit):
            self.name, self.rank = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int32)
            self.first, self.ids = np.zeros(1, dtype=np.int64), np.empty(0, dtype=np.int32)
            return
        end = np.cumsum(pc.binary_length(unit).to_numpy().astype(np.int64))
        raw = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(unit)], pa.int32()), unit.cast(pa.binary())), b"")
        name = hashes(raw[0].as_py() + b" " * 8, np.append(0, end[:-1]), end)
        order = np.argsort(name)
        self.name, self.rank = name[order], order.astype(np.int32)
        self.first = np.append(0, np.cumsum(pc.binary_length(ids).to_numpy().astype(np.int64) // 4))
        raw = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), b"")
        self.ids = np.frombuffer(raw[0].as_py(), dtype="<i4")

    def __len__(self) -> int:
        return len(self.name)

    def look_up(self, name: np.ndarray) -> np.ndarray:
        """The rank of each unit, or the number of ranks where it is not frequent."""
        if not len(self):
            return np.zeros(len(name), dtype=np.int32)
        at = np.minimum(np.searchsorted(self.name, name), len(self) - 1)
        return np.where(self.name[at] == name, self.rank[at], len(self)).astype(np.int32)


def _pack(codes: np.ndarray) -> bytes:
    """Byte planes, compressed: frequent units have small codes and empty high planes."""
    return zstandard.compress(np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def _filled(c: np.ndarray, codes: _Codes, tail: list[np.ndarray]) -> np.ndarray:
    """The ids of a text's codes, with those of its rare units in their places."""
    hole = np.flatnonzero(c == len(codes))
    first = codes.first if len(codes) else np.zeros(2, dtype=np.int64)
    c[hole] = 0
    n = first[c + 1] - first[c]
    n[hole] = [len(t) for t in tail]
    at = np.cumsum(n) - n
    out = np.empty(int(n.sum()), dtype=np.int32)
    own = np.zeros(len(c), dtype=bool)
    own[hole] = True
    rare = np.repeat(own, n)
    index = np.arange(len(out)) - np.repeat(at, n) + np.repeat(first[c], n)
    out[~rare] = codes.ids[index[~rare]]
    out[rare] = np.concatenate(tail) if tail else ()
    return out


def _unfolded(b: pa.RecordBatch, codes: _Codes, ids: str, decoder: Decoder, check: str | None) -> pa.RecordBatch:
    """``key, h`` and the ids of rows of ``key, h, codes, own``."""
    out, offset, absent, same = [np.empty(0, dtype=np.int32)], [0], [], []
    for h, blob, own in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
        absent.append(blob is None)
        if blob is not None:
            tail = [np.frombuffer(o["ids"], dtype="<i4") for o in sorted(own or (), key=lambda o: o["no"])]
            out.append(_filled(_unpack(blob), codes, tail))
        if check:
            # the hash that Spark gave the text
            same.append(None if blob is None else xxhash.xxh64_intdigest(decoder.raw(out[-1].tolist()), seed=42) == h % (1 << 64))
        offset.append(offset[-1] + (0 if blob is None else len(out[-1])))
    lists = pa.ListArray.from_arrays(
        pa.array(offset, pa.int32()), pa.array(np.concatenate(out), pa.int32()), mask=pa.array(absent, pa.bool_())
    )
    checked = [(check, pa.array(same, pa.bool_()))] if check else []
    columns = [("key", b.column(0)), ("h", b.column(1)), (ids, lists), *checked]
    return pa.RecordBatch.from_arrays([c for _, c in columns], names=[n for n, _ in columns])


def encode(docs: DataFrame, key: str, text: str, pieces: Pieces, ids: str = "ids", frequent: int = FREQUENT,
           check: str | None = None) -> DataFrame:
    """``key``, ``h`` (xxhash64 of the text) and ``ids`` of every row; in a column
    named by ``check`` also whether the ids, decoded where they are made, have the
    text's hash."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    counted = stored(count_units(rows.select("text")), "units")
    table = stored(encode_units(counted.select("unit"), pieces, packed=True), "unit-ids")
    # what is sent to the tasks is bounded in its units' length too
    brief = counted.where(F.length("unit") <= UNIT)
    often = brief.where(F.col("n") >= least_frequent(brief, "n", frequent))
    best = often.join(table, "unit").select("unit", "n", "ids").toArrow().sort_by([("n", "descending"), ("unit", "ascending")])
    shared = spark.sparkContext.broadcast(_Codes(best))
    del best

    def coder(only_rare: bool):
        return lambda batches: run(batches, only_rare)

    def run(batches, only_rare):
        codes = shared.value
        for b in parts(batches, 2, PART):
            texts, blobs, tails = b.column(2).to_pylist(), [], []
            for lo, held in _groups(texts):
                name, first, data, begin, end = _cut(held)
                got = codes.look_up(name)
                rare = np.flatnonzero(got == len(codes))
                at = np.searchsorted(rare, first)
                spelled = [data[x:y] for x, y in zip(begin[rare].tolist(), end[rare].tolist(), strict=True)]
                for i in range(len(held)):
                    blobs.append(None if only_rare or texts[lo + i] is None else _pack(got[first[i] : first[i + 1]]))
                    tails.append(spelled[at[i] : at[i + 1]])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(blobs, pa.binary()), pa.array(tails, pa.list_(pa.binary())).cast(pa.list_(pa.string()))],
                names=["key", "h", "codes", "rare"],
            )

    kind = rows.schema["key"].dataType
    schema = T.StructType([
        T.StructField("key", kind), T.StructField("h", T.LongType()),
        T.StructField("codes", T.BinaryType()), T.StructField("rare", T.ArrayType(T.StringType())),
    ])
    coded = rows.mapInArrow(coder(False), schema)
    rare = rows.mapInArrow(coder(True), schema).select("key", "h", F.posexplode("rare").alias("no", "unit"))
    # a document's own rare units, by their place among them: bounded by its text; a
    # set, as repeated rows bring theirs again
    own = rare.join(table, "unit").groupBy(F.col("key").alias("k2"), F.col("h").alias("h2")).agg(
        F.collect_set(F.struct("no", "ids")).alias("own")
    )
    both = coded.join(own, F.col("key").eqNullSafe(F.col("k2")) & (F.col("h") == F.col("h2")), "left").select(
        "key", "h", "codes", "own"
    )

    def fill(batches):
        codes = shared.value
        # a few documents at a time: what they unfold to is many times their codes
        for b in parts(batches, 2, PART // 16):
            yield _unfolded(b, codes, ids, decoder, check)

    schema = T.StructType([*schema.fields[:2], T.StructField(ids, T.ArrayType(T.IntegerType()))])
    if check:
        schema = schema.add(check, T.BooleanType())
    decoder = Decoder(pieces)
    return both.mapInArrow(fill, schema).withColumnRenamed("key", key)


def decode(frame: DataFrame, ids: str, pieces: Pieces, text: str = "text") -> DataFrame:
    """``frame`` with the text of its ``ids`` in a new column; null ids give null."""
    if text in frame.columns:
        raise ValueError(f"column exists already: {text}")
    ship(frame.sparkSession)
    at = frame.columns.index(ids)
    names = [*frame.columns, text]
    decoder = Decoder(pieces)

    def run(batches):
        for b in (whole.slice(lo, 512) for whole in batches for lo in range(0, whole.num_rows, 512)):
            column = b.column(at)
            out = [decoder.text(r.values.to_numpy(zero_copy_only=False).tolist()) if r.is_valid else None for r in column]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=names)

    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, T.StructField(text, T.StringType())]))


def _encoded(docs: DataFrame, model: str) -> DataFrame:
    done = encode(docs, "doc_id", "text", read_model(model), check="round_trip")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")


def op7_sentencepiece(spark, sf_dir: str, model: str = MODEL_PATH) -> DataFrame:
    """Ids of every whole document, and whether they decode to its exact text."""
    return _encoded(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), model)


def stage_sentencepiece(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the ids of each document kept."""
    return _encoded(docs, MODEL_PATH)


__all__ = ["Pieces", "read_model", "units", "count_units", "encode_units", "encode", "decode", "Decoder",
           "op7_sentencepiece", "stage_sentencepiece"]
