"""Exact n-gram Jaccard self-join with prefix filtering, and its components.

Two documents link when ``den * |A & B| >= num * |A | B|`` over their sets of
distinct word shingles. The join is exact; only how pairs are found is filtered:

1. *Sets.* Each text becomes its set of shingle hashes. Documents with the same
   set are one class, named by a 128-bit hash of the set; classes, not documents,
   are joined, so exact copies cost nothing beyond one row each.
2. *Rare-first prefixes.* All sets are ordered by one global order: shingles not
   known as frequent first (by hash), then the frequent ones by their count. The
   frequent list is every shingle whose repeats within input blocks make up at
   least 1/``FREQUENT`` of all such repeats, hence at most ``FREQUENT`` entries
   at any size; any fixed order gives the same links. A set posts only its
   prefix: two linked sets must share a shingle there.
3. *Candidates.* Postings of a shingle meet in one sorted run, read as a stream.
   Pairs pass a length and a positional filter, and a suffix filter over small
   parity bitmaps of the whole sets, whose Hamming distance never exceeds the
   sets' difference. Each run pairs its first ``LEADERS`` classes with all others,
   which is every pair of a short run. In a share of the longer runs each class
   is also paired with the ``NEAREST`` ones by bitmap, which joins large groups of
   near copies.
4. *Verification.* The distinct pairs' sets are read once more and intersected,
   once per pair.
5. *The rest of long runs.* Components of the links so far settle most of a long
   run. Last, the pairs of its classes that are still in different components are
   filtered as in 3, in blocks, and verified as in 4. Pairs within one component
   cannot change it.

So no link between different sets is lost, no group is expanded into all pairs,
and no run, component or set is gathered on the driver.

Null and empty texts, and texts without words, have the empty set: 0 shingles,
linked with nothing. A text of fewer than ``n`` words has its whole sequence as
one shingle. Null ids take part; ``component_id`` is the smallest non-null id of
the component. Repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import textnum as N
from starloom.llm.components import components
from starloom.llm.scratch import partitions, ship, stored, unused

WORDS = 5
NUM, DEN = 75, 100
#: Bound of the broadcast list of frequent shingles.
FREQUENT = 1 << 18
#: Classes of a run that are paired with all its others.
LEADERS = 2
#: Bits of the filter that drops sets of classes in no pair.
CLASS_BITS = 1 << 22
#: Nearest classes that a class of a long run is paired with, and one of how many
#: long runs takes part.
NEAREST, NEAR_SHARE = 4, 8
#: Tokens of a class by which a pair's first common run is told.
HEADS = 8
#: Classes of a long run that one task compares with as many others.
BLOCK = 2048


def _binary(a: np.ndarray, width: int) -> pa.Array:
    data = np.ascontiguousarray(a).tobytes()
    off = np.arange(0, len(data) + 1, width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(data)])


def _blobs(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def shingle_sets(texts: list[str | None], n: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = N.lowered(texts)
    for lo, hi in N.slices(data):
        h, first = N.words(data[lo:hi], N.SPACED)
        g = N.grams(h, range(n))
        for i in range(hi - lo):
            b, e = first[i], first[i + 1]
            if e - b >= n:
                yield np.unique(g[b : e - n + 1])
            elif e > b:
                yield N.grams(h[b:e], range(e - b))
            else:
                yield np.empty(0, dtype=np.uint64)


def class_name(s: np.ndarray) -> bytes:
    """128-bit hash of a set."""
    a = N.mix(s)
    both = np.array([a.sum(dtype=np.uint64), N.mix(a + N.GRAM[61]).sum(dtype=np.uint64)], dtype=np.uint64)
    return N.mix(both + np.uint64(len(s))).tobytes()


def bitmap(s: np.ndarray) -> bytes:
    """Parities of the set's members over a power of two of at least 2 bits each."""
    bits = 1 << max(6, (2 * len(s) - 1).bit_length())
    place = (N.mix(s + N.GRAM[57]) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(bool)).tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the symmetric difference of two sets, from their bitmaps."""
    a, b = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-n * num // den) + 1


def index_length(n, num: int, den: int):
    """The part of the prefix in which the smaller of two linked sets (of either
    where they are equally large) must meet the other's prefix."""
    return n - -(-2 * n * num // (den + num)) + 1


def least_overlap(total, num: int, den: int):
    """The overlap that sets of ``total`` members together need to link."""
    return -(-total * num // (den + num))


def _scan(docs: DataFrame, n: int) -> DataFrame:
    """First reading: ``kind 0``: (id, size, class, bitmap) of every row; ``kind 1``:
    (shingle, count) of shingles that repeat within a block of rows."""

    def run(batches):
        for b in N.parts(batches, 1):
            ids, names, sizes, maps, seen, hot = b.column(0), [], [], [], set(), []
            for s in shingle_sets(b.column(1).to_pylist(), n):
                name = class_name(s) if len(s) else None
                names.append(name)
                sizes.append(len(s))
                maps.append(bitmap(s) if len(s) else None)
                if name is not None and name not in seen:
                    seen.add(name)
                    hot.append(s)
            k = len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * k, pa.int32()), ids, pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
                 pa.array(maps, pa.binary())],
                names=["kind", "id", "n", "class", "bits"],
            )
            if hot:
                tokens, count = np.unique(np.concatenate(hot), return_counts=True)
                tokens, count = tokens[count > 1], count[count > 1]
                if len(tokens):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.ones(len(tokens), dtype=np.int32)),
                            pa.array(tokens.view(np.int64)),
                            pa.array(count.astype(np.int64)),
                            pa.nulls(len(tokens), pa.binary()),
                            pa.nulls(len(tokens), pa.binary()),
                        ],
                        names=["kind", "id", "n", "class", "bits"],
                    )

    return docs.mapInArrow(run, "kind int, id long, n long, class binary, bits binary")


def _frequent(scan: DataFrame, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``bound`` shingles, sorted, with their counts."""
    counts = scan.where("kind = 1").groupBy(F.col("id").alias("token")).agg(F.sum("n").alias("n"))
    total = scan.where("kind = 1").agg(F.sum("n")).first()[0] or 0
    got = counts.where(F.col("n") * bound >= total).toPandas()
    token = got["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(token)
    return token[order], got["n"].to_numpy(dtype=np.int64)[order]


def _postings(docs: DataFrame, frequent, n: int, num: int, den: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        known, count = shared.value
        for b in N.parts(batches, 1):
            seen, tokens, names, sizes, places = set(), [], [], [], []
            for s in shingle_sets(b.column(1).to_pylist(), n):
                if not len(s) or (name := class_name(s)) in seen:
                    continue
                seen.add(name)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    often = np.where(known[at] == s, count[at], 0)
                    if often.any():
                        s = s[np.argsort(often, kind="stable")]
                p = prefix_length(len(s), num, den)
                tokens.append(s[:p])
                names.append(name)
                sizes.append(len(s))
                places.append(p)
            if not tokens:
                continue
            k = np.array(places)
            place = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tokens).view(np.int64)),
                    _binary(np.repeat(np.frombuffer(b"".join(names), dtype="V16"), k), 16),
                    pa.array((np.repeat(np.array(sizes, dtype=np.int64), k) << 32) | place),
                ],
                names=["token", "class", "at"],
            )

    return docs.mapInArrow(run, "token long, class binary, at long")


def _may_link(nx, i, ny, j, num: int, den: int):
    """Length filter, and positional filter for a shingle at places i and j."""
    small, large = np.minimum(nx, ny), np.maximum(nx, ny)
    place = np.where(nx < ny, i, np.where(nx > ny, j, np.minimum(i, j)))
    most = np.minimum(nx - i, ny - j) + np.minimum(i, j)
    return (
        (small * den >= large * num)
        & (place < index_length(small, num, den))
        & (most >= least_overlap(nx + ny, num, den))
    )


def _runs(postings: DataFrame, leaders: int, num: int, den: int) -> DataFrame:
    """``token`` null: the candidate pair (a, b); else a member of a long run."""

    def run(batches):
        token, size, heads, last, held = None, 0, [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = batch.column(0).to_numpy(zero_copy_only=False)
            # only rows whose run has another row here, before or perhaps after
            same = t[1:] == t[:-1]
            busy = np.append(same, True) | np.insert(same, 0, token is not None and t[0] == token)
            sub = batch.filter(pa.array(busy))
            pairs, members = [], []
            rows = zip(t[busy].tolist(), sub.column(1).to_pylist(), sub.column(2).to_pylist(), strict=True)
            for tok, name, at in rows:
                n, i = at >> 32, at & 0xFFFFFFFF
                if tok != token:
                    token, size, heads, last = tok, 1, [(name, n, i, at)], name
                    continue
                if name == last:  # a class posts once per block that holds a copy
                    continue
                last = name
                pairs += [(other, name) for other, m, j, _ in heads if _pair(m, j, n, i, num, den)]
                size += 1
                if size <= leaders:
                    heads.append((name, n, i, at))
                elif size == leaders + 1:
                    held = (tok, name, at)
                else:
                    if size == leaders + 2:  # now a long run
                        members += [(tok, h[0], h[3]) for h in heads] + [held]
                    members.append((tok, name, at))
            if pairs or members:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None] * len(pairs) + [m[0] for m in members], pa.int64()),
                        pa.array([p[0] for p in pairs] + [m[1] for m in members], pa.binary()),
                        pa.array([p[1] for p in pairs] + [None] * len(members), pa.binary()),
                        pa.array([None] * len(pairs) + [m[2] for m in members], pa.int64()),
                    ],
                    names=["token", "a", "b", "at"],
                )

    dealt = postings.repartition(partitions(postings.sparkSession), "token").sortWithinPartitions("token", "class")
    return dealt.mapInArrow(run, "token long, a binary, b binary, at long")


def _pair(nx: int, i: int, ny: int, j: int, num: int, den: int) -> bool:
    small, large = (nx, ny) if nx <= ny else (ny, nx)
    place = i if nx < ny else j if nx > ny else min(i, j)
    if place >= index_length(small, num, den):
        return False
    return small * den >= large * num and min(nx - i, ny - j) + min(i, j) >= least_overlap(nx + ny, num, den)


def suffix_bound(x: np.ndarray, y: np.ndarray) -> int:
    """An upper bound of the overlap of two sorted sets: split both at the middle
    of x, twice; shares on different sides of a split cannot meet."""
    cut = x[len(x) // 4 :: max(1, len(x) // 4)][:3] if len(x) >= 8 else x[:0]
    px = np.concatenate(([0], np.searchsorted(x, cut), [len(x)]))
    py = np.concatenate(([0], np.searchsorted(y, cut), [len(y)]))
    return int(np.minimum(np.diff(px), np.diff(py)).sum())


def overlap(x: bytes, y: bytes, num: int, den: int) -> int:
    """The overlap of two sets, or -1 if they cannot link."""
    a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
    need = least_overlap(len(a) + len(b), num, den)
    if suffix_bound(a, b) < need:
        return -1
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    got = int((b[at] == a).sum())
    return got if got >= need else -1


def _bitmaps(scan: DataFrame) -> DataFrame:
    return scan.where("kind = 0 and class is not null").select("class", "n", "bits").dropDuplicates(["class"])


def _suffix_filter(scan: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """The distinct pairs whose bitmaps allow a link."""
    maps = _bitmaps(scan)

    def run(batches):
        for b in batches:
            rows = zip(*(b.column(i).to_pylist() for i in range(2, 6)), strict=True)
            keep = [
                m + k - least_difference(x, y) >= 2 * least_overlap(m + k, num, den) for m, x, k, y in rows
            ]
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = maps.select(F.col("class").alias("a"), F.col("n").alias("m"), F.col("bits").alias("x"))
    right = maps.select(F.col("class").alias("b"), F.col("n").alias("k"), F.col("bits").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "m", "x", "k", "y")
    return both.mapInArrow(run, "a binary, b binary")


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``c, s``: the sets of the wanted classes, read from the texts. A bitmap of
    fixed size drops most others before they are shuffled."""
    bucket = F.pmod(F.xxhash64("c"), F.lit(CLASS_BITS)).cast("int")
    got = wanted.select(bucket.alias("k")).distinct().toPandas()["k"].to_numpy()
    mask = np.zeros(CLASS_BITS, dtype=bool)
    mask[got] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(mask))

    def run(batches):
        bits = np.unpackbits(shared.value).view(bool)
        for b in N.parts(batches, 1):
            seen, sets = set(), []
            for s in shingle_sets(b.column(1).to_pylist(), n):
                if len(s) and (name := class_name(s)) not in seen:
                    seen.add(name)
                    if bits[xxhash.xxh64_intdigest(name, seed=42) % CLASS_BITS]:
                        sets.append((name, s.tobytes()))
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*sets, strict=True)], names=["c", "s"])

    sets = docs.mapInArrow(run, "c binary, s binary").dropDuplicates(["c"])
    return sets.join(wanted, "c", "left_semi")


def _verified(docs: DataFrame, pairs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The linked ones of the distinct candidate pairs, with their overlap."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct(), "wanted")
    sets = stored(_sets(docs, wanted, n), "sets")

    def check(batches):
        for b in batches:
            x, y = b.column(2).to_pylist(), b.column(3).to_pylist()
            got = np.array([overlap(p, q, num, den) for p, q in zip(x, y, strict=True)], dtype=np.int64)
            keep = np.flatnonzero(got >= 0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep)), b.column(1).take(pa.array(keep)), pa.array(got[keep])],
                names=["a", "b", "overlap"],
            )

    left = sets.select(F.col("c").alias("a"), F.col("s").alias("x"))
    right = sets.select(F.col("c").alias("b"), F.col("s").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(
        check, "a binary, b binary, overlap long"
    )


def _ordered(a: str, b: str):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


class _Bitmaps:
    """Bitmaps of one group, by length, for many comparisons at once."""

    def __init__(self, bits: list[bytes]):
        self.length = np.array([len(x) for x in bits])
        self.rows, self.place = {}, np.zeros(len(bits), dtype=np.int64)
        for n in np.unique(self.length).tolist():
            at = np.flatnonzero(self.length == n)
            self.place[at] = np.arange(len(at))
            self.rows[n] = np.frombuffer(b"".join(bits[i] for i in at), dtype=np.uint8).reshape(len(at), n)

    def differences(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """``least_difference`` of each pair."""
        out = np.zeros(len(i), dtype=np.int64)
        for n, left in self.rows.items():
            for m, right in self.rows.items():
                both = np.flatnonzero((self.length[i] == n) & (self.length[j] == m))
                for lo in range(0, len(both), 4096):
                    at = both[lo : lo + 4096]
                    x, y = left[self.place[i[at]]], right[self.place[j[at]]]
                    while x.shape[1] > y.shape[1]:
                        x = x[:, : x.shape[1] // 2] ^ x[:, x.shape[1] // 2 :]
                    while y.shape[1] > x.shape[1]:
                        y = y[:, : y.shape[1] // 2] ^ y[:, y.shape[1] // 2 :]
                    out[at] = np.bitwise_count(x ^ y).sum(axis=1)
        return out


def _here_first(mine: np.ndarray, others: np.ndarray, token: int) -> np.ndarray:
    """Which pairs of head lists do not surely meet in the run of an earlier token:
    where two lists, in one order, have tokens in common, the first of these is the
    run in which their pair is looked at; else any run may be."""
    common = ((mine[:, :, None] == others[:, None, :]) & (mine[:, :, None] != -1)).any(axis=2)
    first = mine[np.arange(len(mine)), common.argmax(axis=1)]
    return ~common.any(axis=1) | (first == token)


def _group_pairs(token, left, right, size, place, root, heads, maps, num, den, nearest):
    """Pairs (i, j), i from ``left`` and j from ``right`` (the same rows or others),
    that pass the filters; with ``nearest`` only so many for a row."""
    a, b, d = [], [], []
    rows = max(1, 100_000 // max(1, len(right)))
    for lo in range(0, len(left), rows):
        i, j = left[lo : lo + rows, None], right[None, :]
        may = (root[i] != root[j]) & ((i < j) | (left is not right))
        may &= (size[i] * den >= size[j] * num) & (size[j] * den >= size[i] * num)
        p, q = np.nonzero(may)
        i, j = left[lo + p], right[q]
        ok = _may_link(size[i], place[i], size[j], place[j], num, den)
        i, j = i[ok], j[ok]
        ok = _here_first(heads[i], heads[j], token)
        i, j = i[ok], j[ok]
        total, apart = size[i] + size[j], maps.differences(i, j)
        ok = total - apart >= 2 * least_overlap(total, num, den)
        a.append(i[ok])
        b.append(j[ok])
        d.append(apart[ok])
    i, j, apart = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (a, b, d))
    if nearest and len(i):
        # both ways, as each row has its own nearest ones
        one, other, far = np.concatenate((i, j)), np.concatenate((j, i)), np.concatenate((apart, apart))
        order = np.lexsort((far, one))
        one, other = one[order], other[order]
        rank = np.arange(len(one)) - np.searchsorted(one, one)
        return one[rank < nearest], other[rank < nearest]
    return i, j


def _within(scan: DataFrame, members: DataFrame, roots: DataFrame | None, num: int, den: int, nearest: int) -> DataFrame:
    """Pairs of a long run's classes that pass the length, positional and suffix
    filters; with ``roots`` only those in different components, with ``nearest``
    only so many for a class."""
    known = members.select("token", F.col("a").alias("c"), "at", F.col("a").alias("root"))
    if roots is not None:
        known = known.drop("root").join(roots.select(F.col("node").alias("c"), "root"), "c", "left").select(
            "token", "c", "at", F.coalesce("root", "c").alias("root")
        )
    spans = known.groupBy("token").agg(
        F.count(F.lit(1)).alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi")
    ).where("lo <> hi")
    sides = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    rest = known.join(spans, "token").withColumn("sides", sides).withColumn(
        "side", F.pmod(F.hash("c"), F.col("sides"))
    )
    rest = stored(rest, "shingle-rest")
    # the first tokens of each class's own runs of these, in the global order
    place = F.col("at").bitwiseAND(0xFFFFFFFF)
    heads = rest.select("c", F.struct(place.alias("i"), "token").alias("h")).groupBy("c").agg(
        F.slice(F.transform(F.sort_array(F.collect_list("h")), lambda h: h["token"]), 1, HEADS).alias("heads")
    )
    rest = rest.join(_bitmaps(scan).select(F.col("class").alias("c"), "bits"), "c").join(heads, "c")
    # every pair of sides (p <= q) is one group; a class goes to the groups of its side
    dealt = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1))).select(
        "token", F.least("side", "other").alias("p"), F.greatest("side", "other").alias("q"),
        "side", "c", "at", "root", "bits", "heads",
    )

    def run(key, table):
        side = table.column("side").to_numpy()
        at = table.column("at").to_numpy()
        root = np.unique(np.array(table.column("root").to_pylist(), dtype=object), return_inverse=True)[1]
        name = np.array(table.column("c").to_pylist(), dtype=object)
        heads = np.full((len(name), HEADS), -1, dtype=np.int64)
        for i, h in enumerate(table.column("heads").to_pylist()):
            heads[i, : len(h)] = h
        token, p, q = (k.as_py() for k in key)
        left = np.flatnonzero(side == p)
        right = left if p == q else np.flatnonzero(side == q)
        i, j = _group_pairs(
            token, left, right, at >> 32, at & 0xFFFFFFFF, root, heads, _Bitmaps(table.column("bits").to_pylist()),
            num, den, nearest,
        )
        return pa.table({"a": pa.array(name[i], pa.binary()), "b": pa.array(name[j], pa.binary())})

    return dealt.groupBy("token", "p", "q").applyInArrow(run, "a binary, b binary").select(*_ordered("a", "b")).distinct()


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = WORDS,
                  num: int = NUM, den: int = DEN, leaders: int = LEADERS) -> tuple[DataFrame, DataFrame]:
    """``(rows, links)``. rows: ``id, n, class`` of every document (class null for
    the empty set). links: ``a, b, overlap`` between classes; together with equal
    classes they connect exactly the documents that Jaccard links connect."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    scan = stored(_scan(texts, n), "shingle-scan")
    postings = _postings(texts, _frequent(scan, FREQUENT), n, num, den)
    runs = stored(_runs(postings, leaders, num, den), "shingle-runs")
    del postings
    members = runs.where("token is not null").select("token", "a", "at")
    some = members.where(F.pmod("token", F.lit(NEAR_SHARE)) == 0)
    found = runs.where("token is null").select(*_ordered("a", "b")).distinct()
    pairs = _suffix_filter(scan, found, num, den).unionByName(_within(scan, some, None, num, den, NEAREST))
    pairs = stored(pairs.distinct(), "pairs")
    links = stored(_verified(texts, pairs, n, num, den), "links")
    if not members.isEmpty():
        rest = _within(scan, members, components(links, "a", "b"), num, den, 0)
        rest = stored(rest.join(pairs, ["a", "b"], "left_anti"), "pairs")
        if not rest.isEmpty():
            links = links.unionByName(stored(_verified(texts, rest, n, num, den), "links"))
    return scan.where("kind = 0").drop("kind", "bits"), links


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = WORDS,
                       num: int = NUM, den: int = DEN, leaders: int = LEADERS) -> DataFrame:
    """``doc_id, n_shingles, component_id, class`` of every document."""
    rows, links = jaccard_links(docs, id_col, text, n, num, den, leaders)
    roots = components(links, "a", "b").select(F.col("node").alias("class"), "root")
    least = rows.where("class is not null").groupBy("class").agg(F.min("id").alias("least"))
    named = least.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    top = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = named.join(top, "root").select("class", "component_id")
    return rows.join(of_class, "class", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        "class",
    )


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Component of every document under 5-word Jaccard links of 0.75 or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_components(docs).drop("class")


def stage_jaccard(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component one row with the smallest id stays, and one
    of its rows without an id if it has any; of ids with several texts the text of the
    smallest hash, of repeated rows the smallest row (by its JSON text where a column is
    a map, which has no order). Rows without words are in no component and stay. A row is
    known by its id and text."""
    (name,) = unused(docs.columns, "_row")
    row = F.xxhash64("doc_id", "text")
    rows, links = jaccard_links(docs.select(row.alias("doc_id"), "text"))
    known = docs.groupBy(row.alias("row")).agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
    known = known.join(rows.where("class is not null").select(F.col("id").alias("row"), "class").distinct(), "row")
    known = stored(known, "rows")
    # copies collapse to their class before components form
    least = known.groupBy("class").agg(
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "row"))).alias("named"),
        F.min(F.when(F.col("id").isNull(), F.col("row"))).alias("bare"),
    )
    roots = components(links, "a", "b").select(F.col("node").alias("class"), "root")
    stay = least.join(roots, "class", "left").groupBy(F.coalesce("root", "class").alias("root")).agg(
        F.min("named")["row"].alias("named"), F.min("bare").alias("bare")
    )
    stay = stored(stay.select(F.explode(F.array("named", "bare")).alias("row")).where("row is not null"), "rows")
    copies = known.join(stay, "row", "left_anti").select(F.col("row").alias(name))
    again = stored(known.where("n > 1").join(stay, "row", "left_semi").select(F.col("row").alias(name)), "rows")
    if again.isEmpty():
        return docs.join(copies, row == F.col(name), "left_anti")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = F.min_by(whole, F.to_json(whole)) if "map<" in docs.schema.simpleString() else F.min(whole)
    once = docs.join(again, row == F.col(name), "left_semi").groupBy(row.alias(name)).agg(first.alias("least"))
    single = docs.join(copies.unionByName(again), row == F.col(name), "left_anti")
    return single.unionByName(once.select("least.*"))


__all__ = ["jaccard_links", "jaccard_components", "op9_jaccard_join", "stage_jaccard"]
