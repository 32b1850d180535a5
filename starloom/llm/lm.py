"""Language-model scoring with causal self-attention, trained in numpy.

*Tokens.* A text's words (A-Z lower-cased), each as the subword ids of a blank and
the word under a public byte-level vocabulary, then one end. The vocabulary is
only read, never trained.

*Counts.* Words, and through them subwords, are counted over all training texts.
The most frequent subwords are classes of their own; the others share classes of
about equal mass, and a tree of at most ``BRANCH`` children a node tells the members of a
class apart. A subword's probability is that of its class given the context, times that
of each step down the tree given the same context. The model tells all of them, over
the whole vocabulary.

*Coding.* Every text is cut and coded once, and stored as one byte a class and the number
of the member; training and scoring read these.

*Model.* One causal attention layer with a residual. A subword enters it by its class's
embedding and, in a shared class, its own beside it. What the layer gives is multiplied with
a vector of each class, and of each child of a node on the way to a member, on top
of the log frequencies of class bigrams in all training texts and of the children's
smoothed shares of their node. The layer and all vectors learn from
every training text in consecutive windows, so each subword and end is a target.
Windows are dealt to ``ROUNDS`` rounds and in each into shards of about ``SHARD``
windows; every shard trains a copy of the model, and the copies' average starts the
next round. Weights, not windows, come together, and those in a distributed average; that of
a member's or a node's vector is over the shards that met it, by how often they did.

*Scoring.* Windows of ``WINDOW`` tokens overlap by ``WINDOW - STRIDE``: each token
is scored once, all but a text's first with at least that much context, by
batched masked attention.

*Unigram base.* The most frequent words, at most ``FREQUENT`` of them at any size,
travel with the tasks; the rare rest meet the word counts in a join.

Null texts are empty: one end token. Without training texts every count is 0, the
base score 0 and the model's classes are equally likely. Null ids train.
Repeated rows give repeated rows.
"""

from __future__ import annotations

import base64
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import textnum as N
from starloom.llm.scratch import least_frequent, partitions, ship, stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's makers cut text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
HEAD, SHARED = 200, 40
CLASSES = HEAD + SHARED + 1  # and the end
#: Classes are told in two steps, the group and then the member of the group.
GROUPS = 16
MEMBERS = -(-CLASSES // GROUPS)
END, START = CLASSES - 1, CLASSES
WIDTH = 8
WINDOW, STRIDE = 16, 12
SHARD = 16384
ROUNDS = 2
STEPS, EPOCHS = 100, 4
BATCH = 128
RATE = 0.01
#: Weight of a class's own frequency in the class bigrams, in occurrences.
SMOOTH = 8.0
#: Bound of the words that travel with the tasks.
FREQUENT = 1 << 19
#: Windows scored at once: their logits stay in the processor's cache.
CHUNK = 512
#: Bytes of text whose words are counted together before they leave a task.
COUNT_BYTES = 32 << 20
_ABSENT = 255
#: Children of a node of the trees that tell the members of a class.
BRANCH = 16


class Vocabulary:
    """Subword ids of words, from the ranks file alone."""

    def __init__(self, data: bytes):
        import tiktoken

        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        self.size = max(self.ranks.values()) + 1
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    def encode(self, words: list[str]) -> list[list[int]]:
        one = self.encoding.encode_ordinary
        return [one(" " + w) for w in words]


@lru_cache(maxsize=2)
def _vocabulary(data: bytes) -> Vocabulary:
    return Vocabulary(data)


# ---- the model ----------------------------------------------------------------

_SHAPES = {
    "embed": (CLASSES + 1, WIDTH), "place": (WINDOW, WIDTH), "qkv": (WIDTH, 3 * WIDTH), "back": (WIDTH, WIDTH),
    "group": (WIDTH, GROUPS), "out": (GROUPS, WIDTH, MEMBERS),
}
_PAST = np.tril(np.ones((WINDOW, WINDOW), dtype=np.float32))
_MOST = np.float32(60)
_ONES = np.ones(max(GROUPS, MEMBERS), dtype=np.float32)


def bigrams(table: np.ndarray) -> dict[str, np.ndarray]:
    """The model's constants from the probabilities of each class after each: the
    logarithms of the groups' and, within them, the members'."""
    p = np.zeros((CLASSES + 1, GROUPS * MEMBERS))
    p[:, :CLASSES] = table / table.sum(axis=1, keepdims=True)
    p = p.reshape(CLASSES + 1, GROUPS, MEMBERS)
    group = p.sum(axis=2)
    member = np.where(p > 0, np.log(np.maximum(p, 1e-300)) - np.log(np.maximum(group, 1e-300))[:, :, None], -1e9)
    return {"step": np.log(np.maximum(group, 1e-300)).astype(np.float32), "pair": member.astype(np.float32)}


def fresh(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    small = {"group", "out"}
    out = {k: rng.normal(0, 0.02 if k in small else 0.2, s).astype(np.float32) for k, s in _SHAPES.items()}
    return out | bigrams(np.ones((CLASSES + 1, CLASSES)))


def trees(mass: np.ndarray, of: np.ndarray) -> dict[str, np.ndarray]:
    """What the model needs to tell members apart, not learned yet. ``mass`` and ``of``: the
    members' masses and their classes, in the order of both (the first member is number
    1; 0 stands for a class of its own). ``path``: the steps down to each member, a step as
    ``node * BRANCH + child`` and -1 behind the last; ``bias``: the logarithms of the children's
    shares; ``own`` and ``deep``: the members' vectors and, by node, the children's."""
    path, bias = [np.full(len(mass) + 1, -1, dtype=np.int32)], []
    edge = np.flatnonzero(np.diff(of, prepend=-1, append=-1)) if len(of) else np.zeros(1, dtype=int)
    todo = [(lo, hi, 0) for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
    while todo:
        lo, hi, depth = todo.pop()
        if hi - lo < 2:
            continue
        own = mass[lo:hi]
        if hi - lo <= BRANCH:
            child = np.arange(hi - lo)
        else:
            # by mass, and half by number, so that no child has more than about 2 / BRANCH of the members
            weight = own + own.mean()
            place = (np.cumsum(weight) - weight / 2) * (BRANCH / weight.sum())
            child = np.unique(np.minimum(place.astype(int), BRANCH - 1), return_inverse=True)[1]
        share = np.bincount(child, weights=own, minlength=BRANCH) / own.sum()
        if depth == len(path):
            path.append(np.full(len(mass) + 1, -1, dtype=np.int32))
        path[depth][lo + 1 : hi + 1] = len(bias) * BRANCH + child
        bias.append(np.where(share > 0, np.log(np.maximum(share, 1e-300)), -1e9))
        cut = lo + np.append(np.flatnonzero(np.diff(child, prepend=-1)), hi - lo)
        todo += [(a, b, depth + 1) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    return {
        "path": np.stack(path, axis=1), "bias": np.array(bias, dtype=np.float32).reshape(-1, BRANCH),
        "own": np.zeros((len(mass) + 1, WIDTH), dtype=np.float32),
        "deep": np.zeros((len(bias), WIDTH, BRANCH), dtype=np.float32),
    }


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].reshape(-1) for k in _SHAPES])


def shaped(vector: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in _SHAPES:
        n = math.prod(_SHAPES[k])
        out[k] = vector[at : at + n].reshape(_SHAPES[k]).astype(np.float32, copy=False)
        at += n
    return out


def attend(w: dict[str, np.ndarray], x: np.ndarray, skip: int = 0, member: np.ndarray | None = None):
    """The attention layer's output after every place but the first ``skip`` of the
    windows ``x`` (rows of class ids, and of their members), with what led to it: attention
    as unscaled weights and their sums."""
    h = w["embed"].take(x, axis=0)
    h += w["place"]
    if member is not None:
        h += w["own"].take(member, axis=0)
    qkv = h.reshape(-1, WIDTH) @ w["qkv"]
    qkv[:, :WIDTH] *= np.float32(1 / math.sqrt(WIDTH))
    q, k, v = (qkv[:, i * WIDTH : (i + 1) * WIDTH].reshape(h.shape) for i in range(3))
    a = q[:, skip:] @ k.transpose(0, 2, 1)
    # bounded instead of shifted by each row's maximum; what lies ahead weighs nothing
    np.minimum(a, _MOST, out=a)
    np.exp(a, out=a)
    a *= _PAST[skip:]
    total = (a.reshape(-1, WINDOW) @ _ONES[:WINDOW]).reshape(*a.shape[:2], 1)
    z = a @ v
    z /= total
    o = (z.reshape(-1, WIDTH) @ w["back"]).reshape(z.shape)
    o += h[:, skip:]
    return o, (h, q, k, v, a, total, z)


def _sorted_logits(w, o: np.ndarray, x: np.ndarray, y: np.ndarray):
    """``(order, o, group, member, cut, top, low)`` of places (rows): sorted by their target's
    group, so that a group's places are a slice (from ``cut``); logits of the groups and
    of the members of the target's group."""
    group = (y // MEMBERS).astype(np.uint8)
    order = np.argsort(group, kind="stable")  # a radix sort
    cut = np.append(0, np.cumsum(np.bincount(group, minlength=GROUPS))).tolist()
    o, x, y = o.take(order, axis=0), x.take(order), y.take(order)
    group, member = np.divmod(y, MEMBERS)
    top = o @ w["group"]
    top += w["step"].take(x, axis=0)
    low = w["pair"].reshape(-1, MEMBERS).take(x * GROUPS + group, axis=0)
    for i, (lo, hi) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
        if lo < hi:
            low[lo:hi] += o[lo:hi] @ w["out"][i]
    return order, o, group, member, cut, top, low


def _steps(w, o: np.ndarray, member: np.ndarray):
    """``(place, node, child, left, deep, logits)`` of the steps down the trees to the
    targets' members, place by place: of the places (rows of ``o``) with a member."""
    of = np.flatnonzero(member)
    path = w["path"].take(member.take(of), axis=0)
    at = np.flatnonzero(path >= 0)
    node, child = np.divmod(path.reshape(-1).take(at), BRANCH)
    place = of.take(at // path.shape[1])
    left, deep = o.take(place, axis=0), w["deep"].take(node, axis=0)
    logits = w["bias"].take(node, axis=0)
    logits += (left[:, None, :] @ deep)[:, 0]
    return place, node, child, left, deep, logits


def log_probabilities(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, skip: int, members=None) -> np.ndarray:
    """Natural logarithm of the probability of the target class at each place of
    the windows, without the first ``skip`` places; with ``members`` (of ``x`` and ``y``)
    that of the target itself."""
    o, _ = attend(w, x, skip, None if members is None else members[0])
    shape, row = o.shape[:2], np.arange(o.shape[0] * o.shape[1])
    order, _, g, m, _, top, low = _sorted_logits(w, o.reshape(-1, WIDTH), x[:, skip:].reshape(-1), y[:, skip:].reshape(-1))
    got = top[row, g] + low[row, m]
    # logits stay small enough for float32; no row maximum is needed
    got -= np.log((np.exp(top, out=top) @ _ONES[:GROUPS]) * (np.exp(low, out=low) @ _ONES[:MEMBERS]))
    out = np.empty_like(got)
    out[order] = got
    if members is not None:
        place, _, child, _, _, logits = _steps(w, o.reshape(-1, WIDTH), members[1][:, skip:].reshape(-1))
        step = logits[np.arange(len(place)), child]
        step -= np.log(np.exp(logits, out=logits) @ _ONES[:BRANCH])
        out += np.bincount(place, weights=step, minlength=len(out)).astype(np.float32)
    return out.reshape(shape)


def _summed(rows: np.ndarray, name: np.ndarray):
    """The different names, and the sum of the rows of each."""
    order = np.argsort(name, kind="stable")
    name = name.take(order)
    first = np.flatnonzero(np.diff(name, prepend=-1))
    return name.take(first), np.add.reduceat(rows.take(order, axis=0), first, axis=0) if len(first) else rows


def _products(left: np.ndarray, right: np.ndarray, name: np.ndarray):
    """The different names, and the sum of the outer products of each one's rows."""
    order = np.argsort(name.astype(np.uint16) if len(name) and name.max() < 1 << 16 else name, kind="stable")
    name, left, right = name.take(order), left.take(order, axis=0), right.take(order, axis=0)
    cut = np.append(np.flatnonzero(np.diff(name, prepend=-1)), len(name))
    first, n = cut[:-1], np.diff(cut)
    # most stand alone
    out = left.take(first, axis=0)[:, :, None] * right.take(first, axis=0)[:, None, :]
    for i in np.flatnonzero(n > 1).tolist():
        out[i] = left[cut[i] : cut[i + 1]].T @ right[cut[i] : cut[i + 1]]
    return name.take(first), out


def gradients(w, x, y, valid, members=None):
    """The loss's derivatives by what is learned; the class bigrams are counted. Those by
    the vectors of members and nodes are their numbers and the rows of those alone."""
    o, (h, q, k, v, a, total, z) = attend(w, x, 0, None if members is None else members[0])
    a /= total
    rows = lambda t: t.reshape(-1, t.shape[2])
    row = np.arange(x.size)
    order, flat_o, group, member, cut, top, low = _sorted_logits(w, rows(o), x.reshape(-1), y.reshape(-1))
    weight = (valid.reshape(-1).take(order) / max(1, valid.sum())).astype(np.float32)

    def error(p, target):
        # as in scoring: no row maximum is needed
        np.exp(p, out=p)
        p *= (weight / (p @ _ONES[: p.shape[1]]))[:, None]
        p[row, target] -= weight
        return p

    top, low = error(top, group), error(low, member)
    g = {"group": flat_o.T @ top, "out": np.zeros_like(w["out"])}
    due = top @ w["group"].T
    for i, (lo, hi) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
        if lo < hi:
            g["out"][i] = flat_o[lo:hi].T @ low[lo:hi]
            due[lo:hi] += low[lo:hi] @ w["out"][i].T
    do = np.empty_like(due)
    do[order] = due
    if members is not None:
        place, node, child, left, deep, steps = _steps(w, rows(o), members[1].reshape(-1))
        part = (valid.reshape(-1).take(place) / max(1, valid.sum())).astype(np.float32)
        np.exp(steps, out=steps)
        steps *= (part / (steps @ _ONES[:BRANCH]))[:, None]
        steps[np.arange(len(place)), child] -= part
        g["deep"] = _products(left, steps, node)
        at, more = _summed((deep @ steps[:, :, None])[:, :, 0], place)
        do[at] += more
    g["back"] = rows(z).T @ do
    dz = (do @ w["back"].T).reshape(o.shape)
    ds = dz @ v.transpose(0, 2, 1)
    # the sum of a row's weights times their derivatives
    ds -= (rows(dz * z) @ _ONES[:WIDTH]).reshape(*z.shape[:2], 1)
    ds *= a
    dqkv = np.empty((*h.shape[:2], 3 * WIDTH), dtype=np.float32)
    dqkv[:, :, :WIDTH] = ds @ k
    dqkv[:, :, :WIDTH] /= np.float32(math.sqrt(WIDTH))  # q is scaled already
    dqkv[:, :, WIDTH : 2 * WIDTH] = ds.transpose(0, 2, 1) @ q
    dqkv[:, :, 2 * WIDTH :] = a.transpose(0, 2, 1) @ dz
    g["qkv"] = rows(h).T @ rows(dqkv)
    dh = do + rows(dqkv) @ w["qkv"].T
    if members is not None:
        named = members[0].reshape(-1)
        of = np.flatnonzero(named)
        g["own"] = _summed(dh.take(of, axis=0), named.take(of))
    # the rows of each class, one after the other, are summed
    x = x.reshape(-1).astype(np.uint8)
    order = np.argsort(x, kind="stable")
    n = np.bincount(x, minlength=CLASSES + 1)
    seen = np.flatnonzero(n)
    g["embed"] = np.zeros_like(w["embed"])
    g["embed"][seen] = np.add.reduceat(dh.take(order, axis=0), (np.cumsum(n) - n)[seen], axis=0)
    g["place"] = dh.reshape(h.shape).sum(axis=0)
    return g


def train(w: dict[str, np.ndarray], windows: np.ndarray, steps: int = STEPS, rate: float = RATE, seed: int = 0, members=None):
    """Adam from ``w`` over the windows (rows of WINDOW + 1 class ids, padded with
    ``_ABSENT``, and ``members`` of the same shape, padded with 0): each window once, or up to
    ``EPOCHS`` times to make up ``steps``. A vector of a member or a node moves in the steps that meet it."""
    rng = np.random.default_rng(seed)
    learned = flat(w).astype(np.float32)
    w = {**w, **shaped(learned)}
    m1, m2 = np.zeros_like(learned), np.zeros_like(learned)
    if members is not None:
        w |= {k: w[k].copy() for k in _MET}
        met = {k: (np.zeros_like(w[k]), np.zeros_like(w[k])) for k in _MET}
    once = -(-len(windows) // BATCH)
    todo = max(once, min(steps, EPOCHS * once))
    order = np.concatenate([rng.permutation(len(windows)) for _ in range(-(-todo * BATCH // len(windows)))])
    for t in range(todo):
        which = order[t * BATCH : (t + 1) * BATCH]
        batch = windows[which].astype(np.int64)
        x, y = batch[:, :-1], batch[:, 1:]
        valid = (y != _ABSENT).astype(np.float32)
        x, y = np.where(x == _ABSENT, START, x), np.where(y == _ABSENT, END, y)
        both = None if members is None else (members[which, :-1].astype(np.int64), members[which, 1:].astype(np.int64))
        found = gradients(w, x, y, valid, both)
        g = flat(found)
        speed, even = np.float32(rate * (1 - t / todo) / (1 - 0.9 ** (t + 1))), np.float32(1 - 0.99 ** (t + 1))
        m1 += np.float32(0.1) * (g - m1)
        m2 += np.float32(0.01) * (g * g - m2)
        root = np.sqrt(m2 / even)
        root += np.float32(1e-8)
        learned -= speed * m1 / root
        w.update(shaped(learned))
        for k in _MET if both else ():
            at, g = found[k]
            a, b = (m[at] for m in met[k])
            a += np.float32(0.1) * (g - a)
            b += np.float32(0.01) * (g * g - b)
            met[k][0][at], met[k][1][at] = a, b
            b = np.sqrt(b / even)
            b += np.float32(1e-8)
            a *= speed
            a /= b
            w[k][at] -= a
    return w


#: What is learned of members and nodes, by their numbers.
_MET = ("own", "deep")


def _times_met(w: dict[str, np.ndarray], members: np.ndarray) -> dict[str, np.ndarray]:
    """How often training over the windows of ``members`` meets each member and each node."""
    n = len(w["own"])
    own, to = np.bincount(members[:, :-1].reshape(-1), minlength=n), np.bincount(members[:, 1:].reshape(-1), minlength=n)
    own[0] = to[0] = 0
    at = np.flatnonzero(to)
    path = w["path"][at]
    inside = path >= 0
    nodes = np.bincount(path[inside] // BRANCH, weights=np.repeat(to[at], inside.sum(axis=1)), minlength=len(w["deep"]))
    return {"own": own, "deep": nodes}


def _table(w: dict[str, np.ndarray], windows: int, met: dict[str, np.ndarray]) -> pa.Table:
    """What a shard learned, as rows of ``WIDTH`` numbers with their weight in the average: the
    layer's first, then those of the members and nodes that it met."""
    dense = flat(w).reshape(-1, WIDTH)
    at, n, rows, before = [np.arange(len(dense))], [np.full(len(dense), float(windows))], [dense], len(dense)
    for k in _MET:
        each = w[k].reshape(len(w[k]), -1, WIDTH)
        some = np.flatnonzero(met[k])
        at.append((before + some[:, None] * each.shape[1] + np.arange(each.shape[1])).reshape(-1))
        n.append(np.repeat(met[k][some].astype(float), each.shape[1]))
        rows.append(each[some].reshape(-1, WIDTH))
        before += w[k].size // WIDTH
    rows = np.concatenate(rows)
    return pa.table({"at": np.concatenate(at), "n": np.concatenate(n), **{f"x{i}": np.ascontiguousarray(rows[:, i]) for i in range(WIDTH)}})


def _with_rows(w: dict[str, np.ndarray], at: np.ndarray, rows: np.ndarray) -> dict[str, np.ndarray]:
    """The weights with the given rows of ``_table`` in place of their own."""
    every = np.concatenate([flat(w).reshape(-1, WIDTH), *(w[k].reshape(-1, WIDTH) for k in _MET)])
    every[at] = rows
    out, before = w | shaped(every.reshape(-1)), flat(w).size // WIDTH
    for k in _MET:
        out[k] = every[before : before + w[k].size // WIDTH].reshape(w[k].shape)
        before += w[k].size // WIDTH
    return out


# ---- words and counts ---------------------------------------------------------


def count_words(texts: DataFrame, data: bytes) -> DataFrame:
    """``h, n, ids``: hash, count and subword ids of each word of a frame of texts."""
    ship(texts.sparkSession)

    def run(batches):
        for b in N.parts(batches, 0, COUNT_BYTES):
            names, counts, spelled = [], [], []
            low = N.lowered(b.column(0).to_pylist())
            for lo, hi in N.slices(low, 4 * N.BATCH_BYTES):
                h, _, joined, start, end = N.located(low[lo:hi], N.SPACED)
                name, first, n = np.unique(h, return_index=True, return_counts=True)
                names.append(name)
                counts.append(n)
                spelled += [joined[x:y] for x, y in zip(start[first].tolist(), end[first].tolist(), strict=True)]
            if spelled:
                every, first, back = np.unique(np.concatenate(names), return_index=True, return_inverse=True)
                total = np.bincount(back, weights=np.concatenate(counts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(every.view(np.int64)), pa.array([spelled[i] for i in first.tolist()], pa.binary()), pa.array(total)],
                    names=["h", "word", "n"],
                )

    def encode(batches):
        v = _vocabulary(data)
        for b in batches:
            ids = v.encode([w.decode("utf-8", "surrogatepass") for w in b.column(1).to_pylist()])
            packed = [np.array(i, dtype="<u4").tobytes() for i in ids]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(packed, pa.binary())], names=["h", "n", "ids"])

    words = texts.mapInArrow(run, "h long, word binary, n long")
    words = words.groupBy("h").agg(F.min("word").alias("word"), F.sum("n").alias("n"))
    return words.mapInArrow(encode, "h long, n long, ids binary")


def count_subwords(words: DataFrame) -> np.ndarray:
    """``(id, count)`` rows of the subwords, bounded by the vocabulary."""

    def run(batches):
        for b in batches:
            size = np.array([len(i) // 4 for i in b.column(2).to_pylist()])
            ids = np.frombuffer(b"".join(b.column(2).to_pylist()), dtype="<u4")
            n = np.bincount(ids, weights=np.repeat(b.column(1).to_numpy().astype(np.float64), size))
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at].astype(np.int64))], names=["id", "n"])

    got = words.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return got.to_numpy(dtype=np.int64)


class Classes:
    """The class of every subword, and its number among the members of the shared classes
    from 1, the most frequent first (0: a class of its own)."""

    def __init__(self, counts: np.ndarray, size: int):
        n = np.zeros(size)
        if len(counts):
            n[counts[:, 0]] = counts[:, 1]
        order = np.lexsort((np.arange(size), -n))
        self.of = np.empty(size, dtype=np.uint8)
        self.of[order[:HEAD]] = np.arange(min(HEAD, size))
        rest = order[HEAD:]
        mass = np.cumsum(n[rest] + 0.5)
        self.of[rest] = HEAD + np.minimum(SHARED - 1, (mass * SHARED / (mass[-1] + 1)).astype(int))
        self.member = np.zeros(size, dtype="<u2" if len(rest) < 1 << 16 else "<u4")
        self.member[rest] = np.arange(1, len(rest) + 1)
        self.mass, self.shared = n[rest] + 0.5, self.of[rest]


class Known:
    """The frequent words by hash: count, classes and members."""

    def __init__(self, h: np.ndarray, n: np.ndarray, ids: list[bytes], classes: Classes):
        order = np.argsort(h)
        self.h, self.n = h[order], n[order]
        self.first, self.classes, self.members = _classed([np.frombuffer(ids[i], dtype="<u4") for i in order], classes)


def _classed(ids: list[np.ndarray], classes: Classes):
    size = np.array([len(i) for i in ids], dtype=np.int64)
    every = np.concatenate(ids).astype(np.int64) if ids else np.empty(0, dtype=np.int64)
    return np.concatenate(([0], np.cumsum(size))), classes.of[every], classes.member[every]


class Coder:
    """Texts as class sequences."""

    def __init__(self, known: Known, classes: Classes, data: bytes):
        self.known, self.table, self.data = known, classes, data

    def words(self, low: list[bytes]):
        """``(hash, first, place, first class, classes, members)``: place is each
        word's index among the coded words, the frequent ones first."""
        h, first, joined, start, end = N.located(low, N.SPACED)
        k = self.known
        place = np.minimum(np.searchsorted(k.h, h), max(0, len(k.h) - 1)) if len(k.h) else np.zeros(len(h), dtype=np.int64)
        rare = (k.h[place] != h) if len(k.h) else np.ones(len(h), dtype=bool)
        name, at, back = np.unique(h[rare], return_index=True, return_inverse=True)
        index = np.flatnonzero(rare)[at]
        texts = [joined[start[i] : end[i]].decode("utf-8", "surrogatepass") for i in index]
        ids = [np.array(i, dtype=np.int64) for i in _vocabulary(self.data).encode(texts)]
        f, c, s = _classed(ids, self.table)
        place = np.where(rare, 0, place)
        place[rare] = len(k.h) + back
        return (h, first, place, rare, np.concatenate((k.first, k.first[-1] + f[1:])),
                np.concatenate((k.classes, c)), np.concatenate((k.members, s)))


def _gather(place: np.ndarray, first: np.ndarray, classes: np.ndarray, members: np.ndarray):
    """The classes and members of the words one after the other, and where each word begins."""
    size = first[place + 1] - first[place]
    begin = np.cumsum(size) - size
    index = np.arange(int(size.sum())) - np.repeat(begin, size) + np.repeat(first[place], size)
    return classes[index], members[index], np.append(begin, len(index))


def _stream(seq: np.ndarray, begin: np.ndarray, start: int = START, end: int = END):
    """START, classes and END of each text in a row, in the classes' type, and how many each
    scores."""
    size = np.diff(begin) + 1
    out = np.empty(int((size + 1).sum()), dtype=seq.dtype)
    top = np.cumsum(size + 1) - (size + 1)
    inner = np.ones(len(out), dtype=bool)
    inner[top] = inner[top + size] = False
    out[inner], out[top], out[top + size] = seq, start, end
    return out, size


def windows_of(stream: np.ndarray, size: np.ndarray, which=None, members: np.ndarray | None = None):
    """The consecutive windows of each text of a stream, as rows of WINDOW + 1 class
    ids padded with ``_ABSENT``, and each window's text. A window begins with the
    class before its targets, so every class but START is a target once. ``which``:
    the text and number of the windows wanted, of those of ``numbered``. With the stream of the
    ``members``, their windows too, padded with 0."""
    begin = np.cumsum(size + 1) - (size + 1)
    text, no = numbered(size) if which is None else which
    places = (begin[text] + no * WINDOW)[:, None] + np.arange(WINDOW + 1)
    inside = places <= (begin + size)[text][:, None]
    places = np.minimum(places, len(stream) - 1)
    rows = np.where(inside, stream.astype(np.uint8)[places], np.uint8(_ABSENT))
    return (rows, text) if members is None else (rows, text, np.where(inside, members[places], members.dtype.type(0)))


def numbered(size: np.ndarray):
    """The text and number of each text's windows."""
    count = -(-size // WINDOW)
    text = np.repeat(np.arange(len(size)), count)
    return text, np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)


def _streams(classes: pa.Array, members: pa.Array | None = None):
    """``_stream`` of texts stored as one byte a class, and that of their members if given,
    in bounded groups with the first and last text's index."""
    held, other = classes.to_pylist(), None if members is None else members.to_pylist()
    for lo, hi in N.slices(held):
        begin = np.cumsum([0, *map(len, held[lo:hi])])
        own = None if other is None else _stream(_numbers(b"".join(other[lo:hi]), begin[-1]), begin, 0, 0)[0]
        yield lo, hi, *_stream(np.frombuffer(b"".join(held[lo:hi]), dtype=np.uint8), begin), own


def _numbers(data: bytes, n: int) -> np.ndarray:
    """The ``n`` members of ``data``, of two or four bytes each."""
    return np.frombuffer(data, dtype="<u4" if n and len(data) == 4 * n else "<u2")


def _dealt(texts: DataFrame, turn: int, shards: int) -> DataFrame:
    """``shard, w, m`` of a frame of ids, text hashes, classes and, if there, members: the
    windows of one round and those of their members, those of one shard that a task meets
    together in one row. Windows are dealt by their text's id and hash and their number, so
    equal windows go to different shards."""

    def run(batches):
        for b in N.parts(batches, 2):
            ids, keys = (pc.fill_null(b.column(i), 0).to_numpy().astype(np.int64).view(np.uint64) for i in range(2))
            named = N.mix(N.mix(ids + N.GRAM[0]) + keys)
            for lo, _, stream, size, members in _streams(*b.columns[2:]):
                text, no = numbered(size)
                deal = N.mix(named[lo + text] + no.astype(np.uint64) * N.GRAM[1]) % np.uint64(ROUNDS * shards)
                own = np.flatnonzero(deal % np.uint64(ROUNDS) == turn)
                shard = (deal[own] // np.uint64(ROUNDS)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                own, shard = own[order], shard[order]
                rows, _, *more = windows_of(stream, size, (text[own], no[own]), members)
                first = np.flatnonzero(np.diff(shard, prepend=-1))
                place = np.append(first, len(shard)).astype(np.int32) * (WINDOW + 1)
                packed = [_binary(place * r.itemsize, r) for r in (rows, *more)]
                if not more:
                    packed.append(pa.nulls(len(first), pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array(shard[first]), *packed], names=["shard", "w", "m"])

    return texts.mapInArrow(run, "shard long, w binary, m binary")


def _binary(place: np.ndarray, data: np.ndarray) -> pa.Array:
    """The bytes of an array, cut at the given places."""
    return pa.Array.from_buffers(pa.binary(), len(place) - 1, [None, pa.py_buffer(place.astype(np.int32)), pa.py_buffer(data.tobytes())])


def _fit(coded: DataFrame) -> dict[str, np.ndarray]:
    spark = coded.sparkSession
    texts = coded.where("kind = 0 and train").select("doc_id", "key", "classes", "members")
    n = texts.agg(F.sum(F.ceil((F.length("classes") + 1) / WINDOW))).first()[0]
    kept = coded.where("kind = 3").select("members", "classes").first()
    weights = fresh() | trees(np.frombuffer(kept[0], dtype="<f8"), np.frombuffer(kept[1], dtype=np.uint8))
    if not n:
        return weights | {k: np.zeros_like(weights[k]) for k in _SHAPES}
    # at most one number for each pair of classes
    got = coded.where("kind = 2").groupBy("h").agg(F.sum("n_tokens").alias("n")).toPandas()
    table = np.zeros((CLASSES + 1) * CLASSES)
    table[got["h"].to_numpy(dtype=np.int64)] = got["n"].to_numpy()
    table = table.reshape(CLASSES + 1, CLASSES)
    alone = (table.sum(axis=0) + 0.5) / (table.sum() + 0.5 * CLASSES)
    weights |= bigrams(table + SMOOTH * alone)
    shards = max(1, n // (ROUNDS * SHARD))

    def trainer(start, seed):
        def run(key, table):
            rows = np.frombuffer(b"".join(table.column("w").to_pylist()), dtype=np.uint8).reshape(-1, WINDOW + 1)
            members = _numbers(b"".join(table.column("m").to_pylist()), rows.size).reshape(rows.shape)
            done = train(start.value, rows, seed=seed, members=members)
            return _table(done, len(rows), _times_met(done, members))

        return run

    xs = [f"x{i}" for i in range(WIDTH)]
    for seed in range(ROUNDS):
        run = trainer(spark.sparkContext.broadcast(weights), seed)
        # a shard holds a bounded number of windows; the copies' average is a plain aggregate
        copies = _dealt(texts, seed, shards).groupBy("shard").applyInArrow(run, f"at long, n double, {', '.join(f'{x} float' for x in xs)}")
        mean = copies.groupBy("at").agg(*[(F.sum(F.col("n") * F.col(x)) / F.sum("n")).alias(x) for x in xs]).toPandas()
        # few windows may leave a round without any
        weights = _with_rows(weights, mean["at"].to_numpy(dtype=np.int64), mean[xs].to_numpy())
    return weights


def score_classes(weights, stream: np.ndarray, size: np.ndarray, members: np.ndarray | None = None) -> np.ndarray:
    """log10 probability of each text. The stream holds, per text, START, its
    classes and END; ``size`` counts the scored ones, all but START. Without the stream of
    the ``members`` it is that of the classes."""
    begin = np.cumsum(size + 1) - (size + 1)
    count = 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE))
    text = np.repeat(np.arange(len(size)), count)
    no = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    at, end = begin[text] + no * STRIDE, (begin + size)[text]
    out = np.zeros(len(size))
    step = np.arange(WINDOW)
    # a place is scored by the first window that holds it: all of a text's first
    # window, and what the others add to the one before
    for which, skip in ((np.flatnonzero(no == 0), 0), (np.flatnonzero(no), WINDOW - STRIDE)):
        for lo in range(0, len(which), CHUNK):
            i = which[lo : lo + CHUNK]
            places = at[i, None] + step
            inside = places < end[i, None]
            x = np.where(inside, stream[np.minimum(places, len(stream) - 1)], START)
            y = np.where(inside, stream[np.minimum(places + 1, len(stream) - 1)], END)
            both = None
            if members is not None:
                both = tuple(np.where(inside, members[np.minimum(places + n, len(stream) - 1)], 0) for n in (0, 1))
            got = np.where(inside[:, skip:], log_probabilities(weights, x, y, skip, both), 0.0)
            out += np.bincount(text[i], weights=got.sum(axis=1, dtype=np.float64), minlength=len(size))
    return out / math.log(10)


def score_texts(docs: DataFrame, training, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of
    every row; ``training`` is a condition that selects the training rows."""
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary, "rb") as f:
        data = f.read()
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(training, F.lit(True)).alias("train"),
        F.xxhash64(text).alias("key"), F.col(text).alias("text"),
    )
    learn = rows.where("train").select("doc_id", "text")
    words = stored(count_words(learn.select("text"), data), "words")
    sums = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = learn.count()
    total, distinct = (sums["n"] or 0) + ends, sums["v"] + (1 if ends else 0)
    below = total + 0.1 * (distinct + 1)
    classes = Classes(count_subwords(words), _vocabulary(data).size)
    best = words.where(F.col("n") >= least_frequent(words, "n", FREQUENT)).toArrow()
    known = Known(best.column("h").to_numpy().view(np.uint64), best.column("n").to_numpy(), best.column("ids").to_pylist(), classes)
    del best
    coder = spark.sparkContext.broadcast(Coder(known, classes, data))

    def code(batches):
        c = coder.value
        end_score = math.log10((ends + 0.1) / below)
        logs = np.log10((c.known.n + 0.1) / below)
        for b in N.parts(batches, 3):
            low = N.lowered(b.column(3).to_pylist())
            trains = b.column(1).to_numpy(zero_copy_only=False)
            follow = np.zeros((CLASSES + 1) * CLASSES, dtype=np.int64)
            for lo, hi in N.slices(low):
                n = hi - lo
                h, first, place, rare, f, *coded = c.words(low[lo:hi])
                seq, members, begin = _gather(place, f, *coded)
                count = np.diff(first)
                owner = np.repeat(np.arange(n), count)
                often = ~rare
                base = np.bincount(owner[often], weights=logs[place[often]], minlength=n) + end_score
                seen = np.bincount(owner[often], minlength=n) + (1 if ends else 0)
                stream, size = _stream(seq, begin[first])
                # how often a class follows another in the training texts
                inner = (np.repeat(trains[lo:hi], size + 1) & (stream != START))[1:]
                follow += np.bincount(stream[:-1][inner].astype(np.int64) * CLASSES + stream[1:][inner], minlength=len(follow))
                packed = [_binary(begin[first] * a.itemsize, a) for a in (seq, members)]
                doc = b.slice(lo, n)
                yield _rows(0, doc.column(0), doc.column(1), doc.column(2), None, count + 1, seen, base, *packed)
                # one row for each rare word of a text
                pair, times = np.unique(np.stack((owner[rare], h[rare].view(np.int64))), axis=1, return_counts=True)
                if len(times):
                    at = pa.array(pair[0])
                    yield _rows(1, doc.column(0).take(at), None, doc.column(2).take(at), pair[1], times, *[None] * 4)
            at = np.flatnonzero(follow)
            yield _rows(2, pa.nulls(len(at), pa.int64()), None, None, at, follow[at], *[None] * 4)

    # every text is cut and coded once; training and scoring read its classes and members. Beside
    # them stand the members' masses and classes, by which the model tells them
    kept = [(3, *[None] * 7, bytearray(classes.shared.tobytes()), bytearray(classes.mass.astype("<f8").tobytes()))]
    coded = stored(rows.mapInArrow(code, _CODED).unionByName(spark.createDataFrame(kept, _CODED)), "coded")
    model = spark.sparkContext.broadcast(_fit(coded))

    def run(batches):
        for b in N.parts(batches, 6):
            for lo, hi, stream, size, members in _streams(b.column(6), b.column(7)):
                doc = b.slice(lo, hi - lo)
                score = score_classes(model.value, stream.astype(np.int64), size, members)
                yield pa.RecordBatch.from_arrays([*doc.columns[:6], pa.array(score)], names=_SCORED)

    plain = coded.where("kind = 0").select(*_SCORED[:6], "classes", "members")
    scored = "doc_id long, train boolean, key long, n_tokens long, n_known long, base double, score double"
    plain = stored(plain.mapInArrow(run, scored), "scored")
    value = F.log10((F.coalesce("c", F.lit(0)) + F.lit(0.1)) / F.lit(below))
    tail = (
        coded.where("kind = 1").select("doc_id", "key", "h", F.col("n_tokens").alias("times"))
        .join(words.select("h", F.col("n").alias("c")), "h", "left")
        .repartition(partitions(spark), "doc_id", "key")
        .groupBy("doc_id", "key", "h")  # repeated rows bring their words again
        .agg(F.max("times").alias("times"), F.max("c").alias("c"))
        .groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k"))
        .agg(
            F.sum(F.col("times") * value).alias("more"),
            F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("also"),
        )
    )
    both = plain.join(tail, plain["doc_id"].eqNullSafe(tail["d"]) & (plain["key"] == tail["k"]), "left")
    return both.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
    )


_CODED = ("kind int, doc_id long, train boolean, key long, h long, n_tokens long, n_known long, "
          "base double, classes binary, members binary")  # fmt: skip
_SCORED = ["doc_id", "train", "key", "n_tokens", "n_known", "base", "score"]


def _rows(kind, *columns) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.binary()]
    n = len(columns[0])
    arrays = [pa.nulls(n, k) if c is None else c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    names = [x.split()[0] for x in _CODED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, dtype=np.int32)), *arrays], names=names)


def op5_lm_scores(spark, sf_dir: str) -> DataFrame:
    """Scores of all whole documents, learned from nine tenths of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_texts(docs, F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) != 0)


__all__ = ["Vocabulary", "Classes", "fresh", "attend", "train", "gradients", "score_classes", "score_texts", "op5_lm_scores"]
