"""The language model: gradients, probabilities, windows, the base's exact sums, edges."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import lm as L

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def weights(seed=1):
    rng = np.random.default_rng(seed)
    learned = {k: rng.normal(0, 0.3, s).astype(np.float32) for k, s in L._SHAPES.items()}
    return learned | L.bigrams(rng.random((L.CLASSES + 1, L.CLASSES)) + 0.01)


def one_window(w, x):
    """Log probabilities of all classes after the last of ``x``, place by place."""
    h = [w["embed"][c].astype(float) + w["place"][i] for i, c in enumerate(x)]
    q, k, v = (np.array([t @ w["qkv"][:, j * L.WIDTH : (j + 1) * L.WIDTH] for t in h]) for j in range(3))
    s = np.array([q[-1] @ t for t in k]) / math.sqrt(L.WIDTH)
    a = np.exp(s - s.max())
    o = (a / a.sum()) @ v @ w["back"] + h[-1]
    top = o @ w["group"] + w["step"][x[-1]]
    low = np.einsum("d,gdm->gm", o, w["out"]) + w["pair"][x[-1]]
    top, low = (t - np.log(np.exp(t).sum(axis=-1, keepdims=True)) for t in (top, low))
    out = (top[:, None] + low).reshape(-1)[: L.CLASSES]
    assert np.exp(out).sum() == pytest.approx(1)  # a distribution over the classes
    return out


def test_each_token_is_scored_once_with_its_context():
    rng, w = np.random.default_rng(2), weights()
    texts = [rng.integers(0, L.CLASSES - 1, n).tolist() for n in (0, 1, L.WINDOW - 2, L.WINDOW - 1, L.WINDOW, 3 * L.WINDOW + 5)]
    stream = np.concatenate([[L.START, *t, L.END] for t in texts])
    got = L.score_classes(w, stream, np.array([len(t) + 1 for t in texts]))
    for t, score in zip(texts, got, strict=True):
        s, want = [L.START, *t, L.END], 0.0
        for i in range(len(s) - 1):  # the first window that holds place i
            begin = 0 if i < L.WINDOW else -(-(i - L.WINDOW + 1) // L.STRIDE) * L.STRIDE
            want += one_window(w, s[begin : i + 1])[s[i + 1]]
        assert score == pytest.approx(want / math.log(10), rel=1e-4)


def test_gradients_by_differences():
    rng, w = np.random.default_rng(3), weights(4)
    x, y = (rng.integers(0, L.CLASSES, (3, L.WINDOW)) for _ in range(2))
    valid = (rng.random((3, L.WINDOW)) < 0.8).astype(np.float32)
    loss = lambda: -(L.log_probabilities(w, x, y, 0) * valid).sum(dtype=np.float64) / valid.sum()
    g = L.gradients(w, x, y, valid)
    for name in g:
        i = np.unravel_index(np.argmax(np.abs(g[name])), g[name].shape)
        old = w[name][i]
        w[name][i] = old + 1e-2
        up = loss()
        w[name][i] = old - 1e-2
        down = loss()
        w[name][i] = old
        assert (up - down) / 2e-2 == pytest.approx(g[name][i], rel=0.05, abs=1e-4), name


def test_training_learns():
    rows = np.array([[(i + j) % 7 for j in range(L.WINDOW + 1)] for i in range(64)], dtype=np.uint8)
    x, y = rows[:, :-1].astype(int), rows[:, 1:].astype(int)
    before = L.log_probabilities(L.fresh(), x, y, 0).mean()
    after = L.log_probabilities(L.train(L.fresh(), np.tile(rows, (150, 1)), steps=300), x, y, 0).mean()
    assert after > before / 4


def test_windows_hold_every_token_of_every_text():
    rng = np.random.default_rng(6)
    sizes = [0, 1, 5, L.WINDOW - 1, L.WINDOW, 100, 3 * L.WINDOW - 1]
    texts = [rng.integers(0, L.CLASSES - 1, n).tolist() for n in sizes]
    stream = np.concatenate([[L.START, *t, L.END] for t in texts])
    rows, text = L.windows_of(stream, np.array([n + 1 for n in sizes]))
    for i, t in enumerate(texts):
        own = rows[text == i].tolist()
        assert own[0][0] == L.START
        assert all(a[-1] == b[0] for a, b in zip(own[:-1], own[1:], strict=True))
        assert [c for r in own for c in r[1:] if c != L._ABSENT] == [*t, L.END]


def test_query_contract(spark):
    rows = L.op5_lm_scores(spark, SF).collect()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check(rows, text, lambda d: zlib.crc32(str(d).encode()) % 10 != 0)
    held = [r for r in rows if r["held_out"]]
    assert np.isfinite([r["score"] for r in rows]).all() and held
    # better than classes drawn alike, even from so little text
    assert sum(r["score"] for r in held) / sum(r["n_tokens"] for r in held) > -6


def check(rows, text, trains):
    tokens = {d: [*WORD.findall((t or "").translate(LOWER)), None] for d, t in text.items()}
    c = Counter(w for d, t in tokens.items() if trains(d) for w in t)
    n, v = sum(c.values()), len(c)
    assert len(rows) >= len(text)
    for r in rows:
        t = tokens[r["doc_id"]]
        want = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert r["base_score"] == pytest.approx(want, rel=1e-9, abs=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(c[w] > 0 for w in t), n)
        assert r["held_out"] == (not trains(r["doc_id"]))


@pytest.mark.parametrize("frequent", [0, 1 << 20])
def test_edges(spark, frequent, monkeypatch):
    monkeypatch.setattr(L, "FREQUENT", frequent)  # with 0 every word takes the join
    text = {1: "a b a", 2: None, 3: "", 4: "B c " * 3000, 5: "new\twords é", None: "a"}
    df = spark.createDataFrame(list(text.items()), "doc_id long, text string").selectExpr("*", "1 as score", "2 as n_tokens")
    trains = lambda d: d != 5
    condition = F.col("doc_id") != 5
    check(L.score_texts(df, condition).collect(), text, trains)
    none = L.score_texts(df.where("doc_id = 5"), F.lit(False)).collect()
    assert [(r["base_score"], r["train_tokens"], r["n_known"]) for r in none] == [(0.0, 0, 0)]
    assert L.score_texts(df.where("false"), condition).count() == 0


def test_repeated_rows_with_rare_words(spark, monkeypatch):
    monkeypatch.setattr(L, "FREQUENT", 0)
    df = spark.createDataFrame([(1, "x y x"), (1, "x y x"), (1, "x z")], "doc_id long, text string")
    got = sorted(r["base_score"] for r in L.score_texts(df, F.lit(True)).collect())
    # x 5, y 2, z 1 and 3 ends
    p = {w: math.log10((k + 0.1) / (11 + 0.5)) for w, k in {"x": 5, "y": 2, "z": 1, None: 3}.items()}
    assert got == pytest.approx(sorted([2 * p["x"] + p["y"] + p[None]] * 2 + [p["x"] + p["z"] + p[None]]))


def test_every_text_is_coded_once_and_every_window_is_dealt_once(spark, monkeypatch):
    monkeypatch.setattr(L, "SHARD", 4)
    frames, fits = {}, []
    keep, fit = L.stored, L._fit
    monkeypatch.setattr(L, "stored", lambda df, name: frames.setdefault(name, keep(df, name)))
    monkeypatch.setattr(L, "_fit", lambda coded: fits.append(fit(coded)) or fits[0])
    text = {1: "the cat sat on the mat " * 30, 2: "", 3: None, 4: "Some other words, 12 of them", 5: "held out"}
    df = spark.createDataFrame([*text.items(), (1, text[1]), (None, "a b")], "doc_id long, text string")
    got = L.score_texts(df, F.col("doc_id") != 5).collect()
    rows = frames["coded"].where("kind = 0").collect()
    assert len(rows) == len(got) == 7 and "windows" not in frames
    train = [[L.START, *r["classes"], L.END] for r in rows if r["train"]]
    follow = Counter((a, b) for t in train for a, b in zip(t[:-1], t[1:], strict=True))
    counted = frames["coded"].where("kind = 2").groupBy("h").agg(F.sum("n_tokens").alias("n")).collect()
    assert {divmod(r["h"], L.CLASSES): r["n"] for r in counted} == follow
    texts = frames["coded"].where("kind = 0 and train").select("doc_id", "key", "classes")
    dealt = [r for turn in range(L.ROUNDS) for r in L._dealt(texts, turn, 5).collect()]
    size = L.WINDOW + 1
    windows = Counter(r["w"][i : i + size] for r in dealt for i in range(0, len(r["w"]), size))
    want = L.windows_of(np.concatenate(train), np.array([len(t) - 1 for t in train]))[0]
    assert windows == Counter(w.tobytes() for w in want) and all(0 <= r["shard"] < 5 for r in dealt)


def some_trees(rng, sizes=(1, 3, 40, 700)):
    """Members' masses and classes, of that many members each, and weights of their trees."""
    mass = np.sort(rng.pareto(1.0, sum(sizes)) + 0.5)[::-1]  # the most frequent first
    of = np.repeat(np.arange(L.HEAD, L.HEAD + len(sizes)), sizes).astype(np.uint8)
    w = L.trees(mass, of)
    w |= {k: rng.normal(0, 0.3, w[k].shape).astype(np.float32) for k in ("own", "deep")}
    w["own"][0] = 0
    return mass, of, w


def test_members_of_a_class_are_a_distribution_given_the_context():
    rng = np.random.default_rng(8)
    mass, of, tree = some_trees(rng)
    w, n = weights(5) | tree, len(mass)
    assert tree["path"].shape[1] <= 5
    # without what is learned, a member's probability is its share of its class
    flat = w | {"deep": np.zeros_like(w["deep"])}
    x, xm = rng.integers(0, L.HEAD, L.WINDOW), np.zeros(L.WINDOW, dtype=int)
    x[3], xm[3] = of[50], 51
    rows, own = np.tile(x, (n, 1)), np.tile(xm, (n, 1))
    y, ym = rows.copy(), own.copy()
    y[:, -1], ym[:, -1] = of, np.arange(1, n + 1)
    got = {k: L.log_probabilities(v, rows, y, 0, (own, ym))[:, -1] for k, v in (("learned", w), ("not", flat))}
    # that of the class alone, with the vector of the member that was read
    alone = np.zeros_like(ym)
    classes = L.log_probabilities(w, rows, y, 0, (own, alone))[:, -1]
    for c in np.unique(of):
        assert np.exp(got["learned"] - classes)[of == c].sum() == pytest.approx(1, abs=1e-4)
        assert np.exp(got["not"] - classes)[of == c] == pytest.approx(mass[of == c] / mass[of == c].sum(), rel=1e-3)
    # another context, other shares
    rows[:, -1] = (x[-1] + 1) % L.HEAD
    other = L.log_probabilities(w, rows, y, 0, (own, ym))[:, -1] - L.log_probabilities(w, rows, y, 0, (own, alone))[:, -1]
    assert np.abs(other - (got["learned"] - classes))[of == of[-1]].max() > 0.01
    # the member that was read counts, too
    assert np.abs(L.log_probabilities(w, rows, y, 0, (alone, alone))[:, 4:] - L.log_probabilities(w, rows, y, 0, (own, alone))[:, 4:]).max() > 1e-3


def test_gradients_of_members_by_differences():
    rng = np.random.default_rng(9)
    mass, of, tree = some_trees(rng)
    w = weights(6) | tree
    m = rng.integers(0, len(mass) + 1, (2, 4, L.WINDOW))
    x, y = np.where(m > 0, of[m - 1], rng.integers(0, L.HEAD, m.shape))
    valid = (rng.random(y.shape) < 0.8).astype(np.float32)
    m[1][valid == 0] = 0
    both = (m[0], m[1])
    loss = lambda: -(L.log_probabilities(w, x, y, 0, both) * valid).sum(dtype=np.float64) / valid.sum()
    g = L.gradients(w, x, y, valid, both)
    for name in w.keys() & g.keys():
        at, d = g[name] if name in ("own", "deep") else (None, g[name])
        i = np.unravel_index(np.argmax(np.abs(d)), d.shape)
        own = i if at is None else (at[i[0]], *i[1:])
        old = w[name][own]
        w[name][own] = old + 1e-2
        up = loss()
        w[name][own] = old - 1e-2
        down = loss()
        w[name][own] = old
        assert (up - down) / 2e-2 == pytest.approx(d[i], rel=0.05, abs=1e-4), name


def test_training_tells_members_of_one_class_by_what_comes_before():
    counts = np.array([[i, 1000 if i < L.HEAD else 1] for i in range(2000)])
    c = L.Classes(counts, 2000)
    a, b = [np.flatnonzero(c.of == L.HEAD + 2)[i] for i in (0, -1)]
    ids = np.array(([5, a, 6, b] * 5)[: L.WINDOW + 1])
    rows, m = np.tile(c.of[ids], (20000, 1)), np.tile(c.member[ids], (20000, 1))
    w = L.fresh() | L.trees(c.mass, c.shared)
    done = L.train(w, rows, members=m)
    x, xm = rows[:1, :-1].astype(int), m[:1, :-1].astype(int)
    y, ym = rows[:1, 1:].astype(int), m[:1, 1:].astype(int)
    swap = np.where(ym == c.member[a], c.member[b], np.where(ym == c.member[b], c.member[a], 0))
    right, wrong = (L.log_probabilities(done, x, y, 0, (xm, t))[0, 4::2] for t in (ym, swap))
    assert (right > wrong + 1).all()  # nothing but the context tells them
    # and only what was met has moved; an average over shards takes it from those alone
    met = L._times_met(done, m)
    assert set(np.flatnonzero(met["own"])) == {c.member[a], c.member[b]}
    for k in ("own", "deep"):
        assert set(np.flatnonzero(np.abs(done[k] - w[k]).reshape(len(w[k]), -1).sum(axis=1))) == set(np.flatnonzero(met[k]))
    t = L._table(done, len(rows), met)
    back = L._with_rows(w, t["at"].to_numpy(), np.stack([t[f"x{i}"].to_numpy() for i in range(L.WIDTH)], axis=1))
    assert all(np.array_equal(back[k], done[k]) for k in done)


def test_a_rare_subword_is_scored_by_its_context(spark):
    rng = np.random.default_rng(11)
    v = L._vocabulary(open(L.VOCABULARY, "rb").read())
    words = [w for w in (f"{a}{b}{c}" for a in "bcdfgklmnprst" for b in "aeiou" for c in "bdglmnprst") if len(v.encode([w])[0]) == 1]
    head, (a, b) = words[: L.HEAD + 30], words[-2:]
    text = [" ".join(w for _ in range(20) for w in (*rng.choice(head, 6), *((head[0], a) if rng.random() < 0.5 else (head[1], b)))) for _ in range(400)]
    asked = [f"{head[2]} {head[i]} {w} {head[3]}" for i in (0, 1) for w in (a, b)]
    df = spark.createDataFrame([*enumerate(text), *((1000 + i, t) for i, t in enumerate(asked))], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in L.score_texts(df, F.col("doc_id") < 1000).collect()}
    right, wrong = got[1000] + got[1003], got[1001] + got[1002]
    assert right > wrong + 0.3
