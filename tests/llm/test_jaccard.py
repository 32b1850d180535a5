"""The join against all pairs by brute force, near the threshold and in long runs."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from starloom.llm import jaccard as J
from starloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    group = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        group[find(i)].append(d)
    return sorted(
        (d, len(s), d if not s else min((x for x in group[find(i)] if x is not None), default=None))
        for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)) if d is not None
    )


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows = []
    for _ in range(6):  # families of near copies around the threshold
        base = draw(rng.randint(20, 60))
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append(w)
    shared = draw(30)
    rows += [draw(rng.randint(1, 14)) + shared + draw(rng.randint(1, 14)) for _ in range(60)]  # one passage, many texts
    rows += [draw(rng.randint(0, 12)) for _ in range(40)]
    rows += [list(rows[0]) for _ in range(30)]
    texts = [" ".join(x.upper() if rng.random() < 0.1 else x for x in w) for w in rows]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(J, "NEAR_SHARE", 1)
    monkeypatch.setattr(J, "BLOCK", 16)  # long runs are cut into several blocks
    rows = corpus(seed)
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "One two"), (1004, "one TWO"), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df).collect())
    assert got == brute(rows)


def test_bounds():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a = np.unique(rng.integers(0, 400, rng.integers(1, 300), dtype=np.uint64))
        b = np.unique(rng.integers(0, 400, rng.integers(1, 300), dtype=np.uint64))
        both = len(np.intersect1d(a, b))
        assert J.least_difference(J.bitmap(a), J.bitmap(b)) <= len(a) + len(b) - 2 * both
        assert J.suffix_bound(a, b) >= both
        links = 100 * both >= 75 * (len(a) + len(b) - both)
        assert (J.overlap(a.tobytes(), b.tobytes(), 75, 100) >= 0) == links
        maps = J._Bitmaps([J.bitmap(a), J.bitmap(b)])
        assert maps.differences(np.array([0]), np.array([1]))[0] == J.least_difference(J.bitmap(a), J.bitmap(b))


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert J.jaccard_components(empty).count() == 0
    docs = spark.createDataFrame(
        [(3, "a b c d e f g h", 1, 1), (2, "a b c d e f g h", 2, 2), (None, "a b c d e f g h", 3, 3), (4, None, 0, 0)],
        "doc_id long, text string, component_id int, `class` int",
    )
    got = {(r["doc_id"], r["component_id"]) for r in J.jaccard_components(docs).collect()}
    assert got == {(3, 2), (2, 2), (None, 2), (4, 4)}
    kept = J.stage_jaccard(spark, docs, "")
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {2, None, 4}


def test_stage_decides_by_row(spark):
    one, two, near = "a b c d e f g h", "i j k l m n o p", "a b c d e f g h " + "q r s t u v w x y z " * 4
    docs = [
        (5, one, 1), (5, one, 2), (5, one, 1),  # repeated rows of the smallest id: one stays
        (6, one, 3), (6, two, 4), (6, None, 5),  # its copy goes, its own texts stay
        (8, near, 6), (7, near + "end", 7), (7, "only here", 8),
        (None, one, 9), (None, one, 10), (None, two + " x y", 11), (None, "", 12), (None, "", 12),
        (None, "of null ids alone in all copies", 13), (None, "of null ids alone in all copies", 13),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n int").repartition(3)
    kept = J.stage_jaccard(spark, frame, "")
    assert kept.columns == frame.columns
    want = [(5, one, 1), (6, two, 4), (6, None, 5), (7, near + "end", 7), (7, "only here", 8), (None, one, 9),
            (None, two + " x y", 11), (None, "", 12), (None, "", 12), (None, "of null ids alone in all copies", 13)]
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, want))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(50)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(50)}}
