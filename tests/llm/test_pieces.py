"""The lattice against a plain Viterbi, exact round trips, edges."""

import random

import pytest

from starloom.llm import pieces as P


def viterbi(text, p):
    if not text:
        return []
    t, table = " " + text, {x: (i, s) for i, (x, s, n) in enumerate(zip(p.text, p.score, p.normal, strict=True)) if n}
    low = min(s for s, n in zip(p.score, p.normal, strict=True) if n) - P.UNKNOWN_PENALTY
    best, path = [0.0] + [None] * len(t), [[]] + [None] * len(t)
    for e in range(1, len(t) + 1):
        for s in range(max(0, e - p.longest), e):
            if t[s:e] in table:
                i, w = table[t[s:e]]
                ids = [i]
            elif e - s == 1:
                w, ids = low, [p.byte[x] for x in t[s:e].encode()] if p.byte else [p.unknown]
            else:
                continue
            if best[e] is None or best[s] + w > best[e]:
                best[e], path[e] = best[s] + w, path[s] + ids
    return path[-1]


@pytest.fixture(scope="module")
def model():
    return P.read_model()


def texts():
    rng = random.Random(2)
    out = [None, "", " ", "  two  blanks ", "tab\tand\nline", "Ａﬁ é é ▁ mark", "日本語 текст 🙂", "a" * 500, "…" * 200]
    letters = "etaoin shrdlu.,%é\n12"
    out += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 200))) for _ in range(40)]
    return out


@pytest.mark.parametrize("frequent", [0, 8, 1 << 20])
def test_ids_equal_plain_viterbi(spark, model, frequent):
    rows = list(enumerate(texts())) + [(3, "  two  blanks "), (None, "no id"), (3, "another text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    coded = P.encode(df, "doc_id", "text", model, frequent=frequent)
    got = P.decode(coded, "ids", model, "back").collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["back"]): r["ids"] for r in got}
    for d, t in rows:
        if t is None:
            assert by[(d, None)] is None
        else:  # also the exact round trip; a run beyond the unit length may be cut
            assert P.Decoder(model).text(by[(d, t)]) == t
            if max(map(len, P.units(" " + t)), default=0) < P.UNIT:
                assert by[(d, t)] == viterbi(t, model)


@pytest.mark.parametrize("frequent", [0, 1 << 20])
def test_ids_of_long_runs_equal_plain_viterbi(spark, model, frequent):
    rng = random.Random(5)
    runs = ["".join(rng.choice(letters) for _ in range(n)) for letters in ("etaoinshrdlu", "日本語文字の中国人大", "=-*#", " ", "aé🙂")
            for n in (P.UNIT - 1, P.UNIT, P.UNIT + 1, 200)]
    words = "the internationalization of representatives".replace(" ", "")
    rows = list(enumerate([*runs, words * 9, f"a {words * 9} b " * 2, "x" * 3000]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["ids"] for r in P.encode(df, "doc_id", "text", model, frequent=frequent).collect()}
    for d, t in rows:
        assert got[d] == viterbi(t, model), t[:80]
        assert P.Decoder(model).text(got[d]) == t


def test_without_byte_pieces(spark):
    p = P.Pieces([" a", "b", "?", " "], [-1.0, -2.0, 0.0, -3.0], [True, True, False, True], [], 2)
    df = spark.createDataFrame([(1, "ab"), (2, "xb")], "doc_id long, text string")
    got = {r["doc_id"]: r["ids"] for r in P.encode(df, "doc_id", "text", p).collect()}
    assert got == {1: [0, 1], 2: [3, 2, 1]}


def test_empty_table_and_clash(spark, model):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.encode(df, "doc_id", "text", model).count() == 0
    with pytest.raises(ValueError, match="exists"):
        P.decode(spark.createDataFrame([([1], "x")], "ids array<int>, text string"), "ids", model)


def test_query_round_trips(spark):
    got = P.op7_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in got)


def test_units_folded_together_take_the_path_of_each_alone(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(P, "FOLD", 3)
    pieces = P.Pieces(["a", "b", "ab", "ba", "aba", " ", " a", "<unk>"], [-3.0, -3.0, -6.0, -5.0, -8.0, -1.0, -4.0, 0.0], [True] * 7 + [False], [], 7)
    known = {t: (i, c) for i, (t, c, n) in enumerate(zip(pieces.text, pieces.costs()[:-1], pieces.normal, strict=True)) if n}
    rng = np.random.default_rng(5)
    units = {"".join(rng.choice(list("ab é"), n)) for n in rng.integers(1, 12, 60)} | {"é", " ", "ab" * 31, "ab" * 40}
    frame = spark.createDataFrame([(u,) for u in units], "unit string")
    want = {u: [7 if p < 0 else p for p, _ in P.long_path(u, known, pieces.longest, pieces.costs()[-1])] for u in units}
    assert {r["unit"]: r["ids"] for r in P.encode_units(frame, pieces).collect()} == want
    packed = P.encode_units(frame, pieces, packed=True).collect()
    assert {r["unit"]: np.frombuffer(r["ids"], dtype="<i4").tolist() for r in packed} == want
