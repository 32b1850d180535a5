"""Language ID: phrase counts against a brute-force parse, held-out accuracy, edges."""

import random
import zlib

import numpy as np
import pytest

from starloom.llm import langid as L

SF = "/root/testdata/sf0.001"


def parse(train: str, text: str) -> int:
    """Greedy cross-parsing by substring search."""
    at = n = 0
    while at < len(text):
        k = 0
        while at + k < len(text) and text[at : at + k + 1] in train:
            k += 1
        at += max(1, k)
        n += 1
    return n


def test_phrases_equal_brute_force():
    rng = random.Random(5)
    word = lambda a: "".join(rng.choice(a) for _ in range(rng.randint(1, 7)))
    samples = {"x": [" ".join(word("abcd") for _ in range(80))], "y": [" ".join(word("cdeé") for _ in range(80))]}
    model = L.Model(samples)
    texts = [" ".join(word("abcdeéz.") for _ in range(rng.randint(0, 30))) for _ in range(60)]
    size, got = model.phrases(texts, model.table())
    for i, t in enumerate(texts):
        plain = L._plain(t)
        if not plain:
            assert size[i] == 0
            continue
        plain += " "  # a text ends in a blank
        assert size[i] == len(plain)
        for j, lang in enumerate(model.langs):
            train = " ".join(L._plain(s) for s in samples[lang])
            assert got[j, i] == sum(parse(train, plain[k : k + L.LANE]) for k in range(0, len(plain), L.LANE))


def test_query_contract_and_accuracy(spark):
    rows = L.op1_language_id(spark, SF).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    held = [r for r in rows if r["held_out"]]
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    right = np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held])
    assert right >= 0.95


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, "aaa bbb aaa", "x", "s"), (1, "aaa bbb aaa", "x", "s"), (2, None, "x", "s"), (3, "", None, "s"),
         (4, "12 !?", "y", "s"), (None, "ccc ddd", "y", None), (5, "ccc " * 20000, None, "s")],
        "doc_id long, text string, lang string, source string",
    )
    got = L.identify(docs, L.fit(docs)).collect()
    by = {(r["doc_id"], r["text"] if r["text"] is None else r["text"][:3]): r["lang_pred"] for r in got}
    assert len(got) == 7
    assert by[(1, "aaa")] == "x" and by[(None, "ccc")] == "y" and by[(5, "ccc")] == "y"
    assert by[(2, None)] == by[(3, "")] == by[(4, "12 ")] == "und"
    with pytest.raises(ValueError, match="exist"):
        L.identify(docs.withColumnRenamed("source", "score"), L.fit(docs))
    empty = docs.where("false")
    assert L.identify(docs, L.fit(empty)).select("lang_pred").distinct().collect()[0][0] == "und"
    assert L.identify(empty, L.fit(docs)).count() == 0
    kept = L.stage_language_id(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == 4


def test_copies_count_once_in_the_sample(spark):
    rows = spark.createDataFrame([("aa bb", "x")] * 50 + [("cc dd", "x"), ("ee", "y")], "text string, lang string")
    got = L.training_sample(rows, "text", "lang", per_language=2)
    assert sorted(got["x"]) == ["aa bb", "cc dd"] and got["y"] == ["ee"]
