"""Phrases against a plain scan; votes, drift and verification; edges."""

import re

from starloom.llm import license as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def base(text):
    w, at, labels = WORD.findall((text or "").translate(LOWER)), [], set()
    for phrase, label in L.PHRASES.items():
        q = phrase.split()
        here = [i for i in range(len(w) - len(q) + 1) if w[i : i + len(q)] == q]
        at += here
        labels |= {label} if here else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def columns(r):
    return r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]


def test_query_against_plain_scan(spark):
    sf = "/root/testdata/sf0.001"
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = L.op6_license_scan(spark, sf).collect()
    assert len(got) == len(text)
    for r in got:
        assert columns(r) == base(text[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1) >= (r["n_base"] > 0)


def test_templates_survive_edits_and_edges(spark):
    mit = L.TEMPLATES["mit-text"]
    edited = mit.replace("charge", "cost").replace("deal in", "deal freely in")  # a change and an insertion
    rows = [
        (1, "pre " + mit + " post"), (2, "some words before " + edited), (3, "Permission is hereby granted, free of all."),
        (4, None), (5, ""), (6, "MIT License. mit-license the MIT\x00LICENSE"), (7, "İ mit license é"), (8, "mİt license"),
        (9, "general public license " * 3000), (6, "MIT License. mit-license the MIT\x00LICENSE"), (None, "apache license"),
        (10, "Licensed under CC BY-NC 4.0. " * 40),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "'x' as label")
    got = L.scan(df).collect()
    assert len(got) == len(rows)
    text = {}
    for d, t in rows:
        text[d] = t
    by = {r["doc_id"]: r for r in got}
    for d, r in by.items():
        assert columns(r) == base(text[d]), d
    assert by[1]["labels"] == "mit-text" and by[1]["score"] == 1.0
    assert by[2]["labels"] == "mit-text" and L.COVER <= by[2]["score"] < 1
    assert by[3]["labels"] == "" and by[3]["score"] == 0 and by[4]["labels"] == ""
    assert by[10]["labels"] == "cc-by-nc-4.0-line"
    assert L.scan(df.where("false")).count() == 0


def _labels(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["labels"] for r in L.scan(df).orderBy("doc_id").collect()]


def test_a_sentence_put_into_a_notice(spark):
    """Eight words after the 30th, at two places, or a stray repetition between."""
    w = L.TEMPLATES["mit-text"].split()
    extra = "by the holder named above in this very file".split()
    one = " ".join([*w[:30], *extra[:8], *w[30:]])
    two = " ".join([*w[:20], *extra, *w[20:40], *extra, *w[40:]])
    stray = " ".join([*w[:30], *w[2:6], "and so on", *w[30:]])
    far = " ".join([*w[:30], *(["else"] * 60), *w[30:]])  # no longer one notice
    assert _labels(spark, one, two, stray, far) == ["mit-text", "mit-text", "mit-text", ""]
    df = spark.createDataFrame([(1, "intro " + one + " outro")], "doc_id long, text string")
    (s,) = [r for r in L.spans(df, "text", "doc_id", L.template_positions(spark)).collect() if r["label"] == "mit-text"]
    assert (s["first_word"], s["last_word"]) == (1, len(WORD.findall(one))) and s["cover"] > 0.9


def test_a_failed_chain_keeps_its_notices(spark):
    """Of a whole notice and the half of another behind it the whole one stays."""
    w = L.TEMPLATES["mit-text"].split()
    assert _labels(spark, " ".join([*w[:45], "x", *w[30:], *w[:20]])) == ["mit-text"]
    assert _labels(spark, " ".join([*w, *w[:20], *w[40:], *w])) == ["mit-text"]


def test_spans_are_where_the_template_stands(spark):
    text = "one two three " + L.TEMPLATES["gpl-3.0-line"] + " four " + L.TEMPLATES["gpl-3.0-line"]
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    table = L.template_positions(spark)
    got = {(r["first_word"], r["last_word"]) for r in L.spans(df, "text", "doc_id", table).collect() if r["label"] == "gpl-3.0-line"}
    assert got == {(3, 14), (16, 27)}
