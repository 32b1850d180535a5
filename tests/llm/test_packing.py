"""Packing against its contract, the tokenizer and a plain placing rule."""

import random
import zlib

import numpy as np
import pytest

from starloom.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.VOCABULARY)


def check(rows, ids_of, window=1024, padding=0):
    """Every id in one piece, every sequence gapless and short enough; ``padding`` at most."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids_of)
    for doc, pieces in by_doc.items():
        ids = np.array(ids_of[doc], dtype="<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    wasted = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
        wasted += 0 if at & (at - 1) == 0 else window - at
    assert wasted <= padding
    return by_seq


def test_query_packs_every_id(spark, tokenizer):
    d = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    ids = {k: tokenizer.encode(t, add_special_tokens=False).ids + [P.END] for k, t in docs.items()}
    rows = P.op13_packing(spark, d).collect()
    by_seq = check(rows, ids)
    total = sum(map(len, ids.values()))
    assert len(by_seq) <= total / 1024 + 20
    assert sum(r["length"] for r in rows) == total


def test_ids_of_any_text_equal_the_tokenizers(tokenizer, monkeypatch):
    rnd = random.Random(5)
    signs = list("ab \n\t\r\x0b\x1c\x85\xa0 ​　.'s1é漢") + ["<|endoftext|>", "don't", "   "]
    encoder = P.Encoder(P.VOCABULARY)
    assert encoder.fast is not None
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += ["^" * 5000, " " * 9000 + "x", "é" * 20_000, "a\n" * 9000, "<|endoftext|>" * 600, "漢" * 4095 + " " + "漢" * 4096]
    want = [t.ids + [0] for t in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for stretch, fast in ((1 << 20, encoder.fast), (7, encoder.fast), (1 << 20, None)):
        monkeypatch.setattr(P, "STRETCH", stretch)
        encoder.fast = fast
        assert [encoder.ids(t).tolist() for t in texts] == want
    assert encoder.ids(None).tolist() == encoder.ids("").tolist() == [0]


def test_both_libraries_agree_on_every_code_point(tokenizer):
    fast = P.ranked(tokenizer)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(points), 1 << 16):
        texts = [f"a{c}b {c}1{c} !{c}  x{c}{c} 's{c}" for c in points[lo : lo + (1 << 16)]]
        want = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        assert fast.encode_batch(texts, num_threads=4, allowed_special="all") == want


def test_other_tokenizers_are_not_taken_for_plain_ones():
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(P.VOCABULARY.replace("byte_bpe_50k", "word_bpe_49k"))
    assert P.ranked(other) is None
    encoder = P.Encoder(P.VOCABULARY.replace("byte_bpe_50k", "word_bpe_49k"))
    text = "Some WORDS, 12 of them " * 50
    assert encoder.ids(text).tolist() == other.encode(text, add_special_tokens=False).ids + [0]


def plain_level(levels, size, window):
    """The rule, tried out level by level."""
    def squares(held):
        return sum(held.count(h) ** 2 for h in set(held))

    best = None
    for h in sorted({0, *levels}):
        if h + size > window:
            continue
        after = list(levels)
        if h:
            after.remove(h)
        if h + size < window:
            after.append(h + size)
        value = squares(after)
        if best is None or value <= best[0]:  # among equals the fullest
            best = (value, h)
    return best[1]


def test_the_level_leaves_the_least_sum_of_squares():
    rnd = random.Random(6)
    packer = P.Packer(window=16)
    for i in range(600):
        size = rnd.randint(1, 15)
        levels = [h for h in range(16) for _ in packer.at[h]]
        assert packer.level(size) == plain_level(levels, size, 16)
        assert [int(c) for c in packer.counts[:16]] == [len(a) for a in packer.at]
        packer.add(i, np.arange(size, dtype=np.int32))


@pytest.mark.parametrize("sizes", [[9] * 200, [1] * 50, [16] * 3, [8, 8, 9, 40, 100, 3], [15, 2] * 40, []])
@pytest.mark.parametrize("most_open", [1, 3, 4096])
def test_any_sizes_leave_no_padding(sizes, most_open):
    packer = P.Packer(window=16, most_open=most_open, first_id=100)
    docs = {i: list(range(i, i + n)) for i, n in enumerate(sizes)}
    for i, ids in docs.items():
        packer.add(i, np.array(ids, dtype=np.int32))
        assert packer.n_open <= most_open
    packer.finish()
    names = P.SCHEMA.replace(" long", "").split(", ")
    by_seq = check([dict(zip(names, r)) for r in packer.rows], docs, window=16)
    assert sorted(by_seq) == list(range(100, 100 + len(by_seq)))
    assert packer.n_open == 0 and not packer.counts.any()
    assert sum(len(r) > 0 for r in by_seq.values()) <= sum(sizes) / 16 + 5


def test_documents_stay_whole_until_the_end():
    """While documents come, only those of a whole window and more are cut."""
    packer = P.Packer()
    rng = np.random.default_rng(7)
    for i in range(2000):
        packer.add(i, np.zeros(int(rng.integers(1, 900)), dtype=np.int32))
    assert all(r[1] == 0 and r[2] == r[4] for r in packer.rows)


def test_nulls_long_texts_repeats_and_extra_columns(spark, tokenizer):
    long = "some words " * 200_000 + "x" * 3000
    rows = [(1, None, 1), (2, "", 2), (None, "a b", 3), (4, long, 4), (5, "same", 5), (5, "same", 6), (6, "<|endoftext|> x", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    got = P.pack_documents(df.coalesce(1)).collect()
    assert len([r for r in got if r["doc_id"] == 5]) == 2
    texts = {d: t or "" for d, t, _ in rows if d != 5}
    for d, t in texts.items():
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], dtype="<u4")
        own = sorted((r for r in got if r["doc_id"] == d), key=lambda r: r["start"])
        assert sum(r["length"] for r in own) == len(ids)
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in own)


def test_empty_table_and_wrong_arguments(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert P.pack_documents(empty).collect() == []
    with pytest.raises(ValueError):
        P.pack_documents(empty, window=1000)
    with pytest.raises(ValueError):
        P.pack_documents(empty, most_open=0)
