"""Spaced seeds: their guarantee, and pairs against comparing every alignment."""

import itertools
import random
import re

from starloom.llm import decontaminate as C

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items):
    out = set()
    for d, t in docs:
        w = [x.lower() for x in WORD.findall(t or "")]
        for i, s in items:
            v = [x.lower() for x in WORD.findall(s or "")]
            need, least = (C.WINDOW, C.WINDOW - C.MISMATCHES) if len(v) >= C.WINDOW else (len(v), len(v))
            if v and any(
                sum(a == b for a, b in zip(w[p : p + need], v[q : q + need], strict=True)) >= least
                for p in range(len(w) - need + 1) for q in range(len(v) - need + 1)
            ):
                out.add((d, i))
    return out


def test_masks_hit_every_window_with_the_allowed_mismatches():
    span = len(C.MASKS[0])
    for wrong in itertools.combinations(range(C.WINDOW), C.MISMATCHES):
        assert any(
            all(m[i] == "0" or o + i not in wrong for i in range(span))
            for m in C.MASKS for o in range(C.WINDOW - span + 1)
        )


def test_pairs_equal_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(60)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, draw(rng.randint(1, 30))) for i in range(20)]
    docs = []
    for d in range(120):
        w = draw(rng.randint(0, 40))
        if d % 2:
            v = list(rng.choice(items)[1])
            cut = rng.randint(0, max(0, len(v) - 12))
            v = v[cut : cut + rng.randint(8, 30)]
            for _ in range(rng.randint(0, 4)):
                v[rng.randrange(len(v))] = "changed"
            at = rng.randint(0, len(w))
            w = w[:at] + v + w[at:]
        docs.append((d, " ".join(x.title() if rng.random() < 0.2 else x for x in w) + "."))
    docs += [(500, None), (501, ""), (3, docs[3][1]), (None, " ".join(items[0][1] * 2))]
    items = [(i, ", ".join(v)) for i, v in items] + [(90, None), (91, ""), (0, ", ".join(items[0][1]))]
    got = C.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert len(got) == len({(r["doc_id"], r["item_id"]) for r in got})
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute(docs, items)


def test_empty_tables_and_stage(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c", 9), (None, "x y z", 8)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(7, "a b c", 0)], "item_id long, text string, doc_id int")
    assert C.contaminated(docs.where("false"), items).count() == 0
    assert C.contaminated(docs, items.where("false")).count() == 0
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = C.stage_decontaminate(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [None]


def test_stage_decides_by_row(spark, tmp_path):
    docs = [(None, "a b c d"), (None, "clean text"), (None, None), (1, "x a b c"), (1, "clean too"), (2, "clean text"), (2, "clean text")]
    spark.createDataFrame([(7, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = C.stage_decontaminate(spark, spark.createDataFrame(docs, "doc_id long, text string"), str(tmp_path))
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, (docs[i] for i in (1, 2, 4, 5, 6))))
