"""The pipeline on a small table with one planted case for each stage."""

import random

import corpus_pipeline


def test_stages_take_effect_and_keep_clean_documents(spark, tmp_path):
    rng = random.Random(4)
    words = {"en": "the of and to in that is was for".split(), "de": "der die und das ist nicht ein mit von".split()}
    draw = lambda lang, n: " ".join(rng.choice(words[lang]) + rng.choice(["", "er", "en", "ing", "ung", "est"]) for _ in range(n))
    docs = [(i, draw("en" if i % 2 else "de", 60), "en" if i % 2 else "de", f"s{i % 2}") for i in range(30)]
    passage = draw("en", 25)
    docs += [(100, docs[3][1] + " one", "en", "s1"), (101, None, "en", "s1"), (102, "123 !", "en", "s1"),
             (103, draw("en", 20) + " " + passage, "en", "s1")]
    # the last source's documents all begin with one line
    docs += [(200 + i, "menu line\n" + draw("en", 40), "en", "s2") for i in range(10)]
    table = spark.createDataFrame([(*d, len(d[1] or "")) for d in docs], "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        frame = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = frame
        if name != corpus_pipeline.STAGES[-1][0]:
            assert frame.columns == table.columns
    ids = lambda name: {r["doc_id"] for r in seen[name].select("doc_id").collect()}
    every = {d[0] for d in docs}
    assert ids("language_id") == every - {101, 102}
    assert ids("line_dedup") == ids("language_id")
    assert all(not r["text"].startswith("menu") for r in seen["line_dedup"].where("source = 's2'").collect())
    assert ids("jaccard_join") == ids("line_dedup") - {100}
    assert ids("decontaminate") == ids("jaccard_join") - {103}
    assert ids("sentencepiece") == ids("decontaminate")
    assert seen["sentencepiece"].where("round_trip").count() == len(ids("sentencepiece"))
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == ids("sentencepiece")
