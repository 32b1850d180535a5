"""License scans by diagonal voting. DataFrame functions only.

A template is a license's notice as words. Every rolling hash of ``GRAM`` words
of every document meets the templates' positions in a Spark join; a hit whose
words are really equal votes for the diagonal ``document place - template place``.
Votes are added up per diagonal; diagonals at most ``DRIFT`` apart, as a few
inserted or dropped words make them, are merged. Merged diagonals of ``CHAIN`` votes
and more are then chained where the document and the template both go on, as a
sentence put into a notice makes them. A chain, or a merged diagonal of one that fails,
is verified if its votes cover at least ``COVER`` of the template's positions and it is
no longer than ``STRETCH`` templates. Beside the templates, fixed phrases are found at
every place where their words stand in a row.

The template table is fixed, so it is broadcast. Votes are combined per task
before they are shuffled, by document, so no group exceeds one document.

Words are runs of characters other than ASCII blanks, signs and controls, with
A-Z lower-cased. Null and empty texts have no words and no labels. Repeated rows
give repeated rows, equal ones.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM = 4
DRIFT = 3
CHAIN = 3
COVER = 0.6
STRETCH = 1.5

# The phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Public license notices.
TEMPLATES = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so""",
    "mit-line": "Released under the MIT License",
    "apache-2.0-text": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at""",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0",
    "gpl-text": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation""",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3",
    "bsd-text": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met""",
    "mpl-2.0-text": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
        of the MPL was not distributed with this file, You can obtain one at""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
        is hereby granted, provided that the above copyright notice and this permission notice appear in all copies""",
    "unlicense-text": "This is free and unencumbered software released into the public domain",
    "cc-by-4.0-line": "Licensed under CC BY 4.0",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0",
}

# What separates words once A-Z are lower-cased.
_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text. ``lower`` also changes letters beyond ASCII; that
    neither makes nor breaks words, and no template or phrase holds such letters."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATOR), lambda w: w != "")


def _gram(at) -> Column:
    return F.xxhash64(*at)


def template_positions(spark, templates: dict[str, str] = TEMPLATES, gram: int = GRAM) -> DataFrame:
    """``grams, label, t_pos, t_grams, t_words``: every gram of every template. A
    template of fewer words than a gram is refused."""
    rows = []
    for label, text in templates.items():
        w = [x for x in re.split(_SEPARATOR, text.lower()) if x]
        if len(w) < gram:
            raise ValueError(f"template {label} has fewer than {gram} words")
        rows += [(label, i, len(w) - gram + 1, w[i : i + gram]) for i in range(len(w) - gram + 1)]
    table = spark.createDataFrame(rows, "label string, t_pos int, t_grams int, t_words array<string>")
    return table.withColumn("gram", _gram([F.col("t_words")[j] for j in range(gram)]))


def _votes(docs: DataFrame, templates: DataFrame, gram: int) -> DataFrame:
    """``key.., label, t_grams, diagonal, places``: per diagonal the template
    places that voted, and the first and last word of the span."""
    split = docs.select("key", "h1", "h2", words(F.col("text")).alias("w"))
    rolling = F.transform(
        F.sequence(F.lit(0), F.size("w") - gram), lambda i: _gram([F.get(F.col("w"), i + j) for j in range(gram)])
    )
    hashed = split.withColumn("grams", F.when(F.size("w") >= gram, rolling))
    # outer: a plain explode would push a filter on the hashes below the words and
    # so split the text once per word; the join drops the texts without grams
    placed = hashed.select("key", "h1", "h2", "w", F.posexplode_outer("grams").alias("pos", "gram"))
    hits = placed.join(F.broadcast(templates), "gram").where(
        F.slice("w", F.col("pos") + 1, gram) == F.col("t_words")
    )
    return (
        hits.select("key", "h1", "h2", "label", "t_grams", "pos", "t_pos")
        .distinct()
        .groupBy("key", "h1", "h2", "label", "t_grams", (F.col("pos") - F.col("t_pos")).alias("diagonal"))
        .agg(F.collect_list("t_pos").alias("places"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    )


def spans(docs: DataFrame, text: str, key: str, templates: DataFrame, gram: int = GRAM) -> DataFrame:
    """The verified spans: ``key, h1, h2`` (two hashes of the text), ``label``,
    ``first_word, last_word`` and ``cover``, the share of the template that voted."""
    rows = docs.select(F.col(key).alias("key"), *_text_hashes(F.col(text)), F.col(text).alias("text"))
    votes = _votes(rows, templates, gram)
    along = Window.partitionBy("key", "h1", "h2", "label").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    merged = votes.withColumn("new", F.when(gap <= DRIFT, 0).otherwise(1)).withColumn(
        "group", F.sum("new").over(along)
    )
    text_label = ["key", "h1", "h2", "label", "t_grams"]
    single = merged.groupBy(*text_label, "group").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        F.min("first").alias("first"), F.max("last").alias("last"),
    )
    strong = F.size("places") >= CHAIN
    on = Window.partitionBy("key", "h1", "h2", "label", strong).orderBy("first", "last", "group")
    whole = F.col("t_grams") + F.lit(gram - 1)
    goes_on = (
        strong & (F.array_min("places") > F.lag(F.array_max("places")).over(on)) & (F.col("first") > F.lag("last").over(on))
        & (F.col("first") - F.lag("last").over(on) <= (STRETCH - 1) * whole)
    )
    single = single.withColumn("breaks", F.when(goes_on, 0).otherwise(1)).withColumn("strong", strong).withColumn(
        "chain", F.sum("breaks").over(on.rowsBetween(Window.unboundedPreceding, 0))
    )

    def span(places: Column, first: Column, last: Column) -> Column:
        return F.struct(
            first.alias("first_word"), (last + F.lit(gram - 1)).alias("last_word"), (F.size(places) / F.col("t_grams")).alias("cover")
        )

    def holds(s: Column) -> Column:
        return (s["cover"] >= COVER) & (s["last_word"] - s["first_word"] + 1 <= STRETCH * whole)

    chains = single.groupBy(*text_label, "strong", "chain").agg(F.collect_list(F.struct("places", "first", "last")).alias("members"))
    members = F.transform("members", lambda m: span(m["places"], m["first"], m["last"]))
    every = span(
        F.array_distinct(F.flatten(F.transform("members", lambda m: m["places"]))),
        F.array_min(F.transform("members", lambda m: m["first"])), F.array_max(F.transform("members", lambda m: m["last"])),
    )
    verified = F.when(holds(every), F.array(every)).otherwise(F.filter(members, holds))
    return chains.select("key", "h1", "h2", "label", F.explode(verified).alias("s")).select("key", "h1", "h2", "label", "s.*")


def _text_hashes(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("h1"), F.hash(text).alias("h2")


def _phrase_places(w: Column) -> Column:
    """Start of every phrase, by its last word; each of these ends only one phrase."""

    def start(x: Column, i: Column) -> Column:
        out = F.lit(None).cast("int")
        for phrase in PHRASES:
            parts = phrase.split()
            here = x == parts[-1]
            for back, part in enumerate(reversed(parts[:-1]), 1):
                here = here & (i >= back) & (F.get(w, i - back) == part)
            out = F.when(here, i - (len(parts) - 1)).otherwise(out)
        return out

    return F.filter(F.transform(w, start), lambda x: x.isNotNull())


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``
    of every row. The score is 1 where a phrase stands, else the best cover."""
    spark = docs.sparkSession
    w = F.col("w")
    ends = {p.split()[-1] for p in PHRASES}
    may = F.lit(False)
    for e in sorted(ends):
        may = may | F.array_contains(w, e)
    first_words = {p.split()[0]: n for p, n in PHRASES.items()}

    def named(i: Column) -> Column:
        out = F.lit(None).cast("string")
        for word, name in first_words.items():
            out = F.when(F.get(w, i) == word, F.lit(name)).otherwise(out)
        return out

    none = F.array().cast("array<int>")
    rows = docs.select(F.col(key).alias("key"), *_text_hashes(F.col(text)), words(F.col(text)).alias("w"))
    rows = rows.withColumn("at", F.when(may, _phrase_places(w)).otherwise(none))
    base = rows.select(
        "key", "h1", "h2",
        F.size("w").cast("long").alias("n_words"),
        F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.transform("at", named))).alias("names"),
    )
    found = (
        spans(docs, text, key, template_positions(spark, templates))
        .groupBy(F.col("key").alias("k"), F.col("h1").alias("g1"), F.col("h2").alias("g2"))
        .agg(F.collect_set("label").alias("own"), F.max("cover").alias("cover"))
    )
    both = base.join(
        found, base["key"].eqNullSafe(found["k"]) & (base["h1"] == found["g1"]) & (base["h2"] == found["g2"]), "left"
    )
    own = F.coalesce("own", F.array().cast("array<string>"))
    return both.select(
        F.col("key").alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
        F.array_join("names", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("names", own)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
    )


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    """License phrases and templates in every whole document."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


__all__ = ["words", "template_positions", "spans", "scan", "op6_license_scan", "TEMPLATES", "PHRASES"]
