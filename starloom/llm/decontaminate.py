"""Benchmark decontamination by spaced seeds.

A seed hashes the words that a fixed mask selects from eight consecutive words;
the words the mask skips may differ. Together the two masks hit every aligned
stretch of ``WINDOW`` words in which at most ``MISMATCHES`` words were
substituted (checked over all placements in the tests). Training seeds meet the
benchmark's seeds in one equi-join, and only around a hit are words compared:
a document is contaminated by an item if some aligned ``WINDOW`` words agree in
all but ``MISMATCHES`` places.

Before the join a Bloom filter over the benchmark's seeds, of fixed size, drops
the training seeds that cannot match; the join itself decides.

Words are runs of ASCII letters, digits and characters beyond ASCII, with A-Z
lower-cased. An item of fewer than ``WINDOW`` words needs all its words, in a
row and unchanged. Null and empty texts, on either side, never match. Repeated
benchmark rows act once per item_id; repeated documents with one id give one
row. Null ids are kept as an id of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import textnum as N
from starloom.llm.scratch import ship, stored, unused

MASKS = ("10001111", "11011001")
WINDOW = 12
MISMATCHES = 2
# Bits of the Bloom filter; its size never depends on the data.
FILTER_BITS = 1 << 23

_SEEDS = "id long, rule int, seed long, pos int, lo int, hi int, context binary"


def _rules(window: int, masks: tuple[str, ...]) -> list[tuple[int, ...]]:
    """Word offsets of every rule: rule k < window hashes a whole item of k words,
    the rules after them are the masks. Rule 0 is unused."""
    whole = [tuple(range(k)) for k in range(window)]
    return whole + [tuple(i for i, c in enumerate(m) if c == "1") for m in masks]


def _seed_rows(ids, texts, pick, window, masks) -> Iterator[pa.RecordBatch]:
    """Seeds of the texts as rows. ``pick(rule, hashes, first, last)`` says which
    of a rule's positions to keep, given each position's text borders."""
    rules = _rules(window, masks)
    data = N.lowered(texts)
    for lo, hi in N.slices(data):
        h, first = N.words(data[lo:hi], N.ALNUM)
        owner = np.repeat(np.arange(hi - lo), np.diff(first))
        out: list[tuple] = []
        for rule, offsets in enumerate(rules):
            if not offsets:
                continue
            seed = N.grams(h, offsets)
            if not len(seed):
                continue
            keep = pick(rule, seed, owner, first)
            for p in keep:
                doc = owner[p]
                begin, end = first[doc], first[doc + 1]
                left, right = max(begin, p - window), min(end, p + offsets[-1] + 1 + window)
                out.append((ids[lo + doc], rule, seed[p], p - begin, p - left, right - p, h[left:right].tobytes()))
        if out:
            c = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(c[0], pa.int64()),
                    pa.array(c[1], pa.int32()),
                    pa.array(np.array(c[2], dtype=np.uint64).view(np.int64)),
                    pa.array(c[3], pa.int32()),
                    pa.array(c[4], pa.int32()),
                    pa.array(c[5], pa.int32()),
                    pa.array(c[6], pa.binary()),
                ],
                names=["id", "rule", "seed", "pos", "lo", "hi", "context"],
            )


def _inside(offsets, owner, n):
    """Positions whose last word belongs to the same text."""
    return owner[:n] == owner[offsets[-1] : offsets[-1] + n]


def benchmark_seeds(items: DataFrame, item_id: str, text: str, window: int = WINDOW, masks=MASKS) -> DataFrame:
    rules = _rules(window, masks)

    def run(batches):
        for b in batches:
            def pick(rule, seed, owner, first):
                ok = _inside(rules[rule], owner, len(seed))
                count = np.diff(first)[owner[: len(seed)]]
                # a whole-item rule is for items of exactly that many words
                ok &= (count == rule) if rule < window else (count >= window)
                return np.flatnonzero(ok)

            yield from _seed_rows(b.column(0).to_pylist(), b.column(1).to_pylist(), pick, window, masks)

    chosen = items.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text"))
    return chosen.distinct().mapInArrow(run, _SEEDS)


def _filter(seeds: DataFrame, bits: int) -> np.ndarray:
    """Bit per bucket of the benchmark's seeds; at most ``bits`` numbers are read."""
    buckets = seeds.select((F.pmod(F.col("seed"), F.lit(bits))).cast("int").alias("b")).distinct()
    got = buckets.toPandas()["b"].to_numpy()
    out = np.zeros(bits, dtype=bool)
    out[got] = True
    return np.packbits(out)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    mismatches: int = MISMATCHES,
    masks: tuple[str, ...] = MASKS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """One row per document and item that overlap: ``doc_id, item_id, matched``
    (most equal words in one window), ``first_word, last_word`` (the words covered
    by overlapping windows, from 0) and ``n_words`` (how many they are at most).
    """
    spark = docs.sparkSession
    ship(spark)
    rules = _rules(window, masks)
    tests = stored(benchmark_seeds(items, item_id, item_text, window, masks), "bench-seeds")
    bitmap = spark.sparkContext.broadcast(_filter(tests, filter_bits))
    # whole-item rules only for the lengths that occur (at most window - 1 of them)
    used = {r[0] for r in tests.select("rule").distinct().collect()}

    def run(batches):
        bits = np.unpackbits(bitmap.value).view(bool)

        def pick(rule, seed, owner, first):
            if rule not in used:
                return ()
            hit = np.flatnonzero(bits[seed & np.uint64(filter_bits - 1)])
            o = rules[rule][-1]
            return hit[owner[hit] == owner[hit + o]]

        for b in N.parts(batches, 1):
            yield from _seed_rows(b.column(0).to_pylist(), b.column(1).to_pylist(), pick, window, masks)

    def compare(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                before, after = min(r["lo"], r["t_lo"]), min(r["hi"], r["t_hi"])
                x = np.frombuffer(r["context"], dtype=np.uint64)[r["lo"] - before : r["lo"] + after]
                y = np.frombuffer(r["t_context"], dtype=np.uint64)[r["t_lo"] - before : r["t_lo"] + after]
                whole = r["rule"] < window  # a short item: all its words, unchanged
                need = r["rule"] if whole else window
                if len(x) < need:
                    continue
                run_ = np.concatenate(([0], np.cumsum(x == y)))
                score = run_[need:] - run_[:-need]
                good = np.flatnonzero(score >= (need if whole else need - mismatches))
                if len(good):
                    at = r["pos"] - before
                    rows.append((r["id"], r["item_id"], int(score.max()), at + int(good[0]), at + int(good[-1]) + need - 1))
            if rows:
                c = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int32()),
                     pa.array(c[3], pa.int64()), pa.array(c[4], pa.int64())],
                    names=["id", "item_id", "matched", "first_word", "last_word"],
                )

    train = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, _SEEDS)
    seeds = tests.select(
        F.col("id").alias("item_id"), "rule", "seed",
        F.col("lo").alias("t_lo"), F.col("hi").alias("t_hi"), F.col("context").alias("t_context"),
    )
    hits = train.join(seeds, ["rule", "seed"]).mapInArrow(
        compare, "id long, item_id long, matched int, first_word long, last_word long"
    )
    return (
        hits.groupBy(F.col("id").alias("doc_id"), "item_id")
        .agg(
            F.max("matched").alias("matched"),
            F.min("first_word").alias("first_word"),
            F.max("last_word").alias("last_word"),
        )
        .withColumn("n_words", F.col("last_word") - F.col("first_word") + 1)
    )


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Contaminated (document, item) pairs of all documents against all items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return contaminated(docs, items)


def stage_decontaminate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows that hold no benchmark passage. A row is known by its id
    and text, so rows that share an id, or have none, are decided one by one."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    row = F.xxhash64("doc_id", "text")
    (name,) = unused(docs.columns, "_bad")
    bad = contaminated(docs.select(row.alias("doc_id"), "text"), items).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(bad, row == F.col(name), "left_anti")


__all__ = ["benchmark_seeds", "contaminated", "op10_decontaminate", "stage_decontaminate"]
