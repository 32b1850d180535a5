"""Language identification by cross-parsing entropy.

Per language, labelled text becomes a suffix automaton. A document is parsed
greedily against each automaton: every phrase is the longest match from where
the last one ended, so a language's text falls into few, long phrases. The
phrases, times the logarithm of the training length, over the symbols parsed
estimate the cross entropy in bits per symbol; the language needing fewest
normalised phrases wins.

*Fit.* A bounded sample of labelled rows, which the operator's parameters state:
of each language the ``TRAIN_TEXTS`` distinct texts with the smallest text
hashes, in hash order, up to ``TRAIN_SYMBOLS`` symbols. So copies count once,
and neither ids, sources nor row order matter. The automata are of that bounded
size times the number of languages.

*Symbols.* Letters, lower-cased; every run of other characters is one blank.
Letters beyond the ``ALPHABET`` most frequent ones of the sample share one
symbol that no automaton holds, so each is a phrase by itself.

*Parsing.* Whole texts, in lanes of ``LANE`` symbols that run side by side in
numpy; a phrase ends at a lane's border, alike for every language.

Null texts and texts without a letter get ``und`` and score 0. Ties go to the
smaller language. With no labelled text every text is ``und``. The score, from 0
to 1, is the winner's share of the softmax over the bits the text would save.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.scratch import ship, unused
from starloom.llm.textnum import parts

TRAIN_TEXTS = 400
TRAIN_SYMBOLS = 24_000
ALPHABET = 250
LANE = 512
SAMPLE_PARTS = 64
BATCH_SYMBOLS = 2 << 20
UNKNOWN = "und"

_FLAG = np.int32(1 << 30)


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def _code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _plain(text: str) -> str:
    """Lower-cased letters with one blank for every run of anything else."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


class Automaton:
    """The suffix automaton of one text as a dense transition table.

    ``step[state, symbol]`` is the next state; where the text has no such
    continuation it is the state after the symbol alone, with ``_FLAG`` set: a
    new phrase has begun. Symbol 0 is the unknown one.
    """

    def __init__(self, symbols: list[int], width: int):
        nxt: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for s in symbols:
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and s not in nxt[p]:
                nxt[p][s] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][s]
                if length[q] == length[p] + 1:
                    link[cur] = q
                else:
                    twin = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and nxt[p].get(s) == q:
                        nxt[p][s] = twin
                        p = link[p]
                    link[q] = link[cur] = twin
            last = cur
        # the last state follows a symbol the text lacks, and is where parsing starts
        self.start = len(nxt)
        root = np.full(width, self.start | _FLAG, dtype=np.int32)
        for s, q in nxt[0].items():
            root[s] = q | _FLAG
        step = np.tile(root, (len(nxt) + 1, 1))
        for state, edges in enumerate(nxt):
            for s, q in edges.items():
                step[state, s] = q
        self.step = step.reshape(-1)
        self.bits = math.log2(max(2, len(symbols)))


class Model:
    """Automata of all languages over one alphabet."""

    def __init__(self, samples: dict[str, list[str]], symbols: int = TRAIN_SYMBOLS, alphabet: int = ALPHABET):
        plain = {}
        for lang in sorted(samples):
            joined = " ".join(p for p in map(_plain, samples[lang]) if p)[:symbols]
            if joined:
                plain[lang] = joined
        counts = Counter(c for t in plain.values() for c in t if c != " ")
        letters = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:alphabet]]
        # 0 unknown letter, 1 blank, 2.. letters
        code = {" ": 1} | {c: i + 2 for i, c in enumerate(letters)}
        self.letters = letters
        self.width = len(letters) + 2
        self.langs = list(plain)
        self.automata = [Automaton([code.get(c, 0) for c in t], self.width) for t in plain.values()]

    def table(self) -> np.ndarray:
        """Symbol of every code point."""
        t = np.where(_is_letter(), 0, 1).astype(np.uint8)
        for i, c in enumerate(self.letters):
            t[ord(c)] = i + 2
        return t

    def phrases(self, texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(letters and blanks parsed, phrases per language)`` of each text."""
        low = [t.lower() + "\n" for t in texts]
        sym = table[_code_points(low)]
        owner = np.repeat(np.arange(len(low)), [len(t) for t in low])
        keep = sym != 1
        keep[1:] |= sym[:-1] != 1  # the first blank of a run
        sym, owner = sym[keep], owner[keep]
        has = np.bincount(owner, weights=sym != 1, minlength=len(low)) > 0
        # a text that starts with blanks keeps none: texts end in a blank of their own
        size = np.bincount(owner, minlength=len(low))
        start = np.cumsum(size) - size
        lanes = -(-size // LANE)
        lane_doc = np.repeat(np.arange(len(low)), lanes)
        lane_no = np.arange(len(lane_doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = start[lane_doc] + lane_no * LANE
        left = np.minimum(size[lane_doc] - lane_no * LANE, LANE)
        order = np.argsort(-left, kind="stable")  # longest lanes first: the running ones are a prefix
        begin, left, lane_doc = begin[order], left[order], lane_doc[order]
        out = np.zeros((len(self.langs), len(low)), dtype=np.int64)
        running = np.searchsorted(-left, -np.arange(LANE), side="left")  # lanes longer than k
        wide = np.int32(self.width)
        state = np.array([a.start for a in self.automata], dtype=np.int32)[:, None].repeat(len(begin), axis=1)
        count = np.zeros((len(self.langs), len(begin)), dtype=np.int32)
        for k in range(int(left[0]) if len(left) else 0):
            n = running[k]
            s = sym[begin[:n] + k].astype(np.int32)
            for j, a in enumerate(self.automata):
                got = a.step.take(state[j, :n] * wide + s)
                count[j, :n] += got >> 30
                state[j, :n] = got & (_FLAG - 1)
        for j in range(len(self.langs)):
            out[j] = np.bincount(lane_doc, weights=count[j], minlength=len(low))
        return np.where(has, size, 0), out

    def classify(self, texts: list[str | None], table: np.ndarray) -> Iterator[tuple[str, float, float]]:
        """``(language, score, bits per symbol)`` of each text."""
        lo = 0
        while lo < len(texts):
            hi, total = lo, 0
            while hi < len(texts) and (hi == lo or total + len(texts[hi] or "") <= BATCH_SYMBOLS):
                total += len(texts[hi] or "")
                hi += 1
            size, got = self.phrases([t or "" for t in texts[lo:hi]], table)
            bits = got * np.array([a.bits for a in self.automata])[:, None] if self.langs else got
            for i in range(hi - lo):
                if not size[i] or not self.langs:
                    yield UNKNOWN, 0.0, 0.0
                    continue
                b = bits[:, i]
                best = int(np.argmin(b))
                share = 1.0 / float(np.exp2(np.maximum(b[best] - b, -60.0)).sum())
                yield self.langs[best], share, float(b[best]) / int(size[i])
            lo = hi


def training_sample(rows: DataFrame, text: str, lang: str, per_language: int = TRAIN_TEXTS) -> dict[str, list[str]]:
    """The texts with the smallest hashes of each language: at most
    ``per_language`` a language, copies once."""
    hashed = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.xxhash64(text).alias("h"), F.col(text).alias("text")
    )
    distinct = hashed.select("lang", "h").distinct().withColumn("part", F.pmod(F.hash("h"), F.lit(SAMPLE_PARTS)))

    def least(rows: DataFrame, *by: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("h"))
        return rows.withColumn("rank", rank).where(F.col("rank") <= per_language).drop("rank")

    # first within parts of a language, so no task sees all of its hashes
    chosen = least(least(distinct, "lang", "part"), "lang")
    keys = {(r["lang"], r["h"]) for r in chosen.select("lang", "h").collect()}
    if not keys:
        return {}
    hashes = sorted({h for _, h in keys})
    # one text per (language, hash), cut to what the fit can use at most
    texts = (
        hashed.where(F.col("h").isin(hashes))
        .groupBy("lang", "h")
        .agg(F.min(F.substring("text", 1, 4 * TRAIN_SYMBOLS)).alias("text"))
        .collect()
    )
    out: dict[str, list[str]] = {}
    for r in sorted((r for r in texts if (r["lang"], r["h"]) in keys), key=lambda r: (r["lang"], r["h"])):
        out.setdefault(r["lang"], []).append(r["text"])
    return out


def fit(rows: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    return Model(training_sample(rows, text, lang))


def identify(docs: DataFrame, model: Model, text: str = "text", out: tuple[str, str, str] = ("lang_pred", "score", "bits")) -> DataFrame:
    """``docs`` with the predicted language, its score and its bits per symbol.
    The three new columns must not be among those of ``docs``."""
    clash = set(out) & set(docs.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    names = [*docs.columns, *out]

    def run(batches):
        m = shared.value
        table = m.table()
        for b in parts(batches, at):
            got = list(zip(*m.classify(b.column(at).to_pylist(), table), strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(got[0], pa.string()), pa.array(got[1], pa.float64()), pa.array(got[2], pa.float64())],
                names=places,
            )

    # by place: Spark's call resolves names, and a dot in one would not be found
    places = [f"c{i}" for i in range(len(names))]
    kinds = [*(f.dataType for f in docs.schema), T.StringType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField(c, k) for c, k in zip(places, kinds, strict=True)])
    return docs.toDF(*places[: len(docs.columns)]).mapInArrow(run, schema).toDF(*names)


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every whole text; learned from two thirds of the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    model = fit(docs.where(~F.coalesce(held, F.lit(False))).select("text", "lang"))
    rows = docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text")
    return identify(rows, model).drop("text")


def stage_language_id(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents in a learned language; texts that are null or
    have no letter are rejected. Learns from the labelled ones of its input."""
    columns = docs.columns
    model = fit(docs.select("text", "lang"))
    out = unused(columns, "_lang", "_score", "_bits")
    found = identify(docs, model, out=tuple(out))
    return found.where(F.col(out[0]) != UNKNOWN).select(*[F.col(f"`{c}`") for c in columns])


__all__ = ["Automaton", "Model", "training_sample", "fit", "identify", "op1_language_id", "stage_language_id"]
