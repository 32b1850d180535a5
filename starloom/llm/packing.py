"""Packing documents into training windows by the online sum-of-squares rule.

*Tokens.* A document is its ids under the given tokenizer and then the id ``END``. Of a
plain byte-level file the same merges run in ``tiktoken``, which gives the ids of
``tokenizers`` (tested over every code point and on random texts) in a sixth of the
time; other files, and texts with endless runs, take ``tokenizers`` itself. White space
always starts a new pre-token when no white space stands before it, so very long texts
are cut there, and the ids are those of the whole text.

*Placing.* A document of at least ``WINDOW`` ids first gives whole windows. What is
left of it, fewer than ``WINDOW`` ids, goes into an open window whole: the level
array counts the open windows at each fill level, and of all levels that have room
(and of a new window) the one is taken that leaves the smallest sum of squared
counts; among equals the fullest. Levels that reach ``WINDOW`` close.

*Bounds.* Each task packs its own documents, in one pass and without a shuffle. At
most ``OPEN`` windows are open at once; where a further one would be opened, the
document is cut to close the fullest instead. When the task's documents end, the
emptiest open windows are cut to close the fullest ones. The one that remains is
cut at powers of two, at which a sequence needs no padding. So no task pads.

A sequence id is the task's number and a count, so that a repeated task gives the
same rows. Nulls: a null text is an empty one, which is one piece of one id; a null
id is kept. Repeated rows are documents of their own. An empty table gives no rows.
Columns other than the id's and the text's are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.scratch import ship
from starloom.llm.textnum import parts

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
WINDOW = 1024
END = 0
OPEN = 4096

#: Characters that are encoded together, and those of a run that take ``tokenizers``.
STRETCH = 1 << 20
LONG = 1 << 12
ROWS = 1 << 13
TASK_BITS = 36
_NEVER = 1 << 60

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)

#: Fixed value: how byte-level tokenizers cut a text into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# White space under any definition, and characters that are white space under some.
_SPACE = " \t\n\x0b\x0c\r"
_DOUBT = "\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff"
_CUT = re.compile(f"(?<=[^{_SPACE}{_DOUBT}])[{_SPACE}]")


def _alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones
    for themselves, the others for 256, 257, ... in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranked(tokenizer):
    """The same vocabulary in ``tiktoken``, where its ids follow from it: a plain
    byte-level model whose merges are in the order of their ids. Else ``None``."""
    import tiktoken

    spec = json.loads(tokenizer.to_str())
    pre, model = spec["pre_tokenizer"] or {}, spec["model"]
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    flags = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if spec["normalizer"] or not plain or model["type"] != "BPE" or any(model.get(f) for f in flags):
        return None
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        return None
    byte, vocabulary = _alphabet(), model["vocab"]
    made = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in special}
    if made != list(range(256, 256 + len(made))) or len(ranks) != 256 + len(made):
        return None
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


class Encoder:
    """Ids of whole texts under a tokenizer's file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fast = ranked(self.tokenizer)

    def _part(self, text: str) -> np.ndarray:
        if self.fast is not None:
            words = text.split()
            blank = len(text) - sum(map(len, words))
            # a run without an end is left to the library that reads it in one go
            if max(map(len, words), default=0) < LONG and blank < len(words) + LONG:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype(np.int32)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int32)

    def ids(self, text: str | None) -> np.ndarray:
        out, at, text = [], 0, text or ""
        while at < len(text):
            cut = _CUT.search(text, at + STRETCH) if self.fast is not None else None
            end = cut.start() if cut else len(text)
            out.append(self._part(text[at:end]))
            at = end
        return np.concatenate([*out, np.array([END], dtype=np.int32)])


class Piece:
    """Consecutive ids of one document."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.start, self.ids[:n], self.total),
            Piece(self.doc, self.start + n, self.ids[n:], self.total),
        )


class Packer:
    """Open windows by fill level, and the rows of the closed ones."""

    def __init__(self, window: int = WINDOW, most_open: int = OPEN, first_id: int = 0):
        self.window, self.most_open, self.next_id = window, most_open, first_id
        self.counts = np.zeros(window + 1, dtype=np.int64)  # of the open windows at each level
        self.at: list[list[list[Piece]]] = [[] for _ in range(window)]
        self.n_open = 0
        self.rows: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        total, whole = len(ids), len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            self._close([Piece(doc, start, ids[start : start + self.window], total)])
        if total > whole:
            # a copy: a view would keep the ids of the whole document
            self._place(Piece(doc, whole, ids[whole:].copy(), total))

    def level(self, size: int, new: bool = True) -> int | None:
        """The level whose windows take ``size`` ids, 0 for a new window (None without
        one): the change of the sum of squares is 2 n + 1 where a window arrives (0
        where it closes) and 1 - 2 n where it leaves."""
        counts, room = self.counts, self.window - size
        change = 2 * counts[size:] + 1
        change[-1] = 0
        change[1:] += np.where(counts[1 : room + 1] > 0, 1 - 2 * counts[1 : room + 1], _NEVER)
        if not new:
            change[0] = _NEVER
        best = room - int(np.argmin(change[::-1]))
        return best if change[best] < _NEVER // 2 else None

    def _place(self, piece: Piece) -> None:
        level = self.level(len(piece.ids), self.n_open < self.most_open)
        while level is None:
            fullest = int(np.flatnonzero(self.counts)[-1])
            head, piece = piece.cut(self.window - fullest)
            self._put(head, fullest)
            level = self.level(len(piece.ids), self.n_open < self.most_open)
        self._put(piece, level)

    def _put(self, piece: Piece, level: int) -> None:
        held = []
        if level:
            held = self.at[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        held.append(piece)
        level += len(piece.ids)
        if level == self.window:
            self._close(held)
        else:
            self.at[level].append(held)
            self.counts[level] += 1
            self.n_open += 1

    def _close(self, held: list[Piece]) -> None:
        offset = 0
        for p in held:
            crc = zlib.crc32(p.ids.astype("<u4").tobytes())
            self.rows.append((p.doc, p.start, len(p.ids), crc, p.total, self.next_id, offset))
            offset += len(p.ids)
        self.next_id += 1

    def finish(self) -> None:
        """Close what is open: the emptiest windows fill the fullest, the last one is
        cut at powers of two."""
        held = [(level, w) for level in range(self.window - 1, 0, -1) for w in self.at[level]]
        lo, hi = 0, len(held) - 1
        while lo < hi:
            level, pieces = held[lo]
            rest_level, rest = held[hi]
            p = rest.pop()
            if len(p.ids) > self.window - level:
                p, back = p.cut(self.window - level)
                rest.append(back)
            held[hi] = (rest_level - len(p.ids), rest)
            pieces.append(p)
            held[lo] = (level + len(p.ids), pieces)
            if held[lo][0] == self.window:
                self._close(pieces)
                lo += 1
            if not rest:
                hi -= 1
        if lo == hi:
            level, pieces = held[lo]
            pieces.reverse()
            while level:
                want, own = 1 << (level.bit_length() - 1), []
                level -= want
                while want:
                    p = pieces.pop()
                    if len(p.ids) > want:
                        p, back = p.cut(want)
                        pieces.append(back)
                    own.append(p)
                    want -= len(p.ids)
                self._close(own)
        self.at = [[] for _ in range(self.window)]
        self.counts[:] = 0
        self.n_open = 0

    def taken(self) -> pa.RecordBatch:
        """The rows so far, which are then forgotten."""
        columns = list(zip(*self.rows)) or [()] * 7
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    window: int = WINDOW,
    most_open: int = OPEN,
) -> DataFrame:
    """One row per piece of a document: where it stands in the document and in which
    sequence it lies. ``window`` is a power of two; ``vocabulary`` is a file that every
    executor has at the same place."""
    if window < 1 or window & (window - 1):
        raise ValueError(f"window must be a power of two, got {window}")
    if most_open < 1:
        raise ValueError("at least one window must be open")
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        packer = Packer(window, most_open, TaskContext.get().partitionId() << TASK_BITS)
        for b in parts(batches, 1):
            for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                packer.add(doc, encoder.ids(t))
                if len(packer.rows) >= ROWS:
                    yield packer.taken()
        packer.finish()
        yield packer.taken()

    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return own.mapInArrow(run, SCHEMA)


def op13_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 1024 ids."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


__all__ = ["Encoder", "Packer", "pack_documents", "op13_packing"]
