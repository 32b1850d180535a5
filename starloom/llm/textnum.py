"""Words of many texts as numpy arrays: 64-bit word hashes, n-gram hashes.

A batch of texts becomes one byte array; every step is vectorised over it. The
hashes depend only on the words' bytes, so all tasks agree on them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from starloom.llm.scratch import trim

BATCH_BYTES = 1 << 20
PART_BYTES = 8 << 20

_RNG = np.random.Generator(np.random.PCG64(20240229))
_PLACE = _RNG.integers(1, 2**63, 1 << 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
GRAM = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

# Words of more bytes are hashed one by one.
LONG = 1024
# The first n bytes of a little-endian word.
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)

# Bytes of a word. SPACED: anything but blank and \t..\r. ALNUM: ASCII letters and
# digits and every byte of a character beyond ASCII.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word (in place on a copy)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def slices(texts: Sequence[bytes], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of at most ``limit`` bytes in total (one text at least)."""
    lo = total = 0
    for i, t in enumerate(texts):
        if i > lo and total + len(t) > limit:
            yield lo, i
            lo, total = i, 0
        total += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def parts(batches, at: int, limit: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The Arrow batches in consecutive pieces of at most ``limit`` bytes of text
    in column ``at`` (one row at least), so that what is made of a piece at once
    does not depend on how Spark cut the batches. Behind the last one freed memory goes
    back to the system, as Spark keeps the worker."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < b.num_rows:
            done = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi
    b = None
    trim()


def lowered(texts: Sequence[str | None]) -> list[bytes]:
    """UTF-8 with A-Z lower-cased and nothing else changed; null becomes empty."""
    return [t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts]


def hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of each of the given stretches of ``data``, which holds at least
    eight bytes more than the last one's end."""
    length = end - start
    eight = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
    h = length.astype(np.uint64) * GRAM[62]
    at, left, which = start, length, None
    for j in range(LONG // 8):
        part = eight[at] & _KEEP[np.minimum(left, 8)]
        if which is None:
            h = mix(h + part * _PLACE[j])
        else:
            h[which] = mix(h[which] + part * _PLACE[j])
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        which = more if which is None else which[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(length > LONG):
        digest = hashlib.blake2b(data[start[i] : end[i]], digest_size=8).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


def located(texts: Sequence[bytes], is_word: np.ndarray):
    """``(hashes, first, data, start, end)``: the hash of each word in order, for
    each text the index of its first word (the total last), and where each word
    stands in ``data``."""
    # a blank in front, and enough behind for eight bytes from any word's last
    joined = b" " + b" ".join(texts) + b" " * 9
    data = np.frombuffer(joined, dtype=np.uint8)
    inside = is_word[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    size = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    first = np.searchsorted(start, np.concatenate(([1], 1 + np.cumsum(size))))
    h = hashes(joined, start, end)
    return h, first, joined, start, end


def words(texts: Sequence[bytes], is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and for each text the index of its first word."""
    h, first, *_ = located(texts, is_word)
    return h, first


def grams(h: np.ndarray, offsets: Sequence[int]) -> np.ndarray:
    """Hash of the words at ``offsets`` from each position; positions whose last
    word lies beyond the array are left out."""
    n = len(h) - offsets[-1]
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(n, len(offsets), dtype=np.uint64) * GRAM[60]
    for j, o in enumerate(offsets):
        total += h[o : o + n] * GRAM[j]
    return mix(total)
