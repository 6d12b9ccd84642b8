"""Vectorised word splitting and hashing of Arrow string batches.

The Python side of the operators that work on word sequences. A whole batch
is one UTF-8 byte buffer: a byte class table tells word bytes from others, A-Z
are lower-cased by a table, and every word gets a 64-bit hash of its bytes.
Both word classes in use (not white space; letters, digits and everything
beyond ASCII) can be told byte by byte in UTF-8, so no text is decoded.

Null texts have no words. Memory is a small multiple of the batch's bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CHUNK = 1 << 19                                   # bytes hashed at a time
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D                         # odd, 5 mod 8


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _table(inside) -> np.ndarray:
    return np.array([inside(b) for b in range(256)], dtype=bool)


LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
#: [^\x20\x09-\x0D]+
NOT_SPACE = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing
LETTERS = _table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)

with np.errstate(over="ignore"):
    _BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_UP = _powers(_BASE, _CHUNK)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _CHUNK)


@dataclass
class Words:
    """Words of a batch in order: byte span, row of the batch and hash."""

    low: np.ndarray        # lower-cased bytes of the whole batch
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray      # first[i] .. first[i + 1]: the words of row i
    hash: np.ndarray

    def text(self, a: int, b: int) -> bytes:
        """Words a to b - 1 joined by one space, for exact comparison."""
        return b" ".join(self.low[s:e].tobytes()
                         for s, e in zip(self.start[a:b], self.end[a:b], strict=True))


def bytes_of(texts) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each row's offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def split(texts, inside: np.ndarray, hashed: bool = True) -> Words:
    """Words of every row of a string column under the byte class ``inside``."""
    raw, offsets = bytes_of(texts)
    low = LOWER[raw]
    n = len(low)
    word = np.zeros(n + 2, dtype=bool)
    word[1:-1] = inside[low]
    here = word[1:-1]
    begins = here & ~word[:-2]
    ends = here & ~word[2:]
    edge = offsets[1:-1]                             # words never span rows
    inner = edge[(edge > 0) & (edge < n)]
    begins[inner] = here[inner]
    ends[inner - 1] = here[inner - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets, side="left")
    return Words(low, start, end, first, _hash(low, start, end, inside) if hashed else start[:0])


def _hash(low: np.ndarray, start: np.ndarray, end: np.ndarray, inside: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), dtype=np.uint64)
    value = np.where(inside, _BYTE, np.uint64(0))
    at = 0
    with np.errstate(over="ignore"):
        while at < len(start):
            upto = max(at + 1, int(np.searchsorted(end, start[at] + _CHUNK, side="right")))
            lo, hi = start[at], end[upto - 1]
            up, down = _UP, _DOWN
            if hi - lo > _CHUNK:                     # one word longer than a chunk
                up, down = _powers(_BASE, int(hi - lo)), _DOWN
            rel = start[at:upto] - lo
            out[at:upto] = np.add.reduceat(value[low[lo:hi]] * up[:hi - lo], rel) * down[rel]
            at = upto
    return mix(out)


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k consecutive words within a row, and the index of each
    gram's first word. Rows of fewer words have none."""
    h = words.hash
    n = len(h) - k + 1
    if n <= 0:
        return h[:0], np.zeros(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for i in range(1, k):
            out *= _STEP
            out += h[i:i + n]
    ok = np.ones(n, dtype=bool)
    for i in range(1, k):                            # grams that would run into the next row
        cut = words.first[1:-1] - i
        ok[cut[(cut >= 0) & (cut < n)]] = False
    at = np.flatnonzero(ok)
    return mix(out[at]), at
