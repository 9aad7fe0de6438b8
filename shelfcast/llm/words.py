"""Vectorised words and shingles over Arrow string batches (numpy, inside tasks).

Words are runs of word bytes.  Every separator class used here is ASCII, so
cutting UTF-8 at byte level equals cutting at code points.  A word's value
folds its bytes eight at a time into 64 bits through a bijection per step (all
words at once, one numpy step per eight bytes of the longest), so two words of
one length up to eight bytes never share a value, and others only by chance,
at about 2**-64 a pair; no structure of the letters makes two words meet, as
it does for polynomial hashes modulo 2**64.  A shingle's value folds the values of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)

_ALL = np.arange(256, dtype=np.uint8)
#: Words between ASCII white space.
BLANK_WORDS = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
#: Digits, ASCII letters (after lower-casing) and everything beyond ASCII.
ALNUM_WORDS = (((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80))
#: A-Z to a-z.
LOWER = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 32, _ALL).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Words above this many bytes are folded on their own, not with the others.
_LONG = 4096


def _fold(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A value per run of ``size`` bytes from ``start``."""
    value = mix(size.astype(np.uint64) * _P)
    if not len(start):
        return value
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    lanes = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(buf) + 1, 8), (1, 1))
    rows, at, left = np.arange(len(start)), start, size
    while len(rows):
        lane = np.ascontiguousarray(lanes[at]).view("<u8").ravel()
        short = left < 8
        lane[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        value[rows] = mix((value[rows] ^ lane) * _P)
        go = left > 8
        rows, at, left = rows[go], at[go] + 8, left[go] - 8
    return value


def digest(data) -> int:
    """64 bits of a cryptographic digest."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def word_values(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - start
    value = np.empty(len(start), np.uint64)
    short = size <= _LONG
    value[short] = _fold(buf, start[short], size[short])
    for i in np.flatnonzero(~short):
        value[i] = digest(buf[start[i]:end[i]].tobytes())
    return value


@dataclass
class Words:
    buf: np.ndarray      # bytes of the chunk, folded
    start: np.ndarray    # byte offsets of each word
    end: np.ndarray
    value: np.ndarray    # uint64
    first: np.ndarray    # index of each document's first word, and the total
    doc: np.ndarray      # document index of each word

    def shingles(self, k: int):
        """(value, word index) of every k consecutive words of one document."""
        n = len(self.value) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        acc = self.value[:n].copy()
        for i in range(1, k):
            acc *= _Q
            acc += self.value[i:i + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:])
        return mix(acc[at]), at


def scan(buf: np.ndarray, offsets: np.ndarray, word: np.ndarray, fold: np.ndarray | None = None) -> Words:
    buf = buf[offsets[0]:offsets[-1]]
    off = (offsets - offsets[0]).astype(np.int64)
    n = len(buf)
    b = buf if fold is None else fold[buf]
    w = word[b]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    s, e = w.copy(), w.copy()
    if n > 1:
        brk = ~w[:-1] | edge[1:n]
        s[1:] &= brk
        e[:-1] &= ~w[1:] | edge[1:n]
    start, end = np.flatnonzero(s), np.flatnonzero(e) + 1
    value = word_values(b, start, end)
    first = np.searchsorted(start, off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    return Words(b, start, end, value, first, doc)


def chunks(column, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, offsets) in pieces of about ``limit`` bytes.

    A text longer than that is a piece of its own.  Null counts as empty.
    """
    import pyarrow.compute as pc

    column = pc.fill_null(column, "")
    if not len(column):
        return
    kind = np.int64 if str(column.type).startswith("large") else np.int32
    off = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, buf, off[lo:hi + 1]
        lo = hi
