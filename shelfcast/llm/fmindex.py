"""A compressed FM-index over word sequences (numpy), used inside one task.

The text is a set of short fragments, each closed by its own separator, so
suffixes are ordered after at most the longest fragment.  The BWT is held in a
wavelet matrix of packed bits with block counts; backward search runs for all
streamed fragments at once, one word per step.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class PackedBits:
    """Bits in 64-bit words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.word = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.word) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.word), out=self.before[1:])
        self.before = self.before.astype(np.int32)

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        b = i >> 6
        mask = (_ONE << (i & 63).astype(np.uint64)) - _ONE
        return self.before[b] + np.bitwise_count(self.word[b] & mask).astype(np.int64)


class WaveletMatrix:
    """rank of a symbol in a sequence, level by level from the top bit."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.zeros = [], []
        for k in range(self.levels - 1, -1, -1):
            bit = (seq >> k) & 1
            self.bits.append(PackedBits(bit))
            self.zeros.append(int((bit == 0).sum()))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        self.base = self.position(np.arange(sigma), np.zeros(sigma, np.int64))

    def position(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, bits, zeros in zip(range(self.levels - 1, -1, -1), self.bits, self.zeros):
            ones = bits.rank1(i)
            i = np.where((c >> k) & 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.position(c, i) - self.base[c]


class FMIndex:
    def __init__(self, fragments: list[np.ndarray], owner: np.ndarray, depth: int):
        """owner: the smallest document of each fragment; depth: match length."""
        size = np.array([len(f) for f in fragments], np.int64)
        self.depth = depth
        words, ids = np.unique(np.concatenate(fragments), return_inverse=True)
        nf = len(fragments)
        n = int(size.sum()) + nf
        self.start = np.cumsum(size + 1) - size - 1
        text = np.empty(n, np.int64)
        sep = self.start + size
        text[sep] = np.arange(nf)             # separators: distinct, below all words
        inside = np.ones(n, bool)
        inside[sep] = False
        text[inside] = ids + nf
        self.frag_ids = ids + 1               # word symbols as in the BWT: 0 is a separator
        self.size = size
        # Suffix order by prefix doubling; ranks of 2**j words are kept for depth.
        rank, span, ranks = text, 1, {1: text}
        while True:
            far = np.zeros(n, np.int64)
            far[:n - span] = rank[span:] + 1
            key = rank * np.int64(n + nf + len(words) + 2) + far
            order = np.argsort(key, kind="stable")
            step = np.empty(n, np.int64)
            sorted_key = key[order]
            step[order] = np.cumsum(np.r_[0, (sorted_key[1:] != sorted_key[:-1]).astype(np.int64)])
            rank, span = step, span * 2
            ranks[span] = rank
            if int(rank.max()) == n - 1:
                break
        sa = order
        self.full = self._groups(sa, ranks, depth)[0]
        low, high = self._groups(sa, ranks, depth - 1)[1:]
        self.low, self.high = low, high
        begin = np.flatnonzero(self.full)
        of = np.searchsorted(self.start, sa, "right") - 1
        least = np.minimum.reduceat(owner[of], begin)
        self.least = np.repeat(least, np.diff(np.r_[begin, n]))  # smallest owner at full depth
        bwt = np.where(sa > 0, text[sa - 1], 0)
        bwt = np.where(bwt >= nf, bwt - nf + 1, 0)
        self.wavelet = WaveletMatrix(bwt, len(words) + 1)
        # Suffixes that start below a symbol: separators first.
        self.below = np.r_[0, nf + np.searchsorted(np.sort(ids), np.arange(len(words)))]
        self.n = n

    def _groups(self, sa, ranks, depth):
        """Starts and bounds of the runs of suffixes with equal first ``depth`` words."""
        n, at, new = len(sa), 0, np.zeros(len(sa), bool)
        new[0] = True
        spans = sorted((s for s in ranks if depth & s), reverse=True)
        if sum(spans) < depth:  # the doubling ended below depth: all suffixes differ at its last span
            spans = [max(ranks)]
        for j in spans:
            where = np.minimum(sa + at, n - 1)
            value = np.where(sa + at < n, ranks[j][where], -1)
            new[1:] |= value[1:] != value[:-1]
            at += j
        begin = np.flatnonzero(new)
        reps = np.diff(np.r_[begin, n])
        return new, np.repeat(begin, reps), np.repeat(np.r_[begin[1:], n], reps)

    def smallest_owner(self) -> list[np.ndarray]:
        """Per streamed fragment and window start: smallest owner of the window.

        Streams every fragment from its last word to its first.  The state of
        a stream is the interval of its current match; at full depth the
        interval is one group, and before the next word it is widened to the
        group of the match without its last word.
        """
        first = np.cumsum(self.size) - self.size
        out = [np.full(max(0, s - self.depth + 1), -1, np.int64) for s in self.size]
        flat = np.concatenate(out) if out else np.empty(0, np.int64)
        offset = np.cumsum([0] + [len(o) for o in out])
        lo = np.zeros(len(self.size), np.int64)
        hi = np.full(len(self.size), self.n, np.int64)
        length = np.zeros(len(self.size), np.int64)
        for back in range(1, int(self.size.max(initial=0)) + 1):
            live = np.flatnonzero(self.size >= back)
            c = self.frag_ids[first[live] + self.size[live] - back]
            l, h = lo[live], hi[live]
            full = length[live] >= self.depth
            l = np.where(full, self.low[l], l)
            h = np.where(full, self.high[np.minimum(h - 1, self.n - 1)], h)
            l = self.below[c] + self.wavelet.rank(c, l)
            h = self.below[c] + self.wavelet.rank(c, h)
            if (h <= l).any():
                raise AssertionError("a streamed fragment is missing from its index")
            lo[live], hi[live] = l, h
            length[live] = np.minimum(length[live] + 1, self.depth)
            done = length[live] >= self.depth
            at = live[done]
            flat[offset[at] + self.size[at] - back] = self.least[l[done]]
        return np.split(flat, offset[1:-1]) if out else []
