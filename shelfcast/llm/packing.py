"""Operator 1: sum-of-squares online packing into fixed windows.

Each scan task packs the documents it reads, in one pass, with its own windows
(no shuffle of texts).  A document longer than a window fills whole windows
first; the rest of ``s`` ids goes to the open fill level ``h`` that minimises
the sum of squared counts of partially filled windows after the move ``h`` to
``h + s``, tracked in an array with one count per level.  When the task's
input ends, the windows still open are merged: pieces of the emptiest fill the
holes of the fullest, cut where needed, so that at most one is left partly
filled; that one is split into sequences whose lengths are powers of two,
which need no padding.

Tokens: the given ``tokenizers`` file without special tokens, then one end id.

Edge cases: null and empty texts are the end id alone; repeated rows are each
packed; an empty table gives no pieces; a document of any length is cut into
windows as it is read; other columns are not read.  ``sequence_id`` is the
task's number shifted by 36 bits plus a running number, so a task that runs
again after a loss writes the same ids for the same input.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 2048
END_ID = 1

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


# The byte-level pre-tokenizer's pattern.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The fast loop's regex stack ends at a million white-space characters in a row.
BLANK_RUN = 100_000
_BLANKS = re.compile(r"\s{64,}")


def _byte_of() -> dict[str, int]:
    """Characters that a byte-level vocabulary writes for bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """text -> ids of a byte-level BPE file, as the tokenizers library gives them.

    The file's vocabulary and merges are run by a faster BPE loop where they
    allow it (no normaliser, merge order equal to id order); texts with the
    strings of added tokens or very long runs of white space, and other files,
    go through the library itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._path, self._exact = path, None  # the library's object is loaded when a text needs it
        self._added = [t["content"] for t in spec["added_tokens"]]
        self._fast = self._ranked(spec)

    def _library(self, text: str) -> list[int]:
        if self._exact is None:
            from tokenizers import Tokenizer
            self._exact = Tokenizer.from_file(self._path)
        return self._exact.encode(text, add_special_tokens=False).ids

    def _ranked(self, spec):
        import tiktoken

        model, split = spec["model"], spec["pre_tokenizer"] or {}
        plain = (model["type"] == "BPE" and not spec["normalizer"] and split.get("type") == "ByteLevel"
                 and split.get("use_regex") and not split.get("add_prefix_space")
                 and not model.get("ignore_merges") and not model.get("dropout"))
        if not plain:
            return None
        vocab, byte = model["vocab"], _byte_of()
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if made != sorted(made):
            return None
        known = set(made) | {vocab[c] for c in byte if c in vocab}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if i in known}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _long_blanks(text: str) -> bool:
        return len(text) > BLANK_RUN and any(m.end() - m.start() > BLANK_RUN for m in _BLANKS.finditer(text))

    def __call__(self, text: str) -> bytes:
        if self._fast is None or any(t in text for t in self._added) or self._long_blanks(text):
            ids = self._library(text)
        else:
            ids = self._fast.encode_ordinary(text)
        return np.asarray(ids, "<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}  # one per worker process and file


class SumOfSquares:
    """Online placement; ``emit`` receives finished windows as piece lists."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)       # open windows per fill level
        self.open: list[list[list]] = [[] for _ in range(size)]

    def place(self, piece, n: int):
        """Put a piece of n < size ids; returns a full window or None."""
        count, size = self.count, self.size
        # Moving a window from h to h+n changes the sum of squares by
        # 2 * (N[h+n] - N[h]) + 2 (a full window is not counted); opening one
        # at level n by 2 * N[n] + 1.
        best, gain = 0, 2 * int(count[n]) + 1
        levels = np.flatnonzero(count[1:size - n + 1]) + 1
        if len(levels):
            to = count[levels + n].copy()
            full = levels + n == size
            delta = 2 * (to - count[levels]) + 2
            delta[full] = 1 - 2 * count[levels[full]]
            # Ties go to the fullest window.
            k = len(levels) - 1 - int(np.argmin(delta[::-1]))
            if delta[k] <= gain:
                best = int(levels[k])
        window = self.open[best].pop() if best else []
        if best:
            count[best] -= 1
        window.append(piece)
        if best + n == size:
            return window
        self.open[best + n].append(window)
        count[best + n] += 1
        return None

    def rest(self) -> list[tuple[int, list]]:
        """Open windows as (fill, pieces), fullest first."""
        out = [(h, w) for h in range(self.size - 1, 0, -1) for w in self.open[h]]
        self.open = [[] for _ in range(self.size)]
        self.count[:] = 0
        return out


def _cut(piece, n: int):
    """Split (doc_id, start, ids, doc_tokens) after n ids."""
    doc, start, ids, total = piece
    return (doc, start, ids[:4 * n], total), (doc, start + n, ids[4 * n:], total)


def merge_open(rest: list[tuple[int, list]], size: int) -> Iterator[list]:
    """Fill the fullest windows with pieces of the emptiest; power-of-two tail."""
    spare: list = []  # pieces taken from the emptiest windows
    lo, hi = 0, len(rest) - 1
    while lo <= hi:
        fill, window = rest[lo]
        lo += 1
        while fill < size and (spare or lo <= hi):
            if not spare:
                spare = rest[hi][1][::-1]
                hi -= 1
                continue
            piece = spare.pop()
            n = len(piece[2]) // 4
            if fill + n > size:
                piece, left = _cut(piece, size - fill)
                spare.append(left)
                n = size - fill
            window.append(piece)
            fill += n
        if fill == size:
            yield window
        else:
            spare = window[::-1]
    while spare:  # less than one window in all, or a window's leftovers
        left = sum(len(p[2]) // 4 for p in spare)
        room = size if left >= size else 1 << (left.bit_length() - 1)
        window = []
        while room:
            piece = spare.pop()
            n = len(piece[2]) // 4
            if n > room:
                piece, back = _cut(piece, room)
                spare.append(back)
                n = room
            window.append(piece)
            room -= n
        yield window


def pack(df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
         window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece; see the module text."""

    def run(batches):
        import pyarrow as pa

        encode = _ENCODERS.setdefault(tokenizer_path, None) or Encoder(tokenizer_path)
        _ENCODERS[tokenizer_path] = encode
        end = np.asarray([end_id], "<u4").tobytes()
        sos = SumOfSquares(window)
        base, number = TaskContext.get().partitionId() << 36, 0
        rows: list[tuple] = []

        def emit(pieces):
            nonlocal number
            at = 0
            for doc, start, ids, total in pieces:
                n = len(ids) // 4
                rows.append((doc, start, n, zlib.crc32(ids), total, base + number, at))
                at += n
            number += 1

        names = [f.split()[0] for f in SCHEMA.split(", ")]

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
            rows.clear()
            return out

        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(body.as_py() or "") + end
                total, at = len(ids) // 4, 0
                while total - at >= window:
                    emit([(doc, at, ids[4 * at:4 * (at + window)], total)])
                    at += window
                if at < total:
                    full = sos.place((doc, at, ids[4 * at:], total), total - at)
                    if full:
                        emit(full)
            if rows:
                yield flush()
        for pieces in merge_open(sos.rest(), window):
            emit(pieces)
        if rows:
            yield flush()

    return df.select(df[key].cast("long").alias("doc_id"), df[text].alias("text")).mapInArrow(run, SCHEMA)
