"""Operator 12: spelling variants by blocked Gram matrices of letter counts.

Words (and how often they occur) are counted per scan task and summed.  Each
word is a vector of letter counts.  One inserted or deleted letter moves it by
a squared distance of 1, one replaced letter by 2, so only pairs at most two
apart, in equal or adjacent lengths, can be variants.  Words are dealt to
blocks by length and by how many of their letters fall into each of several
letter groups; an edit changes these sums by at most one step, so a block
meets itself and its neighbouring blocks only.  In a block NumPy's product of
the count vectors gives all squared distances; pairs at most two apart are
verified letter by letter.  The number of letter groups follows the number of
words, and blocks above ``BLOCK`` words are split with each part shown to the
others, so no task holds an unbounded block.  Neither changes the result.

A word's form is its near word of largest count, if that is ``ratio`` times
its own count; forms are followed to the last one, the root.

Edge cases: null texts have no words; a null id is written as an empty one in
the checksum's text; repeated rows count each time; ties between forms go to
the smallest word in code-point order; an empty table gives no rows; other
columns are not read; a text of any length is read in pieces.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import byte_pieces, written

#: A-Z to a-z on UTF-8 bytes; no other letter is changed.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Runs of a-z and U+00C0..U+00FF as UTF-8 bytes.
_RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
_LETTERS = 26 + 64
BLOCK = 2048
FLUSH = 400_000


def noise_rule(prefix_crc: int, run: bytes, every: int) -> bytes:
    """``run`` without one letter if its checksum after the id is divisible by ``every``."""
    h = zlib.crc32(run, prefix_crc)
    if h % every:
        return run
    word = run.decode()
    at = h % len(word)
    return (word[:at] + word[at + 1:]).encode()


def count_words(df: DataFrame, key: str = "doc_id", text: str = "text", min_letters: int = 6,
                min_count: int = 5, noise_every: int | None = 199) -> DataFrame:
    """(word, n) of all words of ``min_letters`` letters that occur ``min_count`` times."""
    src = df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.col(text).alias("t"))

    def run(batches):
        import pyarrow as pa

        held: Counter[bytes] = Counter()

        def flush():
            pairs = [(w, n) for w, n in ((b.decode(), n) for b, n in held.items()) if len(w) >= min_letters]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in pairs], pa.string()), pa.array([n for _, n in pairs], pa.int64())],
                names=["word", "n"])

        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1)):
                if not t.is_valid:
                    continue
                prefix = zlib.crc32(f"{k.as_py()}:".encode())
                for piece in byte_pieces(t.as_buffer().to_pybytes().translate(_FOLD)):
                    found = Counter(_RUN.findall(piece))
                    for w, n in found.items():
                        if len(w) < min_letters:
                            continue
                        held[w if noise_every is None else noise_rule(prefix, w, noise_every)] += n
                if len(held) > FLUSH:
                    yield flush()
        yield flush()

    parts = src.mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _letter_counts(column):
    """(words x letters) counts and lengths in code points of an Arrow string column."""
    import pyarrow.compute as pc

    words = column.to_pylist()
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    length = np.asarray(pc.utf8_length(column)).astype(np.int64)
    letter = np.where(flat < 0xC0, flat - 97, flat - 0xC0 + 26)
    row = np.repeat(np.arange(len(words)), length)
    counts = np.bincount(row * _LETTERS + letter, minlength=len(words) * _LETTERS)
    return words, counts.reshape(len(words), _LETTERS), length


def _steps(groups: int):
    """Weights of the block key, and what one edit adds to it."""
    r = np.random.default_rng(12)
    weight = r.integers(1 << 40, 1 << 61, groups + 1)  # a linear hash: two keys that meet only cost time
    length, group = int(weight[0]), [int(x) for x in weight[1:]]
    moves = [a - b for a in group for b in group if a != b]
    moves += [s * (length + a) for a in group for s in (1, -1)]
    wrap = [(m + (1 << 63)) % (1 << 64) - (1 << 63) for m in sorted(set(moves))]
    return weight.astype(np.int64), np.array(wrap, np.int64)


def blocks(words: DataFrame, groups: int) -> DataFrame:
    """word, n, its block, and the later neighbouring blocks it must be shown to."""
    weight, moves = _steps(groups)
    member = np.arange(_LETTERS) % groups

    def run(batches):
        import pyarrow as pa

        onto = np.zeros((_LETTERS, groups), np.int64)
        onto[np.arange(_LETTERS), member] = 1
        for batch in batches:
            if not batch.num_rows:
                continue
            _, counts, length = _letter_counts(batch.column(0))
            with np.errstate(over="ignore"):
                key = length * weight[0] + (counts @ onto) @ weight[1:]
                near = key[:, None] + moves[None, :]
            later = near > key[:, None]
            ends = np.r_[0, np.cumsum(later.sum(1))].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(key),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(near[later]))],
                names=["word", "n", "block", "later"])

    return words.mapInArrow(run, "word string, n long, block long, later array<long>")


def one_edit(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point apart."""
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] and i < len(a) if len(a) == len(b) else a[i:] == b[i + 1:]


def _meet(home, away, upper: bool):
    """Index pairs of rows at most two apart, from products of count vectors."""
    (hc, hn), (ac, an) = home, away
    if not len(hc) or not len(ac):
        return
    for lo in range(0, len(ac), BLOCK):
        part = ac[lo:lo + BLOCK]
        apart = hn[:, None] + an[lo:lo + BLOCK][None, :] - 2 * (hc @ part.T)
        i, j = np.nonzero(apart <= 2)
        j = j + lo
        yield from zip(*((x[i < j].tolist() for x in (i, j)) if upper else (i.tolist(), j.tolist())))


def letter_groups(n_words: int) -> int:
    """Each group more makes about three times as many blocks; some 256 words a block."""
    return min(24, max(4, math.ceil(math.log(max(1, n_words) / 256, 3))))


def near_pairs(words: DataFrame, groups: int | None = None) -> DataFrame:
    """(word, n, near, near_n), each pair in both directions; ``words`` is a written (word, n)."""
    groups = groups or letter_groups(words.count())
    dealt = written(blocks(words, groups), "spelling-blocks")
    size = dealt.groupBy("block").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    placed = dealt.join(size, "block").withColumn("part", part)
    home = placed.select("word", "n", "block", "part", F.lit(True).alias("home"))
    # Another part of its own block is a neighbour too, from the smaller part to the larger.
    own = (placed.filter("parts > 1").select("word", "n", "block", F.explode(F.sequence("part", F.col("parts") - 1)).alias("to"),
                                             "part").filter("`to` > part")
           .select("word", "n", "block", F.col("to").alias("part"), F.lit(False).alias("home")))
    sent = (dealt.select("word", "n", F.explode("later").alias("block")).join(size, "block")
            .select("word", "n", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                    F.lit(False).alias("home")))
    both = home.unionByName(own).unionByName(sent)

    def run(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        table = table.combine_chunks()
        here = np.asarray(table.column("home")).astype(bool)
        found = []
        if here.any():
            longest = pc.max(pc.utf8_length(table.column("word"))).as_py()
            kind = np.float32 if longest < 2048 else np.float64  # squares must be exact

            def side(mask):
                t = table.filter(pa.array(mask))
                words, counts, _ = _letter_counts(t.column("word").combine_chunks())
                vec = counts.astype(kind)
                return words, t.column("n").to_pylist(), (vec, (vec * vec).sum(1))

            longest = pc.max(pc.utf8_length(table.column("word"))).as_py()
            kind = np.float32 if longest < 2048 else np.float64  # squares must be exact

            w, n, vec = side(here)
            v, m, other = side(~here)
            found += [(w[i], n[i], w[j], n[j]) for i, j in _meet(vec, vec, True) if one_edit(w[i], w[j])]
            found += [(w[i], n[i], v[j], m[j]) for i, j in _meet(vec, other, False) if one_edit(w[i], v[j])]
        found += [(b, y, a, x) for a, x, b, y in found]
        cols = list(zip(*found)) or [()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64()) * 2)],
                        names=["word", "n", "near", "near_n"])

    return (both.groupBy("block", "part").applyInArrow(run, "word string, n long, near string, near_n long")
            .distinct())


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a written (word, n) table."""
    near = near_pairs(words)
    best = near.groupBy(F.col("word").alias("_w")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("best"))
    big = -F.col("best.m") >= ratio * F.col("n")
    found = (words.join(best, words["word"] == best["_w"], "left")
             .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                     F.when(big, F.col("best.w")).alias("form"), F.when(big, -F.col("best.m")).alias("form_n")))
    found = written(found, "spelling-forms")
    # Counts grow ``ratio`` times from form to form, so doubling ends after few rounds.
    step = found.filter("form is not null").select("word", F.col("form").alias("root"))
    step = written(step, "spelling-root")
    while True:
        ahead = step.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        moved = step.join(ahead, step["root"] == ahead["_w"], "left").select(
            "word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved"))
        moved = written(moved, "spelling-root")
        step = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    roots = step.select(F.col("word").alias("_w"), "root")
    return found.join(roots, found["word"] == roots["_w"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(df: DataFrame, key: str = "doc_id", text: str = "text", min_letters: int = 6,
                      min_count: int = 5, ratio: int = 5, noise_every: int | None = None) -> DataFrame:
    words = written(count_words(df, key, text, min_letters, min_count, noise_every), "spelling-words")
    return group_variants(words, ratio)
