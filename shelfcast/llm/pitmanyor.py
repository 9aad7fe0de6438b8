"""Operator 11: hierarchical Pitman-Yor language model, seated by Gibbs sampling.

The words of a text are followed by one end token.  Every context has a
restaurant: a context is the previous word hashed into ``CONTEXTS`` classes
(the end token stands before the first word).  All context restaurants share
one parent, the word restaurant, whose base is uniform over the training words
and one unknown word.  A customer is a training token, a dish is a word; each
table of a context restaurant sends one customer to the parent.

Words are dealt to buckets, and a bucket's task holds all tables of its words
in every context.  A sweep reseats each customer given all others of its
context and word: at a new table with weight ``(strength + discount * tables
of the context) * P(word)``, at a table of s customers with ``s - discount``;
up to ``JOINT`` customers of a context and word are seated together, from the
exact distribution of their seatings.  Totals over contexts are those of the
sweep before, and a word with very many customers in one context reseats 1/64
of them at a time.  The first
``burn_in`` sweeps are left out; the predictive probabilities of the later ones
are averaged:

    P(w | u) = (c_uw - d t_uw) / (s + c_u) + (s + d t_u) / (s + c_u) * P(w)

Discounts come from the counts of counts, n1 / (n1 + 2 n2).  Tables of context
totals are bounded by ``CONTEXTS`` and are broadcast; nothing else is.  The
number of (context, word) counts grows with the corpus.

Skew: words with a share of the tokens above ``HOT`` (at most 2 / HOT of them)
are dealt to buckets by context range, with parent tables of their own per
range; pairs above it are scored from a broadcast list of at most 2 / HOT pairs
wherever their documents are.  All other documents' tokens travel to the
buckets in blocks, summed per document, word and context.

Edge cases: null and empty texts are the end token alone; a null id counts as
training; repeated rows are documents of their own; without training documents
all probabilities are 1; an empty table gives no rows; other columns are not
read; long texts are read in pieces.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import byte_pieces, drop_written, written

CONTEXTS = 1 << 16
RANGES = 64                 # parts of a hot word's contexts
HOT = 1 / 500
TOKENS = 1 << 20            # tokens of a block
DOCS = 1 << 15              # documents of a block: positions fit a short
PIECE = 1 << 22             # bytes of text split at a time
BUCKET = 1_500_000          # tokens of a bucket
STRENGTH = 1.0
END = b""


class Block:
    """Tokens of some documents as numbers: word, context class, document."""

    def __init__(self):
        self.words, self.sizes, self.keys = [], [], []
        self.tokens = 0

    def add(self, keys, words, sizes) -> None:
        """Documents with their words one after another; ``sizes``: words and the end token of each."""
        self.words.append(words)
        self.sizes.append(sizes)
        self.keys += keys
        self.tokens += int(sizes.sum())

    def lengths(self) -> np.ndarray:
        return np.concatenate(self.sizes)

    def arrays(self):
        """(word, context, position, held out) of every token, and the words, the end token first."""
        import pyarrow as pa

        sizes = self.lengths()
        parts = pa.chunked_array(self.words).dictionary_encode().chunks     # of one dictionary
        if not parts:
            parts = [self.words[0].dictionary_encode()]
        word, inner = np.zeros(self.tokens, np.int32), np.ones(self.tokens, bool)
        inner[np.cumsum(sizes) - 1] = False
        word[inner] = np.concatenate([np.asarray(x.indices) for x in parts]) + 1
        words = [END, *_bytes(parts[-1].dictionary.cast(pa.binary()))]
        code = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
        before = np.empty_like(word)                            # an end token stands before each first word
        before[0], before[1:] = 0, word[:-1]
        pos = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        held = np.array([k is not None and zlib.crc32(str(k).encode()) % 7 == 2 for k in self.keys], bool)
        return word, (code % CONTEXTS).astype(np.int32)[before], pos, held[pos], words, code


def _bytes(values) -> list[bytes]:
    """As ``to_pylist`` of an Arrow array without nulls, many times as fast."""
    return values.to_numpy(zero_copy_only=False).tolist()


def _split(texts):
    """(words of all texts, A-Z lower-cased, words of each text)."""
    import pyarrow.compute as pc

    texts = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    lists = pc.ascii_split_whitespace(texts)
    n, blank = np.array(pc.list_value_length(lists), np.int64), np.asarray(pc.binary_length(texts)) == 0
    words = lists.flatten()
    if blank.any():                                             # a text without words has one empty one
        words = words.filter(pc.greater(pc.binary_length(words), 0))
        n[blank] = 0
    return words, n


def _documents(batches):
    """(keys, their words, tokens of each) of the documents of a few megabytes at a time."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        ends = np.cumsum(np.asarray(pc.binary_length(texts)), dtype=np.int64)
        lo = 0
        while lo < len(texts):
            start = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, start + PIECE, "right")))
            part = texts.slice(lo, hi - lo)
            if ends[hi - 1] - start > PIECE:                    # one long text, in pieces
                kind = pa.large_binary() if pa.types.is_large_string(part.type) else pa.binary()
                part = pa.array(list(byte_pieces(part[0].as_buffer().to_pybytes(), PIECE)), kind).view(part.type)
            words, n = _split(part)
            if len(n) != hi - lo:
                n = n.sum(keepdims=True)
            yield batch.column(0).slice(lo, hi - lo).to_pylist(), words, n + 1
            lo = hi


def _read(batches):
    """Blocks of whole documents, closed by the one that reaches ``TOKENS`` or ``DOCS``."""
    block = Block()
    for keys, words, sizes in _documents(batches):
        ends, lo = np.cumsum(sizes), 0
        while lo < len(keys):
            start = ends[lo - 1] if lo else 0
            full = int(np.searchsorted(ends, start + TOKENS - block.tokens)) + 1
            hi = min(full, lo + DOCS - len(block.keys), len(keys))
            # Words before a document: its tokens before without one end token each.
            block.add(keys[lo:hi], words[start - lo:ends[hi - 1] - hi], sizes[lo:hi])
            if block.tokens >= TOKENS or len(block.keys) >= DOCS:
                yield block
                block = Block()
            lo = hi
    if block.keys:
        yield block


def _pack(values) -> bytes:
    """Whole numbers from 0 in the fewest bytes each."""
    values = np.asarray(values)
    most = int(values.max(initial=0))
    size = next(k for k in (1, 2, 4, 8) if most < 1 << 8 * k)
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def _unpack(data) -> np.ndarray:
    data = memoryview(data)
    return np.frombuffer(data[1:], f"<u{data[0]}").astype(np.int64)


def _batch(rows, names):
    """Arrow batch of (int or bytes or None) rows."""
    import pyarrow as pa

    kinds = {"bucket": pa.int32(), "block": pa.int64()}
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.binary())) for n, c in zip(names, cols)], names=names)


def _counted(key: np.ndarray):
    """(distinct values, counts); ``key`` is sorted in place."""
    key.sort()
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    return key[first], np.diff(np.r_[first, len(key)])


def frequent(src: DataFrame) -> tuple[int, dict[bytes, set[int]]]:
    """All tokens, and the words and (word, context) pairs with a share above ``HOT``.

    A share above HOT overall is above HOT / 2 in blocks that hold half of it,
    so only those are sent, and at most 2 / HOT of each kind can reach the bound.
    """
    def run(batches):
        import pyarrow as pa

        for block in _read(batches):
            word, ctx, _, _, words, _ = block.arrays()
            n = np.bincount(word, minlength=len(words))
            often = n >= HOT / 2 * len(word)
            big = np.flatnonzero(often)
            mine = often[word]
            pair, m = _counted(word[mine].astype(np.int64) * CONTEXTS + ctx[mine])
            pair, m = pair[m >= HOT / 2 * len(word)], m[m >= HOT / 2 * len(word)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *(words[i] for i in big), *(words[i] for i in pair // CONTEXTS)], pa.binary()),
                 pa.array(np.r_[-1, np.full(len(big), -1), pair % CONTEXTS], pa.int32()),
                 pa.array(np.r_[len(word), n[big], m], pa.int64())], names=["word", "ctx", "n"])

    parts = src.mapInArrow(run, "word binary, ctx int, n long").groupBy("word", "ctx").agg(F.sum("n").alias("n"))
    parts = written(parts, "pitmanyor-frequent")
    total = parts.filter("word is null").agg(F.sum("n")).first()[0] or 0
    hot: dict[bytes, set[int]] = defaultdict(set)
    for r in parts.filter(F.col("word").isNotNull() & (F.col("n") >= HOT / 2 * total)).collect():
        own = hot[bytes(r["word"])]
        if r["ctx"] >= 0:
            own.add(r["ctx"])
    return total, dict(hot)


def _home(code, ctx, hot, spread, buckets):
    """Bucket of a word, of a hot word's context range, or for spread pairs of the block."""
    return (code // 7 + hot * (ctx // (CONTEXTS // RANGES)) * 7919 + spread) % buckets


def _entries(block: Block, hot: dict[bytes, set[int]], buckets: int, number: int, train_only: bool):
    """Rows (bucket, block, words, counts, ctx, pos, n): distinct (word, context[, document]) with
    their tokens, of one bucket each."""
    import pyarrow as pa
    import pyarrow.compute as pc

    word, ctx, pos, held, words, code = block.arrays()
    is_hot = np.asarray(pc.is_in(pa.array(words, pa.binary()), pa.array(list(hot), pa.binary()))).astype(np.int64)
    if train_only:
        word, ctx = word[~held], ctx[~held]
    key = word.astype(np.int64)
    key *= CONTEXTS
    key += ctx
    key *= DOCS
    if not train_only:
        key += pos
    del word, ctx, pos, held
    key, n = _counted(key)
    pos, pair = (key % DOCS).astype(np.uint16), key // DOCS
    word, ctx = (pair // CONTEXTS).astype(np.int32), (pair % CONTEXTS).astype(np.uint16)
    home = _home(code, 0, 0, 0, buckets)[word]
    own = np.flatnonzero(is_hot[word])                       # of hot words, by context too
    if len(own):
        spread = np.zeros(len(own), np.int64)
        if not train_only:
            pairs = [i * CONTEXTS + c for i in np.flatnonzero(is_hot) for c in hot[words[i]]]
            spread[np.isin(pair[own], np.array(pairs, np.int64))] = number * 31 + 1
        home[own] = _home(code[word[own]], ctx[own].astype(np.int64), 1, spread, buckets)
    del key, pair
    order = np.argsort(home.astype(np.uint16) if buckets <= 1 << 16 else home, kind="stable")
    home, word, ctx, pos, n = home[order], word[order], ctx[order], pos[order], n[order]
    ends = np.r_[np.flatnonzero(np.r_[True, home[1:] != home[:-1]]) if len(home) else [0], len(home)].astype(int)
    for lo, hi in zip(ends[:-1], ends[1:]):
        if lo == hi:
            continue
        own = word[lo:hi]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        yield (int(home[lo]), number, b" ".join([words[i] for i in own[first]]), _pack(np.diff(np.r_[first, hi - lo])),
               _pack(ctx[lo:hi]), None if train_only else _pack(pos[lo:hi]), _pack(n[lo:hi]))


#: Number lists are packed; words hold no blank, so they are joined by one.
ROWS = "bucket int, block long, words binary, counts binary, ctx binary, pos binary, n binary"
ROW_NAMES = ["bucket", "block", "words", "counts", "ctx", "pos", "n"]


def _number(k: int) -> int:
    return (TaskContext.get().partitionId() << 24) + k


def training_counts(src: DataFrame, hot, buckets: int) -> DataFrame:
    def run(batches):
        for k, block in enumerate(_read(batches)):
            yield _batch(list(_entries(block, hot, buckets, _number(k), True)), ROW_NAMES)

    return src.mapInArrow(run, ROWS)


def scored_tokens(src: DataFrame, hot, buckets: int) -> DataFrame:
    """All documents' entries; one row more per block, with its ids and numbers of tokens."""
    names = [*ROW_NAMES, "ids", "sizes"]

    def run(batches):
        import pyarrow as pa

        for k, block in enumerate(_read(batches)):
            rows = [(*row, None, None) for row in _entries(block, hot, buckets, _number(k), False)]
            ids = pa.array(block.keys, pa.int64())
            known = _pack(np.asarray(ids.is_valid()))
            rows.append((_number(k) % buckets, _number(k), *[None] * 5,
                         known + np.asarray(ids.fill_null(0), "<i8").tobytes(), _pack(block.lengths())))
            yield _batch(rows, names)

    return src.mapInArrow(run, ROWS + ", ids binary, sizes binary")


def _joined(rows):
    """(distinct words, word of each entry, context, tokens, entries of each row) of packed rows."""
    import pyarrow as pa

    words = [w for x in rows.column("words") for w in x.as_py().split(b" ")]
    code = pa.array(words, pa.binary()).dictionary_encode()
    parts = {k: [_unpack(x.as_buffer()) for x in rows.column(k)] for k in ("counts", "ctx", "n")}
    each = np.repeat(np.asarray(code.indices).astype(np.int64), np.concatenate(parts["counts"]))
    return (code.dictionary, each, np.concatenate(parts["ctx"]), np.concatenate(parts["n"]),
            np.array([len(x) for x in parts["ctx"]]))


STATE_NAMES = ["bucket", "words", "pairs", "ctx", "customers", "tables", "seated", "total", "parents", "parent_seated",
               "averages"]
STATE = "bucket int, " + ", ".join(f"{x} binary" for x in STATE_NAMES[1:])


def initial_state(counts: DataFrame) -> DataFrame:
    """One row per bucket: its words, the contexts of each with customers, all of a pair at one table."""
    def run(table):
        import pyarrow as pa

        names, word, ctx, n, _ = _joined(table)
        pair, at = np.unique(word * CONTEXTS + ctx, return_inverse=True)
        c = np.bincount(at, weights=n, minlength=len(pair)).astype(np.int64)
        pairs = np.bincount(pair // CONTEXTS, minlength=len(names))
        one = np.ones(len(c), np.int64)
        row = (table.column("bucket")[0].as_py(), b" ".join(names.to_pylist()), _pack(pairs), _pack(pair % CONTEXTS),
               _pack(c), _pack(one), _pack(c), _pack(0 * c), _pack(np.ones(len(pairs), np.int64)), _pack(pairs), b"")
        return pa.Table.from_batches([_batch([row], STATE_NAMES)])

    return counts.groupBy("bucket").applyInArrow(run, STATE)


def _shuffled(group, n_groups: int, rng):
    """Indices by rising group, in random order within each: one sort of (group, draw, index)."""
    index = max(1, len(group)).bit_length()
    draw = 63 - n_groups.bit_length() - index
    key = group.astype(np.int64) << draw
    key |= rng.integers(0, 1 << draw, len(group))
    key <<= index
    key |= np.arange(len(group))
    key.sort()
    key &= (1 << index) - 1
    return key


def reseat(seated, group, weight, discount: float, rng, parts: int = 64):
    """One Gibbs sweep: every customer leaves its table and is seated again.

    ``seated``: customers of each table; ``group``: its restaurant and dish, ascending;
    ``weight``: of a new table, per group.  Groups up to ``parts`` customers are reseated one
    customer at a time.  Returns the new (seated, group), by group.
    """
    n_groups, tables = len(weight), len(seated)
    table = np.repeat(np.arange(tables), seated)
    own = group[table]
    size = np.bincount(own, minlength=n_groups)
    start = np.cumsum(size) - size
    # A random order within each group, dealt to parts in turn.
    order = _shuffled(own, n_groups, rng)
    turn = ((np.arange(len(own)) - np.repeat(start, size)) % parts).astype(np.int64)
    queue = np.sort(turn << 40 | order)
    ends = np.searchsorted(queue, np.arange(parts + 1) << 40)
    queue &= (1 << 40) - 1
    held = np.zeros(tables + len(own), np.int64)
    held[:tables] = seated
    count = size.copy()
    open_ = np.bincount(group, minlength=n_groups)
    for k in range(parts):
        who = queue[ends[k]:ends[k + 1]]
        if not len(who):
            continue
        left, g = table[who], own[who]
        np.subtract.at(held, left, 1)
        np.subtract.at(count, g, 1)
        gone = np.unique(left[held[left] == 0])
        np.subtract.at(open_, np.where(gone < tables, group[np.minimum(gone, tables - 1)], own[gone - tables]), 1)
        table[who] = -1
        rest = count[g] - discount * open_[g]
        new = rng.random(len(who)) * (weight[g] + rest) < weight[g]
        new |= count[g] == 0
        chosen = np.where(new, tables + who, -1)
        todo = np.flatnonzero(~new)
        while len(todo):
            # A customer still seated, taken with chance 1 - discount / size of its table: tables by size - discount.
            gt = g[todo]
            pick = table[start[gt] + (rng.random(len(todo)) * size[gt]).astype(np.int64)]
            ok = (pick >= 0) & (rng.random(len(todo)) * held[pick] < held[pick] - discount)
            chosen[todo[ok]] = pick[ok]
            todo = todo[~ok]
        table[who] = chosen
        np.add.at(held, chosen, 1)
        np.add.at(count, g, 1)
        np.add.at(open_, g[new], 1)
    kept = np.flatnonzero(held)
    group = np.concatenate([group, own])[kept]
    order = np.argsort(group, kind="stable")
    return held[kept][order], group[order]


def _resize(seated, group, want, rng):
    """Let random customers go, or seat more at tables of their own, until each group has ``want``."""
    table = np.repeat(np.arange(len(seated)), seated)
    own = group[table]
    order = _shuffled(own, len(want), rng)
    size = np.bincount(own, minlength=len(want))
    rank = np.arange(len(own)) - (np.cumsum(size) - size)[own[order]]
    stay = order[rank < want[own[order]]]
    left = np.bincount(table[stay], minlength=len(seated))
    more = np.repeat(np.arange(len(want)), np.maximum(want - size, 0))
    group = np.concatenate([group[left > 0], more])
    seated = np.concatenate([left[left > 0], np.ones(len(more), np.int64)])
    order = np.argsort(group, kind="stable")
    return seated[order], group[order]


class Totals:
    """What the buckets share: per context customers and tables, per hot word parent customers and
    tables, and the parent's totals."""

    def __init__(self, customers, tables, hot, parent, parent_tables, words, train, discounts):
        self.customers, self.tables, self.hot = customers, tables, hot
        self.parent, self.parent_tables, self.words, self.train = parent, parent_tables, words, train
        self.discount, self.parent_discount = discounts

    def base(self) -> float:
        return (STRENGTH + self.parent_discount * self.parent_tables) / (self.words + 1)

    def unknown(self) -> float:
        """P(word) of a word that no training document holds."""
        return self.base() / (STRENGTH + self.parent)

    def word(self, n, t):
        return (n - self.parent_discount * t + self.base()) / (STRENGTH + self.parent)

    def rise(self):
        return STRENGTH + self.discount * self.tables


#: Customers reseated together: bounds the arrays of a task.
CHUNK = 1 << 18


class Seats:
    """A bucket's state row as arrays."""

    def __init__(self, row: dict):
        for k in STATE_NAMES[2:-1]:
            setattr(self, k, _unpack(row[k].as_buffer()))
        self.words = row["words"].as_py().split(b" ")
        self.averages = np.frombuffer(row["averages"].as_buffer(), "<f8")
        self.word = np.repeat(np.arange(len(self.pairs)), self.pairs)

    def hot_words(self, hot) -> list[int]:
        return [i for i, w in enumerate(self.words) if w in hot] if hot else []

    def parent_counts(self):
        """Parent customers and tables of each word, of this bucket."""
        return np.bincount(self.word, weights=self.tables, minlength=len(self.pairs)), self.parents

    def word_probability(self, totals: Totals):
        """P(word); of a hot word with what other buckets hold of it, as of the last sweep."""
        n, t = (np.array(x, float) for x in self.parent_counts())
        for i in self.hot_words(totals.hot):
            n[i], t[i] = totals.hot[self.words[i]][:2]
        return totals.word(n, t)

    def sweep(self, totals: Totals, rng) -> None:
        weight = totals.rise()[self.ctx] * self.word_probability(totals)[self.word]
        self.seated, self.tables = _reseat_all(self.seated, self.tables, weight, totals.discount, rng)
        want = np.bincount(self.word, weights=self.tables, minlength=len(self.pairs)).astype(np.int64)
        above = np.repeat(np.arange(len(self.pairs)), self.parents)
        seated, above = _resize(self.parent_seated, above, want, rng)
        self.parent_seated, self.parents = _reseat_all(
            seated, np.bincount(above, minlength=len(want)), np.full(len(want), totals.base()), totals.parent_discount, rng)

    def keep(self, totals: Totals) -> None:
        """Add this sample: tables per pair, and P(word)."""
        self.total = self.total + self.tables
        self.averages = np.concatenate([self.averages, self.word_probability(totals)])

    def row(self, bucket: int) -> tuple:
        return (bucket, b" ".join(self.words), *(_pack(getattr(self, k)) for k in STATE_NAMES[2:-1]),
                self.averages.astype("<f8").tobytes())


@functools.cache
def _seatings(n: int, discount: float):
    """Table sizes of all seatings of ``n`` customers, their numbers of tables, and their chance
    up to weight ** tables: the ways to form them times the old customers' shares."""
    def parts(left, most):
        if not left:
            yield ()
        for k in range(min(left, most), 0, -1):
            for rest in parts(left - k, k):
                yield (k, *rest)

    sizes = list(parts(n, n))
    chance = []
    for s in sizes:
        ways = math.factorial(n) / math.prod(math.factorial(k) for k in s) / math.prod(
            math.factorial(m) for m in Counter(s).values())
        chance.append(ways * math.prod(math.prod(j - discount for j in range(1, k)) for k in s))
    return sizes, np.array([len(s) for s in sizes]), np.array(chance)


#: Groups up to here are seated jointly from all their seatings.
JOINT = 8


def _reseat_all(seated, tables, weight, discount: float, rng):
    """One sweep over all groups: (seated, tables per group).

    Groups of up to ``JOINT`` customers draw their whole seating at once from its exact conditional
    distribution (a blocked Gibbs step); larger ones go through ``reseat`` in chunks of whole groups.
    """
    ends = np.cumsum(tables)
    size = np.add.reduceat(seated, ends - tables) if len(tables) else np.empty(0, np.int64)
    new_tables, drawn = tables.copy(), []
    for n in range(2, JOINT + 1):
        group = np.flatnonzero(size == n)
        if not len(group):
            continue
        sizes, count, chance = _seatings(n, discount)
        up = np.cumsum(chance * weight[group][:, None] ** count, axis=1)
        pick = (rng.random(len(group))[:, None] * up[:, -1:] >= up[:, :-1]).sum(1)
        new_tables[group] = count[pick]
        drawn += [(group[pick == k], s) for k, s in enumerate(sizes)]
    many = size > JOINT
    pieces = np.repeat(many, tables)
    own, group = seated[pieces], np.flatnonzero(many)
    counts = tables[group]
    moved, at, lo = [], np.cumsum(counts), 0
    bounds = np.cumsum(size[group])
    while lo < len(group):
        hi = max(lo + 1, int(np.searchsorted(bounds, (bounds[lo - 1] if lo else 0) + CHUNK, "right")))
        a, b = at[lo] - counts[lo], at[hi - 1]
        got, which = reseat(own[a:b], np.repeat(np.arange(hi - lo), counts[lo:hi]), weight[group[lo:hi]], discount, rng)
        new_tables[group[lo:hi]] = np.bincount(which, minlength=hi - lo)
        moved.append(got)
        lo = hi
    out = np.ones(int(new_tables.sum()), np.int64)
    start = np.cumsum(new_tables) - new_tables
    for group, sizes in drawn:
        for j, k in enumerate(sizes):
            out[start[group] + j] = k
    if moved:
        out[np.repeat(many, new_tables)] = np.concatenate(moved)
    return out, new_tables


def _each(batches, pending: Totals | None = None):
    """(bucket, Seats) of every state row; ``pending``: a sample that is still to be added."""
    for batch in batches:
        for i in range(batch.num_rows):
            seats = Seats({k: batch.column(j)[i] for j, k in enumerate(STATE_NAMES) if j})
            if pending is not None:
                seats.keep(pending)
            yield batch.column(0)[i].as_py(), seats


def summed(state: DataFrame, hot, discounts=None) -> Totals:
    """Totals over all buckets: ``CONTEXTS`` rows, the hot words and some scalars reach the driver."""
    names = list(hot)

    def run(batches):
        import pyarrow as pa

        a, b = np.zeros(CONTEXTS), np.zeros(CONTEXTS)
        own = np.zeros((len(names), 3))
        ones = np.zeros(8)
        for _, s in _each(batches):
            a += np.bincount(s.ctx, weights=s.customers, minlength=CONTEXTS)
            b += np.bincount(s.ctx, weights=s.tables, minlength=CONTEXTS)
            n, t = s.parent_counts()
            cold = np.ones(len(n), bool)
            c = np.bincount(s.word, weights=s.customers, minlength=len(n))
            for i in s.hot_words(hot):
                own[names.index(s.words[i])] += n[i], t[i], c[i]
                cold[i] = False
            ones += (n.sum(), t.sum(), cold.sum(), s.customers.sum(), (s.customers == 1).sum(),
                     (s.customers == 2).sum(), (n == 1).sum(), (n == 2).sum())
        used = np.flatnonzero(a)
        kind = np.r_[np.zeros(len(used)), np.ones(len(names)), [2] * 8].astype(np.int32)
        key = np.r_[used, np.arange(len(names)), np.arange(8)].astype(np.int32)
        x, y, z = (np.concatenate(v) for v in ((a[used], own[:, 0], ones), (b[used], own[:, 1], np.zeros(8)),
                                               (np.zeros(len(used)), own[:, 2], np.zeros(8))))
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(key), pa.array(x), pa.array(y), pa.array(z)],
                                         names=["kind", "key", "x", "y", "z"])

    found = (state.mapInArrow(run, "kind int, key int, x double, y double, z double").groupBy("kind", "key")
             .agg(F.sum("x").alias("x"), F.sum("y").alias("y"), F.sum("z").alias("z")).toArrow().to_pydict())
    customers, tables, own, ones = np.zeros(CONTEXTS), np.zeros(CONTEXTS), {}, np.zeros(8)
    for kind, key, x, y, z in zip(*(found[k] for k in ("kind", "key", "x", "y", "z"))):
        if kind == 0:
            customers[key], tables[key] = x, y
        elif kind == 1:
            own[names[key]] = (x, y, z)
        else:
            ones[key] = x
    own = {k: v for k, v in own.items() if v[2]}
    if discounts is None:
        ratio = lambda a, b: float(min(0.95, max(0.05, a / (a + 2 * b) if a else 0.5)))
        discounts = ratio(ones[4], ones[5]), ratio(ones[6], ones[7])
    return Totals(customers, tables, own, ones[0], ones[1], int(ones[2]) + len(own), int(ones[3]), discounts)


class Model:
    """The last state, the totals of every kept sample and the hot pairs."""

    def __init__(self, state, samples, totals, hot, buckets):
        self.state, self.samples, self.totals, self.hot, self.buckets = state, samples, totals, hot, buckets


def fit(src: DataFrame, burn_in: int = 2, samples: int = 2, seed: int = 11) -> Model:
    """``src``: (key, text).  Learn from the documents that are not held out."""
    spark = src.sparkSession
    tokens, hot = frequent(src)
    buckets = max(1, -(-tokens // BUCKET))
    counts = training_counts(src, hot, buckets)
    state = written(initial_state(counts), "pitmanyor-seats")
    totals = summed(state, hot)
    kept: list[Totals] = []
    for k in range(burn_in + samples):
        shared = spark.sparkContext.broadcast(totals)     # CONTEXTS numbers twice, 2 / HOT words

        def run(batches, k=k, shared=shared, again=bool(kept)):
            now = shared.value
            for bucket, s in _each(batches, now if again else None):
                s.sweep(now, np.random.default_rng([seed, k, bucket]))
                yield _batch([s.row(bucket)], STATE_NAMES)

        before, state = state, written(state.mapInArrow(run, STATE), "pitmanyor-seats")
        drop_written(before)
        totals = summed(state, hot, (totals.discount, totals.parent_discount))
        if k >= burn_in:
            kept.append(totals)
    return Model(state, kept, totals, hot, buckets)


def hot_pairs(model: Model) -> dict[tuple[bytes, int], tuple[int, int]]:
    """(word, context) -> (customers, tables over all samples) of the pairs that are scored anywhere."""
    hot = {w: c for w, c in model.hot.items() if c}

    last = model.samples[-1]

    def run(batches):
        import pyarrow as pa

        out = []
        for _, s in _each(batches, last):
            for i in s.hot_words(hot):
                at = np.flatnonzero((s.word == i) & np.isin(s.ctx, list(hot[s.words[i]])))
                out += [(s.words[i], int(s.ctx[j]), int(s.customers[j]), int(s.total[j])) for j in at]
        cols = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), *(pa.int64(),) * 3))],
                                         names=["word", "ctx", "c", "t"])

    if not hot:
        return {}
    rows = model.state.mapInArrow(run, "word binary, ctx long, c long, t long").collect()
    return {(bytes(r["word"]), r["ctx"]): (r["c"], r["t"]) for r in rows}


class Scorer:
    """Probabilities of a bucket's tokens; ``seats`` is None where no training document holds its words.

    ``names``: the distinct words that entries refer to by position.
    """

    def __init__(self, samples: list[Totals], pairs: dict, names, seats: Seats | None):
        import pyarrow as pa
        import pyarrow.compute as pc

        self.samples, self.seats, self.last = samples, seats, samples[-1]
        n = len(names)
        self.at, self.tokens = np.full(n, -1), np.zeros(n)
        self.p = np.array([np.full(n, t.unknown()) for t in samples])
        if s := seats:
            self.at = np.asarray(pc.fill_null(pc.index_in(names, pa.array(s.words, pa.binary())), -1)).astype(np.int64)
            own = self.at >= 0
            self.tokens[own] = np.bincount(s.word, weights=s.customers, minlength=len(s.pairs))[self.at[own]]
            self.p[:, own] = s.averages.reshape(len(samples), -1)[:, self.at[own]]
            self.known = s.word * CONTEXTS + s.ctx
        index = {w: i for i, w in enumerate(names.to_pylist()) if w in self.last.hot} if self.last.hot else {}
        for w, i in index.items():
            self.tokens[i] = self.last.hot[w][2]
            self.p[:, i] = [t.word(*t.hot[w][:2]) for t in samples]
        self.spread = np.array(sorted((index[w] * CONTEXTS + u, *v) for (w, u), v in pairs.items() if w in index),
                               np.int64).reshape(-1, 3)
        self.rise = [x.rise() for x in samples]

    def entries(self, word, ctx):
        """(training tokens of the word, averaged P(word | context)) of each entry."""
        c, t = np.zeros(len(word)), np.zeros(len(word))
        if s := self.seats:
            key = self.at[word] * CONTEXTS + ctx
            i = np.minimum(np.searchsorted(self.known, key), len(self.known) - 1)
            hit = (self.known[i] == key) & (self.at[word] >= 0)
            c[hit], t[hit] = s.customers[i[hit]], s.total[i[hit]]
        if len(self.spread):
            key = word * CONTEXTS + ctx
            i = np.minimum(np.searchsorted(self.spread[:, 0], key), len(self.spread) - 1)
            hit = self.spread[i, 0] == key
            c[hit], t[hit] = self.spread[i[hit], 1], self.spread[i[hit], 2]
        m = len(self.samples)
        down = sum(x[ctx] * p[word] for x, p in zip(self.rise, self.p))
        prob = (m * c - self.last.discount * t + down) / (m * (STRENGTH + self.last.customers[ctx]))
        return self.tokens[word], prob


PART_NAMES = ["bucket", "block", "ids", "sizes", "pos", "known", "base", "score"]
PART = "bucket int, block long, ids binary, sizes binary, pos binary, known binary, base binary, score binary"
RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def score(src: DataFrame, model: Model) -> DataFrame:
    spark = src.sparkSession
    shared = spark.sparkContext.broadcast((model.samples, hot_pairs(model)))  # bounded by CONTEXTS and 2 / HOT

    def run(state, rows):
        import pyarrow as pa
        import pyarrow.compute as pc

        samples, pairs = shared.value
        last = samples[-1]
        lists = pc.is_valid(rows.column("ids"))
        ids, rows = rows.filter(lists), rows.filter(pc.invert(lists))
        out = [(b, k, i, s, None, None, None, None) for b, k, i, s in zip(*(ids.column(x).to_pylist() for x in
                                                                     ("bucket", "block", "ids", "sizes")))]
        if rows.num_rows:
            seats = None
            if state.num_rows:
                seats = Seats({k: state.column(k)[0] for k in STATE_NAMES})
                seats.keep(last)
            names, word, ctx, n, size = _joined(rows)
            scorer = Scorer(samples, pairs, names, seats)
            at = np.r_[0, np.cumsum(size)]
            for i, (bucket, block) in enumerate(zip(rows.column("bucket").to_pylist(), rows.column("block").to_pylist())):
                own = slice(at[i], at[i + 1])                # a block at a time: the arrays stay small
                c, prob = scorer.entries(word[own], ctx[own])
                pos, back = np.unique(_unpack(rows.column("pos")[i].as_buffer()), return_inverse=True)
                base = np.log10((c + 1) / (last.train + last.words + 1))
                known, base, total = (np.bincount(back, weights=x, minlength=len(pos))
                                      for x in (n[own] * (c > 0), n[own] * base, n[own] * np.log10(prob)))
                out.append((bucket, block, None, None, _pack(pos), _pack(known.astype(np.int64)),
                            base.astype("<f8").tobytes(), total.astype("<f8").tobytes()))
        return pa.Table.from_batches([_batch(out, PART_NAMES)])

    parts = (model.state.groupBy("bucket").cogroup(scored_tokens(src, model.hot, model.buckets).groupBy("bucket"))
             .applyInArrow(run, PART))
    train = model.totals.train

    def close(rows):
        import pyarrow as pa
        import pyarrow.compute as pc

        rows = rows.sort_by("bucket")
        lists = pc.is_valid(rows.column("ids"))
        head = rows.filter(lists)
        tokens = _unpack(head.column("sizes")[0].as_buffer())
        data = head.column("ids")[0].as_py()
        valid = _unpack(data[:len(tokens) + 1]) > 0
        ids = pa.array(np.frombuffer(data[len(tokens) + 1:], "<i8"), mask=~valid)
        held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i in ids.to_pylist()]
        known, base, own = np.zeros((3, len(tokens)))
        rows = rows.filter(pc.invert(lists))
        for i in range(rows.num_rows):
            pos = _unpack(rows.column("pos")[i].as_buffer())
            known[pos] += _unpack(rows.column("known")[i].as_buffer())
            base[pos] += np.frombuffer(rows.column("base")[i].as_buffer(), "<f8")
            own[pos] += np.frombuffer(rows.column("score")[i].as_buffer(), "<f8")
        return pa.table([ids, pa.array(held, pa.bool_()), pa.array(tokens), pa.array(known.astype(np.int64)),
                         pa.array(np.full(len(tokens), train, np.int64)), pa.array(base), pa.array(own)],
                        names=[x.split()[0] for x in RESULT.split(", ")])

    return parts.groupBy("block").applyInArrow(close, RESULT)


def pitman_yor(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    src = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return score(src, fit(src, **options))
