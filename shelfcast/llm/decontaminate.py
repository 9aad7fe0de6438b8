"""Operator 7: benchmark decontamination by a prefix-filtered set join.

Every benchmark item is cut into windows of ``window`` words (an item of fewer
words is one window).  A window is a set of shingles of three consecutive
words; as a match must contain all of them, its prefix is one shingle, and the
rarest over all documents is taken (counted in a pass of its own).  Documents
are scanned for prefix shingles only; a find gives the window's place by the
shingle's offset (positional bound), must fit into the document (length
bound), and is then verified word by word over the whole window.

The benchmark is the smaller, stated side.  It is cut by window into blocks of
about ``block_windows`` windows; each block is brought to the driver and
broadcast under that bound, and the scans of all blocks are chained in one
pass over the documents.  Nothing about documents is collected but counts of
a block's own shingles.

Edge cases: null and empty texts have no words (documents: not contaminated;
items: no window); items with a null id are skipped; items of equal text or
rows of an item repeated count as their distinct ids; ids sort as strings;
repeated documents get equal answers; an empty benchmark contaminates
nothing; input columns named like an output column are replaced by it.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from shelfcast.llm import words as W
from shelfcast.llm.common import written

OUT = ("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
SHINGLE = 3


class Lookup:
    """Positions of values in a sorted key array, behind a bitmap of top bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.top = np.zeros(1 << 20, bool)
        self.top[keys >> np.uint64(44)] = True

    def find(self, values: np.ndarray):
        if not len(self.keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.top[values >> np.uint64(44)])
        pos = np.minimum(np.searchsorted(self.keys, values[at]), len(self.keys) - 1)
        ok = self.keys[pos] == values[at]
        return at[ok], pos[ok]


def item_windows(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """item, values: word values of each distinct window of an item."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, vals = [], []
            names = batch.column(0).to_pylist()
            for lo, hi, buf, off in W.chunks(batch.column(1)):
                w = W.scan(buf, off, W.ALNUM_WORDS, W.LOWER)
                for d in range(hi - lo):
                    a, b = int(w.first[d]), int(w.first[d + 1])
                    for s in range(a, max(b - window, a) + 1 if b > a else a):
                        ids.append(names[lo + d])
                        vals.append(w.value[s:min(s + window, b)].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(vals, pa.list_(pa.int64()))], names=["item", "values"])

    src = benchmark.filter(F.col(item).isNotNull() & F.col(text).isNotNull())
    src = src.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    return src.mapInArrow(run, "item string, values array<long>").distinct()


class Block:
    """A part of the windows: distinct windows, who has them, their shingles."""

    def __init__(self, rows: list[tuple[str, list[int]]]):
        own: dict[tuple, set[str]] = {}
        for item, vals in rows:
            own.setdefault(tuple(vals), set()).add(item)
        self.windows = [np.array(k, np.int64).view(np.uint64) for k in own]
        self.items = [sorted(v) for v in own.values()]
        self.shingles = []  # per window: values of its shingles, in order
        for w in self.windows:
            k = min(SHINGLE, len(w))
            self.shingles.append(W.Words(np.empty(0, np.uint8), w, w, w, np.array([0, len(w)]),
                                         np.zeros(len(w), np.int64)).shingles(k)[0])

    def tokens(self, k: int) -> np.ndarray:
        found = [s for s, w in zip(self.shingles, self.windows) if min(SHINGLE, len(w)) == k]
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)

    def sizes(self) -> list[int]:
        return sorted({min(SHINGLE, len(w)) for w in self.windows})

    def choose(self, count: dict[int, int]) -> "Prefixes":
        return Prefixes(self, count)


class Prefixes:
    """Per shingle length: rarest shingle of each window and where it stands."""

    def __init__(self, block: Block, count: dict[int, int]):
        self.items = block.items
        self.size = np.array([len(w) for w in block.windows], np.int64)
        width = int(self.size.max()) if len(self.size) else 0
        self.matrix = np.zeros((len(self.size), width), np.uint64)
        per: dict[int, list[tuple[int, int, int]]] = {}
        for i, (w, sh) in enumerate(zip(block.windows, block.shingles)):
            self.matrix[i, :len(w)] = w
            token, at = min((count.get(int(v), 0), int(v), o) for o, v in enumerate(sh))[1:]
            per.setdefault(min(SHINGLE, len(w)), []).append((token, at, i))
        self.by_len = {}
        for k, entries in per.items():
            entries.sort()
            token = np.array([e[0] for e in entries], np.uint64)
            keys, begin = np.unique(token, return_index=True)
            self.by_len[k] = (Lookup(keys), np.r_[begin, len(entries)],
                              np.array([e[1] for e in entries], np.int64),
                              np.array([e[2] for e in entries], np.int64))

    def occurrences(self, w: W.Words):
        """(first word index, window number) of every verified occurrence."""
        starts, which = [], []
        for k, (lookup, begin, offset, number) in self.by_len.items():
            values, at = w.shingles(k)
            hit, key = lookup.find(values)
            if not len(hit):
                continue
            reps = begin[key + 1] - begin[key]
            entry = np.repeat(begin[key], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            pos = np.repeat(at[hit], reps) - offset[entry]
            num = number[entry]
            doc = np.repeat(w.doc[at[hit]], reps)
            fits = (pos >= w.first[doc]) & (pos + self.size[num] <= w.first[doc + 1])
            pos, num = pos[fits], num[fits]
            for j in range(self.matrix.shape[1]):  # word by word; fewer remain each time
                live = j >= self.size[num]
                same = w.value[np.minimum(pos + j, len(w.value) - 1)] == self.matrix[num, j]
                pos, num = pos[live | same], num[live | same]
                if not len(pos):
                    break
            starts.append(pos)
            which.append(num)
        if not starts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(starts), np.concatenate(which)


def shingle_counts(df: DataFrame, text: str, block: Block) -> dict[int, int]:
    """How often each of the block's shingles occurs in all documents."""
    tokens = df.sparkSession.sparkContext.broadcast({k: block.tokens(k) for k in block.sizes()})

    def run(batches):
        import pyarrow as pa

        look = {k: Lookup(v) for k, v in tokens.value.items()}
        total = {k: np.zeros(len(v), np.int64) for k, v in tokens.value.items()}
        for batch in batches:
            for _, _, buf, off in W.chunks(batch.column(0)):
                w = W.scan(buf, off, W.ALNUM_WORDS, W.LOWER)
                for k, lookup in look.items():
                    _, key = lookup.find(w.shingles(k)[0])
                    np.add.at(total[k], key, 1)
        for k, n in total.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(look[k].keys[some].view(np.int64)), pa.array(n[some])], names=["token", "n"])

    rows = df.select(text).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {t & 0xFFFFFFFFFFFFFFFF: n for t, n in rows.collect()}  # at most the block's shingles


def _scan(df: DataFrame, keep: list[str], text: str, prefixes, last: bool) -> DataFrame:
    """One block's pass: adds hit word ranges and items, or the final columns.

    ``text`` is one of ``keep``, or ``_text``, which the last pass drops.
    """
    made = [f.split()[0] for f in OUT.split(", ")]
    carried = keep if text in keep else [*keep, text]
    out_keep = keep if last else carried
    fields = df.select(*out_keep).schema.fields
    tail = StructType.fromDDL(OUT).fields if last else df.select("_hit", "_item").schema.fields
    shared = df.sparkSession.sparkContext.broadcast(prefixes)
    n, where, m = len(carried), carried.index(text), len(out_keep)

    def run(batches):
        import pyarrow as pa

        p = shared.value
        for batch in batches:
            old_hit, old_item = batch.column(n).to_pylist(), batch.column(n + 1).to_pylist()
            rows = []
            for lo, hi, buf, off in W.chunks(batch.column(where)):
                w = W.scan(buf, off, W.ALNUM_WORDS, W.LOWER)
                pos, num = p.occurrences(w)
                doc = w.doc[pos] if len(pos) else pos
                order = np.argsort(doc, kind="stable")
                pos, num, doc = pos[order], num[order], doc[order]
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                for d in range(hi - lo):
                    a, b = cut[d], cut[d + 1]
                    base, total = int(w.first[d]), int(w.first[d + 1] - w.first[d])
                    hits, items = old_hit[lo + d], old_item[lo + d]
                    if b > a:
                        mark = np.zeros(total + 1, np.int64)
                        np.add.at(mark, pos[a:b] - base, 1)
                        np.add.at(mark, pos[a:b] - base + p.size[num[a:b]], -1)
                        on = np.cumsum(mark[:-1]) > 0
                        if hits:
                            on[np.concatenate([np.arange(x, y) for x, y in zip(hits[::2], hits[1::2])])] = True
                        edge = np.flatnonzero(np.diff(np.r_[False, on, False].astype(np.int8)))
                        hits = edge.tolist()
                        items = sorted(set(items).union(*(p.items[i] for i in set(num[a:b].tolist()))))
                    if last:
                        n_hit = sum(hits[1::2]) - sum(hits[::2])
                        rows.append((total, n_hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(),
                                     n_hit > 0 and 20 * n_hit >= total))
                    else:
                        rows.append((hits, items))
            cols = list(zip(*rows)) or [[]] * (5 if last else 2)
            out = [batch.column(i) for i in range(m)]
            if last:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
                out += [pa.array(c, t) for c, t in zip(cols, types)]
            else:
                out += [pa.array(cols[0], pa.list_(pa.int64())), pa.array(cols[1], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(out, names=out_keep + (made if last else ["_hit", "_item"]))

    return df.select(*carried, "_hit", "_item").mapInArrow(run, StructType(fields + tail))


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None,
                  item: str = "item_id", item_text: str = "text", window: int = 13,
                  block_windows: int = 200_000) -> DataFrame:
    """``keep`` columns of ``df`` plus the columns of ``OUT``."""
    made = [f.split()[0] for f in OUT.split(", ")]
    keep = [c for c in (df.columns if keep is None else keep) if c not in made]
    windows = written(item_windows(benchmark, item, item_text, window), "bench-windows")
    n_blocks = 1 + windows.count() // block_windows
    body = text if text in keep else "_text"  # a text that is carried is not sent twice
    out = df.select(*keep, *([] if text in keep else [F.col(text).alias("_text")]), F.array().cast("array<long>").alias("_hit"),
                    F.array().cast("array<string>").alias("_item"))
    for b in range(n_blocks):
        mine = windows.filter(F.pmod(F.xxhash64("values"), F.lit(n_blocks)) == b)
        block = Block([(r[0], r[1]) for r in mine.collect()])  # about block_windows rows
        out = _scan(out, keep, body, block.choose(shingle_counts(df, text, block)), b == n_blocks - 1)
    return out


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
    FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item, k, win FROM (
    SELECT item, least(13, len(ws)) AS k,
           unnest(list_transform(generate_series(1, greatest(1, len(ws) - 12)),
             lambda i: array_to_string(ws[i : i + 12], ' '))) AS win FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT rid, k, unnest(generate_series(1, len(ws) - k + 1)) AS p,
         unnest(list_transform(generate_series(1, len(ws) - k + 1),
           lambda i: array_to_string(ws[i : i + k - 1], ' '))) AS win
       FROM d, ks WHERE len(ws) >= k),
occ AS (SELECT rid, p, k, item FROM dw JOIN bw USING (k, win)),
hit AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (
          SELECT DISTINCT rid, unnest(generate_series(p, p + k - 1)) AS q FROM (SELECT DISTINCT rid, p, k FROM occ))
        GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT rid, item FROM occ) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""
