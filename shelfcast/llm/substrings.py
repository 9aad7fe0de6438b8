"""Operator 6: substring deduplication with an FM-index per shard.

A window of ``window`` words is removed from a document if the same words also
start in a document with a smaller id.

1. Every window is filed under its minimiser, the ``gram``-word sequence of
   smallest hash in it: a choice that depends on the window's words alone, so
   equal windows share it.  Neighbouring windows with one minimiser form a
   fragment.
2. Minimisers seen in two different documents or more are kept; fragments are
   reduced to distinct ones with their smallest document before any words
   move, so groups of copies cost one fragment each.
3. The words of distinct fragments go to shards by minimiser.  A shard builds
   an FM-index over them (BWT in a wavelet matrix) and streams the fragments
   through backward search; at ``window`` matched words the interval's
   smallest document is reported.
4. Occurrences take the runs of windows whose smallest document precedes
   their own, and the words those runs cover are cut.

Shards hold about ``shard_words`` words of distinct fragments each; the shard
count follows the data.  A passage in very many documents has, at its ends,
one minimiser with as many different fragments; minimisers with more than
``hot_fragments`` of them are dealt window by window instead: equal windows
are first reduced to one, and the shard follows the window's own hash.

Edge cases: null and empty texts have no words; texts shorter than a window
lose nothing; rows with a null id neither remove nor lose words; rows with the
same id are not before each other; equal windows within one document are no
reason to remove; long texts are read whole; extra columns are carried, and
replaced where they clash with an output column.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from shelfcast.llm import words as W
from shelfcast.llm.common import written

OUT = "n_words long, n_removed long, kept_sha256 string, kept_text string"
GRAM = 8
BROADCAST_IDS = 1_000_000  # document ids (16 MB) that may be broadcast; more are joined by shuffle


def _leftmost_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """Index of the first minimum of each run of ``width`` values."""
    n = len(h) - width + 1
    idx, span = np.arange(len(h)), 1

    def merge(shift):
        a, b = idx[:len(idx) - shift], idx[shift:]
        return np.where(h[a] <= h[b], a, b)

    while span * 2 <= width:
        idx, span = merge(span), span * 2
    if span < width:
        idx = merge(width - span)
    return idx[:n]


def fragments(w: W.Words, window: int):
    """(doc, minimiser, fragment hash, first window, windows) of a chunk."""
    if len(w.value) < window:
        empty = np.empty(0, np.int64)
        return empty, np.empty(0, np.uint64), np.empty(0, np.uint64), empty, empty
    gram = W.Words(w.buf, w.start, w.end, w.value, w.first, np.zeros(len(w.value), np.int64)).shingles(GRAM)[0]
    low = _leftmost_minimum(gram, window - GRAM + 1)
    st = np.flatnonzero(w.doc[:len(w.doc) - window + 1] == w.doc[window - 1:])
    low = low[st]
    if not len(st):
        return st, np.empty(0, np.uint64), np.empty(0, np.uint64), st, st
    new = np.r_[True, (low[1:] != low[:-1]) | (st[1:] != st[:-1] + 1) | (w.doc[st[1:]] != w.doc[st[:-1]])]
    a = np.flatnonzero(new)
    s_lo, s_hi = st[a], st[np.r_[a[1:], len(st)] - 1]
    # A digest of the fragment's word values; fragments overlap by a window only.
    data = memoryview(w.value.astype("<u8").tobytes())
    whole = np.array([W.digest(data[8 * i:8 * j]) for i, j in zip(s_lo.tolist(), (s_hi + window).tolist())], np.uint64)
    doc = w.doc[s_lo]
    return doc, gram[low[a]], whole, s_lo - w.first[doc], s_hi - s_lo + 1


def _anchors(df: DataFrame, window: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        names = ["doc", "row", "a", "f", "at", "n"]
        for batch in batches:
            ids, row = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, hi, buf, off in W.chunks(batch.column(2)):
                d, a, f, at, n = fragments(W.scan(buf, off, W.BLANK_WORDS), window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo + d]), pa.array(row[lo + d]), pa.array(a.view(np.int64)),
                     pa.array(f.view(np.int64)), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=names)

    return df.mapInArrow(run, "doc long, row long, a long, f long, at int, n int")


def _fragment_words(df: DataFrame, window: int, single: bool) -> DataFrame:
    """(doc, text, frags) -> (a, f, from, key, doc, words) with 64-bit word values.

    One row per fragment, keyed by its minimiser, or (``single``) one per
    window, keyed by the window's hash.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            docs, frags = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for lo, hi, buf, off in W.chunks(batch.column(1)):
                w = W.scan(buf, off, W.BLANK_WORDS)
                rows = []
                for i in range(lo, hi):
                    base = int(w.first[i - lo])
                    for x in frags[i]:
                        s, n = base + x["at"], x["n"]
                        if not single:
                            rows.append((x["a"], x["f"], 0, x["a"], docs[i], w.value[s:s + n + window - 1].tobytes()))
                            continue
                        own = W.Words(w.buf, w.start, w.end, w.value[s:s + n + window - 1], w.first,
                                      np.zeros(n + window - 1, np.int64)).shingles(window)[0].view(np.int64)
                        rows += [(x["a"], x["f"], k, int(own[k]), docs[i], w.value[s + k:s + k + window].tobytes())
                                 for k in range(n)]
                cols = list(zip(*rows)) or [[]] * 6
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=["a", "f", "from", "key", "doc", "words"])

    return df.mapInArrow(run, "a long, f long, `from` int, key long, doc long, words binary")


def _shard_matches(window: int):
    """Table of one shard's fragments -> runs (a, f, single, from, n, least)."""

    def run(table):
        import pyarrow as pa

        from shelfcast.llm.fmindex import FMIndex

        a, f, single = (table[c].to_numpy() for c in ("a", "f", "single"))
        frags = [np.frombuffer(x, np.uint64) for x in table["words"].to_pylist()]
        index = FMIndex(frags, table["doc"].to_numpy(), window)
        got = index.smallest_owner()
        owner = np.repeat(np.arange(len(got)), [len(g) for g in got])
        least = np.concatenate(got)
        at = np.concatenate([np.arange(len(g)) for g in got])
        new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (least[1:] != least[:-1])])
        n = np.diff(np.r_[new, len(least)])
        return pa.table({"a": a[owner[new]], "f": f[owner[new]], "single": single[owner[new]], "from": at[new].astype(np.int32),
                         "n": n.astype(np.int32), "least": least[new]})

    return run


def repeated_ranges(df: DataFrame, key: str, text: str, window: int, shard_words: int,
                    hot_fragments: int) -> DataFrame:
    """doc, row, ranges: word ranges [start, end) that windows of earlier documents cover."""
    src = df.select(F.col(key).cast("long").alias("doc"), F.xxhash64(F.col(text)).alias("row"),
                    F.col(text).alias("text")).filter("doc IS NOT NULL AND text IS NOT NULL")
    anchors = written(_anchors(src, window), "sub-anchors")
    # Written, so that the join below is between two exchanges and a hot
    # minimiser's occurrences can be split.
    shared = written(anchors.groupBy("a").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
                     .filter("lo < hi").select("a"), "sub-minimisers")
    found = written(anchors.join(shared, "a"), "sub-shared")
    distinct = written(found.groupBy("a", "f", "n").agg(F.min(F.struct("doc", "row", "at")).alias("x"))
                       .select("a", "f", "n", "x.*"), "sub-distinct")
    total = distinct.agg(F.count("*"), F.sum(F.col("n") + window - 1)).first()
    shards = 1 + (total[1] or 0) // shard_words
    hot = written(distinct.groupBy("a").count().filter(F.col("count") > hot_fragments).select("a"), "sub-hot")

    def taken(part: DataFrame, label: str) -> DataFrame:
        """doc, text, frags: fragments of each document that lends their words."""
        lists = written(part.groupBy("doc", "row").agg(
            F.collect_list(F.struct("a", "f", "at", "n")).alias("frags")), label)  # at most a document's own
        owners = lists.select("doc", "row")
        few = owners.count() <= BROADCAST_IDS
        texts = src.join(F.broadcast(owners) if few else owners, ["doc", "row"], "left_semi")
        return texts.dropDuplicates(["doc", "row"]).join(lists, ["doc", "row"]).select("doc", "text", "frags")

    pieces = _fragment_words(taken(distinct.join(hot, "a", "left_anti"), "sub-lists"), window, False)
    windows = written(_fragment_words(taken(distinct.join(hot, "a", "left_semi"), "sub-hot-lists"), window, True),
                      "sub-hot-windows")
    ones = windows.groupBy("key").agg(F.min("doc").alias("doc"), F.first("words").alias("words"))
    pieces = pieces.select("a", "f", F.lit(False).alias("single"), "doc", "words").unionByName(
        ones.select(F.col("key").alias("a"), F.col("key").alias("f"), F.lit(True).alias("single"), "doc", "words"))
    runs = written(pieces.withColumn("shard", F.pmod(F.xxhash64("a"), F.lit(shards))).groupBy("shard").applyInArrow(
        _shard_matches(window), "a long, f long, single boolean, `from` int, n int, least long"), "sub-runs")
    of_windows = windows.select("a", "f", "from", "key").join(
        runs.filter("single").select(F.col("a").alias("key"), "n", "least"), "key").drop("key")
    runs = written(runs.filter("NOT single").drop("single").unionByName(of_windows, allowMissingColumns=False)
                   .groupBy("a", "f").agg(F.collect_list(F.struct("from", "n", "least")).alias("runs")), "sub-found")
    hit = (found.select("a", "f", "doc", "row", "at").join(runs, ["a", "f"])
           .select("doc", "row", "at", F.explode("runs").alias("r")).filter("r.least < doc"))
    start = F.col("at") + F.col("r.from")
    return hit.groupBy("doc", "row").agg(F.collect_set(F.struct(
        start.alias("s"), (start + F.col("r.n") + (window - 1)).alias("e"))).alias("ranges"))


def _cut(df: DataFrame, keep: list[str], text: str, with_text: bool) -> DataFrame:
    made = [x.split()[0] for x in OUT.split(", ")][:None if with_text else 3]
    fields = df.select(*keep).schema.fields + StructType.fromDDL(OUT).fields[:len(made)]
    n, where, spans = len(keep), df.columns.index(text), df.columns.index("_ranges")

    def run(batches):
        import pyarrow as pa

        types = (pa.int64(), pa.int64(), pa.string(), pa.string())
        for batch in batches:
            rows = []
            for t, ranges in zip(batch.column(where), batch.column(spans)):
                text = t.as_py()
                parts = (text or "").encode().split()
                total = len(parts)
                if ranges.is_valid:
                    gone = np.zeros(total, bool)
                    for r in ranges.as_py():
                        gone[r["s"]:r["e"]] = True
                    parts = [parts[i] for i in np.flatnonzero(~gone)]
                body = b" ".join(parts)
                rows.append((total, total - len(parts), hashlib.sha256(body).hexdigest(),
                             text if total == len(parts) else body.decode()))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(n)]
                + [pa.array(c, t) for c, t in zip(cols[:len(made)], types)], names=keep + made)

    return df.mapInArrow(run, StructType(fields))


def dedup_substrings(df: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                     window: int = 50, shard_words: int = 400_000, hot_fragments: int = 2000,
                     with_text: bool = True) -> DataFrame:
    """``keep`` columns plus n_words, n_removed, kept_sha256 and kept_text.

    ``kept_text`` is the text itself where nothing is removed, else the kept
    words joined by one blank.
    """
    made = [x.split()[0] for x in OUT.split(", ")]
    keep = [c for c in (df.columns if keep is None else keep) if c not in made]
    ranges = written(repeated_ranges(df, key, text, window, shard_words, hot_fragments), "sub-ranges")
    ranges = ranges.select(F.col("doc").alias("_doc"), F.col("row").alias("_row"), F.col("ranges").alias("_ranges"))
    body = text if text in keep else "_text"  # a text that is carried is not sent twice
    src = df.select(*keep, *([] if text in keep else [F.col(text).alias("_text")]),
                    F.col(key).cast("long").alias("_key"))
    same = (src["_key"] == ranges["_doc"]) & (F.xxhash64(src[body]) == ranges["_row"])
    out = src.join(ranges, same, "left")  # a broadcast only if Spark finds the written table small
    return _cut(out.select(*keep, *([] if text in keep else ["_text"]), "_ranges"), keep, body, with_text)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT rid, doc_id, unnest(generate_series(1, len(ws) - 49)) AS p,
        unnest(list_transform(generate_series(1, len(ws) - 49),
          lambda i: md5(array_to_string(ws[i : i + 49], ' ')))) AS win
      FROM d WHERE len(ws) >= 50),
m AS (SELECT win, min(doc_id) AS lo FROM g GROUP BY win HAVING min(doc_id) < max(doc_id)),
r AS (SELECT DISTINCT rid, unnest(generate_series(p, p + 49)) AS q FROM g JOIN m USING (win) WHERE doc_id > lo),
k AS (SELECT rid, list(q) AS gone, count(*) AS n_removed FROM r GROUP BY rid),
x AS (SELECT d.rid, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS q FROM d),
y AS (SELECT x.rid, string_agg(word, ' ' ORDER BY x.q) AS body
      FROM x LEFT JOIN r ON r.rid = x.rid AND r.q = x.q WHERE r.rid IS NULL GROUP BY x.rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN k USING (rid) LEFT JOIN y USING (rid)
"""
