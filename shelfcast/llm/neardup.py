"""Operator 8: near duplicates by bottom-k sketches.

One hash function ranks every shingle; a document keeps its ``k`` smallest
values.  Documents with equal shingle sets are one class, represented by the
smallest id.  Inverted lists of retained values give candidate pairs: if two
sets reach the threshold their sketches share at least ``need`` values (five
standard deviations below the mean, exact for sets that fit a sketch), so it
is enough to list each class under its rarest retained values (prefix filter).
The union-sketch estimate (shared values among the k smallest of both) drops
weak pairs, and exact Jaccard on the full sets of both texts decides.

A group of N near copies must not cost N squared pairs, so pairs are taken in
two rounds.

1. Stars: each list's most connected member is its head, and every member is
   compared with the heads of its lists.  The head that shares most with a
   class is its nearest head; following nearest heads upwards (weights grow)
   leads to a root.  The root, else the nearest head, becomes the class's
   centre if it covers half of the class; what the class has beyond its centre
   is its residual.
2. Only pairs that lie in different components now can matter.  Two classes of
   one centre C overlap in at most min(|X & C|, |Y & C|) + |shared residual|
   shingles, so they are compared only if they share enough residual shingles
   (found by the rarest ones of each residual, with their positions), or are so
   small that the first term suffices.  Classes without a common centre are compared if a list
   holds both.

Edge cases: null, empty and blank texts have an empty set and link with
nothing; fewer words than a shingle give one shingle; repeated rows of an id
are one document (linked through the id); rows with a null id are returned
with a null component and kept; an empty table gives no rows; long texts are
hashed whole; extra columns are not carried.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm import words as W
from shelfcast.llm.common import written
from shelfcast.llm.components import connected_components

SKETCH = 48
BROADCAST_IDS = 1_000_000  # ids (8 MB) that may be broadcast; more are joined by shuffle


def shingle_sets(w: W.Words, n_docs: int, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle values of each document of a chunk."""
    values, at = w.shingles(k)
    cut = np.searchsorted(at, w.first)
    out = []
    for d in range(n_docs):
        n = int(w.first[d + 1] - w.first[d])
        if 0 < n < k:  # the whole sequence as one shingle
            short = W.Words(w.buf, w.start, w.end, w.value[w.first[d]:w.first[d + 1]], np.array([0, n]),
                            np.zeros(n, np.int64))
            out.append(short.shingles(n)[0] ^ np.uint64(n))
        else:
            out.append(np.unique(values[cut[d]:cut[d + 1]]))
    return out


def sketches(df: DataFrame, key: str, text: str, k: int, size: int) -> DataFrame:
    """id, n (set size), f1, f2 (fingerprint of the set), sketch (smallest values)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n, f1, f2, sk = [], [], [], []
            for lo, hi, buf, off in W.chunks(batch.column(1)):
                for s in shingle_sets(W.scan(buf, off, W.BLANK_WORDS, W.LOWER), hi - lo, k):
                    n.append(len(s))
                    f1.append(int(s.sum().view(np.int64)) if len(s) else None)
                    f2.append(int(W.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64)) if len(s) else None)
                    sk.append(s[:size].view(np.int64))
            i64 = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, i64), pa.array(f1, i64), pa.array(f2, i64),
                 pa.array(sk, pa.list_(i64))], names=["id", "n", "f1", "f2", "sketch"])

    src = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return src.mapInArrow(run, "id long, n long, f1 long, f2 long, sketch array<long>")


def _need(n: Column, t: float, size: int) -> Column:
    """Retained values that a set of n shingles shares with any linked set."""
    s = F.least(n, F.lit(size)).cast("double")
    sampled = F.floor(s * t - 5 * F.sqrt(s * t * (1 - t)))
    return F.greatest(F.lit(1), F.when(n <= size * t, F.ceil(n * t - 1e-9)).otherwise(sampled)).cast("int")


def _postings(classes: DataFrame, t: float, size: int) -> DataFrame:
    """value, id, n, weight: each class under its rarest retained values."""
    held = classes.select("id", "n", F.explode("sketch").alias("value"))
    # Written, so that the join is between two exchanges and can split a hot value.
    seen = written(held.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1"), "sketch-values")
    mine = (held.join(seen, "value").groupBy("id", "n")
            .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v"))  # at most ``size``
            .withColumn("take", F.size("v") - _need(F.col("n"), t, size) + 1).filter("take > 0")
            .withColumn("weight", F.aggregate("v", F.lit(0).cast("long"), lambda x, y: x + y["df"])))
    return mine.select("id", "n", "weight", F.explode(F.slice("v", F.lit(1), F.col("take"))).alias("v")).select(
        F.col("v.value").alias("value"), "id", "n", "weight")


def _compared(pairs: DataFrame, held: DataFrame, t: float, size: int) -> DataFrame:
    """a, b, shared (values of the union sketch in both), plausible."""
    a = held.select(F.col("id").alias("a"), F.col("sketch").alias("sa"), F.col("n").alias("na"))
    b = held.select(F.col("id").alias("b"), F.col("sketch").alias("sb"), F.col("n").alias("nb"))
    both = pairs.join(b, "b").join(a, "a")
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, size)
    shared = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    return both.select("a", "b", shared.alias("shared"),
                       (shared >= _need(F.greatest("na", "nb"), t, size)).alias("plausible"))


def _measured(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """a, b, rank -> also inter, na, nb and, for a centre (rank > 0), b's residual."""
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    both = pairs.join(b, "b").join(a, "a").select("a", "b", "rank", "ta", "tb")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rank, rows = batch.column(2).to_pylist(), []
            sets = []
            for col in (3, 4):
                got = []
                for lo, hi, buf, off in W.chunks(batch.column(col)):
                    got += shingle_sets(W.scan(buf, off, W.BLANK_WORDS, W.LOWER), hi - lo, k)
                sets.append(got)
            for i, (x, y) in enumerate(zip(*sets)):
                inter = len(np.intersect1d(x, y, assume_unique=True))
                centre = rank[i] > 0 and 2 * inter >= len(y)
                rows.append((inter, len(x), len(y),
                             np.setdiff1d(y, x, assume_unique=True).view(np.int64) if centre else None))
            cols = list(zip(*rows)) or [[]] * 4
            i64 = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2)]
                + [pa.array(c, t) for c, t in zip(cols, (i64, i64, i64, pa.list_(i64)))],
                names=["a", "b", "rank", "inter", "na", "nb", "residual"])

    return both.mapInArrow(run, "a long, b long, rank int, inter long, na long, nb long, residual array<long>")


def _linked(measured: DataFrame, percent: int) -> DataFrame:
    union = F.col("na") + F.col("nb") - F.col("inter")
    return measured.filter((F.col("inter") > 0) & (100 * F.col("inter") >= percent * union)).select("a", "b")


def _stars(posts: DataFrame, held: DataFrame, t: float, size: int) -> DataFrame:
    """a (head), b, rank: members against the heads of their lists; rank 1 for
    the nearest head, 2 for the root above it."""
    band = F.floor(F.log(F.col("n").cast("double")) / -math.log(t))
    listed = posts.withColumn("band", band)
    head = F.max_by("id", F.struct("weight", -F.col("id"))).alias("a")
    pairs = None
    for keys in (["value"], ["value", "band"]):  # linked sets differ by at most t in size
        heads = written(listed.groupBy(*keys).agg(head), "links-heads")
        mine = listed.join(heads, keys).filter("a <> id").select("a", F.col("id").alias("b"))
        pairs = mine if pairs is None else pairs.unionByName(mine)
    seen = written(_compared(pairs.distinct(), held, t, size), "links-stars")
    # The head with most shared values; heads weigh more than their members,
    # so the way up ends.
    near = seen.groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("h"))
    near = written(near, "links-near")
    up = near.select("b", F.col("h").alias("r"))
    while True:  # the way up doubles with each step
        above = up.select(F.col("b").alias("_b"), F.col("r").alias("_r"))
        step = up.join(above, F.col("r") == F.col("_b"), "left").select(
            "b", F.col("r").alias("old"), F.coalesce("_r", "r").alias("r")).checkpoint()
        up = step.select("b", "r")
        if not step.filter("old <> r").limit(1).count():
            break
    roots = up.join(near, "b").filter("r <> h").select(F.col("r").alias("a"), "b", F.lit(2).alias("rank"))
    top = near.join(roots.select("b", F.lit(True).alias("_above")), "b", "left").select(
        F.col("h").alias("a"), "b", F.when(F.col("_above"), 1).otherwise(2).alias("rank"))
    plain = seen.filter("plausible").select("a", "b", F.lit(0).alias("rank"))
    return plain.unionByName(roots).unionByName(top).groupBy("a", "b").agg(F.max("rank").alias("rank"))


def _across(measured: DataFrame, posts: DataFrame, comp: DataFrame, t: float, percent: int) -> DataFrame:
    """a, b: pairs of different components that the stars leave possible."""
    share = percent / (100.0 + percent)  # linked: intersection >= share * (na + nb)
    comp = comp.select(F.col("node").alias("id"), "component")
    one = F.max_by(F.struct("a", "inter", "nb", "residual"), "rank").alias("m")
    own = measured.filter("residual IS NOT NULL").groupBy(F.col("b").alias("id")).agg(one).select(
        F.col("m.a").alias("centre"), "id", "m.inter", F.col("m.nb").alias("n"), "m.residual")
    own = written(own.join(comp, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component"),
                  "links-members")
    differ = (F.col("x.c") != F.col("y.c")) & (100 * F.col("x.n") >= percent * F.col("y.n")) \
        & (100 * F.col("y.n") >= percent * F.col("x.n"))
    names = [F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")]

    # One centre, a shared residual shingle.  Of a linked pair, the smaller set X
    # shares at least 2 * share * n - inter residual shingles with the other, the
    # larger at least t * n - inter; two prefixes of rarest residual shingles,
    # each that number less one short of all, meet, and after their first common
    # shingle enough others must follow in both.
    rest = own.select("centre", "id", "c", F.explode("residual").alias("value"))
    seen = rest.groupBy("centre", "value").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("df"))
    seen = written(seen.filter("lo <> hi").select("centre", "value", "df"), "links-residual-values")

    def take(least: float):
        need = F.greatest(F.lit(1.0), F.ceil(F.lit(least) * F.col("n") - F.col("inter") - 1e-6)).cast("int")
        return F.greatest(F.size("v") - need + 1, F.lit(0))

    listed = (own.select("centre", "id", "inter", "n", "c", F.explode("residual").alias("value")).join(seen, ["centre", "value"])
              .groupBy("centre", "id", "inter", "n", "c")
              .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v")))   # at most a residual
    listed = written(listed.withColumn("small", take(2 * share)).withColumn("large", take(percent / 100)).filter("large > 0"),
                     "links-residual")

    def prefix(length: str) -> DataFrame:
        return (listed.select("centre", "id", "inter", "n", "c", F.size("v").alias("size"),
                              F.posexplode(F.slice("v", F.lit(1), F.col(length))).alias("at", "e"))
                .select("centre", "id", "inter", "n", "c", F.col("e.value").alias("value"), (F.col("size") - F.col("at")).alias("left")))

    x, y = prefix("small").alias("x"), prefix("large").alias("y")
    smaller = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.id") < F.col("y.id")))
    enough = F.least("x.left", "y.left") >= share * (F.col("x.n") + F.col("y.n")) - F.least("x.inter", "y.inter") - 1e-6
    pairs = x.join(y, (F.col("x.centre") == F.col("y.centre")) & (F.col("x.value") == F.col("y.value"))
                   & smaller & enough & differ).select(*names).distinct()
    values = listed.select("id", "inter", "n", F.transform("v", lambda e: e["value"]).alias("v"))
    x = values.select(F.col("id").alias("a"), F.col("inter").alias("ia"), F.col("n").alias("na"), F.col("v").alias("va"))
    y = values.select(F.col("id").alias("b"), F.col("inter").alias("ib"), F.col("n").alias("nb"), F.col("v").alias("vb"))
    both = F.least("ia", "ib") + F.size(F.array_intersect("va", "vb"))
    shared = pairs.join(x, "a").join(y, "b").filter(both >= share * (F.col("na") + F.col("nb")) - 1e-6).select("a", "b")

    # One centre, nothing shared beyond it: only sets up to ``cap`` shingles.
    small = own.drop("residual").withColumn("cap", F.floor(F.col("inter") / share - F.col("n") + 1e-6))
    low = small.groupBy("centre").agg(F.min("n").alias("low"), F.max("cap").alias("high"))
    small = small.join(low, "centre").filter("cap >= low AND n <= high").drop("low", "high")
    x, y = small.alias("x"), small.alias("y")
    bounded = x.join(y, (F.col("x.centre") == F.col("y.centre")) & (F.col("x.id") < F.col("y.id")) & differ
                     & (F.col("y.n") <= F.col("x.cap")) & (F.col("x.n") <= F.col("y.cap"))).select(*names)

    # No common centre: pairs of a list.
    tagged = (posts.join(comp, "id", "left").join(own.select("id", "centre"), "id", "left")
              .select("value", "id", "n", F.coalesce("component", "id").alias("c"),
                      F.coalesce("centre", "id").alias("centre")))
    tagged = written(tagged, "links-tagged")
    several = (tagged.groupBy("value").agg(F.min("c").alias("lo"), F.max("c").alias("hi"),
                                           F.min("centre").alias("l2"), F.max("centre").alias("h2"))
               .filter("lo <> hi AND l2 <> h2").select("value"))
    tagged = tagged.join(written(several, "links-several"), "value")
    x, y = tagged.alias("x"), tagged.alias("y")
    apart = (F.col("x.centre") != F.col("y.centre")) & (F.col("x.centre") != F.col("y.id")) \
        & (F.col("y.centre") != F.col("x.id"))
    listed = x.join(y, (F.col("x.value") == F.col("y.value")) & (F.col("x.id") < F.col("y.id"))
                    & differ & apart).select(*names)
    return shared.unionByName(bounded).unionByName(listed).distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5,
                    percent: int = 80, size: int = SKETCH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``df``."""
    t = percent / 100
    rows = written(sketches(df, key, text, shingle, size), "sketch")
    # One class per set; its row is the one with the smallest id.
    classes = (rows.filter("id IS NOT NULL AND n > 0").groupBy("f1", "f2", "n")
               .agg(F.min_by(F.struct("id", "sketch"), "id").alias("x"))
               .select("f1", "f2", "n", "x.id", "x.sketch"))
    classes = written(classes, "sketch-classes")
    posts = written(_postings(classes, t, size), "sketch-postings")
    listed = posts.select("id").distinct()
    held = written(classes.select("id", "n", "sketch").join(listed, "id", "left_semi"), "sketch-listed")
    # Texts of listed classes only, for the exact step.
    few = held.count() <= BROADCAST_IDS
    ids = held.select("id")
    src = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    texts = written(src.join(F.broadcast(ids) if few else ids, "id", "left_semi"), "sketch-texts")

    first = written(_measured(_stars(posts, held, t, size), texts, shingle), "links-1")
    edges = _linked(first, percent)
    comp = connected_components(edges)
    more = _compared(_across(first, posts, comp, t, percent), held, t, size).filter("plausible")
    second = written(_measured(more.select("a", "b", F.lit(0).alias("rank")), texts, shingle), "links-2")
    comp = connected_components(edges.unionByName(_linked(second, percent)))

    names = classes.join(comp, classes["id"] == comp["node"], "left").select(
        "f1", "f2", F.col("n").alias("_n"), F.coalesce("component", "id").alias("c"))
    same = (rows["f1"] == names["f1"]) & (rows["f2"] == names["f2"]) & (rows["n"] == names["_n"])
    return rows.join(names, same, "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("c", "id")).alias("component_id"),
        F.coalesce(F.coalesce("c", "id") == F.col("id"), F.lit(True)).alias("kept"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(ws) - 2),
      lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS ss FROM w),
u AS MATERIALIZED (SELECT doc_id, len(ss) AS n, unnest(ss) AS sh FROM s),
q AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c
      FROM u a JOIN u b ON a.sh = b.sh AND a.doc_id < b.doc_id
        AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM q WHERE 100 * c >= 85 * (na + nb - c)
      UNION SELECT b, a FROM q WHERE 100 * c >= 85 * (na + nb - c)),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, least(a, min(b)) AS c FROM r GROUP BY a)
SELECT doc_id, CAST(len(ss) AS BIGINT) AS n_shingles, coalesce(m.c, doc_id) AS component_id,
       coalesce(m.c, doc_id) = doc_id AS kept
FROM s LEFT JOIN m ON m.a = s.doc_id
"""
