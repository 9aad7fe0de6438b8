"""Operator 13: hard negatives by cover trees over norm-augmented candidates.

Candidates get one more coordinate, ``sqrt(M*M - |x|*|x|)``, so that all lie on
a sphere of radius M and the largest inner product is the nearest neighbour.
Distinct vectors are dealt to shards of bounded size (for positives by label);
each shard's task builds a cover tree: a node's points are covered by centres more than the
level's radius apart, the radius shrinks from level to level, and each node
keeps the true covering radius of what lies below it.  For an anchor q and a
node with centre c and covering radius r every inner product below the node is
within ``q.c +- |q| * r``.  The search descends best first (largest upper bound
next), skips nodes outside the anchor's windows or below the k-th best found,
and verifies leaves with exact integers.

Two searches: the anchor's first ``n_positives`` rows
of its own label, then, per positive, the first ``n_negatives`` rows of other
labels inside the score window.  Anchors travel to the shards in blocks.

Edge cases: rows with a null id, label or vector, or a null or non-finite
component take no part; equal vectors of one label are held once, with their
smallest ids (no others can be returned); a row repeated whole counts once, and
an anchor is never its own partner (equal ids); ties go to the smaller id;
vectors of unequal length are compared over the coordinates both have; an empty
table, or one without anchors, gives no rows.  Inner products must fit a long.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.llm.common import written

SHARD = 8192       # distinct vectors of one tree
ANCHORS = 256      # anchors of one block
LEAF = 24          # points of a node that is not split further
RUN = 64           # leaves verified at once
SHRINK = 1.3       # radius of a level over that of the next


def _matrix(lists) -> np.ndarray:
    """Integer rows as float64, padded with zeros; the sums stay exact below 2**53."""
    width = max((len(x) for x in lists), default=0)
    out = np.zeros((len(lists), width))
    for row, x in zip(out, lists):
        row[:len(x)] = x
    return out


def _exact(points: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products as Python-size integers where float64 could round."""
    width = min(points.shape[1], len(q))
    a, b = points[:, :width], q[:width]
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, width)
    if most < 2 ** 53:
        return np.rint(a @ b).astype(np.int64)
    return np.array([sum(int(x) * int(y) for x, y in zip(r, b)) for r in a], object)


class CoverTree:
    """Nodes in arrays: centre (row), covering radius, children; leaves list rows."""

    def __init__(self, points: np.ndarray):
        norm = np.sqrt((points * points).sum(1))
        top = norm.max(initial=0.0)
        self.points = points
        self.body = np.c_[points, np.sqrt(np.maximum(top * top - norm * norm, 0.0))]
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.below: list[np.ndarray] = []      # child nodes, or rows of a leaf
        self.leaf: list[bool] = []
        self.square = top * top
        #: rounding of the products and roots below, on the safe side
        self.slack = 1e-6 * max(1.0, top)
        self.root = self._node(0, np.arange(len(points)))
        self.centre, self.radius, self.leaf = map(np.array, (self.centre, self.radius, self.leaf))

    def _apart(self, centre: int, body: np.ndarray) -> np.ndarray:
        """Distances on the sphere, where |a - b|^2 = 2 (M^2 - a.b)."""
        return np.sqrt(np.maximum(2 * (self.square - body @ self.body[centre]), 0.0))

    def _add(self, centre: int, radius: float, leaf: bool, below=None) -> int:
        self.centre.append(centre)
        self.radius.append(radius + self.slack)
        self.leaf.append(leaf)
        self.below.append(below)
        return len(self.centre) - 1

    def _node(self, centre: int, rows: np.ndarray) -> int:
        """The tree below ``centre``, built with a stack (no recursion)."""
        first = self._add(centre, float(self._apart(centre, self.body[rows]).max(initial=0.0)), False)
        todo = [(first, rows)]
        while todo:
            node, rows = todo.pop()
            if len(rows) <= LEAF or self.radius[node] <= 2 * self.slack:
                self.leaf[node], self.below[node] = True, rows
                continue
            level = self.radius[node]
            parts: list[tuple[int, np.ndarray, float]] = []
            while len(parts) < 2:                      # a level on which one centre covers all adds nothing
                level /= SHRINK
                parts = self._cover(self.centre[node], rows, level)
            made = []
            for c, own, far in parts:
                child = self._add(c, far, False)
                made.append(child)
                todo.append((child, own))
            self.below[node] = np.array(made)
        return first

    def _cover(self, centre: int, rows: np.ndarray, radius: float):
        """Centres more than ``radius`` apart, each with the rows it covers."""
        parts, body, left = [], self.body[rows], np.ones(len(rows), bool)
        while True:
            apart = self._apart(centre, body)
            near = left & (apart <= radius)
            parts.append((centre, rows[near], float(apart[near].max(initial=0.0))))
            left &= ~near
            n = int(left.sum())
            if not n:
                return parts
            if 2 * n < len(rows):
                rows, body, left = rows[left], body[left], np.ones(n, bool)
            centre = int(rows[left.argmax()])

    def reach(self, anchors: np.ndarray):
        """Per anchor and node: the smallest and largest inner product that can lie below the node."""
        width = min(self.points.shape[1], anchors.shape[1])
        at = anchors[:, :width] @ self.points[self.centre, :width].T
        span = np.sqrt((anchors * anchors).sum(1))[:, None] * self.radius + 1e-9 * np.abs(at)
        return at - span, at + span

    def search(self, least: np.ndarray, most: np.ndarray, low: float, bound, visit) -> None:
        """Best-first descent by an anchor's bounds: ``visit(rows)`` for leaves; ``bound()`` is the
        smallest score still wanted (it rises), ``low`` and ``bound.high`` limit the windows."""

        heap: list[tuple] = []

        def put(nodes):
            """Inner nodes one by one; a node's leaves as one run, by falling upper bound."""
            nodes = nodes[(most[nodes] >= max(low, bound())) & (least[nodes] <= bound.high)]
            leaf = self.leaf[nodes]
            for n in nodes[~leaf].tolist():
                heapq.heappush(heap, (-most[n], n, None))
            if leaf.any():
                run = nodes[leaf]
                run = run[np.argsort(-most[run], kind="stable")]
                heapq.heappush(heap, (-most[run[0]], int(run[0]), run))

        put(np.array([self.root]))
        while heap:
            b, n, run = heapq.heappop(heap)
            floor = max(low, bound())
            if -b < floor:
                return
            if run is None:
                put(self.below[n])
                continue
            k = min(RUN, int(np.searchsorted(-most[run], -floor, "right")))
            visit(np.concatenate([self.below[x] for x in run[:k]]))
            if k < len(run):
                heapq.heappush(heap, (-most[run[k]], int(run[k]), run[k:]))


class Best:
    """The first k (score, -id) of one window; full lists raise the bound."""

    def __init__(self, k: int, low: float, high: float):
        self.k, self.low, self.high, self.held = k, low, high, []

    def offer(self, score: int, ids, anchor: int) -> None:
        if not self.low <= score <= self.high:
            return
        for i in ids:
            if i != anchor:
                heapq.heappush(self.held, (score, -i))
                if len(self.held) > self.k:
                    heapq.heappop(self.held)

    def wanted(self) -> float:
        return self.held[0][0] if len(self.held) >= self.k else self.low


def find(tree: CoverTree, ids, q: np.ndarray, reach, anchor: int, windows: list[Best], unlike=None) -> None:
    """Fill ``windows`` with the tree's rows; ``ids[row]`` are a vector's (id, label), by id.

    Rows labelled ``unlike`` are left out.
    """
    def bound():
        return min(w.wanted() for w in windows)

    bound.high = max(w.high for w in windows)

    def visit(rows):
        score = _exact(tree.points[rows], q)
        for k in np.flatnonzero(np.asarray(score >= bound(), bool) & np.asarray(score <= bound.high, bool)):
            own = [x["id"] for x in ids[rows[k]] if unlike is None or x["label"] != unlike]
            for w in windows:
                w.offer(int(score[k]), own, anchor)

    tree.search(*reach, min(w.low for w in windows), bound, visit)


def _usable(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return (df.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & v.isNotNull() & fine)
            .select(F.col(key).cast("long").alias("id"), v.alias("v"), F.col(label).alias("label")))


def quantized(rows: DataFrame, scale: int = 256) -> DataFrame:
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("long")))


def vectors(rows: DataFrame, keep: int) -> DataFrame:
    """One row per distinct (label, vector) with its ``keep`` smallest ids.

    Ids are ranked in two steps, first in 64 parts of a group, so a vector that
    very many rows share is no single task's work.
    """
    part = rows.distinct().withColumn("h", F.xxhash64("v")).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(64)))
    w = Window.partitionBy("h", "v", "label", "part").orderBy("id")
    part = part.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= keep)
    return part.groupBy("h", "v", "label").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("id", "label"))), 1, keep).alias("ids"))


def _merged(one: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector: ids of the ``keep`` + 1 labels that start with the smallest ids.

    Whichever label an anchor has, its first ``keep`` ids of other labels are among them.
    """
    w = Window.partitionBy("h", "v").orderBy(F.col("ids")[0]["id"])
    first = one.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= keep + 1)
    return first.groupBy("h", "v").agg(F.array_sort(F.flatten(F.collect_list(F.slice("ids", 1, keep)))).alias("ids"))


def _dealt(h, parts):
    return F.pmod(F.shiftright(h, 8), parts).cast("int")


def _blocks(anchors: DataFrame, per: int = ANCHORS) -> DataFrame:
    """Anchors of one label in blocks: (label, anchors as a list of structs)."""
    n = anchors.groupBy("label").agg(F.ceil(F.count("*") / per).cast("int").alias("parts"))
    return (anchors.join(n, "label").withColumn("b", _dealt(F.xxhash64("id"), F.col("parts")))
            .groupBy("label", "b").agg(F.collect_list(F.struct(*anchors.columns)).alias("anchors")).drop("b"))


def _search(trees: DataFrame, sent: DataFrame, k: int, unlike: bool) -> DataFrame:
    """Per anchor and window the first k rows of every tree that its block is sent to."""
    def run(tree, asked):
        import pyarrow as pa

        lists = tree.column("v").to_pylist()
        ids = tree.column("ids").to_pylist()
        cover = CoverTree(_matrix(lists)) if lists and asked.num_rows else None
        out = []
        for block in asked.column("anchors") if cover else []:
            block = block.as_py()
            queries = _matrix([a["v"] for a in block])
            for a, q, least, most in zip(block, queries, *cover.reach(queries)):
                marks = a.get("marks") or [None]
                windows = [Best(k, -np.inf, np.inf) if m is None else Best(k, -(-m * 50 // 100), m * 95 // 100)
                           for m in marks]
                open_ = [w for w in windows if w.low <= w.high]
                if open_:
                    find(cover, ids, q, (least, most), a["id"], open_, a["label"] if unlike else None)
                out += [(a["id"], m, -i, s) for m, w in zip(marks, windows) for s, i in w.held]
        cols = list(zip(*out)) or [()] * 4
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["anchor", "mark", "id", "score"])

    return (trees.groupBy("tree", "part").cogroup(sent.groupBy("to", "to_part"))
            .applyInArrow(run, "anchor long, mark long, id long, score long"))


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor, n_positives: int = 5, n_negatives: int = 3) -> DataFrame:
    """Negatives of every anchor and positive among integer vectors ``rows`` (id, v, label).

    ``anchor`` is a condition on ``id``.  A negative's score lies between half
    and 95 percent of the positive's score.
    """
    one = written(vectors(rows, n_positives + 1), "negatives-vectors")
    anchors = written(rows.filter(anchor).distinct(), "negatives-anchors")
    # Positives: trees of one label each.
    n = one.groupBy("label").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("parts"))
    trees = one.join(n, "label").select(F.col("label").alias("tree"), _dealt("h", F.col("parts")).alias("part"), "v", "ids")
    sent = _blocks(anchors).join(n, "label").select(
        F.col("label").alias("to"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("to_part"), "anchors")
    found = _search(trees, sent, n_positives, False)
    positives = written(_first(found, ["anchor"], n_positives)
                        .select("anchor", F.col("id").alias("positive"), F.col("score").alias("mark")), "negatives-positives")
    # Negatives: trees over all labels; every block of anchors goes to each.
    many = written(_merged(one, n_negatives), "negatives-candidates")
    parts = max(1, -(-many.count() // SHARD))
    trees = many.select(F.lit(0).alias("tree"), _dealt("h", F.lit(parts)).alias("part"), "v", "ids")
    marks = positives.groupBy("anchor").agg(F.array_sort(F.collect_set("mark")).alias("marks"))
    asked = anchors.join(marks, anchors["id"] == marks["anchor"]).select("id", "v", "label", "marks")
    sent = _blocks(asked).select(
        F.lit(0).alias("to"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("to_part"), "anchors")
    found = _search(trees, sent, n_negatives, True)
    found = _first(found, ["anchor", "mark"], n_negatives)
    out = positives.join(found, ["anchor", "mark"])
    return out.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"),
                      F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                      F.col("mark").alias("positive_score"), F.col("score").alias("negative_score"))


def negatives_query(embeddings: DataFrame) -> DataFrame:
    rows = _usable(embeddings, "vec_id", "embedding", "label")
    rows = rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(quantized(rows), F.col("id") % 50 == 0)


#: DuckDB: all inner products of the anchors.
ORACLE = """
WITH u AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM u a JOIN u b ON a.id % 50 = 0 AND a.id <> b.id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
 AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 3
"""
