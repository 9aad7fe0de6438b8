"""Exact k-nearest-neighbour regression (op L7).

The prediction of a query row is the mean label of its ``k`` nearest
training rows (Euclidean distance, ties broken by the training id), as
scikit-learn's ``KNeighborsRegressor`` with uniform weights.

Training rows belong to the cell of their nearest pivot (a bounded sample of
training vectors), and a cell is cut by distance to its pivot into blocks of
about ``block_rows`` rows; a block's table row holds its size and the smallest
and largest distance ``r`` to the pivot.  By the triangle inequality every
distance from a query q to a block of pivot p is at least
``max(d(q, p) - r_max, r_min - d(q, p))``.  Two rounds:

1. each query goes to its nearest blocks that together hold ``k`` rows; the
   k-th distance found bounds its answer;
2. it then goes only to the other blocks whose lower bound does not exceed
   that distance.

So block pairs that cannot hold a neighbour are never sent, and the result is
exact whatever the pivots.  A (block, chunk of queries) pair is one task group
that computes true squared differences and returns ``k`` candidates per query;
one shuffle by query merges them.  Only the pivots and the block table (rows /
``block_rows`` + pivots rows) reach the driver.  Where distances concentrate
(random directions in many dimensions) no bound prunes, and all pairs are
compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import cut_lineage

CELLS = 4_000_000  # numbers per block of differences inside a task
SENT = 1_000_000   # bounds, or numbers of query vectors sent to blocks, per frame
SLACK = 1e-9       # relative rounding of distances, on the safe side

_CANDIDATES = "query_id long, vec_id long, dist2 double, label double"


def _distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to one vector, a bounded piece at a time."""
    d = np.empty(len(x))
    step = max(1, CELLS // max(1, x.shape[1]))
    for s in range(0, len(x), step):
        diff = x[s:s + step] - q
        d[s:s + step] = np.einsum("ij,ij->i", diff, diff)
    return d


def _nearest(k: int):
    def run(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        cols = {"query_id": "int64", "vec_id": "int64", "dist2": "float64", "label": "float64"}
        if q.empty or t.empty:
            return pd.DataFrame({c: np.empty(0, v) for c, v in cols.items()})
        x = np.stack(t["v"].to_numpy()).astype(np.float64)
        ids, y = t["vec_id"].to_numpy(np.int64), t["label"].to_numpy(np.float64)
        vecs = np.stack(q["v"].to_numpy()).astype(np.float64)
        found, dist = [], []
        for q_vec in vecs:
            d = _distances(x, q_vec)
            near = np.lexsort((ids, d))[:k] if len(d) <= 4 * k else _smallest(d, ids, k)
            found.append(near)
            dist.append(d[near])
        near = np.concatenate(found)
        return pd.DataFrame({"query_id": np.repeat(q["query_id"].to_numpy(np.int64), [len(f) for f in found]),
                             "vec_id": ids[near], "dist2": np.concatenate(dist), "label": y[near]})
    return run


def _smallest(d: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest (distance, id)."""
    within = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
    return within[np.lexsort((ids[within], d[within]))[:k]]


def _to_pivots(vecs: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances (rows x pivots)."""
    return np.sqrt(np.stack([_distances(vecs, p) for p in pivots], axis=1))


class Blocks:
    """The block table as arrays: pivot, size, smallest and largest distance to the pivot."""

    def __init__(self, pivots: np.ndarray, rows: pd.DataFrame):
        rows = rows.sort_values(["cell", "ring"]).reset_index(drop=True)
        self.pivots, self.names = pivots, rows["block"].to_numpy()
        self.cell, self.size = rows["cell"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
        self.low, self.high = rows["low"].to_numpy(float), rows["high"].to_numpy(float)

    def bounds(self, vecs: np.ndarray):
        """(lower bound, distance to the pivot) of every (query, block)."""
        d = _to_pivots(vecs, self.pivots)[:, self.cell]
        slack = SLACK * (1.0 + d + self.high)
        return np.maximum(np.maximum(d - self.high, self.low - d) - slack, 0.0), d

    def first(self, bound: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
        """Blocks by rising bound until they hold k rows."""
        order = np.lexsort((d, bound))
        held = np.cumsum(self.size[order])
        return order[:int(np.searchsorted(held, k)) + 1]


def training_blocks(train: DataFrame, pivots: int = 64, block_rows: int = 20_000) -> tuple[DataFrame, Blocks]:
    """(vec_id, v, label) rows with their ``block``, written once, and the block table.

    Pivots are the rows with the smallest key hashes; a cell's rings are cut
    at approximate quantiles of the distance, so the blocks of one cell nest.
    """
    spark = train.sparkSession
    sample = train.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("v").collect()
    points = np.array([r["v"] for r in sample], float)
    shared = spark.sparkContext.broadcast(points)        # ``pivots`` vectors

    def run(batches):
        for t in batches:
            if len(t):
                d = _to_pivots(np.stack(t["v"].to_numpy()).astype(np.float64), shared.value)
                t["cell"], t["far"] = d.argmin(1).astype(np.int32), d.min(1)
                yield t

    placed = cut_lineage(train.mapInPandas(run, "vec_id long, v array<double>, label double, cell int, far double"))
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.approx_percentile(
        "far", [i / 64 for i in range(1, 64)], 1000).alias("cuts"))
    # A cell of n rows gets about n / block_rows rings, cut at evenly spaced percentiles.
    rings = F.least(F.ceil(F.col("n") / block_rows), F.lit(64))
    cuts = sizes.select(F.col("cell").alias("_cell"), F.transform(
        F.filter(F.sequence(F.lit(1), F.lit(63)), lambda i: F.floor(i * rings / 64) > F.floor((i - 1) * rings / 64)),
        lambda i: F.element_at("cuts", i.cast("int"))).alias("_cuts"))
    ring = F.size(F.filter("_cuts", lambda c: c < F.col("far")))
    ringed = placed.join(cuts, F.col("cell") == F.col("_cell")).select(
        "vec_id", "v", "label", "cell", "far", ring.alias("ring"))
    # Equal distances share a ring whatever their number: rings are cut by their true size.
    parts = ringed.groupBy(F.col("cell").alias("_cell"), F.col("ring").alias("_ring")).agg(
        F.greatest(F.round(F.count(F.lit(1)) / block_rows), F.lit(1)).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("vec_id"), F.col("_parts"))
    out = ringed.join(parts, (F.col("cell") == F.col("_cell")) & (F.col("ring") == F.col("_ring"))).select(
        "vec_id", "v", "label", "cell", "far", "ring", F.concat_ws("/", "cell", "ring", part).alias("block"))
    out = cut_lineage(out)
    rows = out.groupBy("block", "cell", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("far").alias("low"),
                                                    F.max("far").alias("high")).toPandas()
    return out.select("vec_id", "v", "label", "block"), Blocks(points, rows)


def _visit(train: DataFrame, visits: DataFrame, k: int, chunks: int) -> DataFrame:
    """Candidates of every (query, block) visit; queries of a block in ``chunks`` groups."""
    sent = visits.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)))
    asked = sent.select(F.col("block").alias("_b"), F.col("chunk").alias("part")).distinct()
    held = train.join(asked, F.col("block") == F.col("_b")).drop("_b")
    return sent.groupBy("block", "chunk").cogroup(held.groupBy("block", "part")).applyInPandas(
        _nearest(k), _CANDIDATES)


def _sent(q: pd.DataFrame, b: Blocks, chosen):
    """Frames (query_id, v, block) of the blocks that ``chosen(i, bound, d)`` names for each row ``i``.

    A vector is repeated for each of its blocks, whose number grows with the
    training rows: the bounds and the visits are made a bounded piece at a time.
    """
    vecs = q["v"].to_numpy()
    step = max(1, SENT // len(b.names))
    for s in range(0, len(q), step):
        bounds = b.bounds(np.stack(vecs[s:s + step]).astype(np.float64))
        picked = [np.asarray(chosen(s + i, bound, d), np.int64) for i, (bound, d) in enumerate(zip(*bounds))]
        row = np.repeat(np.arange(s, s + len(picked)), [len(j) for j in picked])
        block = np.concatenate(picked)
        size = max(1, SENT // max(1, len(vecs[0])))
        for at in range(0, len(row), size):
            own = row[at:at + size]
            yield pd.DataFrame({"query_id": q["query_id"].to_numpy()[own], "v": vecs[own],
                                "block": b.names[block[at:at + size]]})


def _first_visits(queries: DataFrame, blocks, k: int) -> DataFrame:
    def run(batches):
        b = blocks.value
        for q in batches:
            yield from _sent(q, b, lambda i, bound, d: b.first(bound, d, k))
    return queries.mapInPandas(run, "query_id long, v array<double>, block string")


def _other_visits(queries: DataFrame, blocks, k: int) -> DataFrame:
    """``queries``: (query_id, v, reach), the k-th distance found so far (NULL: none)."""
    def run(batches):
        b = blocks.value
        for q in batches:
            reach = q["reach"].to_numpy(float)

            def others(i, bound, d, reach=reach):
                within = np.ones(len(bound), bool) if np.isnan(reach[i]) else bound <= reach[i] * (1 + SLACK)
                within[b.first(bound, d, k)] = False
                return np.flatnonzero(within)
            yield from _sent(q, b, others)
    return queries.mapInPandas(run, "query_id long, v array<double>, block string")


def _merge(cands: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy("dist2", "vec_id")
    return cands.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)


def nearest_rows(train: DataFrame, queries: DataFrame, k: int, block_rows: int, pivots: int) -> tuple[DataFrame, DataFrame]:
    """(query_id, vec_id, dist2, label, _rn) of the k nearest rows, and the visits table
    (round, visits, all): (query, block) pairs compared, and all there are."""
    spark = train.sparkSession
    placed, table = training_blocks(train, pivots, block_rows)
    shared = spark.sparkContext.broadcast(table)          # rows / block_rows + pivots rows
    queries = cut_lineage(queries)
    total = queries.count()
    chunks = 1 + total // block_rows
    visits = cut_lineage(_first_visits(queries, shared, k))
    found = cut_lineage(_merge(_visit(placed, visits, k, chunks), k))
    reach = found.where(F.col("_rn") == k).select(F.col("query_id").alias("_q"), F.sqrt("dist2").alias("reach"))
    asked = queries.join(reach, F.col("query_id") == F.col("_q"), "left").select("query_id", "v", "reach")
    more = cut_lineage(_other_visits(asked, shared, k))
    rest = _visit(placed, more, k, chunks)
    best = _merge(found.drop("_rn").unionByName(rest), k)
    every = F.lit(total * len(table.names)).cast("long")
    count = lambda df, i: df.agg(F.count(F.lit(1)).alias("visits")).select(
        F.lit(i).alias("round"), "visits", every.alias("all"))
    return best, count(visits, 1).unionByName(count(more, 2))


def knn_regress(train: DataFrame, queries: DataFrame, k: int = 50, block_rows: int = 20_000,
                id_col: str = "vec_id", vec_col: str = "embedding",
                label_col: str = "label", pivots: int = 64) -> DataFrame:
    """(query_id, prediction) for every query row.

    ``train``: (id, vector, label); ``queries``: (id, vector).  Distances are
    computed in float64 from the stored vectors.
    """
    tr, qs = _inputs(train, queries, id_col, vec_col, label_col)
    if tr.isEmpty():
        return qs.select("query_id", F.lit(None).cast("double").alias("prediction")).limit(0)
    best, _ = nearest_rows(tr, qs, k, block_rows, pivots)
    return best.groupBy("query_id").agg(F.avg("label").alias("prediction"))


def knn_visits(train: DataFrame, queries: DataFrame, k: int = 50, block_rows: int = 20_000,
               id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
               pivots: int = 64) -> DataFrame:
    """(round, visits, all): how many (query, block) pairs each round compares, of all."""
    tr, qs = _inputs(train, queries, id_col, vec_col, label_col)
    return nearest_rows(tr, qs, k, block_rows, pivots)[1]


def _inputs(train, queries, id_col, vec_col, label_col):
    v = F.col(vec_col).cast("array<double>").alias("v")
    return (train.select(F.col(id_col).cast("long").alias("vec_id"), v, F.col(label_col).cast("double").alias("label")),
            queries.select(F.col(id_col).cast("long").alias("query_id"), v))
