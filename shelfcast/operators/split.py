"""Train / validation / test splits and cross-validation folds (ops K1-K6).

numpy's seeded draws cannot be reproduced on a cluster, so every split is a
pure function of the row key: ``key_bucket`` takes the first 32 bits of the
MD5 of the key.  The same row lands in the same part whatever the
partitioning, after a retry, and in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.ordering import global_row_number
from shelfcast.session import cut_lineage


def key_hash(*cols: str) -> Column:
    """Unsigned 32-bit hash of the concatenated key columns."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def key_bucket(m: int, *cols: str) -> Column:
    return key_hash(*cols) % m


def _less(cols: list[str], values: list) -> Column:
    """Rows that sort before ``values`` by ``cols`` (NULLs first, never NULL itself)."""
    out, same = F.lit(False), F.lit(True)
    for c, v in zip(cols, values):
        low = F.lit(False) if v is None else F.coalesce(F.col(c) < F.lit(v), F.col(c).isNull())
        out = out | (same & low)
        same = same & F.col(c).eqNullSafe(F.lit(v))
    return out


def _equal(cols: list[str], values: list) -> Column:
    out = F.lit(True)
    for c, v in zip(cols, values):
        out = out & F.col(c).eqNullSafe(F.lit(v))
    return out


def _nth_value(rows: DataFrame, value: Column, n: int, bits: tuple = (16, 0)):
    """(value of the n-th row in the order of a 32-bit ``value``, rows below
    it, rows at it), or None with fewer rows: a histogram by the upper 16 bits,
    then one by the lower bits in the bucket of the n-th row.  Every histogram
    is pre-aggregated and has at most 65,536 rows."""
    below, cut, at = 0, None, 0
    for shift in bits:
        part = rows if cut is None else rows.where(F.shiftright(value, 16) == cut)
        hist = part.groupBy(F.shiftright(value, shift).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        run = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        hit = (hist.select("_b", "_n", F.sum("_n").over(run).alias("_cum"))
               .where(F.col("_cum") >= n - below).orderBy("_b").first())
        if hit is None:
            return None
        cut, at, below = hit["_b"], hit["_n"], below + hit["_cum"] - hit["_n"]
    return cut, below, at


#: Equal rows written by one task when a group of them is cut.
COPIES = 100_000


def _first_copies(rows: DataFrame, n: int, flag: str) -> DataFrame:
    """Rows that differ in few values but repeat without bound, ``n`` of them
    flagged: equal rows are counted, the counts give each its share, and the
    copies are written out again in pieces of ``COPIES`` over all tasks."""
    cols = [F.col(f"`{c}`") for c in rows.columns]
    counted = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    run = Window.orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    shared = counted.withColumn("_off", F.coalesce(F.sum("_n").over(run), F.lit(0)))
    pieces = shared.select("*", F.explode(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(COPIES))).alias("_at"))
    pieces = pieces.repartition(F.col("_at"), F.col("_off"))
    last = F.least(F.col("_at") + COPIES, F.col("_n")) - 1
    each = pieces.select(*cols, "_off", F.explode(F.sequence(F.col("_at"), last)).alias("_i"))
    return each.withColumn(flag, F.col("_off") + F.col("_i") < n).drop("_off", "_i")


def holdout_exact_n(df: DataFrame, n: int, keys: list[str], flag: str = "is_holdout") -> DataFrame:
    """K1: exactly ``n`` holdout rows: the n smallest key hashes (ties broken
    by the key), flagged on every row.

    A distributed selection that writes nothing: two histograms of the 32-bit
    key hash give the hash value of the n-th row; the counts of the keys with
    that very value (about keys / 2**32 of them) give its key, and the flag is
    a comparison with both, a filter without a shuffle of the rows.  Only if
    the n-th row is one of several with the same key, those rows are selected
    in the same way by a hash of the whole row, and only rows equal in every
    column, of which any may be taken, are counted and written out again in
    pieces; so a key that a third of all rows repeat is no single task's work.
    The passes read the key columns alone.
    """
    h = key_hash(*keys)
    inside = F.lit(False)
    if n <= 0:
        return df.withColumn(flag, inside)
    found = _nth_value(df.select(*keys, h.alias("_h")), F.col("_h"), n)
    if found is None:  # fewer than n rows: all are in
        return df.withColumn(flag, F.lit(True))
    cut, below, _ = found
    counts = df.where(h == cut).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    run = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    last = (counts.select(*keys, "_n", F.sum("_n").over(run).alias("_cum"))
            .where(F.col("_cum") >= n - below).orderBy(*keys).first())
    values = [last[k] for k in keys]
    at_key = (h == cut) & _equal(keys, values)
    before = (h < cut) | ((h == cut) & _less(keys, values))
    wanted = n - below - (last["_cum"] - last["_n"])     # of the rows with the last key
    if wanted == last["_n"]:
        return df.withColumn(flag, before | at_key)
    row = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 32))
    mine = df.where(at_key)
    row_cut, row_below, at_row = _nth_value(mine.select(row.alias("_r")), F.col("_r"), wanted)
    tied = at_key & (row == row_cut)
    flagged = df.withColumn(flag, before | (at_key & (row < row_cut)) | (tied & F.lit(wanted - row_below == at_row)))
    if wanted - row_below == at_row:
        return flagged
    copies = _first_copies(df.where(tied), wanted - row_below, flag)
    return flagged.where(~tied).unionByName(copies)


def holdout_fraction(df: DataFrame, pct: int, keys: list[str], flag: str = "is_holdout") -> DataFrame:
    """K2: about ``pct`` per cent of rows in the holdout (hash bucket < pct)."""
    return df.withColumn(flag, key_bucket(100, *keys) < pct)


def split_three_way(df: DataFrame, keys: list[str], check_pct: int = 1, test_pct: int = 5,
                    col: str = "part") -> DataFrame:
    """K3: disjoint check / test / train parts by hash bucket (1 %, 5 % - 1 %
    within test's share as in the reference, the rest)."""
    b = key_bucket(100, *keys)
    return df.withColumn(col, F.when(b < check_pct, "check")
                                .when(b < test_pct, "test").otherwise("train"))


def timeseries_cv(df: DataFrame, n_splits: int, train_days: int, test_days: int,
                  step_days: int = 28, day_col: str = "d_num") -> DataFrame:
    """K4: rows tagged (fold, role) for ``n_splits`` rolling-origin folds.

    Day offsets are measured from the first day; ``duration`` is the last
    offset.  Fold i (0-based) ends its training window
    ``(n_splits - i - 1) * step_days`` days before the last fold's:
    train = (start, end], test = (end, end + test_days], the last fold's test
    open-ended.  With one split: train = [start, end), test = [end, ...).

    The two scalars (first and last day) are one aggregate; each row expands
    into the folds it belongs to with an array generator, so no join.
    """
    # One scalar subquery returning both bounds, referenced once, so the
    # bounds cost one aggregation pass.
    bounds = df.agg(F.struct(F.min(day_col).alias("first"), F.max(day_col).alias("last"))).scalar()
    base = (df.withColumn("_b", bounds)
              .withColumn("_t", F.col(day_col) - F.col("_b.first"))
              .withColumn("_dur", F.col("_b.last") - F.col("_b.first"))
              .drop("_b"))
    t, duration = F.col("_t"), F.col("_dur")
    total = train_days + test_days
    if n_splits == 1:
        start = duration - total
        end = start + train_days
        role = F.when((t >= start) & (t < end), "train").when(t >= end, "test")
        return (base.withColumn("fold", F.lit(0)).withColumn("role", role)
                    .where(F.col("role").isNotNull()).drop("_t", "_dur"))

    def role_of(i: Column) -> Column:
        shift = (F.lit(n_splits) - (i + 1)) * step_days
        start = duration - F.lit(total) - shift
        end = start + train_days
        test_end = end + test_days
        test = (t > end) & ((i == n_splits - 1) | (t <= test_end))
        return F.when((t > start) & (t <= end), F.lit("train")).when(test, F.lit("test"))

    folds = F.filter(F.transform(F.sequence(F.lit(0), F.lit(n_splits - 1)),
                                 lambda i: F.struct(i.alias("fold"), role_of(i).alias("role"))),
                     lambda s: s["role"].isNotNull())
    return (base.select("*", F.explode(folds).alias("_f"))
                .select("*", "_f.fold", "_f.role").drop("_f", "_t", "_dur"))


def systematic_sample(df: DataFrame, every: int, order_cols: list[str], hot_rows: int = 1_000_000) -> DataFrame:
    """K6: every ``every``-th row in the given (total) order, starting with
    the first: the positional ``iloc[::k]``.

    Rows are counted per value of the first order column (a day), the counts
    give each day's offset, and rows are numbered within their day.  A day
    above ``hot_rows`` rows is not numbered by one task: the rows of such days
    are cut into ranges of the whole order, written once, counted per range
    and numbered by the ranges' tasks (``ordering.global_row_number``).
    """
    first = order_cols[0]
    days = df.groupBy(F.col(first).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    hot = F.col("_n") > hot_rows
    days = cut_lineage(days.select(
        "_d", hot.alias("_hot"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        # Rows of earlier hot days: their numbering runs on over all hot days.
        F.coalesce(F.sum(F.when(hot, F.col("_n"))).over(before), F.lit(0)).alias("_seen")))
    rows = df.join(days, F.col(first).eqNullSafe(F.col("_d")))
    within = Window.partitionBy(first).orderBy(*order_cols)
    numbered = rows.where(~F.col("_hot")).withColumn("_rn", F.row_number().over(within).cast("long"))
    if not days.where("_hot").isEmpty():
        ranged = global_row_number(rows.where("_hot"), order_cols, out="_rn")
        numbered = numbered.unionByName(ranged.withColumn("_rn", F.col("_rn") - F.col("_seen")))
    return numbered.where((F.col("_start") + F.col("_rn") - 1) % every == 0).drop("_rn", "_d", "_start", "_hot", "_seen")
