"""Per-series window features (ops F1-F16).

All features of one call share one window spec, ``partitionBy(id)
.orderBy(order)``, so Spark plans a single Exchange (hash on id) and a single
Sort for any number of lag / rolling columns, even when they span several
Window operators (running totals, lags of them, doubling levels): a Window
operator keeps its input's partitioning and order.

Rolling statistics follow pandas ``rolling(k)``: the value is NULL unless all
``k`` rows of the frame hold a non-NULL value.  A rolling window of a lag is
a shifted frame over the raw column (``rowsBetween(-(L+k-1), -L)``), the same
thing without materialising the lag first.  Four evaluation strategies:

* frame form (``rolling``): Spark re-aggregates the frame for every row,
  O(rows x k); any column type;
* running totals (``rolling_sums_prefix``, ``rolling_std_prefix``): exact
  for whole-number columns (units sold), O(rows);
* doubling (``rolling_extreme``): exact max / min, O(rows x log k);
* mergeable moments (``rolling_moments``): std, skewness and kurtosis of any
  numeric column, O(rows x log k), centred at every merge, so large totals
  lose no digits.

The per-series partition is bounded by the number of days in the calendar,
so the rows Spark buffers per key do not grow with the number of series or
the data volume; Window buffers spill to disk beyond that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def series_window(id_col: str | list[str] = "id", order_col: str = "d_num") -> WindowSpec:
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    return Window.partitionBy(*ids).orderBy(order_col)


def series_layout(df: DataFrame, id_col: str = "id", order_col: str = "d_num",
                  num_partitions: int | None = None) -> DataFrame:
    """Hash-partition rows by series and sort each partition by (series, day),
    then write them once with a reliable checkpoint.

    A checkpointed DataFrame keeps the partitioning and ordering of the plan
    that produced it, so every later per-series step on it (window features,
    history arrays, distinct ids, aggregations by series) runs without
    another Exchange or Sort.  An adaptive plan reports its partitioning as
    unknown, so this one materialisation is planned with AQE off (restored
    right after); the explicit partition count makes AQE unnecessary here.
    Use it when several such steps read the same panel.
    """
    from shelfcast.session import cut_lineage
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = df.repartition(n, id_col).sortWithinPartitions(id_col, order_col)
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return cut_lineage(laid)
    finally:
        spark.conf.set(key, before)


def frame(w: WindowSpec, k: int, shift: int = 0) -> WindowSpec:
    """The ``k`` rows ending ``shift`` rows before the current row."""
    return w.rowsBetween(-(k - 1) - shift, -shift)


def rolling(col: str, agg: Callable[[str], Column], k: int, w: WindowSpec,
            shift: int = 0) -> Column:
    """pandas ``x.shift(shift).rolling(k).agg()`` with min_periods = k."""
    f = frame(w, k, shift)
    return F.when(F.count(col).over(f) == k, agg(col).over(f))


def _merged(a: Column, b: Column, na: int, nb: int, order: int) -> list[Column]:
    """Central moments (mean, M2 .. M_order) of two disjoint blocks together."""
    n = float(na + nb)
    d = b["mean"] - a["mean"]
    out = [(a["mean"] + d * F.lit(nb / n)).alias("mean"),
           (a["m2"] + b["m2"] + d * d * F.lit(na * nb / n)).alias("m2")]
    if order >= 3:
        skewed = d * d * d * F.lit(na * nb * (na - nb) / (n * n))
        out.append((a["m3"] + b["m3"] + skewed + F.lit(3.0 / n) * d * (F.lit(float(na)) * b["m2"] - F.lit(float(nb)) * a["m2"]))
                   .alias("m3"))
    if order >= 4:
        fourth = d * d * d * d * F.lit(na * nb * (na * na - na * nb + nb * nb) / n ** 3)
        mixed = F.lit(6.0 / (n * n)) * d * d * (F.lit(float(na * na)) * b["m2"] + F.lit(float(nb * nb)) * a["m2"])
        crossed = F.lit(4.0 / n) * d * (F.lit(float(na)) * b["m3"] - F.lit(float(nb)) * a["m3"])
        out.append((a["m4"] + b["m4"] + fourth + mixed + crossed).alias("m4"))
    return out


def _statistic(kind: str, m: Column, k: int) -> Column:
    """std (n-1), or pandas' bias-corrected skew and kurt, from central moments;
    skew and kurt of a constant window are NULL."""
    n = float(k)
    if kind == "std":
        return F.sqrt(m["m2"] / F.lit(n - 1))
    flat = m["m2"] == 0
    if kind == "skew":
        g1 = F.lit(n ** 0.5) * m["m3"] / F.pow(m["m2"], 1.5)
        return F.when(~flat, g1 * F.lit((n * (n - 1)) ** 0.5 / (n - 2)))
    g2 = F.lit(n) * m["m4"] / (m["m2"] * m["m2"]) - 3.0
    return F.when(~flat, F.lit((n - 1) / ((n - 2) * (n - 3))) * (F.lit(n + 1) * g2 + F.lit(6.0)))


def rolling_moments(df: DataFrame, col: str, specs: list[tuple[str, str, int, int]], w: WindowSpec) -> DataFrame:
    """Rolling std, skew and kurt of a numeric column in O(rows x log k).

    ``specs``: (output name, "std" | "skew" | "kurt", k, shift).  A row's
    blocks of 2, 4, 8, ... rows ending there come from merging the block of
    half the size with the one before it (a lag by half the size); the k rows
    of a window are the disjoint blocks of k's binary digits, merged the same
    way.  Every merge works on central moments, so there is no difference of
    large sums.  All levels and all windows share ``w``: more Window operators,
    no further Exchange or Sort.  NULL unless the window holds k non-NULL
    values (running counts); inside such a window no NULL takes part, so NULLs
    count as 0 in the blocks.
    """
    if not specs:
        return df
    order = {"std": 2, "skew": 3, "kurt": 4}
    top = max(order[kind] for _, kind, _, _ in specs)
    top_level = max(k for _, _, k, _ in specs).bit_length() - 1
    names = ["mean", "m2", "m3", "m4"][:top]
    x = F.coalesce(F.col(col).cast("double"), F.lit(0.0))
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    base = list(df.columns)
    staged = df.select("*", F.count(col).over(run).alias("_mn"),
                       F.struct(x.alias("mean"), *[F.lit(0.0).alias(n) for n in names[1:]]).alias("_b0"))
    for j in range(top_level):
        staged = staged.select("*", F.lag(f"_b{j}", 2 ** j).over(w).alias("_before"))
        staged = staged.select(*[c for c in staged.columns if c != "_before"], F.when(
            F.col("_before").isNotNull(), F.struct(*_merged(F.col("_before"), F.col(f"_b{j}"), 2 ** j, 2 ** j, top))).alias(f"_b{j + 1}"))

    def back(c: str, n: int) -> Column:
        return F.col(c) if n == 0 else F.lag(c, n).over(w)

    # The blocks of every window, newest first; equal windows are read once.
    windows = sorted({(k, shift) for _, _, k, shift in specs})
    parts = {}
    for k, shift in windows:
        at, blocks = shift, []
        for j in reversed(range(k.bit_length())):
            if k >> j & 1:
                blocks.append((f"_b{j}", at, 2 ** j))
                at += 2 ** j
        parts[k, shift] = blocks
    lagged = {(c, n): f"_l{i}" for i, (c, n) in enumerate(sorted({(c, n) for b in parts.values() for c, n, _ in b}))}
    counts = {k_s: f"_n{i}" for i, k_s in enumerate(windows)}
    staged = staged.select(
        *base, *[back(c, n).alias(a) for (c, n), a in lagged.items()],
        *[(back("_mn", s) - F.coalesce(back("_mn", s + k), F.lit(0))).alias(a) for (k, s), a in counts.items()])
    whole = {}
    for i, (key, blocks) in enumerate(parts.items()):
        (c, n, size), done = blocks[0], blocks[0][2]
        current = lagged[c, n]
        for step, (c, n, size) in enumerate(blocks[1:]):
            name = f"_w{i}_{step}"
            staged = staged.withColumn(name, F.struct(*_merged(F.col(lagged[c, n]), F.col(current), size, done, top)))
            current, done = name, done + size
        whole[key] = current
    return staged.select(*base, *[
        F.when(F.col(counts[k, s]) == k, _statistic(kind, F.col(whole[k, s]), k)).alias(name)
        for name, kind, k, s in specs])


def _whole(col: str, to: str) -> Column:
    """``col`` cast to an integral type; a fractional value raises instead of
    being truncated (the running-total forms are exact only for whole numbers)."""
    c = F.col(col)
    return F.when(c.isNull() | (c == F.floor(c)), c.cast(to)).otherwise(
        F.raise_error(F.lit(f"{col}: running-total rolling statistics need whole numbers")).cast(to))


def rolling_sums_prefix(df: DataFrame, col: str, specs: list[tuple[str, int, int]],
                        w: WindowSpec, mean: bool = True) -> DataFrame:
    """Rolling sums (or means) of an integer-valued column in O(rows).

    Spark evaluates a sliding ROWS frame by re-aggregating the whole frame
    for every row (O(rows x k)).  For whole-number data the same sums come
    from running totals: with C(j) the running sum up to row j,
    ``sum(rows r-s-k+1 .. r-s) = C(r-s) - C(r-s-k)``, and the same for the
    running count of non-NULL values (the full-window guard).  Sums of whole
    numbers are exact in 64-bit integers, so the result equals the direct
    frame aggregate bit for bit.  ``specs``: (output name, k, shift).

    Two Window operators with the same partitioning and ordering: one
    Exchange and one Sort in total.
    """
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    staged = df.select("*", F.coalesce(F.sum(_whole(col, "long")).over(run), F.lit(0))
                       .alias("_cs"), F.count(col).over(run).alias("_cn"))

    def at(c: str, back: int) -> Column:
        return F.col(c) if back == 0 else F.lag(c, back).over(w)

    out = []
    for name, k, shift in specs:
        s = at("_cs", shift) - F.coalesce(at("_cs", shift + k), F.lit(0))
        n = at("_cn", shift) - F.coalesce(at("_cn", shift + k), F.lit(0))
        val = s.cast("double") / k if mean else s.cast("double")
        out.append(F.when(n == k, val).alias(name))
    return staged.select("*", *out).drop("_cs", "_cn")


def rolling_std_prefix(df: DataFrame, col: str, specs: list[tuple[str, int, int]],
                       w: WindowSpec) -> DataFrame:
    """Rolling sample std of an integer-valued column in O(rows).

    Window sums S1, S2 of x and x^2 come from running totals in
    DECIMAL(38,0), exact for values up to about 1e15 on a series of a few
    thousand days; with n = k, std = sqrt((n S2 - S1^2) / (n (n - 1))).
    ``specs``: (output name, k, shift).  Skew and kurtosis are not built this
    way: their fourth powers outgrow 38 digits on large totals, so they come
    from ``rolling_moments``, which centres at every merge.
    """
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    dec = "decimal(38,0)"
    x = _whole(col, dec)
    zero = F.lit(0).cast(dec)
    staged = df.select("*", F.count(col).over(run).alias("_rn"),
                       F.coalesce(F.sum(x).over(run), zero).alias("_r1"),
                       F.coalesce(F.sum(x * x).over(run), zero).alias("_r2"))

    def win_sum(c: str, k: int, shift: int) -> Column:
        cur = F.col(c) if shift == 0 else F.lag(c, shift).over(w)
        return cur - F.coalesce(F.lag(c, shift + k).over(w), F.lit(0) if c == "_rn" else zero)

    out = []
    for name, k, shift in specs:
        s1, s2 = win_sum("_r1", k, shift), win_sum("_r2", k, shift)
        spread = (F.lit(k) * s2 - s1 * s1).cast("double")
        out.append(F.when(win_sum("_rn", k, shift) == k, F.sqrt(spread / float(k * (k - 1)))).alias(name))
    return staged.select("*", *out).drop("_rn", "_r1", "_r2")


def rolling_extreme(df: DataFrame, col: str, k: int, w: WindowSpec, shift: int = 0,
                    out: str = "rolling_max", largest: bool = True) -> DataFrame:
    """Exact rolling max (or min) over k rows in O(rows x log k).

    Block extremes by doubling: M_0 = x, M_{j+1}(i) = max(M_j(i), M_j(i-2^j))
    covers the 2^{j+1} rows ending at i.  With 2^J <= k < 2^{J+1} the k rows
    ending at e are the union of the blocks ending at e and at e - k + 2^J.
    Each level is a lag over the same window spec, so the levels add Window
    operators but no Exchange or Sort.  NULL unless all k rows are non-NULL
    (running counts, as ``rolling_sums_prefix``).
    """
    pick = F.greatest if largest else F.least
    levels = max(k.bit_length() - 1, 0)
    staged = df.withColumn("_m0", F.col(col).cast("double"))
    for j in range(levels):
        staged = staged.withColumn(f"_m{j + 1}", pick(F.col(f"_m{j}"),
                                                      F.lag(f"_m{j}", 2 ** j).over(w)))
    top = f"_m{levels}"
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    staged = staged.withColumn("_cn", F.count(col).over(run))

    def at(c: str, back: int) -> Column:
        return F.col(c) if back == 0 else F.lag(c, back).over(w)

    n = at("_cn", shift) - F.coalesce(at("_cn", shift + k), F.lit(0))
    val = pick(at(top, shift), at(top, shift + k - 2 ** levels))
    return staged.withColumn(out, F.when(n == k, val)) \
                 .drop("_cn", *[f"_m{j}" for j in range(levels + 1)])


# --- F1 / F5 ---------------------------------------------------------------

def lag_features(df: DataFrame, lags: Iterable[int], col: str = "sales",
                 w: WindowSpec | None = None, prefix: str = "lag") -> DataFrame:
    """``lag_{n}`` = value n rows earlier in the series (row-based)."""
    w = w or series_window()
    return df.select("*", *[F.lag(col, n).over(w).alias(f"{prefix}_{n}") for n in lags])


def shift_horizon(df: DataFrame, horizon: int = 28, extra: Iterable[int] = (0, 1, 2),
                  col: str = "demand", w: WindowSpec | None = None) -> DataFrame:
    """``shift_t{h+i}`` lags by the horizon and just beyond it."""
    w = w or series_window()
    return df.select("*", *[F.lag(col, horizon + i).over(w).alias(f"shift_t{horizon + i}")
                            for i in extra])


# --- F2 / F3 / F4 ----------------------------------------------------------

def rolling_mean_of_lag(df: DataFrame, lags: Iterable[int], wins: Iterable[int],
                        col: str = "sales", w: WindowSpec | None = None,
                        round_to: int | None = None, integral: bool = False) -> DataFrame:
    """F2 (and F3 with ``round_to``): ``rmean_{lag}_{win}`` for lags x wins.

    F3 rounds half-even (pandas ``round``), i.e. ``bround``.  ``integral``:
    the column holds whole numbers (units sold), so the O(rows) running-total
    form is used (exactly equal results).
    """
    w = w or series_window()
    if integral:
        specs = [(f"rmean_{lag}_{win}", win, lag) for lag in lags for win in wins]
        out = rolling_sums_prefix(df, col, specs, w)
        if round_to is not None:
            out = out.select(*[F.bround(c, round_to).alias(c) if c in {n for n, _, _ in specs}
                               else F.col(c) for c in out.columns])
        return out
    out = []
    for lag in lags:
        for win in wins:
            c = rolling(col, F.avg, win, w, shift=lag)
            if round_to is not None:
                c = F.bround(c, round_to)
            out.append(c.alias(f"rmean_{lag}_{win}"))
    return df.select("*", *out)


def rolling_std_of_lag(df: DataFrame, lag: int, wins: Iterable[int], col: str = "sales",
                       w: WindowSpec | None = None, integral: bool = False) -> DataFrame:
    """sample std (n-1) of the lagged column over ``win`` rows."""
    w = w or series_window()
    if integral:
        return rolling_std_prefix(df, col, [(f"rstd_{lag}_{win}", win, lag) for win in wins], w)
    return rolling_moments(df, col, [(f"rstd_{lag}_{win}", "std", win, lag) for win in wins], w)


# --- F6-F9: horizon-shifted demand statistics --------------------------------

def rolling_horizon_features(df: DataFrame, horizon: int = 28,
                             mean_wins: Iterable[int] = (7, 30, 60, 90, 180),
                             std_wins: Iterable[int] = (7, 30, 60, 90, 180),
                             moment_win: int | None = 30, col: str = "demand",
                             w: WindowSpec | None = None, integral: bool = False) -> DataFrame:
    """F6 mean, F7 std, F8 skew, F9 kurt of ``col`` shifted by the horizon.

    ``integral``: whole-number demand; means and stds then come from exact
    running totals (``rolling_sums_prefix`` / ``rolling_std_prefix``), O(rows)
    instead of O(rows x window).  Skew and kurt, and the std of other columns,
    come from ``rolling_moments``."""
    w = w or series_window()
    moments = [(f"rolling_skew_t{moment_win}", "skew", moment_win, horizon),
               (f"rolling_kurt_t{moment_win}", "kurt", moment_win, horizon)] if moment_win else []
    if integral:
        if mean_wins:
            df = rolling_sums_prefix(df, col, [(f"rolling_mean_t{k}", k, horizon)
                                               for k in mean_wins], w)
        if std_wins:
            df = rolling_std_prefix(df, col, [(f"rolling_std_t{k}", k, horizon) for k in std_wins], w)
    else:
        df = df.select("*", *[rolling(col, F.avg, k, w, shift=horizon).alias(f"rolling_mean_t{k}") for k in mean_wins])
        moments = [(f"rolling_std_t{k}", "std", k, horizon) for k in std_wins] + moments
    return rolling_moments(df, col, moments, w)


# --- F10-F13: price features -----------------------------------------------

def price_delta(df: DataFrame, col: str = "sell_price", w: WindowSpec | None = None) -> DataFrame:
    """previous price minus current price."""
    w = w or series_window()
    return df.withColumn("delta_price", F.lag(col, 1).over(w) - F.col(col))


def price_change_features(df: DataFrame, col: str = "sell_price", year_rows: int = 365,
                          std_wins: Iterable[int] = (7, 30),
                          w: WindowSpec | None = None) -> DataFrame:
    """F11 relative change to the previous price, F12 change against the
    highest of the previous ``year_rows`` prices, F13 rolling price std."""
    w = w or series_window()
    prev = F.lag(col, 1).over(w)
    df = rolling_extreme(df, col, year_rows, w, shift=1, out="_year_max")
    year_max = F.col("_year_max")
    cols = [
        F.try_divide(prev - F.col(col), prev).alias("price_change_t1"),
        F.try_divide(year_max - F.col(col), year_max).alias("price_change_t365"),
    ]
    df = df.select("*", *cols).drop("_year_max")
    return rolling_moments(df, col, [(f"rolling_price_std_t{k}", "std", k, 0) for k in std_wins], w)


# --- F14 ---------------------------------------------------------------------

def group_mean_rolling(df: DataFrame, group_keys: list[str], value_col: str,
                       out_col: str = "Sales_1", win: int = 7, round_to: int = 2,
                       w: WindowSpec | None = None) -> DataFrame:
    """mean of ``value_col`` over the group (E1, joined back: D8), then
    its ``win``-row rolling mean per series, rounded half-even.

    The group mean is an aggregation joined back (skew-safe: a hot group is
    pre-reduced per map task), then one exchange by series id.
    """
    from shelfcast.operators.joins import join_group_stat_back
    w = w or series_window()
    with_mean = join_group_stat_back(df, group_keys, value_col, out_col)
    return with_mean.withColumn(
        f"rmean_{out_col}_{win}", F.bround(rolling(out_col, F.avg, win, w), round_to))


# --- F15 / F16 ---------------------------------------------------------------

def horizon_rank(df: DataFrame, w: WindowSpec | None = None, label_prefix: str = "F") -> DataFrame:
    """1-based position in the series as a label ``F{n}``."""
    w = w or series_window()
    return df.withColumn("F", F.concat(F.lit(label_prefix), F.row_number().over(w).cast("string")))


def head_per_group(df: DataFrame, n: int, w: WindowSpec | None = None) -> DataFrame:
    """F16: first ``n`` rows of every series (Spark plans a WindowGroupLimit
    below the exchange, so at most n rows per key and map task are shuffled)."""
    w = w or series_window()
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") <= n).drop("_rn"))
