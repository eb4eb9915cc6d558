"""Row-based window features over many series at once.

Every builder returns a ``dict[name, Column]`` so a caller can put all
features that share one ``Window.partitionBy(keys).orderBy(order)`` into a
single ``withColumns``: Catalyst then plans one exchange, one sort and one
``Window`` node for all lags and rolling frames together.

Frames are row frames (``rowsBetween``), matching positional rolling windows;
they are not calendar windows when dates have gaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seriesflow.functions.calendar import calendar_exprs
from seriesflow.functions.numeric import col_
from seriesflow.session import cut_lineage

# Fixed values of the forecasting feature set: rolling window lengths, the
# rolling std length, difference and relative-change offsets, lag count.
ROLL_WINDOWS = (3, 7, 14, 21)
STD_WINDOW = 7
DIFF_OFFSETS = (1, 3, 7)
CHANGE_OFFSETS = (3, 7)
N_LAGS = 21


def series_window(keys: Sequence[str], order: Sequence[str] | str) -> WindowSpec:
    order = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return w.orderBy(*order)


def _frame(w: WindowSpec, n: int, shift: int = 0) -> WindowSpec:
    """Last ``n`` rows ending ``shift`` rows before the current one."""
    return w.rowsBetween(-(n - 1) - shift, -shift)


def lag_exprs(col: str, n_lags: int, w: WindowSpec, name: str | None = None) -> dict[str, Column]:
    """``{name}_lag{i}`` for i in 1..n_lags."""
    name = name or col
    return {f"{name}_lag{i}": F.lag(col, i).over(w) for i in range(1, n_lags + 1)}


def rolling_mean_exprs(cols: dict[str, str], windows: Sequence[int], w: WindowSpec,
                       full: bool = True, shift: int = 0) -> dict[str, Column]:
    """E2 (``full=True``: NULL until the frame holds ``n`` non-null values) and
    E4 (``full=False``: partial frames allowed, like ``min_periods=1``).

    ``cols`` maps output prefix -> input column; output ``{prefix}_roll{n}``.
    """
    out = {}
    for n in windows:
        for prefix, c in cols.items():
            fr = _frame(w, n, shift)
            mean = F.avg(c).over(fr)
            out[f"{prefix}_roll{n}"] = F.when(F.count(c).over(fr) == n, mean) if full else mean
    return out


def rolling_std_exprs(cols: dict[str, str], n: int, w: WindowSpec, full: bool = True,
                      shift: int = 0) -> dict[str, Column]:
    """Rolling **sample** std, ``{prefix}_roll{n}_std`` (one row -> NULL)."""
    out = {}
    for prefix, c in cols.items():
        fr = _frame(w, n, shift)
        sd = F.stddev_samp(c).over(fr)
        out[f"{prefix}_roll{n}_std"] = F.when(F.count(c).over(fr) == n, sd) if full else sd
    return out


def diff_exprs(col: str, offsets: Sequence[int], w: WindowSpec, prefix: str) -> dict[str, Column]:
    """``{prefix}_diff_{k}`` = x - x[-k]."""
    return {f"{prefix}_diff_{k}": F.col(col) - F.lag(col, k).over(w) for k in offsets}


def pct_change_exprs(col: str, offsets: Sequence[int], w: WindowSpec, prefix: str) -> dict[str, Column]:
    """``{prefix}_momentum_{k}`` = x / x[-k] - 1; a zero base gives NULL (not inf, no error)."""
    return {f"{prefix}_momentum_{k}": F.try_divide(F.col(col), F.lag(col, k).over(w)) - F.lit(1.0)
            for k in offsets}


def momentum_exprs(col: str, w: WindowSpec, prefix: str = "price") -> dict[str, Column]:
    """E6 + E7 + E8 (volatility = full-frame rolling sample std over 7 rows)."""
    out = diff_exprs(col, DIFF_OFFSETS, w, prefix)
    out.update(pct_change_exprs(col, CHANGE_OFFSETS, w, prefix))
    fr = _frame(w, STD_WINDOW)
    out[f"{prefix}_volatility_{STD_WINDOW}"] = F.when(F.count(col).over(fr) == STD_WINDOW,
                                                      F.stddev_samp(col).over(fr))
    return out


def trend_expr(col: str, w: WindowSpec) -> Column:
    """E11: 'up' / 'down' / 'flat' against the previous row; the first row is 'flat'."""
    s = F.signum(F.col(col) - F.lag(col, 1).over(w))
    return F.when(s > 0, F.lit("up")).when(s < 0, F.lit("down")).otherwise(F.lit("flat"))


def add_lags(df: DataFrame, col: str, n_lags: int, keys, order, name=None) -> DataFrame:
    return df.withColumns(lag_exprs(col, n_lags, series_window(keys, order), name))


def add_rolling(df: DataFrame, cols: dict[str, str], keys, order, windows=ROLL_WINDOWS,
                full: bool = True) -> DataFrame:
    return df.withColumns(rolling_mean_exprs(cols, windows, series_window(keys, order), full))


def add_rolling_std(df: DataFrame, cols: dict[str, str], keys, order, n: int = STD_WINDOW,
                    full: bool = True) -> DataFrame:
    return df.withColumns(rolling_std_exprs(cols, n, series_window(keys, order), full))


def add_momentum(df: DataFrame, col: str, keys, order, prefix: str = "price") -> DataFrame:
    return df.withColumns(momentum_exprs(col, series_window(keys, order), prefix))


def feature_exprs(keys, order, date_col: str, target: str, price: str,
                  measures: dict[str, str], n_lags: int = N_LAGS,
                  windows: Sequence[int] = ROLL_WINDOWS, with_lags: bool = True,
                  with_calendar: bool = True, w: WindowSpec | None = None) -> dict[str, Column]:
    """E14 expression set: rolling means of every measure, rolling std of the
    target and price, calendar columns, target lags and price momentum.

    ``measures`` maps output prefix -> column (e.g. ``{"demand": "demand"}``);
    std columns are built for the target and price prefixes.
    """
    w = w if w is not None else series_window(keys, order)
    out: dict[str, Column] = {}
    out.update(rolling_mean_exprs(measures, windows, w, full=True))
    std_cols = {p: c for p, c in measures.items() if c in (target, price)}
    out.update(rolling_std_exprs(std_cols, STD_WINDOW, w, full=True))
    if with_calendar:
        out.update(calendar_exprs(date_col))
    if with_lags:
        out.update(lag_exprs(target, n_lags, w))
    out.update(momentum_exprs(price, w, "price"))
    return out


def feature_frame(df: DataFrame, keys, order, date_col: str, target: str, price: str,
                  measures: dict[str, str], n_lags: int = N_LAGS, drop_warmup: bool = True,
                  with_lags: bool = True, bucket: Column | None = None,
                  chunk_rows: int = 100_000) -> DataFrame:
    """The full feature frame in one projection, then warm-up rows dropped.

    With ``bucket`` (a column never decreasing along ``order``) the window runs
    through :func:`chunked_window`, for series too long or skewed for one task."""
    if bucket is None:
        out = df.withColumns(feature_exprs(keys, order, date_col, target, price, measures,
                                           n_lags, with_lags=with_lags))
    else:
        lookback = max([n_lags if with_lags else 0, max(ROLL_WINDOWS) - 1, STD_WINDOW - 1,
                        max(DIFF_OFFSETS), max(CHANGE_OFFSETS)])
        order = [order] if isinstance(order, str) else list(order)
        out = chunked_window(df, keys, order, bucket, lambda w: feature_exprs(
            keys, order, date_col, target, price, measures, n_lags, with_lags=with_lags, w=w),
            lookback=lookback, chunk_rows=chunk_rows)
    if not drop_warmup:
        return out
    from seriesflow.operators.clean import drop_incomplete
    return drop_incomplete(out)


def recompute_features(df: DataFrame, keys, order, target: str, price: str,
                       windows: Sequence[int] = ROLL_WINDOWS) -> DataFrame:
    """Partial-frame rolling means / std of target and price plus price momentum,
    refreshed over history + appended rows (exogenous rolling columns are carried)."""
    w = series_window(keys, order)
    cols = {"demand": target, "price": price}
    ex = rolling_mean_exprs(cols, windows, w, full=False)
    ex.update(rolling_std_exprs(cols, STD_WINDOW, w, full=False))
    ex.update(momentum_exprs(price, w, "price"))
    return df.withColumns(ex)


def last_rows(df: DataFrame, keys, order_col: str, n: int, rank_col: str | None = None) -> DataFrame:
    """The last ``n`` rows of every series (recency 1 = latest kept in
    ``rank_col`` when given). ``row_number() <= n`` lets Spark insert a partial
    per-partition group limit before the shuffle, so a hot series ships only n rows."""
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc())
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    if rank_col:
        out = out.withColumn(rank_col, F.col("_rn"))
    return out.drop("_rn")


def last_row(df: DataFrame, keys, order_col: str) -> DataFrame:
    """The last row per series via ``max_by`` (an aggregate: partial on the map side)."""
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order_col)).alias("_last"))
    return agg.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in others])


def sequences(df: DataFrame, keys, order, features: Sequence[str], target: str,
              window_size: int) -> DataFrame:
    """For every row with ``window_size`` earlier rows, ``x`` = the features
    of rows [i-w, i) as ``array<struct>`` and ``y`` = the target at i."""
    w = series_window(keys, order).rowsBetween(-window_size, -1)
    x = F.collect_list(F.struct(*[col_(f) for f in features])).over(w)
    return (df.withColumn("x", x).filter(F.size("x") == window_size)
            .withColumn("y", F.col(target)))


#: The column ``range_buckets`` adds.
RANGE = "_range"


def range_buckets(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int | None = None) -> DataFrame:
    """``df`` with a bucket column ``RANGE`` that never decreases along ``order`` in a series.

    Spark cuts the rows into ``n`` (default: the shuffle partitions) ranges of
    (keys, order) of about equal size, so a series holding a third of all rows
    spreads over a third of the buckets, however crowded its times are, and
    ``keys`` may be empty. Rows equal in (keys, order) share a bucket. The cuts
    come from samples, so the frame is checkpointed: all later readers, and
    recomputed tasks, see the same buckets."""
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(n, *keys, *order).withColumn(RANGE, F.spark_partition_id()))


def chunked_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
                   exprs, lookback: int, chunk_rows: int = 100_000) -> DataFrame:
    """Row-frame window features for series too long (or too skewed) for one task.

    Exact re-plan of ``df.withColumns(exprs(Window.partitionBy(keys).orderBy(order)))``
    for frames that look at most ``lookback`` rows back and never forward:

    1. ``bucket`` (never decreasing along ``order``, e.g. of ``range_buckets``) splits each
       series; rows are numbered inside (series, bucket) - spread over tasks;
    2. bucket sizes (an aggregate) -> running offsets over the small bucket
       table -> a global row number ``rn`` per series;
    3. rows go to chunks of ``chunk_rows`` consecutive rows; the last
       ``lookback`` rows of each chunk are copied into the next chunk as halo
       (``explode``, no join), so every row sees its full frame;
    4. the features run per (series, chunk) and halo copies are dropped.

    ``exprs`` is a function ``WindowSpec -> dict[name, Column]``.
    """
    if chunk_rows < lookback:
        raise ValueError("chunk_rows must be at least the lookback")
    keys, order = list(keys), list(order)
    num = series_row_number(df, keys, order, bucket, "_rn")
    chunk = F.floor((F.col("_rn") - 1) / F.lit(chunk_rows))
    in_tail = ((F.col("_rn") - 1) % F.lit(chunk_rows)) >= F.lit(chunk_rows - lookback)
    copies = F.when(in_tail, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    rep = num.withColumns({"_own": chunk, "_chunk": F.explode(copies)})
    w = Window.partitionBy(*keys, "_chunk").orderBy("_rn")
    out = rep.withColumns(exprs(w)).filter(F.col("_chunk") == F.col("_own"))
    return out.drop("_rn", "_own", "_chunk")


def series_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
                      out: str = "rn", with_size: str | None = None) -> DataFrame:
    """Position 1..n of every row in its series (and optionally the series size)
    without a one-task-per-series window: rows are numbered per (series, bucket),
    bucket sizes are aggregated, running offsets come from a window over the
    small bucket table and are joined back on (series, bucket)."""
    keys, order = list(keys), list(order)
    d = df.withColumn("_b", bucket)
    local = d.withColumn("_lr", F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(*order)))
    sizes = d.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wb = Window.partitionBy(*keys).orderBy("_b")
    offs = sizes.withColumn("_off", F.coalesce(
        F.sum("_n").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if with_size:
        offs = offs.withColumn(with_size, F.sum("_n").over(
            wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    res = local.join(offs.drop("_n"), keys + ["_b"]).withColumn(out, F.col("_off") + F.col("_lr"))
    return res.drop("_b", "_lr", "_off")


def lag_one(df: DataFrame, col: str, keys: Sequence[str], order: Sequence[str], bucket: Column,
            out: str | None = None) -> DataFrame:
    """Skew-safe ``lag(col, 1)`` per series: lag inside (series, bucket); the first
    row of a bucket takes the last value of the previous non-empty bucket of its
    series (``max_by`` per bucket - a partial aggregate - then ``lag`` over the
    small bucket table, joined back on (series, bucket))."""
    keys, order = list(keys), list(order)
    out = out or f"{col}_lag1"
    d = df.withColumn("_b", bucket)
    w = Window.partitionBy(*keys, "_b").orderBy(*order)
    local = d.withColumns({out: F.lag(col, 1).over(w), "_first": F.row_number().over(w) == 1})
    edges = d.groupBy(*keys, "_b").agg(F.max_by(F.col(col), F.struct(*[F.col(c) for c in order])).alias("_last"))
    prev = edges.select(*keys, "_b", F.lag("_last", 1).over(
        Window.partitionBy(*keys).orderBy("_b")).alias("_prev"))
    res = local.join(prev, keys + ["_b"], "left")
    return res.withColumn(out, F.when(F.col("_first"), F.col("_prev")).otherwise(F.col(out))) \
              .drop("_b", "_first", "_prev")
