"""Missing-value operators.

Forward / backward fill over a series come in two plans:

* plain: ``last(c, ignorenulls)`` over ``Window.partitionBy(keys).orderBy(order)``
  - one task per series, fine when every series is small (e.g. ``daily``);
* bucketed (``bucket=`` a column that never decreases along ``order``, such as
  ``date_trunc('day', ts)``): the fill runs per (series, bucket), each bucket's
  last non-null value is an aggregate (partial on the map side), a window over
  those tiny bucket summaries carries values across buckets, and one equi-join
  on (series, bucket) brings the carry-in back.  A series holding a third of all
  rows is then spread over all its buckets instead of landing in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BK = "_bucket"


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _plain_fill(df, cols, keys, order, forward: bool) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    if forward:
        fr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({o: F.last(c, True).over(fr) for c, o in cols.items()})
    fr = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return df.withColumns({o: F.first(c, True).over(fr) for c, o in cols.items()})


def _bucketed_fill(df, cols, keys, order, bucket: Column, forward: bool) -> DataFrame:
    d = df.withColumn(_BK, bucket)
    wk = list(keys) + [_BK]
    local = _plain_fill(d, {c: f"_loc_{i}" for i, c in enumerate(cols)}, wk, order, forward)
    ordv = _order_struct(order)
    pick = F.max_by if forward else F.min_by
    summ = d.groupBy(*wk).agg(*[
        pick(F.col(c), F.when(F.col(c).isNotNull(), ordv)).alias(f"_edge_{i}")
        for i, c in enumerate(cols)])
    wb = Window.partitionBy(*keys).orderBy(_BK)
    if forward:
        fr = wb.rowsBetween(Window.unboundedPreceding, -1)
        carry = {f"_in_{i}": F.last(f"_edge_{i}", True).over(fr) for i in range(len(cols))}
    else:
        fr = wb.rowsBetween(1, Window.unboundedFollowing)
        carry = {f"_in_{i}": F.first(f"_edge_{i}", True).over(fr) for i in range(len(cols))}
    summ = summ.withColumns(carry).select(*wk, *carry.keys())
    out = local.join(summ, on=wk, how="left")
    out = out.withColumns({o: F.coalesce(F.col(f"_loc_{i}"), F.col(f"_in_{i}"))
                           for i, o in enumerate(cols.values())})
    drop = [_BK] + [f"_loc_{i}" for i in range(len(cols))] + list(carry.keys())
    return out.drop(*drop)


def _fill(df, cols, keys, order, bucket, forward, suffix) -> DataFrame:
    order = [order] if isinstance(order, str) else list(order)
    cmap = {c: (c if suffix is None else f"{c}{suffix}") for c in cols}
    if bucket is None:
        return _plain_fill(df, cmap, keys, order, forward)
    return _bucketed_fill(df, cmap, keys, order, bucket, forward)


def forward_fill(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order,
                 bucket: Column | None = None, suffix: str | None = None) -> DataFrame:
    """Carry the last non-null value forward within each series."""
    return _fill(df, cols, keys, order, bucket, True, suffix)


def backward_fill(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order,
                  bucket: Column | None = None, suffix: str | None = None) -> DataFrame:
    """Take the next non-null value within each series."""
    return _fill(df, cols, keys, order, bucket, False, suffix)


def exact_medians(df: DataFrame, cols: Sequence[str], keys: Sequence[str],
                  prefix: str = "median_", bins: int = 4096) -> DataFrame:
    """Exact per-group medians of several columns (mean of the two middle values
    for an even count) without holding a whole group in one task.

    All columns go through one pipeline: values are unpivoted to
    (group, column, value), then
    1. per (group, column): count, min, max (aggregate);
    2. per (group, column, value bin): counts (aggregate, <= ``bins`` rows each);
    3. running counts over that small histogram locate the bins holding the
       middle ranks;
    4. only rows of those bins are grouped by distinct value and ranked.
    A group of n rows sorts about n / bins values in one task (unless its values
    crowd into one bin), instead of all n.  NULLs are skipped.  One output row
    per group, one ``{prefix}{col}`` column per input column."""
    keys = list(keys)
    g = keys + ["_col"]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v"))
                                for c in cols]))
    x = df.select(*keys, pairs.alias("_p")).select(*keys, "_p._col", "_p._v").filter(F.col("_v").isNotNull())
    st = (x.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"),
                            F.max("_v").alias("_hi"))
          .withColumn("_k1", F.floor((F.col("_n") + 1) / 2))
          .withColumn("_k2", F.floor(F.col("_n") / 2) + 1))
    span = F.col("_hi") - F.col("_lo")
    b = F.when(span == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / span * F.lit(bins)), F.lit(bins - 1)))
    xb = x.join(st.select(*g, "_lo", "_hi"), g).withColumn("_bin", b.cast("int")).select(*g, "_bin", "_v")
    hist = xb.groupBy(*g, "_bin").agg(F.count(F.lit(1)).alias("_c"))
    wc = Window.partitionBy(*g).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = hist.withColumn("_cum", F.sum("_c").over(wc)).withColumn("_start", F.col("_cum") - F.col("_c"))

    def hit(k):
        return (F.col(k) > F.col("_start")) & (F.col(k) <= F.col("_cum"))
    tgt = cum.join(st.select(*g, "_k1", "_k2"), g).filter(hit("_k1") | hit("_k2"))
    vals = (xb.join(tgt.select(*g, "_bin", "_start", "_k1", "_k2"), g + ["_bin"])
            .groupBy(*g, "_bin", "_start", "_k1", "_k2", "_v").agg(F.count(F.lit(1)).alias("_vc")))
    wv = Window.partitionBy(*g, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    vals = (vals.withColumn("_last", F.col("_start") + F.sum("_vc").over(wv))
            .withColumn("_first", F.col("_last") - F.col("_vc") + 1))

    def inr(k):
        return (F.col(k) >= F.col("_first")) & (F.col(k) <= F.col("_last"))
    med = (vals.groupBy(*g).agg(F.max(F.when(inr("_k1"), F.col("_v"))).alias("_m1"),
                                F.max(F.when(inr("_k2"), F.col("_v"))).alias("_m2"))
           .select(*g, ((F.col("_m1") + F.col("_m2")) / 2).alias("_m")))
    wide = (med.groupBy(*keys) if keys else med.groupBy()).pivot("_col", list(cols)).agg(F.first("_m"))
    return wide.select(*keys, *[F.col(c).alias(f"{prefix}{c}") for c in cols])


def exact_median(df: DataFrame, col: str, keys: Sequence[str], out: str | None = None,
                 bins: int = 4096) -> DataFrame:
    """Exact distributed median of one column per group (see :func:`exact_medians`)."""
    res = exact_medians(df, [col], keys, bins=bins)
    return res.withColumnRenamed(f"median_{col}", out or f"median_{col}")


def column_stats(df: DataFrame, cols: Sequence[str], keys: Sequence[str], how: str) -> DataFrame:
    """Per-series (or whole-table) median / mean of each column.

    ``median`` is exact and distributed (:func:`exact_medians`, no group held in one
    task) and keeps groups whose values are all NULL, with NULL; ``percentile``
    is Spark's ``median`` (its buffer is a value->count map of a whole group);
    ``approx_median`` uses the mergeable ``percentile_approx`` sketch.
    """
    if how == "median":
        medians = exact_medians(df, cols, keys, prefix="_median_")
        return df.select(*keys).distinct().join(medians, list(keys), "left") if keys else medians
    fn = {"percentile": lambda c: F.median(c), "mean": lambda c: F.avg(c),
          "approx_median": lambda c: F.percentile_approx(c, 0.5, 10000)}[how]
    aggs = [fn(F.col(c)).alias(f"_{how}_{c}") for c in cols]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def fill_with_stats(df: DataFrame, stats_src: DataFrame, cols: Sequence[str], keys: Sequence[str],
                    how: str = "median") -> DataFrame:
    """Fill remaining NULLs with a statistic of ``stats_src`` (e.g. the
    column *before* forward fill).  Keyed: equi-join on the series keys (AQE
    broadcasts it when the runtime size is small).  Unkeyed: the single stats row
    is collected (one value per column) and inlined as literals, so no join at all.
    A column that is all NULL stays NULL; the fill value takes the column's type."""
    st = column_stats(stats_src, cols, keys, how)
    if keys:
        out = df.join(st, on=list(keys), how="left")
        types = {f.name: f.dataType for f in df.schema.fields}
        out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_{how}_{c}").cast(types[c]))
                               for c in cols})
        return out.drop(*[f"_{how}_{c}" for c in cols])
    row = st.first() or {f"_{how}_{c}": None for c in cols}  # no row: every column is all NULL
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(row[f"_{how}_{c}"]).cast(types[c]))
                           for c in cols})


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows holding any NULL (or NaN) - removes the feature warm-up rows.

    Written as one ``NOT greatest(isnull(..))`` predicate instead of ``na.drop``:
    on wide feature frames (~70 window columns) the per-column ``IsNotNull``
    constraints of ``na.drop`` make Catalyst's constraint propagation take
    minutes to plan any operator stacked on top (measured: 93 s vs 1 s); an
    added NaN test over the same columns brings the blow-up back, so NaN is not
    tested here: ingest turns NaN into NULL (``nans_to_nulls``, SURVEY §1)."""
    cols = list(cols) if cols else df.columns
    flags = [F.isnull(F.col(c)) for c in cols]
    any_null = F.greatest(*flags) if len(flags) > 1 else flags[0]
    return df.filter(~any_null)


def count_missing(c) -> Column:
    """C5."""
    return F.count_if(F.col(c).isNull() if isinstance(c, str) else c.isNull())
