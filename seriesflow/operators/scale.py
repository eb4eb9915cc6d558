"""Scaling with stored parameters.

``fit_scaler`` is one aggregation over all columns (partial per task) and
returns a long parameter table ``(column, kind, center, scale)`` (+ series keys
when scaling per series).  ``apply_scaler`` turns it back into expressions:

* whole-table parameters are one row per column, so they are collected and
  inlined as literals - no join, no broadcast;
* per-series parameters are pivoted to one row per series and equi-joined.

Semantics follow the reference's scalers, not Spark ML's: min-max of a
constant column is 0 (Spark ML gives 0.5) and the standard scaler centres and
divides by the **population** std, a zero std giving 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesflow.operators import clean, encode


def fit_scaler(df: DataFrame, cols: Sequence[str], kind: str = "minmax",
               keys: Sequence[str] = ()) -> DataFrame:
    if kind == "minmax":
        aggs = [a for c in cols for a in (F.min(F.col(c).cast("double")).alias(f"a_{c}"),
                                          F.max(F.col(c).cast("double")).alias(f"b_{c}"))]
    elif kind == "standard":
        aggs = [a for c in cols for a in (F.avg(F.col(c).cast("double")).alias(f"a_{c}"),
                                          F.stddev_pop(F.col(c).cast("double")).alias(f"b_{c}"))]
    else:
        raise ValueError(f"unknown scaler kind {kind!r}")
    if not keys:
        # whole-table parameters: one aggregate job, one row back, kept as a tiny
        # local table so every later use is free (no recomputation of the input)
        r = df.agg(*aggs).first()
        local = [(c, kind, r[f"a_{c}"],
                  (None if r[f"b_{c}"] is None or r[f"a_{c}"] is None else
                   (r[f"b_{c}"] - r[f"a_{c}"] if kind == "minmax" else r[f"b_{c}"]))) for c in cols]
        return df.sparkSession.createDataFrame(
            local, "column string, kind string, center double, scale double")
    wide = df.groupBy(*keys).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(kind).alias("kind"),
        F.col(f"a_{c}").alias("center"),
        (F.col(f"b_{c}") - F.col(f"a_{c}") if kind == "minmax" else F.col(f"b_{c}")).alias("scale"))
        for c in cols]))
    return wide.select(*keys, rows.alias("p")).select(*keys, "p.*")


def fit_scalers(df: DataFrame, cols: Sequence[str],
                kinds: Sequence[str] = ("minmax", "standard")) -> dict[str, DataFrame]:
    """Whole-table parameters of several scalers from ONE aggregation job
    (min, max, mean, population std of every column), as tiny local tables."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"mn_{c}"), F.max(x).alias(f"mx_{c}"),
                 F.avg(x).alias(f"mu_{c}"), F.stddev_pop(x).alias(f"sd_{c}")]
    r = df.agg(*aggs).first()
    out = {}
    for kind in kinds:
        rows = []
        for c in cols:
            if kind == "minmax":
                lo, hi = r[f"mn_{c}"], r[f"mx_{c}"]
                rows.append((c, kind, lo, None if lo is None else hi - lo))
            else:
                rows.append((c, kind, r[f"mu_{c}"], r[f"sd_{c}"]))
        out[kind] = df.sparkSession.createDataFrame(
            rows, "column string, kind string, center double, scale double")
    return out


def _scaled(x, center, scale):
    s = F.when(scale == 0, F.lit(1.0)).otherwise(scale)
    return (x.cast("double") - center) / s


def apply_scaler(df: DataFrame, params: DataFrame, cols: Sequence[str] | None = None,
                 keys: Sequence[str] = (), suffix: str | None = None) -> DataFrame:
    """Apply stored parameters; NULL inputs stay NULL."""
    if not keys:
        prm = {r["column"]: (r["center"], r["scale"]) for r in params.collect()}
        cols = [c for c in (cols or prm) if c in prm]
        return df.withColumns({
            (f"{c}{suffix}" if suffix else c): _scaled(F.col(c), F.lit(prm[c][0]), F.lit(prm[c][1]))
            for c in cols})
    cols = list(cols)
    wide = (params.filter(F.col("column").isin(cols)).groupBy(*keys).pivot("column", cols)
            .agg(F.first("center").alias("c"), F.first("scale").alias("s")))
    out = df.join(wide, on=list(keys), how="left")
    out = out.withColumns({(f"{c}{suffix}" if suffix else c): _scaled(F.col(c), F.col(f"{c}_c"), F.col(f"{c}_s"))
                           for c in cols})
    return out.drop(*[f"{c}_{x}" for c in cols for x in ("c", "s")])


def minmax_scale(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """D5."""
    return apply_scaler(df, fit_scaler(df, cols, "minmax", keys), cols, keys)


def standard_scale(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """D6."""
    return apply_scaler(df, fit_scaler(df, cols, "standard", keys), cols, keys)


def numeric_feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    from pyspark.sql.types import NumericType
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def preprocess(df: DataFrame, keys: Sequence[str], order, categorical: Sequence[str],
               targets: Sequence[str], fill_keys: Sequence[str] | None = None, bucket=None):
    """Forward fill -> median fill (median of the column before the fill)
    -> label encode -> {min-max, standard} variants of every numeric non-target
    column (encoded categoricals included).  Returns ``(encoded, mm, std, artifacts)``
    where artifacts holds the label map and both parameter tables.  ``bucket``
    selects the skew-safe bucketed forward fill for long series."""
    from pyspark import StorageLevel
    # like Spark ML estimators: keep the input for the fit's eager jobs, release after
    own = not df.storageLevel.useMemory and not df.storageLevel.useDisk
    if own:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _preprocess(df, keys, order, categorical, targets, fill_keys, bucket)
    finally:
        if own:
            df.unpersist(blocking=False)


def _preprocess(df, keys, order, categorical, targets, fill_keys, bucket):
    fill_keys = list(keys) if fill_keys is None else list(fill_keys)
    from pyspark.sql.types import NumericType
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    cand = [c for c in num + list(categorical) if c not in keys]
    # one cheap aggregate: only columns holding NULLs can change under ffill / median fill
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cand]).first() if cand else {}
    gaps = [c for c in cand if nulls[c]]
    filled = clean.forward_fill(df, gaps, keys, order, bucket=bucket) if gaps else df
    med_cols = [c for c in num if c in gaps]
    if med_cols:
        filled = clean.fill_with_stats(filled, df, med_cols, fill_keys, "median")
    lmap = fit_label_map(filled, categorical)
    enc = encode.encode(filled, lmap, categorical, mode="strict")
    scale_cols = [c for c in list(categorical) + num if c not in targets]
    prm = fit_scalers(enc, scale_cols)
    mm_p, st_p = prm["minmax"], prm["standard"]
    mm = apply_scaler(enc, mm_p, scale_cols)
    std = apply_scaler(enc, st_p, scale_cols)
    return enc, mm, std, {"label_map": lmap, "minmax": mm_p, "standard": st_p}


fit_label_map = encode.fit_label_map
