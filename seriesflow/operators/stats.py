"""Aggregations (H1, H2, H6): all hash aggregates, partial on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: a target whose sample std is below this is flagged as near-constant.
LOW_VARIANCE_STD = 0.01


def validate_target(df: DataFrame, target: str, keys: Sequence[str] = ()) -> DataFrame:
    """H1 + C5: rows, missing, mean, sample std, min, max and a low-variance flag."""
    c = F.col(target)
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.count_if(c.isNull()).alias("n_missing"),
            F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"), F.max(c).alias("max")]
    out = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    return out.withColumn("low_variance", F.col("std") < F.lit(LOW_VARIANCE_STD))


def forecast_summary(df: DataFrame, keys: Sequence[str], date_col: str,
                     measures: Sequence[str]) -> DataFrame:
    """H2 + H3: period, mean, min, max, population std (volatility) and range per measure."""
    aggs = [F.min(date_col).alias("period_start"), F.max(date_col).alias("period_end"),
            F.count(F.lit(1)).alias("n_steps")]
    for m in measures:
        c = F.col(m)
        aggs += [F.avg(c).alias(f"{m}_mean"), F.min(c).alias(f"{m}_min"), F.max(c).alias(f"{m}_max"),
                 F.stddev_pop(c).alias(f"{m}_volatility"), (F.max(c) - F.min(c)).alias(f"{m}_range")]
    return df.groupBy(*keys).agg(*aggs)


def balanced_class_weights(df: DataFrame, label: str) -> DataFrame:
    """H6: weight_c = n / (m * count_c) per class (``class_weight='balanced'``)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_count"))
    tot = counts.agg(F.sum("class_count").alias("n"), F.count(F.lit(1)).alias("m")).first()
    n, m = int(tot["n"] or 0), int(tot["m"] or 0)
    return counts.withColumn(
        "weight", F.lit(float(n)) / (F.lit(float(m)) * F.col("class_count")))


MOST_INLINE_CLASSES = 1000


def with_class_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Attach balanced weights: inlined as a literal map up to ``MOST_INLINE_CLASSES``
    classes (checked), joined above. Rows without a label get no weight and count for none."""
    weights = balanced_class_weights(df.where(F.col(label).isNotNull()), label)
    w = weights.limit(MOST_INLINE_CLASSES + 1).collect()
    if not w:
        return df.withColumn(weight_col, F.lit(None).cast("double"))
    if len(w) > MOST_INLINE_CLASSES:
        return df.join(weights.select(label, F.col("weight").alias(weight_col)), label, "left").select(*df.columns, weight_col)
    mp = F.create_map(*[x for r in w for x in (F.lit(r[label]), F.lit(r["weight"]))])
    return df.withColumn(weight_col, mp[F.col(label)])
