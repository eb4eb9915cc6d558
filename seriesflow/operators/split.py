"""Splits (I1, I2) and tails."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesflow.operators.windows import RANGE, last_rows, range_buckets, series_row_number

#: Ranges that one pass of :func:`kth_smallest` counts; as many rows come to the driver.
RANGES = 1024


def _as_long(df: DataFrame, name: str) -> Column | None:
    """A column as a whole number of the same order; None if its type has none."""
    kind, c = df.schema[name].dataType.typeName(), F.col(name)
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(c.cast("timestamp"))
    if kind == "date":
        return F.unix_date(c).cast("long")
    return c.cast("long") if kind in ("byte", "short", "integer", "long") else None


def kth_smallest(df: DataFrame, order: Sequence[Column], k: int) -> tuple[int | None, ...]:
    """The ``k``-th smallest row (from 1) of whole-number columns, compared one after the other; NULL is the smallest.

    Each pass counts rows in ``RANGES`` ranges, an aggregate combined in the tasks, and goes on in the one that
    holds the row; a 64-bit column takes seven passes at most. No rows are numbered or sorted."""
    rows, found = df.select(*[c.alias(f"o{i}") for i, c in enumerate(order)]), []
    for i in range(len(order)):
        x = F.col(f"o{i}")
        low, high, missing = rows.agg(F.min(x), F.max(x), F.count_if(x.isNull())).first()
        if k <= missing:
            found.append(None)
            rows = rows.filter(x.isNull())
            continue
        k -= missing
        while low < high:
            bits = ((high - low) // RANGES).bit_length()
            counts = rows.filter(x.between(low, high)).groupBy(F.shiftright(x, bits).alias("part")).count().collect()
            for part, n in sorted(counts):
                if k <= n:
                    low, high = max(low, part << bits), min(high, ((part + 1) << bits) - 1)
                    break
                k -= n
        found.append(low)
        rows = rows.filter(x == low)
    return tuple(found)


def _first_rows(df: DataFrame, order: Sequence[Column], k: int) -> Column:
    """True for rows up to the ``k``-th in ``order`` (and its equals)."""
    if not k:
        return F.lit(False)
    before, same = F.lit(False), F.lit(True)
    for c, v in zip(order, kth_smallest(df, order, k)):
        less = F.lit(False) if v is None else c.isNull() | (c < v)
        before, same = before | (same & less), same & c.eqNullSafe(F.lit(v).cast("long"))
    return before | same


def chronological_split(df: DataFrame, keys: Sequence[str], order, train_frac: float = 0.8,
                        col: str = "is_train", bucket: Column | None = None) -> DataFrame:
    """Per series, the first ``floor(train_frac * n)`` rows in time order are
    train (``is_train`` true), the rest test.  Row number and series size come
    from one window over the series, or - with ``bucket`` - from the skew-safe
    :func:`series_row_number` (no task holds a whole series).

    Without keys all rows are one series: the cut is a distributed order
    statistic (:func:`kth_smallest`; rows equal to it in ``order`` are train), or, if ``order`` has
    other than whole-number and time columns, rows are numbered in range-cut buckets."""
    order = [order] if isinstance(order, str) else list(order)
    if not keys and bucket is None:
        whole = [_as_long(df, c) for c in order]
        if all(c is not None for c in whole):
            return df.withColumn(col, _first_rows(df, whole, math.floor(train_frac * df.count())))
        return chronological_split(range_buckets(df, [], order), keys, order, train_frac, col, F.col(RANGE)).drop(RANGE)
    if bucket is not None:
        num = series_row_number(df, keys, order, bucket, "_rn", with_size="_size")
        return num.withColumn(col, F.col("_rn") <= F.floor(F.lit(train_frac) * F.col("_size"))) \
                  .drop("_rn", "_size")
    w = Window.partitionBy(*keys).orderBy(*order)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    cut = F.floor(F.lit(train_frac) * n)
    return df.withColumn(col, F.row_number().over(w) <= cut)


def hash_bucket(key_cols: Sequence[str], seed: int = 42, buckets: int = 100) -> Column:
    """A stable bucket in [0, buckets) from the md5 of the key and a seed; the
    same row always lands in the same part, whatever the partitioning."""
    s = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed)))
    return (F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def hash_split(df: DataFrame, key_cols: Sequence[str], test_pct: int = 20, seed: int = 42,
               col: str = "is_train") -> DataFrame:
    """Reproducible ~80/20 split (``randomSplit`` depends on partitioning)."""
    return df.withColumn(col, hash_bucket(key_cols, seed) >= test_pct)


def history_tail(df: DataFrame, keys: Sequence[str], order_col: str, n: int = 90) -> DataFrame:
    """Last ``min(n, rows)`` rows per series, with their position 1..n."""
    return last_rows(df, keys, order_col, n)
