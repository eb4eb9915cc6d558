"""Numeric column expressions (all native, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Fixed value: the largest finite double, used when replacing +/-inf.
MAX_DOUBLE = 1.7976931348623157e308


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c) -> Column:
    """round(x, 6) + 0.0: the oracle-parity form (folds -0.0 into 0.0)."""
    return F.round(col_(c), 6) + F.lit(0.0)


def r4(c) -> Column:
    """Tie-safe 4-place rounding ``floor(x * 1e4 + 0.5003) / 1e4`` for large values
    (~1e5) derived from fitted models, whose last bits differ between engines."""
    return F.floor(col_(c) * F.lit(1e4) + F.lit(0.5003)) / F.lit(1e4)


def nan_to_null(c) -> Column:
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def sanitize(c) -> Column:
    """NaN/NULL -> 0, +inf -> largest double, -inf -> -largest double."""
    c = col_(c)
    return (F.when(c.isNull() | F.isnan(c), F.lit(0.0))
            .when(c == F.lit(float("inf")), F.lit(MAX_DOUBLE))
            .when(c == F.lit(float("-inf")), F.lit(-MAX_DOUBLE))
            .otherwise(c))


def sanitize_array(c) -> Column:
    """Element-wise :func:`sanitize` over an ``array<double>`` column."""
    return F.transform(col_(c), sanitize)


def has_missing(c) -> Column:
    """True when an ``array<double>`` holds a NaN or NULL."""
    return F.exists(col_(c), lambda x: x.isNull() | F.isnan(x))


def double_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (output boundary for oracle comparison)."""
    cols = double_columns(df)
    if not cols:
        return df
    return df.withColumns({c: F.round(F.col(c), places) + F.lit(0.0) for c in cols})


def nans_to_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Ingest canonicalisation: NaN becomes NULL in every (or the given) double column."""
    cols = cols if cols is not None else double_columns(df)
    return df.withColumns({c: nan_to_null(c) for c in cols}) if cols else df
