"""Projections (B1-B10): schema-level column handling, no job is run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def rename_if_present(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """B1: rename the columns that exist; absent names are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    """B2: ``drop`` is already a no-op for absent names."""
    return df.drop(*names)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns (select_dtypes include number)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Categorical (string) columns."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, StringType) and f.name not in exclude]


def non_string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Every column that is not a string (select_dtypes exclude object)."""
    return [f.name for f in df.schema.fields
            if not isinstance(f.dataType, StringType) and f.name not in exclude]


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """All columns minus an exclusion set, in frame order."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


def align_columns(df: DataFrame, feature_cols: Sequence[str], fill=0.0) -> DataFrame:
    """B5 + B6 + B10: add each missing required column as a constant, then select
    the stored training order (extra columns are dropped)."""
    missing = {c: F.lit(fill).cast("double") for c in feature_cols if c not in df.columns}
    return df.withColumns(missing).select(*feature_cols) if missing else df.select(*feature_cols)


def tabular_dataset(df: DataFrame, feature_cols: Sequence[str], target: str,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Features + label (before vector assembly)."""
    return df.select(*keep, *feature_cols, F.col(target).alias("label"))
