"""Named queries: Spark builder + optional DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a lazy ``DataFrame`` over the
driver tables; its oracle is an independent SQL statement over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seriesflow.functions.numeric import double_columns, r4, round_doubles

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, round_output: bool = True, places: int = 6):
    """Register ``fn`` as query ``name``; doubles are rounded to 6 places at the
    output boundary so both engines compare equal (see SURVEY §4 rounding rule).
    ``places=4`` first applies the tie-safe 4-place form (model-derived values)."""
    def deco(fn: QueryFn) -> QueryFn:
        if round_output:
            def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
                out = fn(spark, sf_dir)
                if places == 4:
                    cols = double_columns(out)
                    out = out.withColumns({c: r4(c) for c in cols}) if cols else out
                return round_doubles(out)
            wrapped.__name__ = fn.__name__
            wrapped.__doc__ = fn.__doc__
            QUERIES[name] = wrapped
        else:
            QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so the registry is filled."""
    from seriesflow.plans import (  # noqa: F401
        queries_features, queries_forecast, queries_models, queries_prep, queries_sensors)
