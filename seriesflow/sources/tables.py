"""Scans (A1-A5): parquet / CSV with declared schemas, column checks, profile."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seriesflow.functions.numeric import nans_to_nulls

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


#: Declared schemas of the tables that the queries of this library read; a file is never opened to infer one.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                 "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A1: Parquet scan of one driver table with its declared schema (others: the file's), NaN as NULL (A4); Catalyst
    prunes columns / pushes filters into it."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return nans_to_nulls(reader.parquet(table_path(sf_dir, name)))


def read_csv(spark: SparkSession, path: str, schema: StructType | str,
             header: bool = True, sep: str = ",") -> DataFrame:
    """A1: CSV scan with a declared schema (no inference pass over the data), NaN as NULL (A4)."""
    return nans_to_nulls(spark.read.schema(schema).option("header", header).option("sep", sep).csv(path))


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """A2: schema-level check (no job). Raises ``ValueError`` naming what is absent."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"dataset must contain column(s): {', '.join(missing)}")
    return df


def profile(df: DataFrame) -> DataFrame:
    """A5: one row with the row count and column count (column list lives in the schema)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)))


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by an explicit order (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
