"""Label encoding with stored maps.

The map is a small table ``(column string, value string, code int)``: codes
0..m-1 follow the sorted distinct values of each column (binary string order),
and a missing value becomes the string ``"nan"`` (its own class), like the
reference's encoder.  Applying it is an equi-join on the value.  A map of at most
``MOST_MAP_ROWS`` rows with short values is read once, kept as a local table and
broadcast, so the big side is not exchanged; a larger map is joined by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the string a missing categorical becomes before encoding.
MISSING_LABEL = "nan"
#: A broadcast map has at most so many rows, with values of at most so many bytes (10 MB).
MOST_MAP_ROWS, MOST_VALUE_BYTES = 20_000, 512


def _as_label(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit(MISSING_LABEL))


def fit_label_map(df: DataFrame, cols: Sequence[str], prefix_len: int | None = None) -> DataFrame:
    """D1 fit: one scan, values of all columns unpivoted, distinct (partial
    aggregate), then codes 0..m-1 in sorted order.

    By default the codes come from ``row_number`` over each column's distinct
    set, i.e. one task per column - right for categorical columns (Spark ML's
    ``StringIndexer`` even collects them to the driver).  For high-cardinality
    columns pass ``prefix_len``: values are numbered per (column, value prefix)
    and prefix-bucket offsets are added (:func:`series_row_number`), so no task
    sorts a whole column.  Both give identical codes."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _as_label(c).alias("value"))
                                for c in cols]))
    distinct = df.select(pairs.alias("p")).select("p.column", "p.value").distinct()
    if prefix_len:
        from seriesflow.operators.windows import series_row_number
        # binary string order: a shorter prefix orders consistently with the full value
        bucket = F.substring(F.encode("value", "UTF-8"), 1, prefix_len)
        num = series_row_number(distinct, ["column"], ["value"], bucket, "_rn")
        return num.withColumn("code", (F.col("_rn") - 1).cast("int")).drop("_rn")
    w = Window.partitionBy("column").orderBy("value")
    return distinct.withColumn("code", (F.row_number().over(w) - 1).cast("int"))


def extend_label_map(label_map: DataFrame, df: DataFrame, cols: Sequence[str], prefix_len: int = 16) -> DataFrame:
    """D2 refit: the map with the values of ``df`` it doesn't hold yet.

    Old codes stay, so rows and models encoded before remain right; a column's new
    values get the next free codes in sorted order. The values are numbered per
    (column, value prefix) with offsets, so no task sorts a column; a column that the map doesn't know starts at 0."""
    from seriesflow.operators.windows import series_row_number
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _as_label(c).alias("value")) for c in cols]))
    new = df.select(pairs.alias("p")).select("p.column", "p.value").distinct().join(label_map.select("column", "value"), ["column", "value"], "left_anti")
    num = series_row_number(new, ["column"], ["value"], F.substring(F.encode("value", "UTF-8"), 1, prefix_len), "_rn")
    free = label_map.groupBy("column").agg((F.max("code") + 1).alias("_next"))
    added = num.join(free, "column", "left").select("column", "value", (F.coalesce("_next", F.lit(0)) + F.col("_rn") - 1).cast("int").alias("code"))
    return label_map.select("column", "value", "code").unionByName(added)


def small_map(label_map: DataFrame) -> tuple[DataFrame, bool]:
    """The map as a local table and True if it is within the broadcast bounds, else as it is and False.

    At most ``MOST_MAP_ROWS`` + 1 rows of bounded size reach the driver."""
    short = F.coalesce(F.octet_length("value") <= MOST_VALUE_BYTES, F.lit(True))
    held = (label_map.select("column", F.when(short, F.col("value")).alias("value"), "code", (~short).alias("long"))
            .limit(MOST_MAP_ROWS + 1).collect())
    if len(held) > MOST_MAP_ROWS or any(r["long"] for r in held):
        return label_map, False
    schema = label_map.select("column", "value", "code").schema
    return label_map.sparkSession.createDataFrame([tuple(r)[:3] for r in held], schema), True


def encode(df: DataFrame, label_map: DataFrame, cols: Sequence[str], mode: str = "strict",
           suffix: str | None = None) -> DataFrame:
    """D1/D2/D3 transform.

    * ``strict`` (D2): a value absent from the map fails the job (``raise_error``);
    * ``safe``   (D3): an unseen value gets code 0 (the first class);
    * ``null``: an unseen value gets NULL.
    """
    out = df
    label_map, small = small_map(label_map)
    for c in cols:
        m = (label_map.filter(F.col("column") == c)
             .select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_c_{c}")))
        m = F.broadcast(m) if small else m
        out = out.withColumn(f"_v_{c}", _as_label(c)).join(m, on=f"_v_{c}", how="left")
        code = F.col(f"_c_{c}")
        if mode == "strict":
            code = F.when(code.isNull(), F.raise_error(
                F.concat(F.lit(f"unseen label in column {c}: "), F.col(f"_v_{c}")))
            ).otherwise(code).cast("int")
        elif mode == "safe":
            code = F.coalesce(code, F.lit(0))
        out = out.withColumn(suffix and f"{c}{suffix}" or c, code).drop(f"_v_{c}", f"_c_{c}")
    return out


def unseen_counts(df: DataFrame, label_map: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D3 report: per column, each value not in the map and how many rows carry it
    (``left_anti`` join + aggregate, replaces the reference's per-value warning)."""
    vals = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                                  _as_label(c).alias("value"))
                                         for c in cols])).alias("p")).select("p.*")
    counts = vals.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(label_map.select("column", "value"), ["column", "value"], "left_anti")


def decode(df: DataFrame, label_map: DataFrame, col: str, out: str | None = None,
           map_column: str | None = None) -> DataFrame:
    """Code -> label via the map (NULL for an unknown code); result in ``out``
    (default ``{col}_label``); ``map_column`` names the map entry if it differs from ``col``."""
    out = out or f"{col}_label"
    label_map, small = small_map(label_map.filter(F.col("column") == (map_column or col)))
    m = (label_map.filter(F.col("column") == (map_column or col))
         .select(F.col("code").alias("_code"), F.col("value").alias(out)))
    m = F.broadcast(m) if small else m
    return df.join(m, df[col] == m["_code"], "left").drop("_code")
