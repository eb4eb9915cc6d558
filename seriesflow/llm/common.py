"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesflow.session import checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters that separate words: tab to carriage return, and space.
SPACES = "\\x20\\x09-\\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage and gives later joins a plain scan on both sides, so that
    adaptive execution can split skewed partitions. Survives lost executors.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of rows in one Arrow batch between Spark and a Python worker.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> None:
    """Bound the session's Arrow batches by bytes, unless it has a bound of its own.

    Without one a batch is 10,000 rows, whatever their length; a batch is held
    by the JVM and by the worker, on the way there and back. Results don't depend on it.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(limit))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; ``lower`` is enough (and faster) where a text has single-byte characters only."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def crc_mod(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and each text's start (with the end as last); null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


LOWER_TABLE = np.arange(256, dtype=np.uint8)
LOWER_TABLE[65:91] += 32


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker process (functions travel by value)."""
    name = "_seriesflow_worker_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].items = {}
    return sys.modules[name].items


def row_slices(offsets: np.ndarray, limit: int):
    """(first, last) row ranges of at most ``limit`` bytes, or one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def number_rows(df: DataFrame, group: list[str], order: list, name: str, cells: int, index: str = "idx") -> DataFrame:
    """Gapless numbers from 0 within each group without sorting a group in one task.

    Rows are dealt to ``cells`` cells of each group by the hash of ``order``; a
    cell's first number is the sum of the cells before it. ``df`` must be a
    stored table (it is read twice). The cell table has at most ``cells`` rows
    a group; groups must be few (shards).
    """
    from pyspark.sql import Window
    cell = df.withColumn("__cell", F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int"))
    counts = cell.groupBy(*group, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*group).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(counts.withColumn("__from", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n"), name)
    inner = Window.partitionBy(*group, "__cell").orderBy(*order)
    return (cell.join(F.broadcast(starts), [*group, "__cell"])
            .withColumn(index, F.col("__from") + F.row_number().over(inner) - 1).drop("__cell", "__from"))


def classes(pattern_bytes: bytes) -> np.ndarray:
    """256 booleans: True at these bytes."""
    out = np.zeros(256, bool)
    out[list(pattern_bytes)] = True
    return out


BLANK = classes(b"\x20\x09\x0a\x0b\x0c\x0d")
_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (multiply and shift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    cache = worker_cache()
    if len(cache.get("powers", ((),))[0]) < n:
        with np.errstate(over="ignore"):
            cache["powers"] = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 1 << 20), b, np.uint64)]))
                                    for b in (_PRIME, _INVERSE))
    return cache["powers"]


def word_spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words (runs of bytes that aren't ``breaks``), and the first word of each text (and the end)."""
    inside = ~breaks[data]
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]  # a word doesn't go on into the next text
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] |= inside[cuts]
    last[cuts - 1] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans' bytes, whatever their place."""
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
        return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def chain_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of ``k`` consecutive word hashes, for each start that has ``k`` words after it (across texts too)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for j in range(k):
            out = mix64(out * _PRIME + hashes[j:j + n])
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices start .. start + length - 1, one run after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
