"""Sensor readings, batch twins of the stream operators (O1-O3).

* :func:`parse_lines` - stateless projection line -> (kind, value, status);
* :func:`latest_readings` - per line, the last value of every kind seen so far
  on that device (bucketed carry: skew-safe for a device that sends a third
  of all lines);
* :func:`complete_readings` - the first moment each device has all four kinds,
  with the latest value of each kind at that moment.  Built from aggregates
  only (first-seen position per kind, then ``max_by`` up to that position), so
  a hot device is combined map-side instead of landing in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesflow.functions.text import KINDS, line_kind, line_role, line_value, parse_status
from seriesflow.operators import clean
from seriesflow.operators.windows import RANGE, range_buckets


def parse_lines(df: DataFrame, line_col: str = "line") -> DataFrame:
    """Add ``kind``, ``value`` and ``status`` to every line."""
    k = line_kind(line_col)
    v = line_value(line_col)
    return df.withColumns({"kind": k, "value": v}).withColumn(
        "status", parse_status(F.col("kind"), F.col("value")))


def _pos(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def valid_readings(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("status") == "ok")


def latest_readings(parsed: DataFrame, keys: Sequence[str], order: Sequence[str],
                    bucket: Column | None = None) -> DataFrame:
    """O2 batch twin: four columns carrying the last valid value of each kind."""
    ok = F.col("status") == "ok"
    wide = parsed.withColumns({k: F.when(ok & (F.col("kind") == k), F.col("value")) for k in KINDS})
    return clean.forward_fill(wide, KINDS, keys, order, bucket=bucket)


def complete_readings(parsed: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """O3 batch twin: per device, the first line after which all four kinds were
    seen, and the latest value of each kind at that line."""
    ok = valid_readings(parsed).withColumn("_pos", _pos(order))
    first = ok.groupBy(*keys, "kind").agg(F.min("_pos").alias("_first"))
    done = (first.groupBy(*keys)
            .agg(F.max("_first").alias("_done"), F.count(F.lit(1)).alias("_kinds"))
            .filter(F.col("_kinds") == len(KINDS)).drop("_kinds"))
    upto = ok.join(done, on=list(keys), how="inner").filter(F.col("_pos") <= F.col("_done"))
    vals = upto.groupBy(*keys, "_done").agg(*[
        F.max_by(F.col("value"), F.when(F.col("kind") == k, F.col("_pos"))).alias(k) for k in KINDS])
    return vals.select(*keys, *[F.col(f"_done.{c}").alias(f"done_{c}") for c in order], *KINDS)


def kind_counts(parsed: DataFrame) -> DataFrame:
    """Lines per (kind, status); unmatched lines are counted, not failed."""
    return parsed.groupBy("kind", "status").agg(F.count(F.lit(1)).alias("n_lines"))


def assemble_frames(lines: DataFrame, keys: Sequence[str], order: Sequence[str], line_col: str = "line") -> DataFrame:
    """One row per frame of a device's lines: keys, frame (from 1), first and last ``order`` position, n_lines, the
    latest value of each kind, has_header, has_footer, has_error, complete.

    Gaps and islands: a frame's number is the running count of headers. Lines
    after a footer (the error lines that precede a header, say) belong to the next
    frame; a header that comes before a footer begins a new frame and leaves the last one incomplete. The count and the last header or
    footer run inside range-cut buckets and are carried over them by a table of
    one row a bucket, so a device with a third of all lines is spread. Complete: header, footer and all four kinds.
    """
    keys, order = list(keys), list(order)
    role = F.col("_role")
    mark = F.when(role.isin("header", "footer"), role)
    p = range_buckets(parse_lines(lines, line_col).withColumn("_role", line_role(line_col)), keys, order)
    pos = _pos(order)
    run = Window.partitionBy(*keys, RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = p.withColumns({"_n": F.sum((role == "header").cast("int")).over(run), "_mark": F.last(mark, ignorenulls=True).over(run)})
    edges = p.groupBy(*keys, RANGE).agg(F.count_if(role == "header").alias("_in"), F.max_by(mark, F.when(mark.isNotNull(), pos)).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(*keys, RANGE, F.coalesce(F.sum("_in").over(earlier), F.lit(0)).alias("_before"),
                           F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    x = local.join(carried, [*keys, RANGE])
    outside = ~role.isin("header", "footer") & (F.coalesce("_mark", "_carried", F.lit("footer")) == "footer")
    frame = x.withColumn("frame", F.col("_before") + F.col("_n") + outside.cast("int"))
    ok = lambda k: F.when((F.col("status") == "ok") & (F.col("kind") == k), pos)
    has = lambda r: F.coalesce(F.bool_or(role == r), F.lit(False))
    out = frame.groupBy(*keys, "frame").agg(
        F.min(pos).alias("_first"), F.max(pos).alias("_last"), F.count(F.lit(1)).alias("n_lines"), *[F.max_by("value", ok(k)).alias(k) for k in KINDS],
        has("header").alias("has_header"), has("footer").alias("has_footer"), has("error").alias("has_error"))
    complete = F.col("has_header") & F.col("has_footer")
    for k in KINDS:
        complete = complete & F.col(k).isNotNull()
    return out.select(*keys, F.col("frame").cast("long").alias("frame"), *[F.col(f"_first.{c}").alias(f"first_{c}") for c in order],
                      *[F.col(f"_last.{c}").alias(f"last_{c}") for c in order], "n_lines", *KINDS, "has_header", "has_footer", "has_error",
                      complete.alias("complete"))
