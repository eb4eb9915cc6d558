"""Structured Streaming path of the sensor feed.

The feed is a file stream of lines ``(device_id, event_ts, seq, line)`` for any
number of devices; a batch is whatever files have arrived, in any order:

* :func:`parse_stream` - stateless parse (the batch operator, unchanged);
* :func:`latest_by_window` - O2: per device and event-time window, the latest
  value of each kind (``max_by`` aggregation, the watermark bounds the state);
* :class:`FirstComplete` - O3: emit once per device when all four kinds have
  been seen. Its state is a small table (the latest value of each kind of every
  device that isn't complete, and who is), written per batch and joined with
  the next one by native aggregates; no device's rows meet in one worker;
* O4: a model scores the rows that O3 emits, batch by batch.

Sinks are written per batch id by overwriting that batch's folder, so a batch
that is run again after a failure replaces itself. Every run writes under the
session's shared checkpoint folder.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesflow.functions.text import KINDS
from seriesflow.operators.sensors import complete_readings, parse_lines
from seriesflow.session import checkpoint_dir

LINE_SCHEMA = "device_id bigint, event_ts timestamp_ntz, seq bigint, line string"
STATE_SCHEMA = "device_id bigint, event_ts timestamp_ntz, seq bigint, kind string, value double, emitted boolean"
KEYS, ORDER = ["device_id"], ["event_ts", "seq"]


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one stream run inside the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def feed_slices(lines: DataFrame, n_slices: int = 4) -> Iterator[DataFrame]:
    """Replay helper: the lines cut into ``n_slices`` pieces by event time."""
    b = lines.agg(F.min("event_ts").alias("lo"), F.max("event_ts").alias("hi")).first()
    if b["lo"] is None:
        yield lines
        return
    lo, step = b["lo"], (b["hi"] - b["lo"]) / n_slices
    dtype = lines.schema["event_ts"].dataType

    def bound(i):  # a literal of the column's own type, independent of any time zone
        return F.lit((lo + step * i).isoformat(sep=" ")).cast(dtype)
    for i in range(n_slices):
        piece = lines if i == 0 else lines.filter(F.col("event_ts") >= bound(i))
        yield piece if i == n_slices - 1 else piece.filter(F.col("event_ts") < bound(i + 1))


def read_line_stream(spark: SparkSession, path: str) -> DataFrame:
    """A10: stream of line files (typed, no inference); all files that have arrived are one batch."""
    return spark.readStream.schema(LINE_SCHEMA).parquet(path)


def parse_stream(df: DataFrame) -> DataFrame:
    """O1: the batch parser is stateless, so it runs unchanged on a stream."""
    return parse_lines(df)


def latest_by_window(parsed: DataFrame, window: str = "60 seconds",
                     watermark: str = "10 seconds") -> DataFrame:
    """O2: latest valid value of each kind per device and tumbling event-time window."""
    ok = parsed.filter(F.col("status") == "ok").withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    pos = F.struct("event_ts", "seq")
    agg = (ok.withWatermark("event_ts", watermark)
           .groupBy("device_id", F.window("event_ts", window).alias("w"))
           .agg(*[F.max_by(F.col("value"), F.when(F.col("kind") == k, pos)).alias(k) for k in KINDS]))
    complete = F.lit(True)
    for k in KINDS:
        complete = complete & F.col(k).isNotNull()
    return agg.select("device_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), *KINDS, complete.alias("complete"))


class FirstComplete:
    """O3 for ``foreachBatch``: per device, one row when all four kinds have been seen.

    ``then`` (O4) maps the emitted rows, for instance through a model. With
    ``ttl`` (a time delta) a device whose last reading is older than the newest
    one of all by more than that leaves the state, which then holds no more than the devices of
    such a span; should it come back, it starts anew and may emit again.
    Without it a device is remembered for good. Each batch reads the state of the
    batch before and writes its own, so a batch that is run again, or a query
    that goes on from its checkpoint, finds what it needs.
    """

    def __init__(self, base: str, then: Callable[[DataFrame], DataFrame] | None = None, ttl: timedelta | None = None):
        self.base, self.then, self.ttl = base, then, ttl
        self.sink = os.path.join(base, "sink")

    def state_path(self, batch_id: int) -> str:
        return os.path.join(self.base, "state", f"batch={batch_id}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = (spark.read.schema(STATE_SCHEMA).parquet(self.state_path(batch_id - 1)) if batch_id
                else spark.createDataFrame([], STATE_SCHEMA))
        emitted = held.where("emitted")
        ok = batch.where("status = 'ok'").select(*KEYS, *ORDER, "kind", "value").persist()
        seen = (ok.join(emitted.select(*KEYS), KEYS, "left_anti")
                .unionByName(held.where("not emitted").drop("emitted"))).withColumn("status", F.lit("ok")).persist()
        done = complete_readings(seen, KEYS, ORDER).persist()
        # A model's trees are loaded once a worker, so its rows go to no more tasks than run at a time.
        out = self.then(done.coalesce(max(1, spark.sparkContext.defaultParallelism))) if self.then else done
        out.write.mode("overwrite").parquet(os.path.join(self.sink, f"batch={batch_id}"))
        pos = F.struct(*ORDER)
        open_kinds = (seen.join(done.select(*KEYS), KEYS, "left_anti").groupBy(*KEYS, "kind")
                      .agg(F.max(pos).alias("p"), F.max_by("value", pos).alias("value"))
                      .select(*KEYS, "p.*", "kind", "value", F.lit(False).alias("emitted")))
        # An emitted device's row holds when it was last heard of.
        heard = (done.select(*KEYS, F.col("done_event_ts").alias("event_ts")).unionByName(emitted.select(*KEYS, "event_ts"))
                 .join(ok.groupBy(*KEYS).agg(F.max("event_ts").alias("now")), KEYS, "left"))
        closed = heard.select(*KEYS, F.greatest("event_ts", "now").alias("event_ts"), F.lit(None).cast("long").alias("seq"),
                              F.lit(None).cast("string").alias("kind"), F.lit(None).cast("double").alias("value"),
                              F.lit(True).alias("emitted"))
        state = open_kinds.unionByName(closed).select(*[c.split()[0] for c in STATE_SCHEMA.split(", ")])
        if self.ttl is not None:
            state = state.persist()
            newest = state.agg(F.max("event_ts")).first()[0]
            if newest is not None:
                floor = F.lit((newest - self.ttl).isoformat(sep=" ")).cast("timestamp_ntz")
                state = state.join(state.where(F.col("event_ts") >= floor).select(*KEYS).distinct(), KEYS, "left_semi")
        (state.coalesce(max(1, spark.sparkContext.defaultParallelism))
         .write.mode("overwrite").parquet(self.state_path(batch_id)))
        for df in (state, done, seen, ok):
            df.unpersist()


def _run(stream: DataFrame, base: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """One ``availableNow`` run from the run's checkpoint over what has arrived since the last one."""
    q = (stream.writeStream.outputMode(mode).foreachBatch(each)
         .option("checkpointLocation", os.path.join(base, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()


def _replay(spark: SparkSession, lines: DataFrame, base: str, run: Callable[[DataFrame], None]) -> None:
    """Let the lines arrive slice by slice (some files of about equal size each) and run the stream after each arrival."""
    for piece in feed_slices(lines):
        files = max(1, spark.sparkContext.defaultParallelism)
        piece.select("device_id", "event_ts", "seq", "line").repartition(files, "seq").write.mode("append").parquet(os.path.join(base, "src"))
        run(read_line_stream(spark, os.path.join(base, "src")))


def run_lines_stream(spark: SparkSession, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A10 + O1 + O5: feed -> parse -> sinks: (all lines, with arrival time and raw bytes; those that gave no reading)."""
    base = run_dir(spark, "lines")

    def each(batch: DataFrame, batch_id: int) -> None:
        tail = batch.withColumns({"arrived_at": F.current_timestamp(), "raw": F.encode("line", "UTF-8")}).persist()
        tail.write.mode("overwrite").parquet(os.path.join(base, "sink", f"batch={batch_id}"))
        tail.where("status <> 'ok'").write.mode("overwrite").parquet(os.path.join(base, "rejects", f"batch={batch_id}"))
        tail.unpersist()

    _replay(spark, lines, base, lambda s: _run(parse_stream(s), base, each))
    read = lambda name: spark.read.parquet(os.path.join(base, name)).drop("batch")
    return read("sink"), read("rejects")


def run_window_stream(spark: SparkSession, lines: DataFrame, window: str = "1 day",
                      watermark: str = "1 hour") -> DataFrame:
    """O2 run: every batch writes the windows it changed, open ones too; a window's last version counts."""
    base = run_dir(spark, "latest")

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(base, "sink", f"batch={batch_id}"))

    _replay(spark, lines, base, lambda s: _run(latest_by_window(parse_stream(s), window, watermark), base, each, "update"))
    sink = spark.read.parquet(os.path.join(base, "sink"))
    rest = [c for c in sink.columns if c not in ("device_id", "window_start", "batch")]
    return (sink.groupBy("device_id", "window_start").agg(F.max_by(F.struct(*rest), "batch").alias("v"))
            .select("device_id", "window_start", "v.*"))


def run_first_complete_stream(spark: SparkSession, lines: DataFrame,
                              then: Callable[[DataFrame], DataFrame] | None = None, ttl: timedelta | None = None) -> DataFrame:
    """O3 run (with ``then``: O4): one row per device that completed a reading."""
    base = run_dir(spark, "complete")
    each = FirstComplete(base, then, ttl)
    _replay(spark, lines, base, lambda s: _run(parse_stream(s), base, each))
    return spark.read.parquet(each.sink).drop("batch")
