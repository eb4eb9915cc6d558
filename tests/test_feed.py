"""Frames, expiring state and the live text tail."""
import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from conftest import SF001, rows
from seriesflow.operators import sensors as S
from seriesflow.plans import base
from seriesflow.session import checkpoint_dir
from seriesflow.streaming import sensors as ST
from seriesflow.streaming import tail

HEADER, FOOTER = "===== SENSOR READINGS =====", "============================"
FULL = ["DHT11 Temperature: 20.00 °C", "DHT11 Humidity: 60.00 %", "DS18B20 Temperature: 18.50 °C", "Soil Moisture Value: 4095"]


def folder(spark):
    path = os.path.join(checkpoint_dir(spark), "feed-" + uuid.uuid4().hex[:8])
    return path.removeprefix("file:")


def frames(spark, lines):
    t0 = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([(d, t0 + dt.timedelta(seconds=i), i, x) for i, (d, x) in enumerate(lines)],
                               "device_id long, event_ts timestamp_ntz, seq long, line string")
    out = S.assemble_frames(df, ["device_id"], ["event_ts", "seq"]).orderBy("device_id", "frame")
    return [(r["device_id"], r["frame"], r["n_lines"], r["has_header"], r["has_footer"], r["has_error"], r["complete"], r["soil_temp"]) for r in out.collect()]


def test_frames(spark):
    whole = [HEADER, *FULL, FOOTER, ""]
    assert frames(spark, [(1, x) for x in whole * 2]) == [(1, 1, 6, True, True, False, True, 18.5), (1, 2, 7, True, True, False, True, 18.5),
                                                          (1, 3, 1, False, False, False, False, None)]
    cut = ["Error: DS18B20 not detected!", HEADER, *FULL[:2], FULL[3], FOOTER,   # a sensor failed
           HEADER, *FULL,                                                        # no footer
           HEADER, *FULL, FOOTER, "Error: x"]
    assert frames(spark, [(1, x) for x in cut]) == [(1, 1, 6, True, True, True, False, None), (1, 2, 5, True, False, False, False, 18.5),
                                                    (1, 3, 6, True, True, False, True, 18.5), (1, 4, 1, False, False, True, False, None)]
    mixed = [(d, x) for x in whole[:-1] for d in (2, 1)]
    assert [f[:2] for f in frames(spark, mixed)] == [(1, 1), (2, 1)] and frames(spark, []) == []
    assert frames(spark, [(1, "noise"), (1, FULL[2])]) == [(1, 1, 2, False, False, False, False, 18.5)]


def test_state_expires_and_a_restart_goes_on(spark):
    t0 = dt.datetime(2025, 1, 1)
    day = lambda d, n, start, kinds=FULL: [(d, t0 + dt.timedelta(days=start, seconds=i), start * 100 + i, x) for i, x in enumerate(kinds[:n])]
    arrivals = [day(1, 4, 0) + day(2, 2, 0),          # 1 completes, 2 is open
                day(3, 4, 3) + day(2, 4, 3)[2:],      # 2's last reading is three days old: it was forgotten
                day(1, 4, 4)]                         # 1 comes back
    schema = "device_id long, event_ts timestamp_ntz, seq long, line string"
    emitted, states = {}, {}
    for ttl in (None, dt.timedelta(days=2)):
        at = ST.run_dir(spark, "ttl")
        for k, arrival in enumerate(arrivals):
            spark.createDataFrame(arrival, schema).write.mode("append").parquet(os.path.join(at, "src"))
            each = ST.FirstComplete(at, ttl=ttl)      # a new process: only the folders carry on
            ST._run(ST.parse_stream(ST.read_line_stream(spark, os.path.join(at, "src"))), at, each)
            states[ttl, k] = sorted({(r["device_id"], r["emitted"]) for r in spark.read.parquet(each.state_path(k)).collect()})
        emitted[ttl] = sorted(rows(spark.read.parquet(each.sink), "device_id", "batch"))
    assert emitted[None] == [(1, 0), (2, 1), (3, 1)] and states[None, 2] == [(1, True), (2, True), (3, True)]
    two = dt.timedelta(days=2)
    assert states[two, 0] == [(1, True), (2, False)]
    assert emitted[two] == [(1, 0), (1, 2), (2, 1), (3, 1)]
    assert states[two, 1] == [(2, True), (3, True)] and (1, True) in states[two, 2]


def test_a_batch_that_runs_again_leaves_the_same(spark):
    lines = base.lines(spark, SF001)
    each = ST.FirstComplete(ST.run_dir(spark, "again"), ttl=dt.timedelta(days=1))
    batch = S.parse_lines(lines)
    for _ in range(2):
        each(batch, 0)
    want = S.complete_readings(batch, ["device_id"], ["event_ts", "seq"])
    assert sorted(rows(spark.read.parquet(each.sink).drop("batch"), "device_id", "done_seq")) == sorted(rows(want, "device_id", "done_seq"))


def test_tail_reads_each_line_once(spark):
    src, out = folder(spark), folder(spark)
    os.makedirs(src)

    def add(name, raw):
        with open(os.path.join(src, name), "ab") as f:
            f.write(raw)

    def run():
        stream = tail.read_text_stream(spark, src, part_bytes=7)  # a part may begin or end in a line
        q = stream.writeStream.format("parquet").option("path", os.path.join(out, "sink")).option("checkpointLocation", os.path.join(out, "ckpt"))
        q = q.trigger(availableNow=True).start()
        q.awaitTermination()
        return [tuple(r) for r in spark.read.parquet(os.path.join(out, "sink")).select("device", "seq", "line").orderBy("device", "seq").collect()]

    add("a.txt", "one\ntwo °C\r\n\nunfin".encode())
    add("b.txt", b"bad \xff byte\n")
    add("_hidden", b"no\n")
    first = [("a.txt", 0, "one"), ("a.txt", 4, "two °C"), ("a.txt", 13, ""), ("b.txt", 0, "bad  byte")]
    assert run() == first
    assert run() == first                                  # nothing new
    add("a.txt", b"ished\n" + b"x" * 100 + b"\nlast without end")
    add("c.txt", b"only\n")
    want = [*first[:3], ("a.txt", 14, "unfinished"), ("a.txt", 25, "x" * 100), first[3], ("c.txt", 0, "only")]
    assert run() == want
    add("a.txt", b"\n")
    assert run() == [*want[:5], ("a.txt", 126, "last without end"), *want[5:]]


def test_tail_parts_cover_a_file(tmp_path, monkeypatch):
    text = b"\n".join(b"%d" % k * (k % 9) for k in range(300)) + b"\ntail"
    (tmp_path / "f").write_bytes(text)
    for block, part in ((5, 3), (64, 11), (1 << 16, 1 << 20)):
        monkeypatch.setattr(tail, "BLOCK", block)
        reader = tail.LineTailReader(str(tmp_path), part)
        end = reader.latestOffset()
        assert end == {"f": text.rindex(b"\n") + 1}
        got = [(p, r) for x in reader.partitions({}, end) for b in reader.read(x) for p, r in zip(b.column("position").to_pylist(), b.column("raw").to_pylist())]
        assert [r for _, r in got] == text.split(b"\n")[:-1] and all(text[p:].startswith(r + b"\n") for p, r in got)


def test_framed_lines_are_parsed_like_the_feed(spark):
    out = S.assemble_frames(base.framed_lines(spark, SF001), ["device_id"], ["event_ts", "seq"])
    n = base.framed_lines(spark, SF001).count()
    assert out.agg(F.sum("n_lines")).first()[0] == n and out.filter("complete").count() > out.filter("NOT complete").count() > 0
