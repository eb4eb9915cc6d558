import math

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from seriesflow.functions.text import decode_line
from seriesflow.operators import sensors as S
from seriesflow.plans import base

LINES = [
    "DHT11 Temperature: 29.30 °C",
    "DHT11 Humidity: 68.00 %",
    "DS18B20 Temperature: -127.00 °C",
    "Soil Moisture Value: 2048",
    "DHT11 Humidity: nan %",
    "DHT11 Temperature: bad",
    "===== SENSOR READINGS =====",
    "",
    "Initializing Sensors...",
    "Error: Failed to read from DHT11 sensor!",
    "Error: DS18B20 not detected!",
]


def test_parse_fixture_lines(spark):
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate(LINES)], "device_id long, seq long, line string")
    got = {r["seq"]: (r["kind"], r["value"], r["status"]) for r in S.parse_lines(df).collect()}
    assert got[0] == ("air_temp", 29.3, "ok")
    assert got[1] == ("air_humidity", 68.0, "ok")
    assert got[2] == ("soil_temp", -127.0, "ok")          # no sanity filter
    assert got[3][0] == "soil_moisture" and abs(got[3][1] - 50.012210) < 1e-6
    assert got[4][0] == "air_humidity" and math.isnan(got[4][1]) and got[4][2] == "ok"   # nan kept
    assert got[5] == ("air_temp", None, "rejected")
    for i in range(6, 11):
        assert got[i][2] == "ignored"


def test_decode_drops_bad_bytes(spark):
    df = spark.createDataFrame([(bytes([0x32, 0x39, 0x2E, 0xFF, 0x33, 0x30, 0x0D, 0x0A]),)], "raw binary")
    assert df.select(decode_line("raw")).first()[0] == "29.30"


def test_complete_readings_aggregate_equals_window(spark):
    p = S.parse_lines(base.lines(spark, SF001))
    got = S.complete_readings(p, ["device_id"], ["event_ts", "seq"])
    # brute force: carried values per line, first complete line per device
    lat = S.latest_readings(p, ["device_id"], ["event_ts", "seq"])
    from pyspark.sql import Window
    comp = lat.dropna(subset=S.KINDS)
    w = Window.partitionBy("device_id").orderBy("event_ts", "seq")
    first = comp.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
    a = sorted(rows(got, "device_id", "done_seq", *S.KINDS))
    b = sorted(rows(first, "device_id", "seq", *S.KINDS))
    assert a == b and len(a) > 0


@pytest.mark.parametrize("files", [1, 4])
def test_stream_equals_batch(spark, files):
    from seriesflow.streaming.sensors import run_first_complete_stream
    lines = base.lines(spark, SF001).repartition(files)
    stream = run_first_complete_stream(spark, lines)
    batch = S.complete_readings(S.parse_lines(lines), ["device_id"], ["event_ts", "seq"])
    assert sorted(rows(stream, "device_id", "done_seq", *S.KINDS)) == \
        sorted(rows(batch, "device_id", "done_seq", *S.KINDS))


def test_lines_stream_keeps_all_and_sets_rejects_aside(spark):
    from seriesflow.streaming.sensors import run_lines_stream
    lines = base.lines(spark, SF001).repartition(3)
    tail, rejects = run_lines_stream(spark, lines)
    want = S.parse_lines(lines)
    assert sorted(rows(tail, "device_id", "seq", "line")) == sorted(rows(want, "device_id", "seq", "line"))
    assert sorted(rows(rejects, "device_id", "seq")) == sorted(rows(want.where("status <> 'ok'"), "device_id", "seq"))
    assert tail.where("arrived_at is null or cast(raw as string) <> line").count() == 0


def test_numbers_without_java_suffixes(spark):
    texts = ["12d", "1f", "+1.5e3", ".5", "5.", "nan", "1_0", "0x10", ""]
    df = spark.createDataFrame([(i, f"Soil Moisture Value: {t}") for i, t in enumerate(texts)], "seq long, line string")
    ok = {r["seq"] for r in S.parse_lines(df).where("status = 'ok'").collect()}
    assert ok == {2, 3, 4, 5}


@pytest.mark.parametrize("files", [1, 4])
def test_window_stream_equals_batch_windows(spark, files):
    from seriesflow.streaming.sensors import run_window_stream
    lines = base.lines(spark, SF001).repartition(files)
    got = run_window_stream(spark, lines, window="1 day", watermark="1 hour")
    assert got.count() > 0
    ok = S.parse_lines(lines).filter("status = 'ok'").withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    pos = F.struct("event_ts", "seq")
    batch = (ok.groupBy("device_id", F.window("event_ts", "1 day").alias("w"))
             .agg(*[F.max_by(F.col("value"), F.when(F.col("kind") == k, pos)).alias(k) for k in S.KINDS])
             .select("device_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"), *S.KINDS))
    emitted = got.select("device_id", "window_start", *S.KINDS)
    assert emitted.exceptAll(batch).count() == 0 and batch.exceptAll(emitted).count() == 0


def test_feed_arrives_in_files_of_about_equal_size(spark, tmp_path):
    import glob

    from seriesflow.streaming import sensors as ST
    lines = spark.range(4000).selectExpr("id % 7 AS device_id", "TIMESTAMP_NTZ'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id) AS event_ts", "id AS seq",
                                         "'Soil Moisture Value: 5' AS line").coalesce(1)
    seen = []
    ST._replay(spark, lines, str(tmp_path), lambda s: seen.append(set(glob.glob(f"{tmp_path}/src/*.parquet"))))
    for before, now in zip([set(), *seen], seen):
        rows = [spark.read.parquet(f).count() for f in now - before]
        assert len(rows) == spark.sparkContext.defaultParallelism and sum(rows) == 1000 and max(rows) < 500


def test_training_readings_carry_along_a_device_and_without_one_within_the_hour(spark, tmp_path, monkeypatch):
    from seriesflow.plans import queries_models as Q
    parts = [spark.range(lo, lo + 4).selectExpr("id AS event_id", f"TIMESTAMP_NTZ'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id * {step}) AS ts",
                                                f"CAST({user} AS BIGINT) AS user_id", "'a' AS event_type", "30D AS value", "'' AS props")
             for lo, step, user in ((0, 7200, 1), (10, 7200, "NULL"), (20, 1, "NULL"))]
    parts[0].unionByName(parts[1]).unionByName(parts[2]).write.parquet(f"{tmp_path}/events.parquet")
    got = []
    monkeypatch.setattr(Q.M, "fit_custom_forest", lambda t, *a, **k: got.append(t))
    Q.sensor_recommender(spark, str(tmp_path))
    assert sorted(r["seq"] for r in got[0].collect()) == [3, 23]
