"""Versioned artifacts, extended label maps, order statistics and the report sink."""
import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from seriesflow.operators import encode, forecast, split
from seriesflow.plans import artifacts as A
from seriesflow.plans import models as M
from seriesflow.plans import queries_models as Q
from seriesflow.session import checkpoint_dir


def folder(spark):
    return os.path.join(checkpoint_dir(spark), "t-" + uuid.uuid4().hex[:8])


def test_forecaster_saved_and_loaded_forecasts_the_same(spark, monkeypatch):
    monkeypatch.setattr(M, "BOOST", dict(M.BOOST, rounds=4, rate=0.3, max_depth=3))
    root, fitted = folder(spark), []

    def fit():
        fitted.append(Q.fit_forecaster(spark, SF001))
        return fitted[-1]

    loaded = A.Forecaster.load_or_fit(spark, root, fit)       # nothing there: fitted and published
    again = A.Forecaster.load_or_fit(spark, root, fit)        # there now
    assert len(fitted) == 1
    days = lambda f: sorted(rows(Q.forecast(spark, SF001, "2030-01-01", 3, f)["days"]))
    want = days(fitted[0])
    assert want and days(loaded) == want == days(again)
    m, parts = A.read(spark, A.newest(spark, root), A.PARTS)
    assert m["window"] == Q.SEQ_W and m["input_shape"] == [Q.SEQ_W, len(m["price_features"])] and m["demand_features"] == fitted[0].demand.features
    assert m["n_rows"] > 0 and set(m["parts"]) == set(A.PARTS) and m["rounds"] == len(fitted[0].demand.trees)
    assert sorted(rows(parts["scalers"])) == sorted(rows(fitted[0].scalers)) and parts["label_map"].count() == 5


def test_readers_take_the_newest_complete_version(spark):
    root = folder(spark)
    assert A.newest(spark, root) is None
    part = lambda n: {"a": spark.range(n), "b": spark.range(1)}
    info = spark.createDataFrame([(1,)], "x int")
    first, second = A.publish(root, part(1), info), A.publish(root, part(2), info)
    spark.range(3).write.parquet(os.path.join(root, "v99999999999999999999-later", "a"))  # never finished: no manifest
    assert A.newest(spark, root) == second != first
    m, got = A.read(spark, second, ["a"])
    assert got["a"].count() == 2 and m["x"] == 1 and m["parts"] == ["a", "b"]
    with pytest.raises(FileNotFoundError, match="c, d"):
        A.read(spark, second, ["a", "c", "d"])


def test_extended_map_keeps_old_codes(spark):
    df = spark.createDataFrame([("b", "x"), ("d", None), ("b", "x")], "p string, q string")
    old = encode.fit_label_map(df, ["p", "q"])
    more = spark.createDataFrame([("a", "x"), ("c", "y"), ("d", "z"), (None, None), ("a", "y")], "p string, q string")
    new = sorted(rows(encode.extend_label_map(old, more, ["p", "q"]), "column", "value", "code"))
    assert new == [("p", "a", 2), ("p", "b", 0), ("p", "c", 3), ("p", "d", 1), ("p", "nan", 4), ("q", "nan", 0), ("q", "x", 1), ("q", "y", 2), ("q", "z", 3)]
    assert sorted(rows(encode.extend_label_map(old, df, ["p", "q"]))) == sorted(rows(old))
    fresh = encode.extend_label_map(old.limit(0), more, ["q"])
    assert sorted(rows(fresh, "value", "code")) == [("nan", 0), ("x", 1), ("y", 2), ("z", 3)]
    encoded = encode.encode(more, encode.extend_label_map(old, more, ["p", "q"]), ["p", "q"], "strict")
    assert sorted(r["p"] for r in encoded.collect()) == [1, 2, 2, 3, 4]


def test_kth_smallest_equals_sorting(spark):
    data = [(None if k % 7 == 0 else (k * k) % 31 - 15, (k * 37) % 101 * 10**15, k) for k in range(200)]
    df = spark.createDataFrame(data, "a long, b long, c long")
    order = [F.col(c) for c in "abc"]
    ranked = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    for k in (1, 2, 29, 30, 31, 100, 199, 200):
        assert split.kth_smallest(df, order, k) == ranked[k - 1]
    wide = spark.createDataFrame([(-2**63,), (2**63 - 1,), (0,)], "a long")
    assert [split.kth_smallest(wide, [F.col("a")], k)[0] for k in (1, 2, 3)] == [-2**63, 0, 2**63 - 1]


@pytest.mark.parametrize("columns", [["t", "c"], ["s"]])
def test_unkeyed_split_equals_row_numbers(spark, columns):
    t0 = dt.datetime(2024, 5, 1)
    df = spark.createDataFrame([(t0 + dt.timedelta(hours=(k * 7) % 50), k, f"{(k * 13) % 97:03d}") for k in range(97)], "t timestamp_ntz, c int, s string")
    got = rows(split.chronological_split(df, [], columns).orderBy(*columns), "is_train")
    assert got == [(True,)] * 77 + [(False,)] * 20
    assert split.chronological_split(df.limit(0), [], columns).count() == 0 and split.chronological_split(df.limit(1), [], columns).first()["is_train"] is False
    if columns == ["t", "c"]:
        plan = split.chronological_split(df, [], columns)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Exchange" not in plan


def test_report_sink_replaces_only_its_day(spark):
    path = folder(spark)
    row = lambda k, d, kind: (k, dt.date(2025, 7, d), float(d), kind)
    make = lambda *r: spark.createDataFrame(list(r), "k string, d date, price double, kind string")
    early = make(row("a", 1, "history"), row("a", 2, "forecast"), row("a", 3, "forecast"))
    late = make(row("a", 2, "history"), row("a", 3, "forecast"))
    assert forecast.write_report(early, path) == "2025-07-02" and forecast.write_report(late, path) == "2025-07-03"
    before = sorted(rows(forecast.read_report(spark, path)))
    forecast.write_report(early, path)
    assert sorted(rows(forecast.read_report(spark, path))) == before and len(before) == 5
    forecast.write_report(early.filter("kind <> 'history'"), path)
    assert forecast.read_report(spark, path, "2025-07-02").count() == 2 and forecast.read_report(spark, path, "2025-07-03").count() == 2
    assert forecast.write_report(early.filter("kind = 'history'"), path) is None


def test_forecasts_read_the_orders_once(spark, monkeypatch):
    monkeypatch.setattr(M, "BOOST", dict(M.BOOST, rounds=2, rate=0.3, max_depth=2))
    read, daily = [], Q.base.daily

    def seen(*a):
        read.append(a)
        return daily(*a)

    monkeypatch.setattr(Q.base, "daily", seen)
    assert Q.saved_forecast(spark, SF001).count() == 5 * Q.H and len(read) == 1
    job = Q.forecast(spark, SF001)
    assert job["days"].count() == 5 * Q.H and len(read) == 2
