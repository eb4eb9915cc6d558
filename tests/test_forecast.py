import pytest
from pyspark.sql import functions as F

from conftest import rows
from seriesflow.operators import forecast as FC


def test_fold_matches_python_loop(spark):
    hist = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([10, 12, 11, 13, 12, 14])],
                                 "k string, t int, y double").withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("t")))
    fit = FC.ar1_fit(hist, ["k"], ["d"], "y").first()
    fc = FC.recursive_forecast(hist, FC.ar1_fit(hist, ["k"], ["d"], "y"), ["k"], "d", "y", 5).orderBy("step")
    y, want = 14.0, []
    for _ in range(5):
        y = fit["a"] + fit["b"] * y
        want.append(y)
    got = rows(fc, "step", "y")
    assert [s for s, _ in got] == [1, 2, 3, 4, 5]
    assert [v for _, v in got] == pytest.approx(want)
    assert rows(fc.limit(1), "d")[0][0].isoformat() == "2024-01-07"


def test_horizon_must_be_positive(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, y double")
    with pytest.raises(ValueError):
        FC.recursive_forecast(df, df, ["k"], "d", "y", 0)


def test_future_rows_and_attach(spark):
    last = spark.createDataFrame([("a", "2024-01-31", 5.0)], "k string, d string, v double").withColumn("d", F.col("d").cast("date"))
    fut = FC.future_rows(last, ["k"], "d", 3).orderBy("step")
    assert [r.isoformat() for (r,) in rows(fut, "d")] == ["2024-02-01", "2024-02-02", "2024-02-03"]
    df = spark.createDataFrame([("a", i) for i in range(4)], "k string, d int")
    preds = spark.createDataFrame([("a", 2, 9.0), ("a", 3, 8.0)], "k string, d int, p double")
    out = FC.attach_predictions(df, preds, ["k"], "d", "p").orderBy("d")
    assert [v for (v,) in rows(out, "p")] == [9.0, 9.0, 9.0, 8.0]
