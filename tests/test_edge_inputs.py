"""FIXTURES §6 'empty' / 'one_row': every operator returns its schema and no error."""
import pytest
from pyspark.sql import functions as F

from seriesflow.functions.calendar import add_calendar
from seriesflow.operators import clean, encode, forecast, metrics, scale, sensors, split, stats
from seriesflow.operators import windows as W

SCHEMA = "k string, d date, y double, c string"


@pytest.fixture(params=["empty", "one_row"])
def frame(spark, request):
    rows = [] if request.param == "empty" else [("a", None, 2.0, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("d", F.coalesce("d", F.lit("2024-01-01").cast("date")))


def test_operators_on_edge_inputs(spark, frame):
    n = frame.count()
    w = W.series_window(["k"], ["d"])
    outs = [
        frame.withColumns(W.feature_exprs(["k"], ["d"], "d", "y", "y", {"y": "y"})),
        W.feature_frame(frame, ["k"], ["d"], "d", "y", "y", {"y": "y"}),
        W.chunked_window(frame, ["k"], ["d"], F.col("d"), lambda ww: W.lag_exprs("y", 2, ww), 2, 4),
        W.lag_one(frame, "y", ["k"], ["d"], F.col("d")),
        W.last_row(frame, ["k"], "d"),
        W.last_rows(frame, ["k"], "d", 3, "recency"),
        clean.forward_fill(frame, ["y"], ["k"], ["d"], bucket=F.col("d")),
        clean.backward_fill(frame, ["y"], ["k"], ["d"]),
        clean.fill_with_stats(frame, frame, ["y"], ["k"], "median"),
        clean.drop_incomplete(frame),
        encode.encode(frame, encode.fit_label_map(frame, ["c"]), ["c"], "safe"),
        scale.apply_scaler(frame, scale.fit_scaler(frame, ["y"], "minmax"), ["y"]),
        scale.standard_scale(frame, ["y"], keys=["k"]),
        split.chronological_split(frame, ["k"], ["d"]),
        split.chronological_split(frame, ["k"], ["d"], bucket=F.col("d")),
        split.hash_split(frame, ["k"]),
        stats.validate_target(frame, "y", ["k"]),
        metrics.regression_metrics(frame, "y", "y"),
        metrics.confusion_matrix(frame, "c", "c"),
        metrics.classification_report(frame, "c", "c"),
        add_calendar(frame, "d"),
        forecast.recursive_forecast(frame, forecast.ar1_fit(frame, ["k"], ["d"], "y"), ["k"], "d", "y", 3),
        sensors.parse_lines(frame.withColumnRenamed("c", "line")),
    ]
    for o in outs:
        assert len(o.columns) > 0
        o.collect()
    assert outs[0].count() == n and outs[6].count() == n
