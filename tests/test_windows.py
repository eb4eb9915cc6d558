import pytest
from pyspark.sql import functions as F

from conftest import rows
from seriesflow.operators import windows as W


@pytest.fixture
def tiny(spark):
    return spark.createDataFrame([("a", d, float(y)) for d, y in zip(range(1, 6), [1, 2, 4, 8, 16])],
                                 "k string, d int, y double")


def test_lag_diff_mean(tiny):
    w = W.series_window(["k"], ["d"])
    out = tiny.withColumns({**W.lag_exprs("y", 2, w), **W.diff_exprs("y", [1], w, "y"),
                            **W.rolling_mean_exprs({"y": "y"}, [3], w)}).orderBy("d")
    assert rows(out, "y_lag1") == [(None,), (1.0,), (2.0,), (4.0,), (8.0,)]
    assert rows(out, "y_diff_1") == [(None,), (1.0,), (2.0,), (4.0,), (8.0,)]
    got = [r[0] for r in rows(out, "y_roll3")]
    assert got[:2] == [None, None]
    assert got[2:] == pytest.approx([7 / 3, 14 / 3, 28 / 3])


def test_partial_frames_and_std_one_row(tiny):
    w = W.series_window(["k"], ["d"])
    out = tiny.withColumns({**W.rolling_mean_exprs({"y": "y"}, [3], w, full=False),
                            **W.rolling_std_exprs({"y": "y"}, 7, w, full=False)}).orderBy("d")
    r = rows(out, "y_roll3", "y_roll7_std")
    assert r[0] == (1.0, None)            # single row: mean of itself, std NULL
    assert r[1][0] == 1.5


def test_zero_base_change_is_null(spark):
    df = spark.createDataFrame([("a", i, float(i - 1)) for i in range(1, 5)], "k string, d int, y double")
    w = W.series_window(["k"], ["d"])
    out = df.withColumns(W.pct_change_exprs("y", [3], w, "y")).orderBy("d")
    assert rows(out, "y_momentum_3")[3] == (None,)  # 3 / 0 - 1 -> NULL, no error


def test_trend(spark):
    df = spark.createDataFrame([("a", i, float(y)) for i, y in enumerate([3, 3, 4, 2])], "k string, d int, y double")
    out = df.withColumn("t", W.trend_expr("y", W.series_window(["k"], ["d"]))).orderBy("d")
    assert [r[0] for r in rows(out, "t")] == ["flat", "flat", "up", "down"]


def test_feature_frame_single_window_node_no_python(spark):
    from seriesflow.plans import base
    d = base.daily(spark, "/root/testdata/sf0.001")
    ff = W.feature_frame(d, ["k"], ["d"], "d", "demand", "price", {"demand": "demand", "price": "price"})
    plan = ff._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") + plan.count("Window(") <= 2
    assert "EvalPython" not in plan and "ArrowEvalPython" not in plan
    assert ff.count() > 0


def test_empty_and_one_row(spark):
    w = W.series_window(["k"], ["d"])
    empty = spark.createDataFrame([], "k string, d int, y double")
    one = spark.createDataFrame([("a", 1, 2.0)], "k string, d int, y double")
    for df in (empty, one):
        out = df.withColumns({**W.lag_exprs("y", 3, w), **W.rolling_mean_exprs({"y": "y"}, [3], w)})
        assert "y_lag3" in out.columns and out.count() == df.count()


def test_chunked_window_equals_plain(spark):
    from seriesflow.sources.tables import read_table
    e = read_table(spark, "/root/testdata/sf0.001", "events").select("user_id", "event_id", "ts", "value")

    def feats(w):
        return {**W.rolling_mean_exprs({"value": "value"}, [5], w), **W.lag_exprs("value", 4, w),
                **W.rolling_std_exprs({"value": "value"}, 3, w, full=False)}
    plain = e.withColumns(feats(W.series_window(["user_id"], ["ts", "event_id"])))
    for chunk in (4, 5, 9):
        ch = W.chunked_window(e, ["user_id"], ["ts", "event_id"], F.date_trunc("hour", "ts"),
                              feats, lookback=4, chunk_rows=chunk)
        assert sorted(rows(ch, *plain.columns)) == sorted(rows(plain))
    with pytest.raises(ValueError):
        W.chunked_window(e, ["user_id"], ["ts"], F.col("ts"), feats, lookback=4, chunk_rows=2)


def test_feature_frame_chunked_equals_plain(spark):
    from seriesflow.plans import base
    d = base.daily(spark, "/root/testdata/sf0.001")
    m = {"demand": "demand", "price": "price"}
    a = W.feature_frame(d, ["k"], ["d"], "d", "demand", "price", m)
    b = W.feature_frame(d, ["k"], ["d"], "d", "demand", "price", m,
                        bucket=F.date_trunc("month", "d"), chunk_rows=50)
    ra = sorted(rows(a, *a.columns))
    rb = sorted(rows(b, *a.columns))
    assert len(ra) == len(rb) > 0
    for x, y in zip(ra, rb):
        assert all((p == q) or (isinstance(p, float) and abs(p - q) <= 1e-9 * max(1.0, abs(p)))
                   for p, q in zip(x, y))


def test_lag_one_bucketed_equals_plain(spark):
    from seriesflow.sources.tables import read_table
    e = read_table(spark, "/root/testdata/sf0.001", "events").select("user_id", "event_id", "ts", "value")
    plain = e.withColumn("value_lag1", F.lag("value", 1).over(W.series_window(["user_id"], ["ts", "event_id"])))
    b = W.lag_one(e, "value", ["user_id"], ["ts", "event_id"], F.date_trunc("hour", "ts"))
    assert sorted(rows(b, "event_id", "value_lag1")) == sorted(rows(plain, "event_id", "value_lag1"))


def _one_hot_hour(spark, n=900):
    """A third of all rows: one series inside one hour; some values missing, one row without a key's neighbours."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("k"),
        F.when(F.col("id") % 3 == 0, F.pmod(F.xxhash64("id"), F.lit(3600))).otherwise(F.col("id") * 5000).alias("t"), "id",
        F.when(F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(4)) > 0, F.col("id").cast("double")).alias("v"))


@pytest.mark.parametrize("keys", [["k"], []])
def test_range_buckets_equal_the_plain_windows(spark, keys):
    from seriesflow.operators import clean
    df, order = _one_hot_hour(spark), ["t", "id"]

    def feats(w):
        return {**W.rolling_mean_exprs({"f": "v_f"}, [5], w), "lag1": F.lag("v_f", 1).over(w)}
    plain = clean.backward_fill(clean.forward_fill(df, ["v"], keys, order, suffix="_f"), ["v"], keys, order, suffix="_b")
    plain = plain.withColumns(feats(W.series_window(keys, order)))
    cut = W.range_buckets(df, keys, order, 12)
    assert cut.filter("k = 'hot'").select(W.RANGE).distinct().count() >= 3
    assert cut.groupBy(W.RANGE).count().agg(F.max("count")).first()[0] < 3 * 900 / 12
    b = F.col(W.RANGE)
    mine = clean.backward_fill(clean.forward_fill(cut, ["v"], keys, order, b, suffix="_f"), ["v"], keys, order, b, suffix="_b")
    mine = W.chunked_window(mine, keys, order, b, feats, lookback=4, chunk_rows=50).drop(W.RANGE)
    order_by = plain.columns.index("id")
    key = lambda r: r[order_by]
    assert sorted(rows(mine, *plain.columns), key=key) == sorted(rows(plain), key=key)
    lagged = W.lag_one(cut, "v", keys, order, b).drop(W.RANGE)
    expected = df.withColumn("v_lag1", F.lag("v", 1).over(W.series_window(keys, order)))
    assert sorted(rows(lagged, "id", "v_lag1")) == sorted(rows(expected, "id", "v_lag1"))
