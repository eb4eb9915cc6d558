import math

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from seriesflow.functions.numeric import MAX_DOUBLE, sanitize
from seriesflow.operators import clean


@pytest.fixture
def gaps(spark):
    return spark.createDataFrame([("a", i, y) for i, y in enumerate([None, 1.0, None, 3.0, None])],
                                 "k string, d int, y double")


def test_ffill_bfill_median(gaps):
    f = clean.forward_fill(gaps, ["y"], ["k"], ["d"]).orderBy("d")
    assert [r[0] for r in rows(f, "y")] == [None, 1.0, 1.0, 3.0, 3.0]
    b = clean.backward_fill(f, ["y"], ["k"], ["d"]).orderBy("d")
    assert [r[0] for r in rows(b, "y")] == [1.0, 1.0, 1.0, 3.0, 3.0]
    m = clean.fill_with_stats(f, gaps, ["y"], [], "median").orderBy("d")
    assert [r[0] for r in rows(m, "y")] == [2.0, 1.0, 1.0, 3.0, 3.0]


def test_all_null_mean_stays_null(spark):
    df = spark.createDataFrame([("a", i, None) for i in range(3)], "k string, d int, y double")
    out = clean.fill_with_stats(df, df, ["y"], ["k"], "mean")
    assert [r[0] for r in rows(out, "y")] == [None] * 3


def test_bucketed_fill_equals_plain_window(spark):
    from seriesflow.plans import base
    g = base.gappy(spark, SF001)
    bucket = F.date_trunc("hour", F.col("ts"))
    for fn in (clean.forward_fill, clean.backward_fill):
        a = fn(g, ["v"], ["user_id"], ["ts", "event_id"], suffix="_f")
        b = fn(g, ["v"], ["user_id"], ["ts", "event_id"], bucket=bucket, suffix="_f")
        want = sorted(rows(a, "event_id", "v_f"))
        assert want == sorted(rows(b, "event_id", "v_f"))
        # and the result does not depend on the input partitioning
        c = fn(g.repartition(7), ["v"], ["user_id"], ["ts", "event_id"], bucket=bucket, suffix="_f")
        assert want == sorted(rows(c, "event_id", "v_f"))


def test_sanitize(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (float("inf"),), (float("-inf"),)], "x double")
    assert [r[0] for r in df.select(sanitize("x")).collect()] == [1.0, 0.0, 0.0, MAX_DOUBLE, -MAX_DOUBLE]


def test_drop_incomplete(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, "b"), (3, 2.0, None)], "i int, x double, s string")
    assert rows(clean.drop_incomplete(df), "i") == [(1,)]


def test_exact_median_matches_percentile(spark):
    from seriesflow.plans import base
    g = base.gappy(spark, SF001)
    for bins in (1, 3, 4096):
        a = clean.exact_median(g, "v", ["user_id"], out="m", bins=bins)
        b = g.groupBy("user_id").agg(F.median("v").alias("m"))
        ra = dict(rows(a, "user_id", "m"))
        rb = dict(rows(b, "user_id", "m"))
        assert ra.keys() == {k for k, v in rb.items() if v is not None}
        assert all(abs(ra[k] - rb[k]) < 1e-9 for k in ra)
    whole = clean.exact_median(g, "v", [], out="m").first()["m"]
    assert abs(whole - g.agg(F.median("v")).first()[0]) < 1e-9
    even = spark.createDataFrame([(1.0,), (4.0,), (2.0,), (10.0,)], "v double")
    assert clean.exact_median(even, "v", [], out="m").first()["m"] == 3.0


def test_median_keeps_groups_without_values(spark):
    from seriesflow.plans import base
    none = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0), ("b", 4.0)], "k string, v double")
    assert sorted(rows(clean.column_stats(none, ["v"], ["k"], "median"))) == [("a", None), ("b", 2.5)]
    blank = none.where("k = 'a'")
    assert rows(clean.fill_with_stats(blank, blank, ["v"], [], "median"), "v") == [(None,)] * 2
    g = base.gappy(spark, SF001)
    small = sorted(rows(clean.column_stats(g, ["v"], ["user_id"], "percentile")))
    big = sorted(rows(clean.column_stats(g, ["v"], ["user_id"], "median")))
    assert [k for k, _ in small] == [k for k, _ in big]
    assert all((a is None and b is None) or abs(a - b) < 1e-9 for (_, a), (_, b) in zip(small, big))
