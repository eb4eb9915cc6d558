import pytest
from pyspark.sql import functions as F

from conftest import rows
from seriesflow.operators import encode, scale


def test_label_codes_sorted_and_missing_as_nan(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "x string")
    m = encode.fit_label_map(df, ["x"])
    assert sorted(rows(m, "value", "code")) == [("a", 0), ("b", 1), ("c", 2), ("nan", 3)]


def test_safe_and_strict_unseen(spark):
    m = spark.createDataFrame([("x", "a", 0), ("x", "b", 1)], "column string, value string, code int")
    df = spark.createDataFrame([("zz",), ("b",)], "x string")
    assert sorted(rows(encode.encode(df, m, ["x"], "safe"), "x")) == [(0,), (1,)]
    with pytest.raises(Exception, match="unseen label"):
        encode.encode(df, m, ["x"], "strict").collect()
    rep = encode.unseen_counts(df, m, ["x"])
    assert rows(rep, "value", "n_rows") == [("zz", 1)]


def test_inverse_roundtrip(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate("abcab")], "i int, x string")
    m = encode.fit_label_map(df, ["x"])
    back = encode.decode(encode.encode(df, m, ["x"], suffix="_c"), m, "x_c", "x_back", map_column="x")
    assert all(a == b for a, b in rows(back, "x", "x_back"))


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,)] * 3, "y double")
    assert rows(scale.minmax_scale(df, ["y"]), "y") == [(0.0,)] * 3
    assert rows(scale.standard_scale(df, ["y"]), "y") == [(0.0,)] * 3


def test_standard_scaled_mean0_std1(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("y"), (F.col("id") % 3).alias("g"))
    out = scale.standard_scale(df, ["y"]).agg(F.avg("y").alias("m"), F.stddev_pop("y").alias("s")).first()
    assert out["m"] == pytest.approx(0.0, abs=1e-12) and out["s"] == pytest.approx(1.0)
    per = scale.standard_scale(df, ["y"], keys=["g"]).groupBy("g").agg(F.avg("y").alias("m"))
    assert all(abs(r["m"]) < 1e-12 for r in per.collect())


def test_null_stays_null(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "y double")
    assert rows(scale.minmax_scale(df, ["y"]), "y") == [(0.0,), (None,), (1.0,)]


def test_prefix_bucketed_codes_equal(spark):
    from seriesflow.sources.tables import read_table
    c = read_table(spark, "/root/testdata/sf0.001", "customer")
    a = encode.fit_label_map(c, ["c_name", "c_mktsegment"])
    for n in (1, 12, 17):
        b = encode.fit_label_map(c, ["c_name", "c_mktsegment"], prefix_len=n)
        assert sorted(rows(a, "column", "value", "code")) == sorted(rows(b, "column", "value", "code"))


def test_small_map_is_broadcast_and_large_map_joined(spark, monkeypatch):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(["b", "a", None, "c", "a"])], "i int, x string")
    m = encode.fit_label_map(df, ["x"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = encode.encode(df, m, ["x"])
        assert "Exchange hashpartitioning" not in small._jdf.queryExecution().executedPlan().toString()
        expected = sorted(rows(small, "i", "x"))
        for name, value in (("MOST_MAP_ROWS", 2), ("MOST_VALUE_BYTES", 0)):
            with monkeypatch.context() as patch:
                patch.setattr(encode, name, value)
                large = encode.encode(df, m, ["x"])
                assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
                assert sorted(rows(large, "i", "x")) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert expected == [(0, 1), (1, 0), (2, 3), (3, 2), (4, 0)]
