import pytest

from conftest import rows
from seriesflow.operators import metrics, split


@pytest.fixture
def confusion(spark):
    return spark.createDataFrame(list(zip("aabc", "abba")), "actual string, predicted string")


def test_confusion_matrix_keeps_zero_cells(confusion):
    cm = {(a, p): n for a, p, n in rows(metrics.confusion_matrix(confusion, "actual", "predicted"))}
    assert len(cm) == 9
    assert cm[("a", "a")] == 1 and cm[("a", "b")] == 1 and cm[("b", "b")] == 1 and cm[("c", "a")] == 1
    assert sum(cm.values()) == 4


def test_accuracy_and_zero_division(confusion):
    m = metrics.classification_metrics(confusion, "actual", "predicted").first()
    assert m["accuracy"] == 0.5
    rep = {r["label"]: r for r in metrics.classification_report(confusion, "actual", "predicted").collect()}
    assert rep["c"]["precision"] == 0.0 and rep["c"]["f1"] == 0.0
    assert rep["accuracy"]["precision"] == 0.5


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 2.0), (0.0, 1.0)], "y double, p double")
    m = metrics.regression_metrics(df, "y", "p").first()
    assert m["mae"] == pytest.approx(0.75)
    assert m["rmse"] == pytest.approx((3 / 4) ** 0.5)
    assert m["r2"] == pytest.approx(1 - 3 / 5)
    assert m["mape"] == pytest.approx((0 + 0.5 + 1 / 3) / 3 * 100)   # zero actual skipped


def test_hash_split_stable_and_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "key")
    a = split.hash_split(df, ["key"])
    b = split.hash_split(df.repartition(13), ["key"])
    assert sorted(rows(a)) == sorted(rows(b))
    n_train = a.filter("is_train").count()
    assert 1400 < n_train < 1800 and a.count() == 2000


def test_chronological_split(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", i) for i in range(5)], "k string, d int")
    out = split.chronological_split(df, ["k"], ["d"])
    got = {k: sorted(d for kk, d, t in rows(out, "k", "d", "is_train") if kk == k and t) for k in "ab"}
    assert got == {"a": list(range(8)), "b": list(range(4))}


def test_bucketed_chronological_split_equals_window(spark):
    from pyspark.sql import functions as F
    from seriesflow.plans import base
    g = base.gappy(spark, "/root/testdata/sf0.001")
    a = split.chronological_split(g, ["user_id"], ["ts", "event_id"])
    b = split.chronological_split(g, ["user_id"], ["ts", "event_id"], bucket=F.date_trunc("hour", "ts"))
    assert sorted(rows(a, "event_id", "is_train")) == sorted(rows(b, "event_id", "is_train"))
