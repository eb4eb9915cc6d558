import datetime as dt
import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from seriesflow.plans import models as M
from seriesflow.plans import queries_models as Q
from seriesflow.plans.queries_models import RECO_CAT, RECO_FEATURES, RECO_KEYS, reco_table
from seriesflow.session import checkpoint_dir


def test_save_load_same_predictions_and_missing_part(spark, tmp_path):
    t = reco_table(spark, SF001)
    rec = M.fit_recommender(t.filter("is_train"), RECO_FEATURES, RECO_CAT, "priority",
                            numTrees=5, maxDepth=3, seed=7)
    path = os.path.join(checkpoint_dir(spark), "t-" + uuid.uuid4().hex[:8])
    rec.save(path)
    test = t.filter("NOT is_train")
    a = rows(M.score(rec, test, keep=RECO_KEYS).orderBy(*RECO_KEYS))
    b = rows(M.score(M.Recommender.load(spark, path), test, keep=RECO_KEYS).orderBy(*RECO_KEYS))
    assert a == b and len(a) > 0
    labels = {r[0] for r in t.select("priority").distinct().collect()}
    assert {x[-1] for x in a} <= labels
    with pytest.raises(FileNotFoundError, match="scaler"):
        M.Recommender.load(spark, os.path.join(checkpoint_dir(spark), "nope"))


def test_unseen_category_scores_without_error(spark):
    t = reco_table(spark, SF001)
    rec = M.fit_recommender(t, RECO_FEATURES, RECO_CAT, "priority", numTrees=3, maxDepth=2)
    one = spark.createDataFrame([(1, 1, 10.0, 100.0, 0.05, 0.02, "ZZ", "O")],
                                "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                "l_discount double, l_tax double, l_returnflag string, l_linestatus string")
    out = M.score(rec, one.drop("l_tax"), keep=RECO_KEYS).collect()   # l_tax missing -> 0
    assert len(out) == 1 and out[0]["recommendation"] is not None


def test_price_forecast_equals_a_plain_loop(spark):
    """Each step of the loop appends a row and recomputes every feature of the whole frame."""
    model, _ = Q.price_predictions(spark, SF001)
    weights, bias = model.coefficients.toArray(), model.intercept
    frame = Q.seq_rows(spark, SF001)
    feats = Q.seq_features(frame)
    assert len(feats) == 1 + 12 + 2 + 14 + 6 and len(weights) == Q.SEQ_W * len(feats)
    got = {}
    for r in Q.model_price_forecast(spark, SF001, n_steps=4, start_date="2030-03-08", model=model).collect():
        got.setdefault(r["k"], {})[r["step"]] = (r["d"], r["price"])
    history = frame.toPandas().sort_values(["k", "d"])
    long_enough = {k for k, h in history.groupby("k") if len(h) >= Q.SEQ_W}
    assert set(got) == long_enough and got

    def stamp(row, day):
        m, q, w, y = day.month, (day.month + 2) // 3, day.weekday(), day.timetuple().tm_yday
        row.update(month=m, quarter=q, day_of_week=w, day_of_year=y, year_progress=y / 365, is_weekend=float(w >= 5))
        for name, x, n in (("month", m, 12), ("quarter", q, 4), ("dow", w, 7), ("doy", y, 365)):
            row[f"{name}_sin"], row[f"{name}_cos"] = np.sin(2 * np.pi * x / n), np.cos(2 * np.pi * x / n)

    for k, steps in got.items():
        data = history[history.k == k].reset_index(drop=True).astype({c: float for c in [*feats, "price", "demand"]})
        window = data[feats].to_numpy()[-Q.SEQ_W:]
        for step in range(1, 5):
            y = float(window.ravel() @ weights + bias)
            day = dt.date(2030, 3, 7) + dt.timedelta(step)
            assert steps[step][0] == day and steps[step][1] == pytest.approx(y, rel=1e-6), (k, step)
            new = data.iloc[-1].to_dict()
            stamp(new, day)
            window = np.vstack([window[1:], [y - data.price.iloc[-1] if c == "price_diff_1" else new[c] for c in feats]])
            new["price"] = y
            data.loc[len(data)] = new
            for n in (3, 7, 14, 21):
                data[f"price_roll{n}"], data[f"demand_roll{n}"] = (data[c].rolling(n, min_periods=1).mean() for c in ("price", "demand"))
            data["price_roll7_std"], data["demand_roll7_std"] = (data[c].rolling(7, min_periods=1).std() for c in ("price", "demand"))
            for n in (1, 3, 7):
                data[f"price_diff_{n}"] = data.price.diff(n)
            for n in (3, 7):
                data[f"price_momentum_{n}"] = data.price.pct_change(n)
            data["price_volatility_7"] = data.price.rolling(7).std()


def test_forecast_job_follows_start_and_horizon(spark, monkeypatch):
    monkeypatch.setattr(M, "BOOST", dict(M.BOOST, rounds=3, rate=0.3, max_depth=2))
    job = Q.forecast(spark, SF001, "2031-01-30", 3)
    days = rows(job["days"].orderBy("k", "step"), "k", "step", "d", "price", "demand", "price_trend")
    assert {(s, d.isoformat()) for _, s, d, *_ in days} == {(1, "2031-01-30"), (2, "2031-01-31"), (3, "2031-02-01")}
    assert all(p is not None and q is not None for *_, p, q, _ in days)
    for (k, s, _, p, _, t), (_, _, _, before, _, _) in zip(days[1:], days):
        assert t == ("flat" if s == 1 or p == before else "up" if p > before else "down")
    summary = job["summary"].collect()
    assert len(summary) * 3 == len(days)
    for r in summary:
        mine = [p for k, _, _, p, *_ in days if k == r["k"]]
        assert r["n_steps"] == 3 and r["price_mean"] == pytest.approx(np.mean(mine)) and r["price_range"] == pytest.approx(max(mine) - min(mine))
    assert job["report"].filter("kind = 'forecast'").count() == len(days)
    assert job["report"].filter("kind = 'history'").groupBy("k").count().agg(F.max("count")).first()[0] <= 90


def test_registered_models_are_the_full_ones(spark, monkeypatch):
    """The queries ask for every round, tree and setting of the library's constants."""
    class Seen(Exception):
        pass

    def seen(*args, **kw):
        raise Seen(kw)

    def asked(query):
        with pytest.raises(Seen) as e:
            query(spark, SF001)
        return e.value.args[0]

    monkeypatch.setattr(M.trees, "fit_boosting", seen)
    for query in (Q.boosted_demand, Q.feature_importance_top, Q.two_stage_demand, Q.demand_forecast, Q.forecast_report):
        assert asked(query) == M.BOOST
    monkeypatch.setattr(M, "fit_custom_forest", seen)
    assert asked(Q.forest_custom) == M.FOREST_CUSTOM
    monkeypatch.setattr(M, "grid_search", seen)
    assert asked(Q.forest_grid_search)["grid"] == M.GRID and len(M.GRID) == 4


def test_grid_search_weighs_classes(spark):
    """Of 90 and 10 rows that features cannot tell apart, balanced forests do not always say the larger class."""
    df = spark.createDataFrame([(float(i % 2), "ab"[i % 10 == 0], i) for i in range(200)], "x double, y string, i int")
    out = M.grid_search(df, ["x"], [], "y", ["i"], grid=dict(n_trees=[3], max_depth=[2, None], min_split=[2], min_leaf=[1]))
    got = rows(out, "n_trees", "max_depth", "accuracy")
    assert {g[:2] for g in got} == {(3, 2), (3, None)} and all(0.2 < g[2] < 0.88 for g in got)


def test_custom_forest_saves_and_loads(spark):
    t = reco_table(spark, SF001)
    rec = M.fit_custom_forest(t.filter("is_train"), RECO_FEATURES, RECO_CAT, "priority", RECO_KEYS, 4, 3, 4, 2)
    path = os.path.join(checkpoint_dir(spark), "t-" + uuid.uuid4().hex[:8])
    rec.save(path)
    test = t.filter("NOT is_train")
    a, b = (rows(M.score(m, test, keep=RECO_KEYS).orderBy(*RECO_KEYS)) for m in (rec, M.Recommender.load(spark, path)))
    assert a == b and len(a) == test.count() and {x[-1] for x in a} <= {r[0] for r in t.select("priority").distinct().collect()}


def small_forest(monkeypatch):
    monkeypatch.setattr(M, "FOREST_OWN", dict(M.FOREST_OWN, n_trees=3, max_depth=3))


def test_roundtrip_scores_one_reading_of_the_test_rows(spark, monkeypatch):
    small_forest(monkeypatch)
    out = Q.artifact_roundtrip(spark, SF001)
    assert out._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2  # lineitem and orders
    got = out.first()
    assert got["n_scored"] == reco_table(spark, SF001).filter("NOT is_train").count() and got["n_different"] == 0


def test_sensor_model_is_the_librarys_forest(spark, monkeypatch):
    """Its trees are grown from packed samples and don't depend on how rows are dealt to tasks."""
    small_forest(monkeypatch)
    monkeypatch.setattr(M, "RandomForestClassifier", None)
    rec = Q.sensor_recommender(spark, SF001)
    assert isinstance(rec.model, M.trees.Forest) and rec.model.trees.count() == 3
    again = Q.sensor_recommender(spark, SF001)
    key = lambda m: sorted((r["tree"], r["feature"], r["cut"]) for r in m.model.trees.collect())
    assert key(rec) == key(again)


def test_training_frame_is_made_once(spark, monkeypatch):
    seen = []
    fit = M.encode.fit_label_map
    monkeypatch.setattr(M.encode, "fit_label_map", lambda df, cols: seen.append(df.storageLevel.useMemory) or fit(df, cols))
    df = spark.createDataFrame([(float(i % 2), "ab"[i % 3 == 0], i) for i in range(50)], "x double, y string, i int")
    M.fit_custom_forest(df, ["x"], [], "y", ["i"], 2, 3, 2, 1)
    assert seen == [True] and not spark._jsparkSession.sharedState().cacheManager().lookupCachedData(df.select("i", "x", "y")._jdf).isDefined()
