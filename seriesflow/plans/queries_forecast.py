"""Forecast queries (L10, N1-N4, J1-J6, H2, A12, E13, F7) over ``daily``.

The closed-form AR(1) per series stands in for the sequence model so that
the recursive forecast has an exact SQL oracle (a recursive CTE).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from seriesflow.functions.calendar import calendar_exprs
from seriesflow.operators import forecast as FC
from seriesflow.operators import stats
from seriesflow.operators import windows as W
from seriesflow.plans import base
from seriesflow.plans.registry import query as _query
from seriesflow.plans import sqlgen
from seriesflow.plans.sqlgen import (
    DAILY_CTE, INT_CALENDAR, calendar_sql, feature_sql, lag, roll_mean, roll_std)
from seriesflow.session import checkpoint_dir

# Values derived from fitted models are ~1e5 and their last bits differ between
# engines, so every double here is compared at 4 places (tie-safe form).
r6 = sqlgen.r64


def select_list(exprs, ints=frozenset()):
    return sqlgen.select_list(exprs, ints, rfn=sqlgen.r64)


def query(name, sql=None):
    return _query(name, sql, places=4)

KEYS, ORDER = base.DAILY_KEYS, base.DAILY_ORDER
H = 7  # forecast horizon (days) used by the registered queries


def price_fit(spark, sf):
    return FC.ar1_fit(base.daily(spark, sf), KEYS, ORDER, "price")


def price_forecast(spark, sf, n_steps: int = H):
    d = base.daily(spark, sf)
    return FC.recursive_forecast(d, FC.ar1_fit(d, KEYS, ORDER, "price"), KEYS, "d", "price", n_steps)


def demand_forecast_ar(spark, sf, n_steps: int = H):
    d = base.daily(spark, sf)
    return FC.recursive_forecast(d, FC.ar1_fit(d, KEYS, ORDER, "demand"), KEYS, "d", "demand", n_steps)


def _fit_cte(y: str, name: str) -> str:
    return f"""{name} AS (SELECT k, regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM
    (SELECT k, {y} AS y, lag({y}) OVER (PARTITION BY k ORDER BY d) AS x FROM daily) GROUP BY k)"""


def _rec_cte(y: str, fit: str, name: str, n: int = H) -> str:
    return f"""{name}(k, step, y) AS (
    SELECT k, 0, arg_max({y}, d) FROM daily GROUP BY k
    UNION ALL
    SELECT r.k, r.step + 1, f.a + f.b * r.y FROM {name} r JOIN {fit} f ON r.k = f.k WHERE r.step < {n})"""


_LAST_CTE = "lastd AS (SELECT k, max(d) AS last_d FROM daily GROUP BY k)"
_FC_PRICE = f"""WITH RECURSIVE {DAILY_CTE}, {_fit_cte('price', 'fitp')}, {_rec_cte('price', 'fitp', 'recp')}, {_LAST_CTE},
fcp AS (SELECT recp.k, CAST(step AS INTEGER) AS step, CAST(last_d + CAST(step - 1 AS INTEGER) + 1 AS DATE) AS d,
          y AS price FROM recp JOIN lastd USING (k) WHERE step > 0)"""
_FC_BOTH = _FC_PRICE + f""", {_fit_cte('demand', 'fitd')}, {_rec_cte('demand', 'fitd', 'recd')},
fcd AS (SELECT recd.k, CAST(step AS INTEGER) AS step, y AS demand FROM recd WHERE step > 0),
fc AS (SELECT fcp.k, fcp.step, fcp.d, fcp.price, fcd.demand FROM fcp JOIN fcd ON fcp.k = fcd.k AND fcp.step = fcd.step)"""


@query("ar1_fit", f"""WITH {DAILY_CTE},
p AS (SELECT k, price AS y, lag(price) OVER (PARTITION BY k ORDER BY d) AS x FROM daily)
SELECT k, {r6('regr_intercept(y, x)')} AS a, {r6('regr_slope(y, x)')} AS b,
  CAST(regr_count(y, x) AS BIGINT) AS n_fit FROM p GROUP BY k""")
def ar1_fit(spark, sf):
    """Per-series AR(1) of price by least squares."""
    return price_fit(spark, sf)


@query("recursive_forecast", f"""{_FC_PRICE}
SELECT k, step, d, {r6('price')} AS price FROM fcp""")
def recursive_forecast(spark, sf):
    """7-step recursive price forecast of every series, prediction fed back."""
    return price_forecast(spark, sf)


@query("join_forecasts", f"""{_FC_BOTH}
SELECT k, step, d, {r6('price')} AS price, {r6('demand')} AS demand FROM fc""")
def join_forecasts(spark, sf):
    """Price and demand forecasts paired by (series, step, date)."""
    return FC.join_forecasts(price_forecast(spark, sf),
                             demand_forecast_ar(spark, sf).drop("d"), KEYS)


@query("forecast_summary", f"""{_FC_BOTH}
SELECT k, min(d) AS period_start, max(d) AS period_end, count(*) AS n_steps,
  {r6('avg(price)')} AS price_mean, {r6('min(price)')} AS price_min, {r6('max(price)')} AS price_max,
  {r6('stddev_pop(price)')} AS price_volatility, {r6('max(price) - min(price)')} AS price_range,
  {r6('avg(demand)')} AS demand_mean, {r6('min(demand)')} AS demand_min, {r6('max(demand)')} AS demand_max,
  {r6('stddev_pop(demand)')} AS demand_volatility, {r6('max(demand) - min(demand)')} AS demand_range
FROM fc GROUP BY k""")
def forecast_summary(spark, sf):
    """H2 + H3: period, mean, min, max, population std and range of both forecasts."""
    fc = FC.join_forecasts(price_forecast(spark, sf), demand_forecast_ar(spark, sf).drop("d"), KEYS)
    return stats.forecast_summary(fc, KEYS, "d", ["price", "demand"])


#: Moves within this share of the value are the rounding noise of a converged recursion; its sign differs between engines.
_NOISE = 1e-12
_MOVE = "({c} - lag({c}) OVER (PARTITION BY k ORDER BY step))"
_TR = f"CASE WHEN abs({_MOVE}) <= {_NOISE} * abs({{c}}) THEN 'flat' WHEN {_MOVE} > 0 THEN 'up' WHEN {_MOVE} < 0 THEN 'down' ELSE 'flat' END"


@query("forecast_trend", f"""{_FC_BOTH}
SELECT k, step, d, {_TR.format(c='price')} AS price_trend, {_TR.format(c='demand')} AS demand_trend
FROM fc""")
def forecast_trend(spark, sf):
    """E11 on the forecasts: arrow per step against the previous prediction, unrounded.

    Only for the comparison with SQL, arrows of moves within ``_NOISE`` of the value are set to flat."""
    fc = FC.join_forecasts(price_forecast(spark, sf), demand_forecast_ar(spark, sf).drop("d"), KEYS)
    w = W.series_window(KEYS, "step")

    def arrow(c):
        noise = F.abs(F.col(c) - F.lag(c).over(w)) <= F.lit(_NOISE) * F.abs(F.col(c))
        return F.when(noise, F.lit("flat")).otherwise(W.trend_expr(c, w))

    return fc.select("k", "step", "d", arrow("price").alias("price_trend"), arrow("demand").alias("demand_trend"))


@query("append_forecast", f"""{_FC_BOTH}
SELECT k, d, CAST(NULL AS INTEGER) AS step, {r6('price')} AS price, {r6('demand')} AS demand, 'history' AS kind FROM daily
UNION ALL SELECT k, d, step, {r6('price')}, {r6('demand')}, 'forecast' FROM fc""")
def append_forecast(spark, sf):
    """History and forecast rows in one frame."""
    fc = FC.join_forecasts(price_forecast(spark, sf), demand_forecast_ar(spark, sf).drop("d"), KEYS)
    h = base.daily(spark, sf).select("k", "d", "price", "demand")
    return FC.append_forecast(h, fc).select("k", "d", "step", "price", "demand", "kind")


@query("report_frame", f"""{_FC_BOTH},
tail AS (SELECT k, d, price, demand, row_number() OVER (PARTITION BY k ORDER BY d DESC) AS rn FROM daily)
SELECT k, d, {r6('price')} AS price, {r6('demand')} AS demand, 'history' AS kind FROM tail WHERE rn <= 90
UNION ALL SELECT k, d, {r6('price')}, {r6('demand')}, 'forecast' FROM fc""")
def report_frame(spark, sf):
    """The data behind the forecast charts - last 90 days + the forecast."""
    fc = FC.join_forecasts(price_forecast(spark, sf), demand_forecast_ar(spark, sf).drop("d"), KEYS)
    h = W.last_rows(base.daily(spark, sf).select("k", "d", "price", "demand"), KEYS, "d", 90)
    return FC.append_forecast(h, fc.drop("step")).select("k", "d", "price", "demand", "kind")


@query("report_sink", f"""{_FC_BOTH},
tail AS (SELECT k, d, price, demand, row_number() OVER (PARTITION BY k ORDER BY d DESC) AS rn FROM daily)
SELECT k, d, {r6('price')} AS price, {r6('demand')} AS demand, 'history' AS kind, (SELECT min(d) FROM fc) AS forecast_start FROM tail WHERE rn <= 90
UNION ALL SELECT k, d, {r6('price')}, {r6('demand')}, 'forecast', (SELECT min(d) FROM fc) FROM fc""")
def report_sink(spark, sf):
    """A12 as a sink: the report written under its first forecast day, twice, and read back."""
    path = os.path.join(checkpoint_dir(spark), "reports", uuid.uuid4().hex[:12])
    for _ in range(2):
        start = FC.write_report(report_frame(spark, sf), path)
    return FC.read_report(spark, path, start)


_PART = {f"{p}_roll{n}": roll_mean(p, n, full=False) for n in (3, 7, 14, 21) for p in ("demand", "price")}
_PART.update({f"{p}_roll7_std": roll_std(p, 7, full=False) for p in ("demand", "price")})
_PART.update({f"price_diff_{k}": f"price - {lag('price', k)}" for k in (1, 3, 7)})
_PART.update({f"price_momentum_{k}": f"price / NULLIF({lag('price', k)}, 0) - 1" for k in (3, 7)})
_PART["price_volatility_7"] = roll_std("price", 7)


@query("recompute_features", f"""{_FC_BOTH},
u AS (SELECT k, d, price, demand FROM daily UNION ALL SELECT k, d, price, demand FROM fc)
SELECT k, d, {r6('price')} AS price, {r6('demand')} AS demand, {select_list(_PART)} FROM u""")
def recompute_features(spark, sf):
    """Partial-frame rolling and momentum features refreshed over history + forecast rows."""
    fc = FC.join_forecasts(price_forecast(spark, sf), demand_forecast_ar(spark, sf).drop("d"), KEYS)
    u = base.daily(spark, sf).select("k", "d", "price", "demand").unionByName(
        fc.select("k", "d", "price", "demand"))
    return W.recompute_features(u, KEYS, ORDER, "demand", "price")


@query("future_calendar", f"""{_FC_PRICE}
SELECT k, step, d, {select_list(calendar_sql('d'), INT_CALENDAR)} FROM fcp""")
def future_calendar(spark, sf):
    """calendar columns re-stamped for each forecast date."""
    return FC.restamp_calendar(price_forecast(spark, sf).select("k", "step", "d"), "d")


_FUT_MEASURES = {"demand": "demand", "price": "price", "orders": "n"}
_FUT = feature_sql(_FUT_MEASURES, "demand", "price")


_LOOKBACK = 45


@query("future_frame", f"""{_FC_PRICE},
lr AS (SELECT k, arg_max(demand, d) AS demand, arg_max(n, d) AS n FROM daily GROUP BY k),
u AS (SELECT k, d, CAST(NULL AS INTEGER) AS step, demand, n, price FROM daily
      UNION ALL SELECT fcp.k, fcp.d, fcp.step, lr.demand, lr.n, fcp.price FROM fcp JOIN lr USING (k)),
f AS (SELECT k, d, step, demand, n, price, {select_list(_FUT, INT_CALENDAR)} FROM u)
SELECT k, d, step, {r6('demand')} AS demand, n, {r6('price')} AS price, {', '.join(_FUT)} FROM f WHERE step IS NOT NULL""")
def future_frame(spark, sf):
    """J2 + N3 (``with_history=True``): each series' last row repeated over the
    horizon with the forecast price, then every lag / rolling / calendar /
    momentum feature computed over history + future; future rows returned."""
    d = base.daily(spark, sf)
    last = W.last_row(d.select("k", "d", "demand", "n"), KEYS, "d")
    fut = FC.future_rows(last, KEYS, "d", H).join(price_forecast(spark, sf).drop("d"), ["k", "step"])
    tail = W.last_rows(d, KEYS, "d", _LOOKBACK)  # no feature of a future row reaches further back
    u = tail.withColumn("step", F.lit(None).cast("int")).unionByName(fut.select(*d.columns, "step"))
    f = u.withColumns(W.feature_exprs(KEYS, ORDER, "d", "demand", "price", _FUT_MEASURES))
    return f.filter(F.col("step").isNotNull())


_N4_COLS = ["demand_lag1", "demand_lag2", "demand_lag3", "demand_lag7", "price_roll3",
            "price_roll7", "price_diff_1"]
_N4_FEATURES = ["demand_lag1", "demand_lag2", "demand_lag3", "demand_lag7", "price_roll3",
                "price_roll7", "price_diff_1", "month", "day_of_week", "holiday_flag"]
_WF = "PARTITION BY k ORDER BY step"
_N4_RAW = {"demand_lag1": lag("demand", 1, _WF), "demand_lag2": lag("demand", 2, _WF),
           "demand_lag3": lag("demand", 3, _WF), "demand_lag7": lag("demand", 7, _WF),
           "price_roll3": roll_mean("price", 3, _WF), "price_roll7": roll_mean("price", 7, _WF),
           "price_diff_1": f"price - {lag('price', 1, _WF)}"}


def _n4_fill(c: str) -> str:
    ff = f"last_value({c} IGNORE NULLS) OVER ({_WF} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return ff


@query("prepare_features", f"""{_FC_PRICE},
lr AS (SELECT k, arg_max(demand, d) AS demand FROM daily GROUP BY k),
fut AS (SELECT fcp.k, fcp.step, fcp.d, lr.demand, fcp.price FROM fcp JOIN lr USING (k)),
raw AS (SELECT k, step, d, {', '.join(f'{v} AS {c}' for c, v in _N4_RAW.items())} FROM fut),
ff AS (SELECT k, step, d, {', '.join(f'{_n4_fill(c)} AS {c}' for c in _N4_COLS)} FROM raw),
bf AS (SELECT k, step, d, {', '.join(f'first_value({c} IGNORE NULLS) OVER ({_WF} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {c}' for c in _N4_COLS)} FROM ff),
mf AS (SELECT k, step, d, {', '.join(f'coalesce({c}, avg({c}) OVER (PARTITION BY k)) AS {c}' for c in _N4_COLS)} FROM bf)
SELECT k, step, d, {', '.join(f'{r6(c)} AS {c}' for c in _N4_COLS)},
  {calendar_sql('d')['month']} AS month, {calendar_sql('d')['day_of_week']} AS day_of_week,
  CAST(0.0 AS DOUBLE) AS holiday_flag FROM mf""")
def prepare_features(spark, sf):
    """N3 (reference behaviour, horizon-only features, see quirk Q3) + N4:
    ffill -> bfill -> series mean -> missing feature columns as 0 -> training order."""
    from seriesflow.operators.project import align_columns
    d = base.daily(spark, sf)
    last = W.last_row(d.select("k", "d", "demand"), KEYS, "d")
    fut = FC.future_rows(last, KEYS, "d", H).join(price_forecast(spark, sf).drop("d"), ["k", "step"])
    w = W.series_window(KEYS, "step")
    raw = fut.withColumns({
        **{f"demand_lag{i}": F.lag("demand", i).over(w) for i in (1, 2, 3, 7)},
        **W.rolling_mean_exprs({"price": "price"}, [3, 7], w),
        "price_diff_1": F.col("price") - F.lag("price", 1).over(w)})
    raw = raw.withColumns(calendar_exprs("d", ["month", "day_of_week"]))
    filled = FC.horizon_fill(raw, _N4_COLS, KEYS, "step")
    return align_columns(filled, ["k", "step", "d"] + _N4_FEATURES)


_NS_FEATS = ["price", "price_diff_1", "demand_roll7", "month", "month_sin", "day_of_week",
             "dow_cos", "is_weekend", "year_progress"]
_FF_ALL = feature_sql({"demand": "demand", "price": "price", "orders": "n"}, "demand", "price")
_CALS = calendar_sql("d")


@query("next_step_features", f"""WITH {DAILY_CTE}, {_fit_cte('price', 'fitp')},
f AS (SELECT k, d, demand, n, price, {', '.join(f'{v} AS {c}' for c, v in _FF_ALL.items())} FROM daily),
g AS (SELECT * FROM f WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _FF_ALL)}),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY d DESC) AS rn FROM g) WHERE rn = 1),
nx AS (SELECT l.k, CAST(l.d + 1 AS DATE) AS d, fitp.a + fitp.b * l.price AS pred, l.price AS last_price,
         l.demand_roll7 FROM l JOIN fitp USING (k))
SELECT k, d, {r6('pred')} AS price, {r6('pred - last_price')} AS price_diff_1, {r6('demand_roll7')} AS demand_roll7,
  {_CALS['month']} AS month, {r6(_CALS['month_sin'])} AS month_sin, {_CALS['day_of_week']} AS day_of_week,
  {r6(_CALS['dow_cos'])} AS dow_cos, {_CALS['is_weekend']} AS is_weekend, {r6(_CALS['year_progress'])} AS year_progress
FROM nx""")
def next_step_features(spark, sf):
    """The next model input per series from its last feature row and the
    one-step price prediction."""
    d = base.daily(spark, sf)
    ff = W.feature_frame(d, KEYS, ORDER, "d", "demand", "price", {"demand": "demand", "price": "price",
                                                                   "orders": "n"})
    last = W.last_row(ff, KEYS, "d").join(price_fit(spark, sf), "k")
    nxt = FC.next_step_features(last, F.col("a") + F.col("b") * F.col("price"), "d", "price", _NS_FEATS)
    return nxt.select("k", "d", *_NS_FEATS)


@query("attach_predictions", f"""WITH {DAILY_CTE}, {_fit_cte('price', 'fitp')},
p AS (SELECT k, d, price, lag(price) OVER (PARTITION BY k ORDER BY d) AS prev,
        row_number() OVER (PARTITION BY k ORDER BY d) AS rn FROM daily),
pr AS (SELECT p.k, p.d, fitp.a + fitp.b * p.prev AS price_pred FROM p JOIN fitp USING (k) WHERE rn > 21),
fp AS (SELECT k, arg_min(price_pred, d) AS first_pred FROM pr GROUP BY k)
SELECT daily.k, daily.d, {r6('daily.price')} AS price, {r6('coalesce(pr.price_pred, fp.first_pred)')} AS price_pred
FROM daily LEFT JOIN pr ON daily.k = pr.k AND daily.d = pr.d LEFT JOIN fp ON daily.k = fp.k""")
def attach_predictions(spark, sf):
    """First-stage predictions (in-sample AR(1) after a 21-row warm-up) joined
    back by (series, date); warm-up rows take the series' first prediction."""
    d = base.daily(spark, sf).select("k", "d", "price")
    w = W.series_window(KEYS, ORDER)
    p = (d.withColumns({"prev": F.lag("price").over(w), "rn": F.row_number().over(w)})
         .filter(F.col("rn") > 21).join(price_fit(spark, sf), "k")
         .select("k", "d", (F.col("a") + F.col("b") * F.col("prev")).alias("price_pred")))
    return FC.attach_predictions(d, p, KEYS, "d", "price_pred")
