"""Window / time-series feature queries (E1-E14, F1-F9) over ``daily``."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesflow.functions.calendar import add_calendar, format_day
from seriesflow.operators import windows as W
from seriesflow.plans import base
from seriesflow.plans.registry import query
from seriesflow.sources.tables import read_table
from seriesflow.plans.sqlgen import (
    DAILY_CTE, INT_CALENDAR, calendar_sql, feature_sql, lag, momentum_sql, r6, roll_mean,
    roll_std, select_list)

KEYS, ORDER = base.DAILY_KEYS, base.DAILY_ORDER
MEASURES = {"demand": "demand", "price": "price", "orders": "n"}


def feature_frame(spark, sf_dir):
    """E14 flagship: rolling means/std, calendar, 21 demand lags, price momentum; warm-up dropped."""
    d = base.daily(spark, sf_dir)
    return W.feature_frame(d, KEYS, ORDER, "d", "demand", "price", MEASURES)


_FF = feature_sql(MEASURES, "demand", "price")
_FF_SQL = f"""WITH {DAILY_CTE},
f AS (SELECT k, d, demand, n, price,
    {select_list(_FF, INT_CALENDAR)}
  FROM daily)
SELECT k, d, {r6('demand')} AS demand, n, {r6('price')} AS price, {', '.join(_FF)}
FROM f WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _FF)}"""

query("feature_frame", _FF_SQL)(feature_frame)


# ---------------------------------------------------------------- single-family queries
def _daily_w(spark, sf):
    return base.daily(spark, sf), W.series_window(KEYS, ORDER)


def _sel(extra: dict[str, str], ints=frozenset(), where: str = "") -> str:
    return f"""WITH {DAILY_CTE}
SELECT k, d, {r6('demand')} AS demand, {r6('price')} AS price, n,
    {select_list(extra, ints)}
FROM daily {where}"""


_LAGS = {f"demand_lag{i}": lag("demand", i) for i in range(1, 22)}


@query("lag_features", _sel(_LAGS))
def lag_features(spark, sf):
    """Demand lags 1..21 in one Window node."""
    d, w = _daily_w(spark, sf)
    return d.withColumns(W.lag_exprs("demand", 21, w))


_RM = {f"{p}_roll{n}": roll_mean(c, n) for n in (3, 7, 14, 21) for p, c in MEASURES.items()}


@query("rolling_mean", _sel(_RM))
def rolling_mean(spark, sf):
    """Full-frame rolling means (NULL until the frame holds n values)."""
    d, w = _daily_w(spark, sf)
    return d.withColumns(W.rolling_mean_exprs(MEASURES, W.ROLL_WINDOWS, w))


@query("rolling_std", _sel({"demand_roll7_std": roll_std("demand", 7), "price_roll7_std": roll_std("price", 7)}))
def rolling_std(spark, sf):
    """Full-frame rolling sample std over 7 rows."""
    d, w = _daily_w(spark, sf)
    return d.withColumns(W.rolling_std_exprs({"demand": "demand", "price": "price"}, 7, w))


_RMP = {f"{p}_roll{n}": roll_mean(c, n, full=False) for n in (3, 7, 14, 21)
        for p, c in {"demand": "demand", "price": "price"}.items()}


@query("rolling_mean_partial", _sel(_RMP))
def rolling_mean_partial(spark, sf):
    """min_periods=1 rolling means."""
    d, w = _daily_w(spark, sf)
    return d.withColumns(W.rolling_mean_exprs({"demand": "demand", "price": "price"},
                                              W.ROLL_WINDOWS, w, full=False))


@query("rolling_std_partial", _sel({"demand_roll7_std": roll_std("demand", 7, full=False),
                                    "price_roll7_std": roll_std("price", 7, full=False)}))
def rolling_std_partial(spark, sf):
    """E5: min_periods=1 rolling sample std (a single row gives NULL)."""
    d, w = _daily_w(spark, sf)
    return d.withColumns(W.rolling_std_exprs({"demand": "demand", "price": "price"}, 7, w, full=False))


_MOM = momentum_sql("price")


@query("diff_features", _sel({k: v for k, v in _MOM.items() if "_diff_" in k}))
def diff_features(spark, sf):
    """Price differences over 1, 3, 7 rows."""
    d, w = _daily_w(spark, sf)
    return d.withColumns(W.diff_exprs("price", W.DIFF_OFFSETS, w, "price"))


@query("pct_change", _sel({k: v for k, v in _MOM.items() if "_momentum_" in k}))
def pct_change(spark, sf):
    """Relative change over 3 and 7 rows (zero base -> NULL)."""
    d, w = _daily_w(spark, sf)
    return d.withColumns(W.pct_change_exprs("price", W.CHANGE_OFFSETS, w, "price"))


@query("volatility", _sel({"price_volatility_7": _MOM["price_volatility_7"]}))
def volatility(spark, sf):
    """Price volatility = rolling sample std of price over 7 rows."""
    d, w = _daily_w(spark, sf)
    m = W.momentum_exprs("price", w, "price")
    return d.withColumn("price_volatility_7", m["price_volatility_7"])


@query("calendar_features", f"""WITH {DAILY_CTE}
SELECT k, d, {select_list(calendar_sql('d'), INT_CALENDAR)} FROM daily""")
def calendar_features(spark, sf):
    """Month / quarter / weekday (Mon=0) / day-of-year with sin-cos, year progress, weekend."""
    return add_calendar(base.daily(spark, sf).select("k", "d"), "d")


@query("format_dates", """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day_text,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts_text FROM orders""")
def format_dates(spark, sf):
    """day and timestamp formatting."""
    from seriesflow.functions.calendar import format_ts
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", format_day(F.to_date("o_orderdate")).alias("day_text"),
                    format_ts("o_orderdate").alias("ts_text"))


_SEQ_W = 21
_SEQ_SQL = f"""WITH {DAILY_CTE},
s AS (SELECT k, d, price AS y,
        list(struct_pack(price := price, n := n)) OVER (PARTITION BY k ORDER BY d
             ROWS BETWEEN {_SEQ_W} PRECEDING AND 1 PRECEDING) AS x FROM daily)"""


@query("sequences", f"""{_SEQ_SQL}
SELECT k, d, {r6('y')} AS y, CAST(pos AS INTEGER) AS pos, {r6('x[pos].price')} AS x_price, x[pos].n AS x_n
FROM s, range(1, {_SEQ_W + 1}) t(pos) WHERE len(x) = {_SEQ_W}""")
def sequences(spark, sf):
    """Windows of the 21 previous rows (features price, n) -> target price,
    shown in long form (one row per window position)."""
    d = base.daily(spark, sf)
    s = W.sequences(d, KEYS, ORDER, ["price", "n"], "price", _SEQ_W)
    return (s.select("k", "d", "y", F.posexplode("x").alias("p", "e"))
            .select("k", "d", "y", (F.col("p") + 1).alias("pos"),
                    F.col("e.price").alias("x_price"), F.col("e.n").alias("x_n")))


@query("sequence_stats", f"""{_SEQ_SQL}
SELECT k, count(*) AS n_sequences, {r6('min(y)')} AS y_min, {r6('max(y)')} AS y_max,
  {r6('stddev_pop(y)')} AS y_std,
  CAST(count_if(list_bool_or([e.price IS NULL OR isnan(e.price) FOR e IN x])) AS BIGINT) AS n_with_missing
FROM s WHERE len(x) = {_SEQ_W} GROUP BY k""")
def sequence_stats(spark, sf):
    """E10 + H4: sequence count, target min / max / population std, windows with NaN."""
    d = base.daily(spark, sf)
    s = W.sequences(d, KEYS, ORDER, ["price", "n"], "price", _SEQ_W)
    bad = F.exists("x", lambda e: e["price"].isNull() | F.isnan(e["price"]))
    return s.groupBy("k").agg(F.count(F.lit(1)).alias("n_sequences"), F.min("y").alias("y_min"),
                              F.max("y").alias("y_max"), F.stddev_pop("y").alias("y_std"),
                              F.count_if(bad).alias("n_with_missing"))


@query("trend_direction", f"""WITH {DAILY_CTE}
SELECT k, d, {r6('price')} AS price,
  CASE WHEN sign(price - lag(price) OVER (PARTITION BY k ORDER BY d)) > 0 THEN 'up'
       WHEN sign(price - lag(price) OVER (PARTITION BY k ORDER BY d)) < 0 THEN 'down' ELSE 'flat' END AS trend
FROM daily""")
def trend_direction(spark, sf):
    """Up / down / flat against the previous row (first row flat)."""
    d, w = _daily_w(spark, sf)
    return d.select("k", "d", "price", W.trend_expr("price", w).alias("trend"))


@query("last_row", f"""WITH {DAILY_CTE}
SELECT k, max(d) AS d, {r6('arg_max(demand, d)')} AS demand, arg_max(n, d) AS n,
  {r6('arg_max(price, d)')} AS price FROM daily GROUP BY k""")
def last_row(spark, sf):
    """Last row per series (max_by aggregate, partial per task)."""
    return W.last_row(base.daily(spark, sf), KEYS, "d")


@query("last_window", f"""WITH {DAILY_CTE},
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY d DESC) AS rn FROM daily)
SELECT k, d, {r6('price')} AS price, CAST(rn AS INTEGER) AS recency FROM r WHERE rn <= 21""")
def last_window(spark, sf):
    """Last 21 rows per series (the window fed to the sequence model)."""
    d = base.daily(spark, sf).select("k", "d", "price")
    return W.last_rows(d, KEYS, "d", 21, rank_col="recency")


# ---------------------------------------------------------------- long / skewed series
_WE = "PARTITION BY user_id ORDER BY ts, event_id"


def _event_feats(w):
    out = W.rolling_mean_exprs({"value": "value"}, [3, 7], w)
    out.update(W.rolling_std_exprs({"value": "value"}, 7, w))
    out.update(W.lag_exprs("value", 3, w))
    out.update(W.diff_exprs("value", [1], w, "value"))
    return out


@query("event_rolling_chunked", f"""SELECT user_id, event_id, ts, value,
  {select_list({'value_roll3': roll_mean('value', 3, _WE), 'value_roll7': roll_mean('value', 7, _WE),
                'value_roll7_std': roll_std('value', 7, _WE),
                **{f'value_lag{i}': lag('value', i, _WE) for i in (1, 2, 3)},
                'value_diff_1': f"value - {lag('value', 1, _WE)}"})}
FROM events""")
def event_rolling_chunked(spark, sf):
    """Rolling / lag features over per-user event series through the chunked
    window (range-cut buckets, 4096-row chunks, halo of 6 rows = 0.15 % extra rows): a
    user holding a third of all events is computed in many tasks, with results
    equal to the plain window (halo crossings are covered by the property test
    in tests/test_windows.py with chunks of 4-9 rows)."""
    e = read_table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    e = W.range_buckets(e, ["user_id"], ["ts", "event_id"])
    return W.chunked_window(e, ["user_id"], ["ts", "event_id"], F.col(W.RANGE),
                            _event_feats, lookback=6, chunk_rows=4096).drop(W.RANGE)
