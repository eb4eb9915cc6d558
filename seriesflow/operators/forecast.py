"""Forecast operators.

The reference forecasts one series with a Python loop that appends a row and
recomputes every feature per step.  Here every series is forecast at once:

* closed-form models (AR(1) per series, :func:`ar1_fit`) fold the horizon
  inside one expression per series (``aggregate`` over ``sequence(1, n)``) -
  no loop, no job per step;
* fitted models of a window of feature rows fold it, too
  (:func:`recursive_window_forecast`): each series carries a sliding buffer of
  its last prices and targets, from which every step's features are computed.

Future rows are generated with ``explode(sequence(...))`` on the last row of
each series - never a cross join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesflow.functions.calendar import calendar_exprs
from seriesflow.operators.windows import CHANGE_OFFSETS, DIFF_OFFSETS, ROLL_WINDOWS, STD_WINDOW, last_row, last_rows, series_window


def ar1_fit(df: DataFrame, keys: Sequence[str], order, y: str) -> DataFrame:
    """Per series least squares of y on its previous value:
    ``y_t = a + b * y_(t-1)`` (``regr_intercept`` / ``regr_slope``, one aggregate)."""
    w = series_window(keys, order)
    prev = df.select(*keys, F.col(y).alias("_y"), F.lag(y, 1).over(w).alias("_x"))
    return prev.groupBy(*keys).agg(F.regr_intercept("_y", "_x").alias("a"),
                                   F.regr_slope("_y", "_x").alias("b"),
                                   F.regr_count("_y", "_x").alias("n_fit"))


def fold_horizon(a: Column, b: Column, y0: Column, n_steps: int) -> Column:
    """N1 for a linear one-lag model: ``array`` of the n recursive predictions,
    each fed back as the next input (``aggregate`` over the step sequence)."""
    init = F.array(y0.cast("double"))
    acc = F.aggregate(F.sequence(F.lit(1), F.lit(n_steps)), init,
                      lambda acc, _i: F.concat(acc, F.array(a + b * F.element_at(acc, -1))))
    return F.slice(acc, 2, n_steps)


def recursive_forecast(history: DataFrame, fit: DataFrame, keys: Sequence[str], date_col: str,
                       y: str, n_steps: int = 7, start: Column | None = None,
                       out: str | None = None) -> DataFrame:
    """Per series, start from the last observed value and feed each
    prediction back; dates run from ``start`` (default: the day after the last
    observed date) for ``n_steps`` days.  Output ``(keys, step, date, out)``."""
    if n_steps <= 0:
        raise ValueError("horizon must be a positive number of days")
    out = out or y
    last = last_row(history.select(*keys, date_col, y), keys, date_col)
    j = last.join(fit, on=list(keys), how="inner")
    first_day = start if start is not None else F.date_add(F.col(date_col), 1)
    preds = fold_horizon(F.col("a"), F.col("b"), F.col(y), n_steps)
    z = j.select(*keys, first_day.alias("_start"),
                 F.posexplode(preds).alias("_pos", out))
    return z.select(*keys, (F.col("_pos") + 1).alias("step"),
                    F.date_add("_start", F.col("_pos")).alias(date_col), out)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)


def _std(x: Column, n: int) -> Column:
    """Sample std of an array of ``n`` numbers."""
    return _let(_total(x) / n, lambda m: F.sqrt(_total(F.transform(x, lambda v: (v - m) * (v - m))) / (n - 1)))


def buffer_features(prices: Column, targets: Column, price: str = "price", target: str = "demand") -> dict[str, Column]:
    """E13 from the last ``max(ROLL_WINDOWS)`` prices and targets of a series (arrays, the present one last):
    rolling means and std of both, and the price's differences, momentum and volatility."""
    out: dict[str, Column] = {}
    ago = lambda k: F.element_at(prices, -1 - k)
    for name, x in ((target, targets), (price, prices)):
        for n in ROLL_WINDOWS:
            out[f"{name}_roll{n}"] = _total(F.slice(x, -n, n)) / n
        out[f"{name}_roll{STD_WINDOW}_std"] = _std(F.slice(x, -STD_WINDOW, STD_WINDOW), STD_WINDOW)
    out.update({f"{price}_diff_{k}": ago(0) - ago(k) for k in DIFF_OFFSETS})
    out.update({f"{price}_momentum_{k}": F.try_divide(ago(0), ago(k)) - 1 for k in CHANGE_OFFSETS})
    out[f"{price}_volatility_{STD_WINDOW}"] = out[f"{price}_roll{STD_WINDOW}_std"]
    return out


def recursive_window_forecast(frame: DataFrame, keys: Sequence[str], date_col: str, features: Sequence[str], window: int,
                              predict: Callable[[Column], Column], n_steps: int = 7, start: Column | None = None,
                              price: str = "price", target: str = "demand") -> DataFrame:
    """N1 with a model of the last ``window`` feature rows: (keys, step, date, price) for every series, in one plan.

    ``frame`` holds a series' rows with price, target and features; ``predict``
    makes the next price from the window's values, row after row in one array.
    All steps are one fold per series over the step sequence: no loop, no job and no
    checkpoint a step. Its state is the sliding buffer of the last prices and
    targets, the window, and the last row's features. Each step predicts; moves
    the window on by the last row's features with the new date's calendar and the
    new first difference; appends the price (and the last target again) to the
    buffers; and computes that new row's rolling and momentum features from
    them (:func:`buffer_features`). Other features are carried on. A series with fewer rows than window and buffer need has no forecast.
    """
    if n_steps <= 0:
        raise ValueError("horizon must be a positive number of days")
    features, size = list(features), max(*ROLL_WINDOWS, *[k + 1 for k in (*DIFF_OFFSETS, *CHANGE_OFFSETS)])
    need = max(size, window)
    rows = last_rows(frame.select(*keys, date_col, price, target, *features), keys, date_col, need)
    held = F.sort_array(F.collect_list(F.struct(date_col, F.col(price).cast("double").alias("p"), F.col(target).cast("double").alias("t"),
                                                F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]).alias("f"))))
    series = (rows.groupBy(*keys).agg(held.alias("_w"), F.max(date_col).alias("_d")).filter(F.size("_w") == need)
              .withColumn("_start", start if start is not None else F.date_add("_d", 1)))

    def state(prices, targets, rows_, last, preds):
        return F.struct(prices.alias("prices"), targets.alias("targets"), rows_.alias("rows"), last.alias("last"), preds.alias("preds"))

    part = lambda name, n: F.transform(F.slice("_w", need - n + 1, n), lambda e: e[name])
    init = state(part("p", size), part("t", size), part("f", window), F.element_at("_w", -1)["f"], F.array().cast("array<double>"))
    push = lambda x, new: F.concat(F.slice(x, 2, F.size(x) - 1), F.array(new))

    def step(acc: Column, i: Column) -> Column:
        calendar = calendar_exprs(F.date_add("_start", (i - 1).cast("int")))
        carried = {c: F.element_at(acc["last"], k + 1) for k, c in enumerate(features)}
        values = lambda known: F.array(*[F.coalesce(known.get(c, carried[c]).cast("double"), F.lit(0.0)) for c in features])

        def moved(y):
            seen = values({**calendar, f"{price}_diff_1": y - F.element_at(acc["prices"], -1)})
            buffers = F.struct(push(acc["prices"], y).alias("p"), push(acc["targets"], F.element_at(acc["targets"], -1)).alias("t"))
            return _let(buffers, lambda b: state(b["p"], b["t"], push(acc["rows"], seen), values({**calendar, **buffer_features(b["p"], b["t"], price, target)}),
                                                 F.concat(acc["preds"], F.array(y))))

        return _let(predict(F.flatten(acc["rows"])), moved)

    preds = F.aggregate(F.sequence(F.lit(1), F.lit(n_steps)), init, step, lambda acc: acc["preds"])
    z = series.select(*keys, "_start", F.posexplode(preds).alias("_pos", price))
    return z.select(*keys, (F.col("_pos") + 1).alias("step"), F.date_add("_start", F.col("_pos")).alias(date_col), price)


def linear_prediction(weights: Sequence[float], intercept: float) -> Callable[[Column], Column]:
    """The prediction of a linear model from an array of its inputs."""
    return lambda x: F.lit(float(intercept)) + _total(F.zip_with(x, F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b))


def future_rows(last: DataFrame, keys: Sequence[str], date_col: str, n_steps: int,
                start: Column | None = None) -> DataFrame:
    """Each series' last row repeated over the horizon with its new date
    (``explode`` of the step sequence - no join)."""
    first_day = start if start is not None else F.date_add(F.col(date_col), 1)
    other = [c for c in last.columns if c not in keys and c != date_col]
    z = last.select(*keys, *other, first_day.alias("_start"),
                    F.explode(F.sequence(F.lit(1), F.lit(n_steps))).alias("step"))
    return z.select(*keys, "step", F.date_add("_start", F.col("step") - 1).alias(date_col), *other)


def restamp_calendar(df: DataFrame, date_col: str) -> DataFrame:
    """overwrite every calendar column present for the (new) date."""
    ex = {k: v for k, v in calendar_exprs(date_col).items()}
    return df.withColumns(ex)


def append_forecast(history: DataFrame, forecast: DataFrame, kind_col: str = "kind") -> DataFrame:
    """History and forecast rows in one frame (one union, by name)."""
    h = history.withColumn(kind_col, F.lit("history"))
    f = forecast.withColumn(kind_col, F.lit("forecast"))
    return h.unionByName(f, allowMissingColumns=True)


def attach_predictions(df: DataFrame, preds: DataFrame, keys: Sequence[str], date_col: str,
                       pred_col: str) -> DataFrame:
    """First-stage predictions joined by (series, date); rows without one take
    the first prediction of their series (the reference fills the warm-up that way)."""
    first = preds.groupBy(*keys).agg(F.min_by(pred_col, date_col).alias("_first"))
    out = (df.join(preds.select(*keys, date_col, pred_col), on=list(keys) + [date_col], how="left")
           .join(first, on=list(keys), how="left"))
    return out.withColumn(pred_col, F.coalesce(F.col(pred_col), F.col("_first"))).drop("_first")


def join_forecasts(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pair two forecasts of the same horizon on (series, step, date)."""
    return a.join(b, on=list(keys) + ["step"] + [c for c in a.columns if c in b.columns
                                                  and c not in keys and c != "step"], how="inner")


def next_step_features(last_features: DataFrame, predicted: Column, date_col: str,
                       price_col: str, feature_cols: Sequence[str]) -> DataFrame:
    """The next input row: the last feature row with the predicted price,
    calendar parts / sin-cos / progress / weekend re-stamped for the next date,
    ``price_diff_1`` = predicted - last price; only listed features are kept."""
    nxt = last_features.withColumns({
        "_pred": predicted, date_col: F.date_add(F.col(date_col), 1)})
    ex = {k: v for k, v in calendar_exprs(date_col).items() if k in feature_cols}
    if "price_diff_1" in feature_cols:
        ex["price_diff_1"] = F.col("_pred") - F.col(price_col)
    if price_col in feature_cols:
        ex[price_col] = F.col("_pred")
    return nxt.withColumns(ex).drop("_pred")


def horizon_fill(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order) -> DataFrame:
    """N4 fill chain over (small) future frames: forward fill, backward fill,
    then the series mean (a column missing everywhere stays missing)."""
    w = Window.partitionBy(*keys).orderBy(*([order] if isinstance(order, str) else order))
    fw = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bw = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(*keys)
    out = df.withColumns({c: F.last(c, True).over(fw) for c in cols})
    out = out.withColumns({c: F.first(c, True).over(bw) for c in cols})
    return out.withColumns({c: F.coalesce(F.col(c), F.avg(c).over(whole)) for c in cols})


#: The column that a report's partitions are named by.
STARTS = "forecast_start"


def write_report(report: DataFrame, path: str, date_col: str = "d") -> str | None:
    """A12 as a sink: append a report (``append_forecast``) under its first forecast day; returns that day.

    A day's partition is replaced whole, others are left alone, so a job that
    is run again leaves one copy. A report without a forecast row writes nothing."""
    start = report.filter(F.col("kind") == "forecast").agg(F.min(date_col)).first()[0]
    if start is None:
        return None
    (report.withColumn(STARTS, F.lit(start)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(STARTS).parquet(path))
    return str(start)


def read_report(spark, path: str, start: str | None = None) -> DataFrame:
    """The report of one first forecast day, or all."""
    df = spark.read.parquet(path)
    return df if start is None else df.filter(F.col(STARTS) == F.lit(start).cast("date"))
