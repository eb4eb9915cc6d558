"""Scan / projection / missing-value / encoding / scaling / split / metric queries
(A1-A5, B1-B14, C1-C6, D1-D8, H1, H6, I1-I6, M1-M9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesflow.functions.calendar import add_calendar, horizon_dates, parse_day, format_day
from seriesflow.functions.numeric import has_missing, sanitize_array
from seriesflow.operators import clean, encode, metrics, project, scale, split, stats
from seriesflow.operators import windows as W
from seriesflow.plans import base
from seriesflow.plans.registry import query
from seriesflow.plans.sqlgen import DAILY_CTE, GAPPY_CTE, calendar_sql, lag, r6, roll_mean
from seriesflow.sources.tables import preview, profile, read_table, require_columns

DK, DO = base.DAILY_KEYS, base.DAILY_ORDER
GK, GO = base.GAPPY_KEYS, base.GAPPY_ORDER
W_GAPPY = "PARTITION BY user_id ORDER BY ts, event_id"


def _gappy_buckets(spark, sf):
    """``gappy`` in range-cut buckets: no user and no crowded hour fills a task."""
    return W.range_buckets(base.gappy(spark, sf), GK, GO)


# ---------------------------------------------------------------- A: scans
@query("scan_daily", f"""WITH {DAILY_CTE}
SELECT k, d, {r6('demand')} AS demand, n, {r6('price')} AS price FROM daily""")
def scan_daily(spark, sf):
    """A1 + A2: declared-schema scan, required columns checked on the driver (no job)."""
    require_columns(read_table(spark, sf, "orders"), "o_orderdate", "o_totalprice", "o_orderpriority")
    return base.daily(spark, sf)


@query("parse_dates", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d_text,
  CAST(o_orderdate AS DATE) AS d_parsed,
  CAST(TRY_STRPTIME(o_orderstatus, '%Y-%m-%d') AS DATE) AS bad_parsed FROM orders""")
def parse_dates(spark, sf):
    """A3: date strings parsed back to dates; a malformed string gives NULL."""
    o = read_table(spark, sf, "orders")
    t = o.select("o_orderkey", "o_orderstatus", format_day("o_orderdate").alias("d_text"))
    return t.select("o_orderkey", "d_text", parse_day("d_text").alias("d_parsed"),
                    parse_day("o_orderstatus").alias("bad_parsed"))


@query("ordered_daily", f"""WITH {DAILY_CTE}
SELECT k, d, CAST(row_number() OVER (PARTITION BY k ORDER BY d) AS INTEGER) AS rn,
  {r6('demand')} AS demand, {r6('price')} AS price FROM daily""")
def ordered_daily(spark, sf):
    """Canonical time order made explicit as a per-series position."""
    d = base.daily(spark, sf)
    w = W.series_window(DK, DO)
    return d.select("k", "d", F.row_number().over(w).alias("rn"), "demand", "price")


@query("profile_counts", f"""WITH {DAILY_CTE}
SELECT count(*) AS n_rows, 5 AS n_columns FROM daily""")
def profile_counts(spark, sf):
    """A5: row and column count."""
    return profile(base.daily(spark, sf))


@query("preview_first5", f"""WITH {DAILY_CTE}
SELECT k, d, {r6('demand')} AS demand, n, {r6('price')} AS price FROM daily ORDER BY k, d LIMIT 5""")
def preview_first5(spark, sf):
    """First five rows in (series, time) order - a top-k, not a full sort."""
    return preview(base.daily(spark, sf), ["k", "d"], 5)


# ---------------------------------------------------------------- B: projections
@query("rename_if_present", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  o_orderpriority AS priority FROM orders""")
def rename_if_present(spark, sf):
    """B1."""
    o = read_table(spark, sf, "orders")
    return project.rename_if_present(o, {"o_orderpriority": "priority", "no_such_col": "x"})


@query("drop_if_present", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority
FROM orders""")
def drop_if_present(spark, sf):
    """B2."""
    return project.drop_if_present(read_table(spark, sf, "orders"), "o_orderstatus", "no_such_col")


@query("numeric_columns", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
  l_extendedprice, l_discount, l_tax FROM lineitem""")
def numeric_columns(spark, sf):
    """Only numeric columns survive (the scan reads just those)."""
    li = read_table(spark, sf, "lineitem")
    return li.select(*project.numeric_columns(li))


_CAL = calendar_sql("d")


@query("feature_projection", f"""WITH {DAILY_CTE}
SELECT k, n, {', '.join(f"{v} AS {c}" if c in ('month','quarter','day_of_week','day_of_year','is_weekend') else f"{r6(v)} AS {c}" for c, v in _CAL.items())}
FROM daily""")
def feature_projection(spark, sf):
    """All columns minus the time column and both targets."""
    d = add_calendar(base.daily(spark, sf), "d")
    return d.select(*project.feature_columns(d, ["d", "price", "demand"]))


@query("align_columns", f"""WITH {DAILY_CTE}
SELECT k, d, n, CAST(0.0 AS DOUBLE) AS quantity, {_CAL['month']} AS month, {r6('price')} AS price FROM daily""")
def align_columns(spark, sf):
    """B5 + B6 + B10: stored feature order, a missing column added as 0."""
    d = add_calendar(base.daily(spark, sf), "d")
    return project.align_columns(d, ["k", "d", "n", "quantity", "month", "price"])


@query("tabular_dataset", f"""WITH {DAILY_CTE}
SELECT k, d, n, {_CAL['month']} AS month, {_CAL['day_of_week']} AS day_of_week,
  {_CAL['is_weekend']} AS is_weekend, {r6('demand')} AS label FROM daily""")
def tabular_dataset(spark, sf):
    """Feature columns + target as ``label`` (before vector assembly)."""
    d = add_calendar(base.daily(spark, sf), "d")
    return project.tabular_dataset(d, ["n", "month", "day_of_week", "is_weekend"], "demand",
                                   keep=["k", "d"])


@query("drop_warmup", f"""WITH {DAILY_CTE},
f AS (SELECT k, d, demand, {roll_mean('demand', 7)} AS demand_roll7, {lag('demand', 3)} AS demand_lag3 FROM daily)
SELECT k, d, {r6('demand')} AS demand, {r6('demand_roll7')} AS demand_roll7, {r6('demand_lag3')} AS demand_lag3
FROM f WHERE demand_roll7 IS NOT NULL AND demand_lag3 IS NOT NULL""")
def drop_warmup(spark, sf):
    """Rows with any missing feature (the warm-up) are dropped."""
    d = base.daily(spark, sf).select("k", "d", "demand")
    w = W.series_window(DK, DO)
    f = d.withColumns({**W.rolling_mean_exprs({"demand": "demand"}, [7], w),
                       "demand_lag3": F.lag("demand", 3).over(w)})
    return clean.drop_incomplete(f)


@query("horizon_calendar", f"""WITH {DAILY_CTE}, last AS (SELECT k, max(d) AS last_d FROM daily GROUP BY k)
SELECT k, CAST(step AS INTEGER) AS step, CAST(last_d + CAST(step AS INTEGER) AS DATE) AS d
FROM last, range(1, 8) t(step)""")
def horizon_calendar(spark, sf):
    """7 future dates per series after its last date (explode, no join)."""
    last = base.daily(spark, sf).groupBy("k").agg(F.max("d").alias("last_d"))
    days = horizon_dates(F.date_add("last_d", 1), 7)
    return (last.select("k", F.posexplode(days).alias("pos", "d"))
            .select("k", (F.col("pos") + 1).alias("step"), "d"))


# ---------------------------------------------------------------- C: missing values
_FF = f"last_value(v IGNORE NULLS) OVER ({W_GAPPY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("forward_fill", f"""WITH {GAPPY_CTE}
SELECT user_id, event_id, ts, {r6('v')} AS v, {r6(_FF)} AS v_ffill FROM gappy""")
def forward_fill(spark, sf):
    """C1 on per-user event series, skew-safe plan in range-cut buckets."""
    g = _gappy_buckets(spark, sf)
    return clean.forward_fill(g, ["v"], GK, GO, bucket=F.col(W.RANGE), suffix="_ffill").drop(W.RANGE)


@query("backward_fill", f"""WITH {GAPPY_CTE}, f AS (SELECT *, {_FF} AS v_ffill FROM gappy)
SELECT user_id, event_id, ts, {r6('v')} AS v, {r6('v_ffill')} AS v_ffill,
  {r6(f"first_value(v_ffill IGNORE NULLS) OVER ({W_GAPPY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")} AS v_bfill
FROM f""")
def backward_fill(spark, sf):
    """C1 then C2 (bfill only reaches the leading gap), bucketed plan."""
    g = _gappy_buckets(spark, sf)
    f = clean.forward_fill(g, ["v"], GK, GO, bucket=F.col(W.RANGE), suffix="_ffill")
    return clean.backward_fill(f.withColumn("v_bfill", F.col("v_ffill")), ["v_bfill"], GK, GO,
                               bucket=F.col(W.RANGE)).drop(W.RANGE)


_W_ALL = "ORDER BY ts, event_id"
_FF_ALL = f"last_value(v IGNORE NULLS) OVER ({_W_ALL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("unkeyed_fill_roll", f"""WITH {GAPPY_CTE}, f AS (SELECT *, {_FF_ALL} AS v_ffill FROM gappy)
SELECT user_id, event_id, ts, {r6('v')} AS v, {r6('v_ffill')} AS v_ffill,
  {r6(roll_mean('v_ffill', 7, _W_ALL))} AS v_ffill_roll7, {r6(lag('v_ffill', 1, _W_ALL))} AS v_ffill_lag1 FROM f""")
def unkeyed_fill_roll(spark, sf):
    """C1, E1 and E2 over one series without a key (all events in time order), in range-cut buckets and chunks."""
    g = W.range_buckets(base.gappy(spark, sf), [], GO)
    f = clean.forward_fill(g, ["v"], [], GO, bucket=F.col(W.RANGE), suffix="_ffill")
    return W.chunked_window(f, [], GO, F.col(W.RANGE), lambda w: {
        **W.rolling_mean_exprs({"v_ffill": "v_ffill"}, [7], w), "v_ffill_lag1": F.lag("v_ffill", 1).over(w)},
        lookback=6, chunk_rows=4096).drop(W.RANGE)


@query("median_fill", f"""WITH {GAPPY_CTE}, f AS (SELECT *, {_FF} AS v_ffill FROM gappy),
m AS (SELECT user_id, median(v) AS med FROM gappy GROUP BY user_id)
SELECT f.user_id, event_id, ts, {r6('v')} AS v, {r6('coalesce(v_ffill, med)')} AS v_filled
FROM f JOIN m USING (user_id)""")
def median_fill(spark, sf):
    """C1 then C3: what ffill leaves is filled with the median of the column *before* ffill."""
    g = _gappy_buckets(spark, sf)
    f = clean.forward_fill(g, ["v"], GK, GO, bucket=F.col(W.RANGE), suffix="_filled").drop(W.RANGE)
    return clean.fill_with_stats(f, g.select("user_id", F.col("v").alias("v_filled")),
                                 ["v_filled"], GK, "median")


@query("mean_fill", f"""WITH {GAPPY_CTE}, m AS (SELECT user_id, avg(v) AS mu FROM gappy GROUP BY user_id)
SELECT g.user_id, event_id, ts, {r6('v')} AS v, {r6('coalesce(v, mu)')} AS v_filled
FROM gappy g JOIN m USING (user_id)""")
def mean_fill(spark, sf):
    """C4: per-user mean fill (an all-missing series stays missing)."""
    g = base.gappy(spark, sf).withColumn("v_filled", F.col("v"))
    return clean.fill_with_stats(g, g, ["v_filled"], GK, "mean")


@query("validate_target", f"""WITH {GAPPY_CTE}
SELECT user_id, count(*) AS n_rows, CAST(count_if(v IS NULL) AS BIGINT) AS n_missing, {r6('avg(v)')} AS mean,
  {r6('stddev_samp(v)')} AS std, {r6('min(v)')} AS min, {r6('max(v)')} AS max,
  stddev_samp(v) < 0.01 AS low_variance
FROM gappy GROUP BY user_id""")
def validate_target(spark, sf):
    """H1 + C5 per user series."""
    return stats.validate_target(base.gappy(spark, sf), "v", GK)


_SEQ3 = f"""[lag(v, 2) OVER ({W_GAPPY}), lag(v, 1) OVER ({W_GAPPY}),
   CASE WHEN v > 400 THEN CAST('inf' AS DOUBLE) WHEN v < 25 THEN CAST('-inf' AS DOUBLE) ELSE v END]"""


def _san(x):
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) THEN 0.0 WHEN {x} = CAST('inf' AS DOUBLE) "
            f"THEN 1.7976931348623157e308 WHEN {x} = CAST('-inf' AS DOUBLE) THEN -1.7976931348623157e308 "
            f"ELSE {x} END")


@query("sanitize_sequences", f"""WITH {GAPPY_CTE}, s AS (SELECT user_id, event_id, {_SEQ3} AS x FROM gappy)
SELECT user_id, event_id,
  list_bool_or([e IS NULL OR isnan(e) FOR e IN x]) AS has_missing,
  CAST({_san('x[1]')} AS DOUBLE) AS x0, CAST({_san('x[2]')} AS DOUBLE) AS x1,
  CAST({_san('x[3]')} AS DOUBLE) AS x2 FROM s""")
def sanitize_sequences(spark, sf):
    """Detect NaN/NULL in a window array, then NaN/NULL -> 0, +-inf -> +-max double."""
    g = _gappy_buckets(spark, sf)
    last = (F.when(F.col("v") > 400, F.lit(float("inf")))
            .when(F.col("v") < 25, F.lit(float("-inf"))).otherwise(F.col("v")))
    s = W.chunked_window(g, GK, GO, F.col(W.RANGE), lambda w: {
        "x": F.array(F.lag("v", 2).over(w), F.lag("v", 1).over(w), last)}, lookback=2)
    s = s.select("user_id", "event_id", has_missing("x").alias("has_missing"),
                 sanitize_array("x").alias("x"))
    return s.select("user_id", "event_id", "has_missing",
                    *[F.col("x")[i].alias(f"x{i}") for i in range(3)])


# ---------------------------------------------------------------- D: encoding / scaling
@query("label_map", """SELECT 'o_orderpriority' AS "column", o_orderpriority AS value,
  CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT o_orderpriority FROM orders)
UNION ALL
SELECT 'o_orderstatus', o_orderstatus, CAST(row_number() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER)
FROM (SELECT DISTINCT o_orderstatus FROM orders)""")
def label_map(spark, sf):
    """D1 fit: the stored map (column, value, code), codes over sorted distinct values."""
    return encode.fit_label_map(read_table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"])


@query("label_encode", """SELECT o_orderkey,
  CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority,
  CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS o_orderstatus FROM orders""")
def label_encode(spark, sf):
    """D1 fit + transform on all rows."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    cols = ["o_orderpriority", "o_orderstatus"]
    return encode.encode(o, encode.fit_label_map(o, cols), cols, mode="strict")


@query("encode_with_map", """WITH m AS (SELECT o_orderpriority AS value,
    CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'))
SELECT o_orderkey, code AS o_orderpriority FROM orders JOIN m ON o_orderpriority = value""")
def encode_with_map(spark, sf):
    """Map fitted on the training period, strict transform of every order
    (an unseen value would fail the job)."""
    o = read_table(spark, sf, "orders")
    m = encode.fit_label_map(o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")),
                             ["o_orderpriority"])
    return encode.encode(o.select("o_orderkey", "o_orderpriority"), m, ["o_orderpriority"], "strict")


_SAFE_MAP = """m AS (SELECT c_name AS value, CAST(row_number() OVER (ORDER BY c_name) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT c_name FROM customer WHERE c_acctbal >= 0))"""


@query("safe_encode", f"""WITH {_SAFE_MAP}
SELECT c_custkey, coalesce(code, 0) AS c_name FROM customer LEFT JOIN m ON c_name = value""")
def safe_encode(spark, sf):
    """D3: unseen names (customers with negative balance were not in the fit) get code 0."""
    c = read_table(spark, sf, "customer")
    # one name per customer: high cardinality -> distributed code assignment
    m = encode.fit_label_map(c.filter(F.col("c_acctbal") >= 0), ["c_name"], prefix_len=16)
    return encode.encode(c.select("c_custkey", "c_name"), m, ["c_name"], mode="safe")


@query("extended_label_map", """WITH pairs AS (SELECT 'c_name' AS col, c_name AS value, c_acctbal FROM customer
  UNION ALL SELECT 'c_mktsegment', c_mktsegment, c_acctbal FROM customer),
v AS (SELECT col, value, max(c_acctbal) < 0 AS later FROM pairs GROUP BY col, value)
SELECT col AS "column", value, CAST(row_number() OVER (PARTITION BY col ORDER BY later, value) - 1 AS INTEGER) AS code FROM v""")
def extended_label_map(spark, sf):
    """D2 refit: a map fitted on customers without debt, extended by all customers; old codes stay, unseen values follow."""
    c = read_table(spark, sf, "customer")
    cols = ["c_name", "c_mktsegment"]
    return encode.extend_label_map(encode.fit_label_map(c.filter(F.col("c_acctbal") >= 0), cols, prefix_len=16), c, cols)


@query("unseen_report", f"""WITH {_SAFE_MAP}
SELECT 'c_name' AS "column", c_name AS value, count(*) AS n_rows FROM customer
WHERE c_name NOT IN (SELECT value FROM m) GROUP BY c_name""")
def unseen_report(spark, sf):
    """D3 diagnostics: unseen values and how many rows carry them."""
    c = read_table(spark, sf, "customer")
    known = c.filter(F.col("c_acctbal") >= 0).select(F.lit("c_name").alias("column"), F.col("c_name").alias("value")).distinct()
    return encode.unseen_counts(c, known, ["c_name"])


@query("inverse_encode", """SELECT o_orderkey,
  CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority,
  o_orderpriority AS o_orderpriority_label FROM orders""")
def inverse_encode(spark, sf):
    """Encode then decode; the label must come back unchanged."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    m = encode.fit_label_map(o, ["o_orderpriority"])
    return encode.decode(encode.encode(o, m, ["o_orderpriority"]), m, "o_orderpriority")


def _scale_sql(kind: str, where: str = "") -> str:
    cols = ["n", "price", "demand"]
    if kind == "minmax":
        st = ", ".join(f"min({c}) AS a_{c}, max({c}) - min({c}) AS b_{c}" for c in cols)
    else:
        st = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS b_{c}" for c in cols)
    sel = ", ".join(
        f"{r6(f'({c} - a_{c}) / CASE WHEN b_{c} = 0 THEN 1.0 ELSE b_{c} END')} AS {c}" for c in cols)
    return f"""WITH {DAILY_CTE}, s AS (SELECT {st} FROM daily {where})
SELECT k, d, {sel} FROM daily, s"""


@query("minmax_scale", _scale_sql("minmax"))
def minmax_scale(spark, sf):
    """Whole-table min-max of n, price, demand (constant column -> 0)."""
    d = base.daily(spark, sf).select("k", "d", "n", "price", "demand")
    return scale.minmax_scale(d, ["n", "price", "demand"])


@query("standard_scale", _scale_sql("standard"))
def standard_scale(spark, sf):
    """Centre and divide by the population std."""
    d = base.daily(spark, sf).select("k", "d", "n", "price", "demand")
    return scale.standard_scale(d, ["n", "price", "demand"])


@query("apply_scaler", _scale_sql("standard", "WHERE d < DATE '1999-01-01'"))
def apply_scaler(spark, sf):
    """Parameters fitted on the early period, applied to every row."""
    d = base.daily(spark, sf).select("k", "d", "n", "price", "demand")
    p = scale.fit_scaler(d.filter(F.col("d") < F.lit("1999-01-01").cast("date")),
                         ["n", "price", "demand"], "standard")
    return scale.apply_scaler(d, p, ["n", "price", "demand"])


@query("scaler_params", f"""WITH {DAILY_CTE}
SELECT 'n' AS "column", 'minmax' AS kind, {r6('CAST(min(n) AS DOUBLE)')} AS center,
  {r6('CAST(max(n) - min(n) AS DOUBLE)')} AS scale FROM daily
UNION ALL SELECT 'price', 'minmax', {r6('min(price)')}, {r6('max(price) - min(price)')} FROM daily""")
def scaler_params(spark, sf):
    """D5 fit: the stored parameter table."""
    return scale.fit_scaler(base.daily(spark, sf), ["n", "price"], "minmax")


@query("preprocess_full", f"""WITH {DAILY_CTE},
e AS (SELECT k AS k_raw, d, demand, n, price,
        CAST(dense_rank() OVER (ORDER BY k) - 1 AS INTEGER) AS k FROM daily),
s AS (SELECT min(k) AS mn_k, max(k) - min(k) AS rg_k, min(n) AS mn_n, max(n) - min(n) AS rg_n,
        avg(k) AS mu_k, stddev_pop(k) AS sd_k, avg(n) AS mu_n, stddev_pop(n) AS sd_n FROM e)
SELECT k_raw, d, k, n, {r6('demand')} AS demand, {r6('price')} AS price,
  {r6('(k - mn_k) / CASE WHEN rg_k = 0 THEN 1.0 ELSE rg_k END')} AS k_mm,
  {r6('(n - mn_n) / CASE WHEN rg_n = 0 THEN 1.0 ELSE rg_n END')} AS n_mm,
  {r6('(k - mu_k) / CASE WHEN sd_k = 0 THEN 1.0 ELSE sd_k END')} AS k_std,
  {r6('(n - mu_n) / CASE WHEN sd_n = 0 THEN 1.0 ELSE sd_n END')} AS n_std
FROM e, s""")
def preprocess_full(spark, sf):
    """Ffill -> median fill -> label encode -> min-max and standard variants
    (targets price / demand are not scaled; the encoded category is)."""
    d = base.daily(spark, sf).withColumn("k_raw", F.col("k"))
    enc, _mm, _std, art = scale.preprocess(d, ["k_raw"], ["d"], ["k"], ["price", "demand"])
    cols = ["k", "n"]
    out = scale.apply_scaler(enc, art["minmax"], cols, suffix="_mm")
    out = scale.apply_scaler(out, art["standard"], cols, suffix="_std")
    return out.select("k_raw", "d", "k", "n", "demand", "price", "k_mm", "n_mm", "k_std", "n_std")


# ---------------------------------------------------------------- H6 / I: weights and splits
@query("balanced_class_weights", """SELECT o_orderpriority, count(*) AS class_count,
  {w} AS weight FROM orders GROUP BY o_orderpriority""".replace(
    "{w}", r6("(SELECT count(*) FROM orders) / ((SELECT count(DISTINCT o_orderpriority) FROM orders) * count(*))")))
def balanced_class_weights(spark, sf):
    """H6: n / (m * count_c)."""
    return stats.balanced_class_weights(read_table(spark, sf, "orders"), "o_orderpriority")


@query("chronological_split", f"""WITH {DAILY_CTE}
SELECT k, d, row_number() OVER (PARTITION BY k ORDER BY d) <= floor(0.8 * count(*) OVER (PARTITION BY k)) AS is_train
FROM daily""")
def chronological_split(spark, sf):
    """First floor(0.8 n) rows of each series train, the rest test."""
    d = base.daily(spark, sf).select("k", "d")
    return split.chronological_split(d, DK, DO)


@query("unkeyed_chronological_split", """SELECT event_id,
  row_number() OVER (ORDER BY ts, event_id) <= floor(0.8 * count(*) OVER ()) AS is_train FROM events""")
def unkeyed_chronological_split(spark, sf):
    """I1 over one series of all events: the cut is an order statistic of (time, id), found by counting."""
    e = read_table(spark, sf, "events").select("event_id", "ts")
    return split.chronological_split(e, [], ["ts", "event_id"]).drop("ts")


_HB = "CAST(('0x' || substr(md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42')), 1, 8))::BIGINT % 100 AS INTEGER)"


@query("hash_split", f"""SELECT o_orderkey, {_HB} AS bucket, {_HB} >= 20 AS is_train FROM orders""")
def hash_split(spark, sf):
    """Stable md5 bucket of the key; ~80 % train."""
    o = read_table(spark, sf, "orders").select("o_orderkey")
    return split.hash_split(o.withColumn("bucket", split.hash_bucket(["o_orderkey"])), ["o_orderkey"])


@query("history_tail", f"""WITH {DAILY_CTE},
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY d DESC) AS rn FROM daily)
SELECT k, d, {r6('price')} AS price, {r6('demand')} AS demand, CAST(rn AS INTEGER) AS recency FROM r WHERE rn <= 90""")
def history_tail(spark, sf):
    """Last min(90, n) rows of each series (recency 1 = latest)."""
    d = base.daily(spark, sf).select("k", "d", "price", "demand")
    return W.last_rows(d, DK, "d", 90, rank_col="recency")


# ---------------------------------------------------------------- M: metrics
@query("regression_metrics", f"""WITH {DAILY_CTE},
p AS (SELECT k, demand, lag(demand) OVER (PARTITION BY k ORDER BY d) AS pred FROM daily)
SELECT k, count(*) AS n, {r6('sqrt(avg((demand - pred) * (demand - pred)))')} AS rmse,
  {r6('avg(abs(demand - pred))')} AS mae,
  {r6('1 - sum((demand - pred) * (demand - pred)) / (count(demand) * var_pop(demand))')} AS r2,
  {r6('avg(abs((demand - pred) / NULLIF(demand, 0))) * 100')} AS mape
FROM p WHERE pred IS NOT NULL GROUP BY k""")
def regression_metrics(spark, sf):
    """M1-M4 on the naive previous-day forecast, per series."""
    return metrics.regression_metrics(base.naive_regression(spark, sf), "demand", "pred", DK)


_NAIVE_CLS = """p AS (SELECT o_orderpriority AS actual,
    lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS predicted
  FROM orders),
q AS (SELECT * FROM p WHERE predicted IS NOT NULL),
labels AS (SELECT actual AS label FROM q UNION SELECT predicted FROM q),
cm AS (SELECT actual, predicted, count(*) AS n FROM q GROUP BY 1, 2),
pc AS (SELECT l.label,
    coalesce((SELECT n FROM cm WHERE cm.actual = l.label AND cm.predicted = l.label), 0) AS tp,
    coalesce((SELECT sum(n) FROM cm WHERE cm.actual = l.label), 0) AS support,
    coalesce((SELECT sum(n) FROM cm WHERE cm.predicted = l.label), 0) AS n_pred
  FROM labels l),
pr AS (SELECT label, support,
    coalesce(tp / NULLIF(n_pred, 0), 0.0) AS precision, coalesce(tp / NULLIF(support, 0), 0.0) AS recall
  FROM pc),
f AS (SELECT *, coalesce(2 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1 FROM pr)"""


@query("confusion_matrix", f"""WITH {_NAIVE_CLS}
SELECT a.label AS actual, b.label AS predicted, coalesce(cm.n, 0) AS n
FROM labels a CROSS JOIN labels b LEFT JOIN cm ON cm.actual = a.label AND cm.predicted = b.label""")
def confusion_matrix(spark, sf):
    """M8: all label pairs, zero cells kept."""
    return metrics.confusion_matrix(base.naive_classification(spark, sf), "actual", "predicted")


@query("classification_metrics", f"""WITH {_NAIVE_CLS}
SELECT (SELECT {r6('avg(CAST(actual = predicted AS DOUBLE))')} FROM q) AS accuracy,
  (SELECT count(*) FROM q) AS n,
  {r6('sum(precision * support) / sum(support)')} AS precision,
  {r6('sum(recall * support) / sum(support)')} AS recall,
  {r6('sum(f1 * support) / sum(support)')} AS f1 FROM f""")
def classification_metrics(spark, sf):
    """M5 + M6 + M9: accuracy and support-weighted precision / recall / F1."""
    return metrics.classification_metrics(base.naive_classification(spark, sf), "actual", "predicted")


@query("classification_report", f"""WITH {_NAIVE_CLS}
SELECT label, {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('f1')} AS f1,
  CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', {r6('avg(CAST(actual = predicted AS DOUBLE))')},
  {r6('avg(CAST(actual = predicted AS DOUBLE))')}, {r6('avg(CAST(actual = predicted AS DOUBLE))')}, count(*) FROM q
UNION ALL SELECT 'macro avg', {r6('avg(precision)')}, {r6('avg(recall)')}, {r6('avg(f1)')},
  CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', {r6('sum(precision * support) / sum(support)')},
  {r6('sum(recall * support) / sum(support)')}, {r6('sum(f1 * support) / sum(support)')},
  CAST(sum(support) AS BIGINT) FROM f""")
def classification_report(spark, sf):
    """M7: per-class rows plus accuracy / macro / weighted average rows."""
    return metrics.classification_report(base.naive_classification(spark, sf), "actual", "predicted")
