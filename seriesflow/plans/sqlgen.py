"""Small helpers that write the DuckDB oracle SQL for the catalog.

The oracle is an independent statement of each query in plain ANSI SQL
(window functions, CTEs, recursive CTEs); these helpers only save typing.
"""

from __future__ import annotations

DAILY_CTE = """daily AS (
  SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS d,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS demand,
         COUNT(*) AS n,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS price
  FROM orders GROUP BY 1, 2)"""

GAPPY_CTE = """gappy AS (
  SELECT user_id, event_id, ts, CASE WHEN value > 20 THEN value END AS v FROM events)"""

LINES_CTE = """lines AS (
  SELECT user_id AS device_id, ts AS event_ts, event_id AS seq,
    CASE event_id % 5
      WHEN 0 THEN 'DHT11 Temperature: ' || printf('%.2f', value) || ' °C'
      WHEN 1 THEN 'DHT11 Humidity: ' || printf('%.2f', value) || ' %'
      WHEN 2 THEN 'DS18B20 Temperature: ' || printf('%.2f', value) || ' °C'
      WHEN 3 THEN 'Soil Moisture Value: ' || CAST(CAST(floor(value * 8) AS INTEGER) % 4096 AS VARCHAR)
      ELSE 'Error: DS18B20 not detected!' END AS line
  FROM events)"""


W_DAILY = "PARTITION BY k ORDER BY d"


def r6(expr: str) -> str:
    return f"(round({expr}, 6) + 0.0)"


def r4(expr: str) -> str:
    return f"(floor(({expr}) * 1e4 + 0.5003) / 1e4)"


def rows(w: str, n: int, shift: int = 0) -> str:
    lo = n - 1 + shift
    hi = "CURRENT ROW" if shift == 0 else f"{shift} PRECEDING"
    return f"({w} ROWS BETWEEN {lo} PRECEDING AND {hi})"


def roll_mean(col: str, n: int, w: str = W_DAILY, full: bool = True) -> str:
    fr = rows(w, n)
    if full:
        return f"CASE WHEN count({col}) OVER {fr} = {n} THEN avg({col}) OVER {fr} END"
    return f"avg({col}) OVER {fr}"


def roll_std(col: str, n: int, w: str = W_DAILY, full: bool = True) -> str:
    fr = rows(w, n)
    if full:
        return f"CASE WHEN count({col}) OVER {fr} = {n} THEN stddev_samp({col}) OVER {fr} END"
    return f"stddev_samp({col}) OVER {fr}"


def lag(col: str, i: int, w: str = W_DAILY) -> str:
    return f"lag({col}, {i}) OVER ({w})"


def calendar_sql(d: str = "d") -> dict[str, str]:
    tp = "(2 * pi())"
    m, q = f"CAST(month({d}) AS INTEGER)", f"CAST(quarter({d}) AS INTEGER)"
    w, y = f"CAST(isodow({d}) - 1 AS INTEGER)", f"CAST(dayofyear({d}) AS INTEGER)"
    return {
        "month": m, "month_sin": f"sin({tp} * {m} / 12)", "month_cos": f"cos({tp} * {m} / 12)",
        "quarter": q, "quarter_sin": f"sin({tp} * {q} / 4)", "quarter_cos": f"cos({tp} * {q} / 4)",
        "day_of_week": w, "dow_sin": f"sin({tp} * {w} / 7)", "dow_cos": f"cos({tp} * {w} / 7)",
        "day_of_year": y, "doy_sin": f"sin({tp} * {y} / 365)", "doy_cos": f"cos({tp} * {y} / 365)",
        "year_progress": f"{y} / CAST(365.0 AS DOUBLE)",
        "is_weekend": f"CAST(isodow({d}) - 1 >= 5 AS INTEGER)",
    }


INT_CALENDAR = {"month", "quarter", "day_of_week", "day_of_year", "is_weekend"}


def momentum_sql(col: str = "price", w: str = W_DAILY, prefix: str = "price") -> dict[str, str]:
    out = {f"{prefix}_diff_{k}": f"{col} - {lag(col, k, w)}" for k in (1, 3, 7)}
    for k in (3, 7):
        out[f"{prefix}_momentum_{k}"] = f"{col} / NULLIF({lag(col, k, w)}, 0) - 1"
    out[f"{prefix}_volatility_7"] = roll_std(col, 7, w)
    return out


def feature_sql(measures: dict[str, str], target: str, price: str, n_lags: int = 21,
                w: str = W_DAILY, with_lags: bool = True) -> dict[str, str]:
    out: dict[str, str] = {}
    for n in (3, 7, 14, 21):
        for p, c in measures.items():
            out[f"{p}_roll{n}"] = roll_mean(c, n, w)
    for p, c in measures.items():
        if c in (target, price):
            out[f"{p}_roll7_std"] = roll_std(c, 7, w)
    out.update(calendar_sql("d"))
    if with_lags:
        out.update({f"{target}_lag{i}": lag(target, i, w) for i in range(1, n_lags + 1)})
    out.update(momentum_sql(price, w))
    return out


def r64(expr: str) -> str:
    """4-place tie-safe rounding, then the 6-place output form (matches ``places=4``)."""
    return r6(r4(expr))


def select_list(exprs: dict[str, str], ints: set[str] = frozenset(), round_all: bool = True,
                rfn=None) -> str:
    rfn = rfn or r6
    parts = []
    for name, e in exprs.items():
        parts.append(f"{e} AS {name}" if (name in ints or not round_all) else f"{rfn(e)} AS {name}")
    return ",\n    ".join(parts)
