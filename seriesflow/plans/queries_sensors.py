"""Sensor-feed queries (G1-G4, O1-O3 batch twins, A10/O5 stream runs)."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesflow.functions.text import decode_line
from seriesflow.operators import sensors as S
from seriesflow.operators import windows as W
from seriesflow.plans import base
from seriesflow.plans.registry import ORACLE, query
from seriesflow.plans.sqlgen import LINES_CTE, r6

LK, LO = base.LINE_KEYS, base.LINE_ORDER

_NUM = "TRY_CAST(trim({p}) AS DOUBLE)"
_PART = "split_part(line, ':', 2)"
PARSED_SQL = f"""{LINES_CTE},
kinds AS (SELECT *, CASE WHEN contains(line, 'DHT11 Temperature') THEN 'air_temp'
    WHEN contains(line, 'DHT11 Humidity') THEN 'air_humidity'
    WHEN contains(line, 'DS18B20 Temperature') THEN 'soil_temp'
    WHEN contains(line, 'Soil Moisture Value') THEN 'soil_moisture' END AS kind FROM lines),
vals AS (SELECT *, CASE kind
    WHEN 'air_temp' THEN {_NUM.format(p=f"replace({_PART}, '°C', '')")}
    WHEN 'air_humidity' THEN {_NUM.format(p=f"replace({_PART}, '%', '')")}
    WHEN 'soil_temp' THEN {_NUM.format(p=f"replace({_PART}, '°C', '')")}
    WHEN 'soil_moisture' THEN {_NUM.format(p=_PART)} / CAST(4095.0 AS DOUBLE) * CAST(100.0 AS DOUBLE) END AS value
  FROM kinds),
parsed AS (SELECT *, CASE WHEN kind IS NULL THEN 'ignored' WHEN value IS NULL THEN 'rejected' ELSE 'ok' END AS status
  FROM vals)"""


def parsed_lines(spark, sf):
    return S.parse_lines(base.lines(spark, sf))


@query("parse_lines", f"""WITH {PARSED_SQL}
SELECT device_id, event_ts, seq, line, kind, {r6('value')} AS value, status FROM parsed""")
def parse_lines(spark, sf):
    """O1 batch twin / B12 / G2: kind by first matching substring, number after
    ':' without its unit, status ok / rejected / ignored."""
    return parsed_lines(spark, sf)


@query("calibrate_moisture", f"""WITH {PARSED_SQL}
SELECT device_id, seq, CAST({_NUM.format(p=_PART)} AS DOUBLE) AS raw, {r6('value')} AS moisture_pct
FROM parsed WHERE kind = 'soil_moisture'""")
def calibrate_moisture(spark, sf):
    """12-bit soil reading -> percent (raw / 4095 * 100)."""
    p = parsed_lines(spark, sf).filter(F.col("kind") == "soil_moisture")
    raw = F.trim(F.try_element_at(F.split("line", ":"), F.lit(2))).try_cast("double")
    return p.select("device_id", "seq", raw.alias("raw"), F.col("value").alias("moisture_pct"))


@query("line_kind_counts", f"""WITH {PARSED_SQL}
SELECT kind, status, count(*) AS n_lines FROM parsed GROUP BY kind, status""")
def line_kind_counts(spark, sf):
    """Lines per kind and status; unmatched lines are counted, not failed."""
    return S.kind_counts(parsed_lines(spark, sf))


def _frame_value(k: str) -> str:
    return f"arg_max(value, pos) FILTER (WHERE kind = '{k}')"


_FRAMED = """raw AS (SELECT user_id AS device_id, ts AS event_ts, event_id, event_id * 10 + k AS seq, value AS v, k,
    CASE k WHEN 0 THEN CASE WHEN event_id % 5 = 4 THEN 'Error: DS18B20 not detected!' END
      WHEN 1 THEN CASE WHEN event_id % 11 <> 0 THEN '===== SENSOR READINGS =====' END
      WHEN 2 THEN 'DHT11 Temperature: ' || printf('%.2f', value) || ' °C' WHEN 3 THEN 'DHT11 Humidity: ' || printf('%.2f', value) || ' %'
      WHEN 4 THEN CASE WHEN event_id % 5 <> 4 THEN 'DS18B20 Temperature: ' || printf('%.2f', value) || ' °C' END
      WHEN 5 THEN 'Soil Moisture Value: ' || CAST(CAST(floor(value * 8) AS INTEGER) % 4096 AS VARCHAR)
      ELSE CASE WHEN event_id % 13 <> 0 THEN '============================' END END AS line
  FROM events, (SELECT unnest(range(7)) AS k))"""


@query("sensor_frames", f"""WITH {_FRAMED},
l AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY event_ts, seq) AS pos,
    CASE k WHEN 0 THEN 'error' WHEN 1 THEN 'header' WHEN 6 THEN 'footer' ELSE 'reading' END AS role,
    CASE k WHEN 2 THEN 'air_temp' WHEN 3 THEN 'air_humidity' WHEN 4 THEN 'soil_temp' WHEN 5 THEN 'soil_moisture' END AS kind,
    CASE WHEN k IN (2, 3, 4) THEN CAST(printf('%.2f', v) AS DOUBLE)
      WHEN k = 5 THEN CAST(floor(v * 8) AS INTEGER) % 4096 / CAST(4095.0 AS DOUBLE) * CAST(100.0 AS DOUBLE) END AS value
  FROM raw WHERE line IS NOT NULL),
m AS (SELECT *, count(*) FILTER (WHERE role = 'header') OVER w AS n,
    last_value(CASE WHEN role IN ('header', 'footer') THEN role END IGNORE NULLS) OVER w AS mark
  FROM l WINDOW w AS (PARTITION BY device_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
f AS (SELECT *, n + CASE WHEN role NOT IN ('header', 'footer') AND coalesce(mark, 'footer') = 'footer' THEN 1 ELSE 0 END AS frame FROM m),
g AS (SELECT device_id, frame, arg_min(event_ts, pos) AS first_event_ts, arg_min(seq, pos) AS first_seq, arg_max(event_ts, pos) AS last_event_ts,
    arg_max(seq, pos) AS last_seq, count(*) AS n_lines, {', '.join(f"{_frame_value(k)} AS {k}" for k in S.KINDS)},
    bool_or(role = 'header') AS has_header, bool_or(role = 'footer') AS has_footer, bool_or(role = 'error') AS has_error FROM f GROUP BY device_id, frame)
SELECT device_id, frame, first_event_ts, first_seq, last_event_ts, last_seq, n_lines, {', '.join(f"{r6(k)} AS {k}" for k in S.KINDS)},
  has_header, has_footer, has_error, has_header AND has_footer AND {' AND '.join(f'{k} IS NOT NULL' for k in S.KINDS)} AS complete FROM g""")
def sensor_frames(spark, sf):
    """The feed's lines assembled into frames by their header and footer lines."""
    return S.assemble_frames(base.framed_lines(spark, sf), LK, LO)


def _carry(k: str) -> str:
    return (f"last_value(CASE WHEN status = 'ok' AND kind = '{k}' THEN value END IGNORE NULLS) OVER "
            "(PARTITION BY device_id ORDER BY event_ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


@query("latest_readings", f"""WITH {PARSED_SQL}
SELECT device_id, event_ts, seq, line, kind, {r6('value')} AS value, status,
  {', '.join(f'{r6(_carry(k))} AS {k}' for k in S.KINDS)} FROM parsed""")
def latest_readings(spark, sf):
    """O2 batch twin: latest value per kind carried along each device's lines
    (skew-safe carry in range-cut buckets)."""
    p = W.range_buckets(parsed_lines(spark, sf), LK, LO)
    return S.latest_readings(p, LK, LO, bucket=F.col(W.RANGE)).drop(W.RANGE)


@query("complete_readings", f"""WITH {PARSED_SQL},
ok AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY event_ts, seq) AS pos
       FROM parsed WHERE status = 'ok'),
fs AS (SELECT device_id, kind, min(pos) AS first_pos FROM ok GROUP BY device_id, kind),
done AS (SELECT device_id, max(first_pos) AS done_pos FROM fs GROUP BY device_id HAVING count(*) = 4),
v AS (SELECT ok.device_id, done_pos, kind, arg_max(value, pos) AS value FROM ok JOIN done USING (device_id)
      WHERE pos <= done_pos GROUP BY ok.device_id, done_pos, kind)
SELECT v.device_id, ok.event_ts AS done_event_ts, ok.seq AS done_seq,
  {', '.join(f"{r6(f'max(CASE WHEN v.kind = {chr(39)}{k}{chr(39)} THEN v.value END)')} AS {k}" for k in S.KINDS)}
FROM v JOIN ok ON ok.device_id = v.device_id AND ok.pos = v.done_pos
GROUP BY v.device_id, ok.event_ts, ok.seq""")
def complete_readings(spark, sf):
    """O3 batch twin: first complete reading per device (all four kinds seen),
    from aggregates only."""
    return S.complete_readings(parsed_lines(spark, sf), LK, LO)


@query("decode_lines", f"""WITH {LINES_CTE} SELECT device_id, seq, trim(line) AS text FROM lines""")
def decode_lines(spark, sf):
    """G1: raw bytes (every line as UTF-8, with an invalid 0xFF byte spliced into
    the value of every error line) decoded with bad bytes dropped and stripped."""
    ln = base.lines(spark, sf)
    raw = F.when(F.col("line").startswith("Error"),
                 F.concat(F.encode(F.col("line"), "UTF-8"), F.unhex(F.lit("FF")), F.lit(b"\r\n")))
    raw = raw.otherwise(F.concat(F.encode(F.col("line"), "UTF-8"), F.lit(b"\r\n")))
    return ln.select("device_id", "seq", raw.alias("raw")).select(
        "device_id", "seq", decode_line("raw").alias("text"))


@query("lines_source", f"""WITH {PARSED_SQL}
SELECT device_id, event_ts, seq, line, kind, {r6('value')} AS value, status FROM parsed""")
def lines_source(spark, sf):
    """A10 + O5: the lines arrive as files of a stream, are parsed and appended to a
    sink; returns the sink's rows (without arrival time and raw bytes)."""
    from seriesflow.streaming.sensors import run_lines_stream
    return run_lines_stream(spark, base.lines(spark, sf))[0].drop("arrived_at", "raw")


_LATEST = [f"arg_max(CASE WHEN kind = '{k}' THEN value END, CASE WHEN kind = '{k}' THEN pos END)" for k in S.KINDS]


@query("stream_latest_readings", f"""WITH {PARSED_SQL},
ok AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY event_ts, seq) AS pos FROM parsed WHERE status = 'ok')
SELECT device_id, date_trunc('day', event_ts) AS window_start, date_trunc('day', event_ts) + INTERVAL 1 DAY AS window_end,
  {', '.join(f'{r6(x)} AS {k}' for x, k in zip(_LATEST, S.KINDS))}, count(DISTINCT kind) = 4 AS complete
FROM ok GROUP BY device_id, date_trunc('day', event_ts)""")
def stream_latest_readings(spark, sf):
    """O2 on a stream: per device and event-time window of a day (watermark one hour),
    the latest value of each kind; windows with all four kinds are complete."""
    from seriesflow.streaming.sensors import run_window_stream
    return run_window_stream(spark, base.lines(spark, sf))


@query("stream_first_complete", ORACLE["complete_readings"])
def stream_first_complete(spark, sf):
    """O3 on a stream: emit once per device when all four kinds have been seen
    (state: the latest value per kind of open devices, carried from batch to batch)."""
    from seriesflow.streaming.sensors import run_first_complete_stream
    return run_first_complete_stream(spark, base.lines(spark, sf))


@query("stream_first_complete_expiring", ORACLE["complete_readings"])
def stream_first_complete_expiring(spark, sf):
    """O3 on a stream with bounded state: devices that are silent for 400 days (longer than the feed) are forgotten."""
    from datetime import timedelta

    from seriesflow.streaming.sensors import run_first_complete_stream
    return run_first_complete_stream(spark, base.lines(spark, sf), ttl=timedelta(days=400))
