"""Sensor text functions (G1-G3): native string expressions, no Python per line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesflow.functions.numeric import col_

# The reading kinds of the device feed, the substring that
# selects each one (first match wins, in this order), the unit stripped before
# parsing, and the 12-bit full scale of the soil-moisture ADC.
KIND_RULES = [
    ("DHT11 Temperature", "air_temp", "°C"),
    ("DHT11 Humidity", "air_humidity", "%"),
    ("DS18B20 Temperature", "soil_temp", "°C"),
    ("Soil Moisture Value", "soil_moisture", None),
]
KINDS = ["soil_temp", "soil_moisture", "air_temp", "air_humidity"]
ADC_FULL_SCALE = 4095.0
REPLACEMENT_CHAR = "�"


def strip(c) -> Column:
    """Whitespace strip on both ends (tabs, CR and LF too, not just spaces)."""
    return F.btrim(col_(c), F.lit(" \t\n\x0b\f\r"))


def decode_line(raw) -> Column:
    """G1: bytes -> text; invalid UTF-8 bytes are dropped, then the line is stripped."""
    fixed = F.make_valid_utf8(col_(raw).cast("string"))
    return strip(F.replace(fixed, F.lit(REPLACEMENT_CHAR), F.lit("")))


def line_kind(line) -> Column:
    """The reading kind selected by substring, first match wins; NULL if none."""
    c = col_(line)
    out = None
    for needle, kind, _unit in KIND_RULES:
        out = (F.when(c.contains(needle), F.lit(kind)) if out is None
               else out.when(c.contains(needle), F.lit(kind)))
    return out


# What a reading may look like; a cast alone would also take Java's suffixes (12d, 1f).
NUMBER = r"^\s*([+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[+-]?(?i:nan|inf|infinity))\s*$"


# The lines around a frame of readings, and how an error line begins.
HEADER, FOOTER, ERROR = "===== SENSOR READINGS =====", "============================", "Error:"


def line_role(line) -> Column:
    """What a line is in a frame: header, footer, error, reading or other."""
    c = strip(line)
    return (F.when(c == HEADER, "header").when(c == FOOTER, "footer").when(c.startswith(ERROR), "error")
            .when(line_kind(c).isNotNull(), "reading").otherwise("other"))


def _number_after_colon(line: Column, unit: str | None) -> Column:
    part = F.try_element_at(F.split(line, ":"), F.lit(2))
    if unit:
        part = F.replace(part, F.lit(unit), F.lit(""))
    return F.regexp_extract(part, NUMBER, 1).try_cast("double")


def line_value(line) -> Column:
    """G2 + G3: the number after the first ':' with the kind's unit removed, as a
    double (a malformed number gives NULL = the line is rejected; ``nan`` parses
    to NaN and is kept).  Soil moisture is calibrated raw / 4095 * 100."""
    c = col_(line)
    out = None
    for needle, kind, unit in KIND_RULES:
        v = _number_after_colon(c, unit)
        if kind == "soil_moisture":
            v = calibrate_moisture(v)
        out = F.when(c.contains(needle), v) if out is None else out.when(c.contains(needle), v)
    return out


def calibrate_moisture(raw) -> Column:
    """12-bit ADC reading -> percent."""
    return col_(raw) / F.lit(ADC_FULL_SCALE) * F.lit(100.0)


def parse_status(kind: Column, value: Column) -> Column:
    """'ok' (kind and number), 'rejected' (kind but no number), 'ignored' (no kind)."""
    return (F.when(kind.isNull(), F.lit("ignored"))
            .when(value.isNull(), F.lit("rejected")).otherwise(F.lit("ok")))
