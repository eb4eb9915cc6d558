"""Base frames derived from the driver tables.

* ``daily``  - orders -> one row per (priority ``k``, day ``d``): demand, n, price.
* ``gappy``  - events -> per-user series with missing values (v NULL when value <= 20).
* ``lines``  - events -> sensor text lines (device, event time, seq, line).
* ``naive_*`` - naive predictions for the metric operators.

Every frame is a lazy plan over a parquet scan, so its work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesflow.functions.text import FOOTER, HEADER
from seriesflow.operators.windows import series_window
from seriesflow.sources.tables import read_table

DAILY_KEYS = ["k"]
DAILY_ORDER = ["d"]
GAPPY_KEYS = ["user_id"]
GAPPY_ORDER = ["ts", "event_id"]
LINE_KEYS = ["device_id"]
LINE_ORDER = ["event_ts", "seq"]


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimal sum keeps the demand total independent of summation order.
    The aggregate is partial per task, so the shuffle carries at most
    (#priorities x #days) rows per task whatever the size of ``orders``."""
    o = read_table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("k"),
                      F.to_date("o_orderdate").alias("d"))
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("demand"),
                 F.count(F.lit(1)).alias("n"))
            .withColumn("price", F.col("demand") / F.col("n")))


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select("user_id", "event_id", "ts",
                    F.when(F.col("value") > 20, F.col("value")).alias("v"))


# The sensor line grammar of the device feed (one reading per line).
LINE_TEMPLATES = {
    0: "DHT11 Temperature: {} °C",
    1: "DHT11 Humidity: {} %",
    2: "DS18B20 Temperature: {} °C",
    3: "Soil Moisture Value: {}",
    4: "Error: DS18B20 not detected!",
}


def lines(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Sensor lines: the reading kind rotates with ``event_id``; every event becomes a line.
    ``tasks``: events are dealt to so many tasks first, as one task reads a file's whole row group."""
    e = read_table(spark, sf_dir, "events")
    if tasks:
        e = e.select("user_id", "ts", "event_id", "value").repartition(tasks, "event_id")
    v2 = F.format_string("%.2f", F.col("value"))
    raw = (F.floor(F.col("value") * 8).cast("int") % 4096).cast("string")
    kind = F.col("event_id") % 5
    line = (F.when(kind == 0, F.concat(F.lit("DHT11 Temperature: "), v2, F.lit(" °C")))
            .when(kind == 1, F.concat(F.lit("DHT11 Humidity: "), v2, F.lit(" %")))
            .when(kind == 2, F.concat(F.lit("DS18B20 Temperature: "), v2, F.lit(" °C")))
            .when(kind == 3, F.concat(F.lit("Soil Moisture Value: "), raw))
            .otherwise(F.lit(LINE_TEMPLATES[4])))
    return e.select(F.col("user_id").alias("device_id"), F.col("ts").alias("event_ts"),
                    F.col("event_id").alias("seq"), line.alias("line"))


def framed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full feed of a device: every event is one frame of an optional error line, header, readings and footer;
    a header is lost where the id divides by 11, a footer where it divides by 13, a reading where the sensor failed."""
    e = read_table(spark, sf_dir, "events")
    i, v2 = F.col("event_id"), F.format_string("%.2f", F.col("value"))
    raw = (F.floor(F.col("value") * 8).cast("int") % 4096).cast("string")
    failed = i % 5 == 4
    text = [F.when(failed, F.lit(LINE_TEMPLATES[4])), F.when(i % 11 != 0, F.lit(HEADER)), F.concat(F.lit("DHT11 Temperature: "), v2, F.lit(" °C")),
            F.concat(F.lit("DHT11 Humidity: "), v2, F.lit(" %")), F.when(~failed, F.concat(F.lit("DS18B20 Temperature: "), v2, F.lit(" °C"))),
            F.concat(F.lit("Soil Moisture Value: "), raw), F.when(i % 13 != 0, F.lit(FOOTER))]
    parts = F.filter(F.array(*[F.struct((i * 10 + k).alias("seq"), t.alias("line")) for k, t in enumerate(text)]), lambda x: x["line"].isNotNull())
    return e.select(F.col("user_id").alias("device_id"), F.col("ts").alias("event_ts"), F.explode(parts).alias("p")).select("device_id", "event_ts", "p.*")


def naive_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``daily`` with ``pred`` = previous day's demand of the same series."""
    d = daily(spark, sf_dir)
    w = series_window(DAILY_KEYS, DAILY_ORDER)
    return d.withColumn("pred", F.lag("demand", 1).over(w)).filter(F.col("pred").isNotNull())


def naive_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with ``pred`` = the customer's previous order priority (bucketed
    lag: a customer with a third of all orders is still spread over tasks)."""
    from seriesflow.operators.windows import lag_one
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", F.col("o_orderpriority").alias("actual"))
    out = lag_one(o, "actual", ["o_custkey"], ["o_orderdate", "o_orderkey"],
                  F.date_trunc("month", "o_orderdate"), out="predicted")
    return out.filter(F.col("predicted").isNotNull())
