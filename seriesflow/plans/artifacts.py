"""Versioned artifacts (A6-A9): parts first, manifest last; readers take the newest complete version.

A version is a folder of Parquet tables under the artifact's root. Its manifest
is written when all its parts are, so a version without one is being written or
was given up, and nobody reads it. Nothing is overwritten: a reader of the last
version is never disturbed, and a job that is run again publishes a new one.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from seriesflow.operators import encode, scale, trees
from seriesflow.operators.forecast import linear_prediction

_MANIFEST = "manifest"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _file_system(spark, path)
    return fs.exists(p)


def publish(root: str, parts: Mapping[str, DataFrame], manifest: DataFrame) -> str:
    """Write a new version under ``root``; returns its folder."""
    path = os.path.join(root, f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")
    for name, df in parts.items():
        df.write.parquet(os.path.join(path, name))
    (manifest.withColumns({"parts": F.lit(list(parts)), "published_at": F.current_timestamp()}).coalesce(1)
     .write.parquet(os.path.join(path, _MANIFEST)))
    return path


def newest(spark: SparkSession, root: str) -> str | None:
    """The newest complete version, or None."""
    fs, p, _ = _file_system(spark, root)
    if not fs.exists(p):
        return None
    names = sorted((s.getPath().getName() for s in fs.listStatus(p)), reverse=True)
    return next((os.path.join(root, n) for n in names if n.startswith("v") and exists(spark, os.path.join(root, n, _MANIFEST, "_SUCCESS"))), None)


def read(spark: SparkSession, path: str, wanted: Sequence[str]) -> tuple[Row, dict[str, DataFrame]]:
    """The manifest and the wanted parts of a version; a missing part is an error that names it."""
    missing = [n for n in (*wanted, _MANIFEST) if not exists(spark, os.path.join(path, n))]
    if missing:
        raise FileNotFoundError(f"missing required artifact part(s): {', '.join(missing)} under {path}")
    return (spark.read.parquet(os.path.join(path, _MANIFEST)).first(), {n: spark.read.parquet(os.path.join(path, n)) for n in wanted})


PARTS = ("price_model", "demand_model", "demand_trees", "label_map", "scalers")


@dataclass
class Forecaster:
    """All that a forecast needs of its training: both models, their features in order, the window, the encoders and the scalers."""
    price_weights: list[float]
    price_intercept: float
    price_features: list[str]
    window: int
    demand: trees.Boosted
    label_map: DataFrame         # (column, value, code)
    scalers: DataFrame           # (column, kind, center, scale)
    n_rows: int

    def predict_price(self):
        """The next price from a window of features, as ``recursive_window_forecast`` wants it."""
        return linear_prediction(self.price_weights, self.price_intercept)

    def save(self, root: str) -> str:
        """A6 + A9: publish a version: models, encoders, scalers, and a manifest of both feature lists, window and input shape."""
        spark, b = self.label_map.sparkSession, self.demand
        price = spark.createDataFrame([(self.price_weights, self.price_intercept)], "weights array<double>, intercept double")
        demand = spark.createDataFrame([(b.cuts, b.base, b.rate, b.quality.l1, b.quality.l2, b.quality.unit, b.errors)],
                                       "cuts array<array<double>>, base double, rate double, l1 double, l2 double, unit double, errors array<double>")
        names = [f.split()[0] for f in trees.TREE_FIELDS.split(", ")]
        held = trees.pa.table([trees.pa.array(range(len(b.trees)), trees.pa.int32()), *trees.tree_arrays(b.trees)], names=["round", *names])
        manifest = spark.createDataFrame(
            [(self.price_features, b.features, self.window, [self.window, len(self.price_features)], self.n_rows, len(b.trees), len(b.errors))],
            "price_features array<string>, demand_features array<string>, window int, input_shape array<int>, n_rows long, rounds int, rounds_tried int")
        return publish(root, {"price_model": price, "demand_model": demand, "demand_trees": spark.createDataFrame(held),
                              "label_map": self.label_map, "scalers": self.scalers}, manifest)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Forecaster":
        """A7 + A8: a version as it was saved."""
        m, parts = read(spark, path, PARTS)
        price, d = parts["price_model"].first(), parts["demand_model"].first()
        grown = trees.trees_of(parts["demand_trees"].orderBy("round").toArrow())
        demand = trees.Boosted(list(m["demand_features"]), [list(c) for c in d["cuts"]], d["base"], d["rate"],
                               trees.Penalised(d["l1"], d["l2"], d["unit"]), grown, list(d["errors"]))
        return Forecaster(list(price["weights"]), price["intercept"], list(m["price_features"]), m["window"], demand, parts["label_map"], parts["scalers"], m["n_rows"])

    @staticmethod
    def load_or_fit(spark: SparkSession, root: str, fit) -> "Forecaster":
        """The newest complete version; without one, ``fit()`` is called and published first."""
        path = newest(spark, root)
        return Forecaster.load(spark, path or fit().save(root))


def encoders_and_scalers(df: DataFrame, categorical: Sequence[str], measures: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """D1 + D5 + D6: the label map of the categorical columns and both scalers' parameters of the measures."""
    label_map, _ = encode.small_map(encode.fit_label_map(df, list(categorical)))
    parts = scale.fit_scalers(df, list(measures))
    return label_map, parts["minmax"].unionByName(parts["standard"])
