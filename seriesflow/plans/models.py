"""Model layer (L1-L9, N5, A6-A9) on Spark ML and the library's histogram trees.

The recommendation model is a small bundle: label maps and scaler parameters
as tables, a fitted forest (Spark ML's, or the library's own), and a one-row manifest.  Fitting and
scoring are DataFrame-in / DataFrame-out; scoring works the same on a batch or
a stream (every step is a stateless projection or a join with small tables).
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesflow.operators import encode, scale, split, stats, trees
from seriesflow.session import cut_lineage

# Fixed values of the reference's model configurations.
FOREST = dict(numTrees=150, maxDepth=10, seed=42)
FOREST_OWN = dict(n_trees=150, max_depth=10, min_split=2, min_leaf=1, seed=42)  # FOREST on the library's trees
FOREST_CUSTOM = dict(n_trees=300, max_depth=12, min_split=4, min_leaf=2, seed=42)
GRID = dict(n_trees=[100, 200, 300], max_depth=[8, 10, 12, None], min_split=[2, 4, 6], min_leaf=[1, 2, 3])
BOOST = dict(rounds=2000, rate=0.01, max_depth=10, subsample=0.8, per_tree=0.8, per_level=0.8, l1=0.1, l2=0.1, patience=100, seed=42)
PARTS = ("model", "label_map", "scaler", "manifest")


@dataclass
class Recommender:
    """Fitted classifier bundle (A6): everything scoring needs, as Spark objects."""
    model: RandomForestClassificationModel | trees.Forest
    label_map: DataFrame           # (column, value, code) for features and target
    scaler: DataFrame              # (column, kind, center, scale)
    features: list[str]
    categorical: list[str]
    target: str
    extra: dict = field(default_factory=dict)

    def save(self, path: str) -> None:
        """The model + parquet parameter tables + one-row manifest."""
        spark = self.label_map.sparkSession
        own = isinstance(self.model, trees.Forest)
        if own:
            cuts = spark.createDataFrame([(self.model.cuts, self.model.weights)], "cuts array<array<double>>, weights array<double>")
            cuts.write.mode("overwrite").parquet(os.path.join(path, "model", "cuts"))
            self.model.trees.write.mode("overwrite").parquet(os.path.join(path, "model", "trees"))
        else:
            self.model.write().overwrite().save(os.path.join(path, "model"))
        self.label_map.write.mode("overwrite").parquet(os.path.join(path, "label_map"))
        self.scaler.write.mode("overwrite").parquet(os.path.join(path, "scaler"))
        manifest(spark, self.features, self.categorical, self.target, own_forest=own).write.mode(
            "overwrite").parquet(os.path.join(path, "manifest"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Recommender":
        """A7 + A8: check every part exists (naming the missing one), then load."""
        missing = [p for p in PARTS if not _exists(spark, os.path.join(path, p))]
        if missing:
            raise FileNotFoundError(f"missing required artifact part(s): {', '.join(missing)} under {path}")
        m = spark.read.parquet(os.path.join(path, "manifest")).first()
        if m["own_forest"]:
            held = spark.read.parquet(os.path.join(path, "model", "cuts")).first()
            model = trees.Forest([list(c) for c in held["cuts"]], list(held["weights"]), spark.read.parquet(os.path.join(path, "model", "trees")))
        else:
            model = RandomForestClassificationModel.load(os.path.join(path, "model"))
        return Recommender(
            model=model,
            label_map=spark.read.parquet(os.path.join(path, "label_map")),
            scaler=spark.read.parquet(os.path.join(path, "scaler")),
            features=list(m["features"]), categorical=list(m["categorical"]), target=m["target"])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def manifest(spark: SparkSession, features, categorical, target, **info) -> DataFrame:
    """One-row training manifest (feature lists, counts, training time, and whatever ``info`` adds)."""
    row = [(list(features), list(categorical), target, len(features))]
    df = spark.createDataFrame(row, "features array<string>, categorical array<string>, "
                                    "target string, n_features int")
    return df.withColumns({k: F.lit(v) for k, v in info.items()}).withColumn("trained_at", F.current_timestamp())


def fit_recommender(df: DataFrame, features: list[str], categorical: list[str], target: str,
                    balanced: bool = True, **forest) -> Recommender:
    """L1 / L2: encode (sorted-value codes) -> standard-scale every feature (codes
    included) -> balanced class weights -> random forest."""
    params = {**FOREST, **forest}
    lmap, _ = encode.small_map(encode.fit_label_map(df, categorical + [target]))
    enc = encode.encode(df, lmap, categorical + [target], mode="strict").persist()
    sc = scale.fit_scaler(enc, features, "standard")
    sc = df.sparkSession.createDataFrame(sc.collect(), sc.schema)  # one row per feature
    scaled = scale.apply_scaler(enc, sc, features)
    data = VectorAssembler(inputCols=features, outputCol="features",
                           handleInvalid="keep").transform(scaled)
    kw = {}
    if balanced:
        data = stats.with_class_weights(data, target, "weight")
        kw["weightCol"] = "weight"
    rf = RandomForestClassifier(featuresCol="features", labelCol=target, **kw, **params)
    try:
        model = rf.fit(data)
    finally:
        enc.unpersist()
    return Recommender(model, lmap, sc, list(features), list(categorical), target)


def score(rec: Recommender, df: DataFrame, keep: list[str] = (), constants: dict | None = None,
          label_out: str = "recommendation") -> DataFrame:
    """Safe-encode -> add missing features as 0 -> scale -> predict -> decode
    the class label.  Works on any number of rows, batch or streaming."""
    x = df.withColumns({k: F.lit(v) for k, v in (constants or {}).items()})
    x = encode.encode(x, rec.label_map, [c for c in rec.categorical if c in x.columns], mode="safe",
                      suffix="__c")
    enc = {c: (f"{c}__c" if c in rec.categorical else c) for c in rec.features}
    # A feature absent from the input is added as 0; B5: training order
    x = x.withColumns({f"{c}__f": (F.col(e) if e in x.columns else F.lit(0.0)).cast("double")
                       for c, e in enc.items()})
    fcols = [f"{c}__f" for c in rec.features]
    prm = rec.scaler.withColumn("column", F.concat(F.col("column"), F.lit("__f")))
    x = scale.apply_scaler(x, prm, fcols)
    if isinstance(rec.model, trees.Forest):
        pred = rec.model.transform(x, fcols)
    else:
        x = VectorAssembler(inputCols=fcols, outputCol="features", handleInvalid="keep").transform(x)
        pred = rec.model.transform(x).withColumn("prediction", F.col("prediction").cast("int"))
    return encode.decode(pred, rec.label_map, "prediction", label_out, rec.target).select(*keep, "prediction", label_out)


def _class_table(df: DataFrame, features, categorical, target, keys, folds: int, seed: int):
    """Label map, scaler, cut points and the binned table (rid, row, y, fold, bins) of a classification frame, which is made once."""
    df = df.select(*dict.fromkeys([*keys, *features, *categorical, target])).persist()
    lmap, _ = encode.small_map(encode.fit_label_map(df, categorical + [target]))
    enc = encode.encode(df, lmap, categorical + [target], mode="strict")
    sc = scale.fit_scaler(enc, features, "standard")
    sc = df.sparkSession.createDataFrame(sc.collect(), sc.schema)  # one row per feature
    scaled = scale.apply_scaler(enc, sc, features)
    cuts = trees.find_cuts(scaled, features)
    keep = {"rid": F.xxhash64(*keys), "row": F.monotonically_increasing_id(), "y": F.col(target).cast("int"),
            "fold": split.hash_bucket(keys, seed, folds)}
    table = cut_lineage(trees.bin_rows(scaled, features, cuts, keep))
    df.unpersist()
    return lmap, sc, cuts, table


def fit_custom_forest(df: DataFrame, features: list[str], categorical: list[str], target: str, keys: Sequence[str], n_trees: int,
                      max_depth: int | None, min_split: int, min_leaf: int, seed: int = 42) -> Recommender:
    """L2: a balanced forest with every stopping rule: depth, minimum rows to split a node and minimum rows in a leaf."""
    lmap, sc, cuts, table = _class_table(df, features, categorical, target, keys, 1, seed)
    counts = {r["y"]: r["count"] for r in table.groupBy("y").count().collect()}  # one row a class
    weights = [sum(counts.values()) / (len(counts) * counts.get(c, 1)) for c in range(max(counts, default=-1) + 1)]
    spec = trees.forest_growth(len(features), weights, max_depth, min_split, min_leaf, seed)
    grown = trees.forest_trees(table, trees.Bootstrap(len(weights), seed), spec, range(n_trees))
    return Recommender(trees.Forest(cuts, weights, grown), lmap, sc, list(features), list(categorical), target)


def grid_search(df: DataFrame, features, categorical, target, keys: Sequence[str], grid: dict | None = None, folds: int = 3, seed: int = 42) -> DataFrame:
    """L3: cross-validated grid over forest settings, scored by accuracy; folds by the hash of ``keys``.
    Classes weigh alike in each fold's training part, as in the forests of L1 and L2.
    Returns one row per setting with its mean accuracy, best first."""
    g = grid or GRID
    *_, table = _class_table(df, features, categorical, target, keys, folds, seed)
    n_classes = (table.agg(F.max("y")).first()[0] or 0) + 1
    out = trees.grid_accuracy(table, n_classes, len(features), folds, g["n_trees"], g["max_depth"], g["min_split"], g["min_leaf"], seed)
    return out.orderBy(F.col("accuracy").desc(), "n_trees", F.col("max_depth").asc_nulls_last(), "min_split", "min_leaf")


def fit_boosted(train: DataFrame, features: list[str], label: str, valid_col: str | None = None, keys: Sequence[str] = (), **params) -> trees.Boosted:
    """L4: gradient-boosted trees; with ``valid_col`` the rounds up to the best one on
    the validation rows are kept (``patience`` rounds without a better one end the search)."""
    return trees.fit_boosting(train, features, label, valid_col, keys, **{**BOOST, **params})


def feature_importances(model: trees.Boosted, top: int = 15) -> DataFrame:
    """L7 + I4: importances by feature name, top ``top`` descending."""
    df = SparkSession.getActiveSession().createDataFrame(list(zip(model.features, model.importances())), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature")).limit(top)


def fit_sequence_regressor(train: DataFrame, label: str = "y", reg_param: float = 0.01) -> LinearRegression:
    """L5 re-aimed: the flattened window (a Vector of w x features) -> next value."""
    lr = LinearRegression(featuresCol="x_vec", labelCol=label, regParam=reg_param,
                          elasticNetParam=0.0)
    return lr.fit(train)


def rmse(df: DataFrame, label: str, pred: str = "prediction") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=pred, metricName="rmse").evaluate(df)
