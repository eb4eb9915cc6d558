"""Evaluation metrics (M1-M9) as aggregations.

Regression metrics are one pass: R^2 uses ``n * var_pop(y)`` (Welford-stable)
as the total sum of squares.  Classification metrics start from the long
confusion table ``(actual, predicted, n)`` (one aggregate, partial per task);
per-class precision / recall / F1 and the weighted averages are aggregates
over that table, whose size is bounded by (#classes)^2.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Confusion cells that may come to the driver (a few MB).
MOST_CELLS = 100_000


def regression_metrics(df: DataFrame, y: str, p: str, keys: Sequence[str] = ()) -> DataFrame:
    """M1-M4: rmse, mae, r2, mape (%) and n over rows with both values.  MAPE skips rows with a zero actual."""
    both = F.col(y).isNotNull() & F.col(p).isNotNull()
    yc, pc = F.when(both, F.col(y)), F.when(both, F.col(p))
    err = yc - pc
    aggs = [F.count(err).alias("n"),
            F.sqrt(F.avg(err * err)).alias("rmse"),
            F.avg(F.abs(err)).alias("mae"),
            (F.lit(1.0) - F.sum(err * err) / F.nullif(F.count(yc) * F.var_pop(yc), F.lit(0.0))).alias("r2"),
            (F.avg(F.abs(F.try_divide(err, yc))) * F.lit(100.0)).alias("mape")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def confusion_counts(df: DataFrame, actual: str, predicted: str, local: bool = True) -> DataFrame:
    """Non-zero confusion cells - one aggregate over the input (partial per task).

    By default up to ``MOST_CELLS`` rows are brought back once and kept as a small
    local table, which every later branch of a report (per class, averages,
    accuracy) reads instead of the input; with more cells it stays distributed."""
    cm = (df.groupBy(F.col(actual).cast("string").alias("actual"),
                     F.col(predicted).cast("string").alias("predicted"))
          .agg(F.count(F.lit(1)).alias("n")))
    if not local:
        return cm
    cells = cm.limit(MOST_CELLS + 1).collect()
    if len(cells) > MOST_CELLS:
        return cm
    return df.sparkSession.createDataFrame(cells, "actual string, predicted string, n bigint")


def confusion_matrix(df: DataFrame, actual: str, predicted: str,
                     labels: list | None = None) -> DataFrame:
    """M8: every (actual, predicted) cell over the sorted class list, zeros kept.

    The m x m grid is two ``explode`` of the (bounded) class list taken from
    the non-zero counts - no driver round trip, no cross join - then
    left-joined with those counts; the input is read once."""
    counts = confusion_counts(df, actual, predicted)
    if labels is not None:
        lab = df.sparkSession.createDataFrame([(list(labels),)], "labels array<string>")
    else:
        # the class list from the counts themselves (one row, bounded by #classes)
        lab = counts.select(F.explode(F.array("actual", "predicted")).alias("c")).agg(
            F.sort_array(F.collect_set("c")).alias("labels"))
    grid = (lab.select(F.explode("labels").alias("actual"), "labels")
            .select("actual", F.explode("labels").alias("predicted")))
    return (grid.join(counts, ["actual", "predicted"], "left")
            .withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("bigint")))


def _accuracy(cm: DataFrame) -> DataFrame:
    """Accuracy and row count from the confusion counts (one row)."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    return cm.agg((F.sum(hit) / F.sum("n")).alias("accuracy"), F.sum("n").cast("bigint").alias("n"))


def _class_rows(confusion: DataFrame) -> DataFrame:
    """M7 rows: precision, recall, F1, support per class (0 on zero division).

    One aggregate: every cell (a, p, n) counts n as support of a, as a
    prediction of p, and as a true positive when a = p."""
    n = F.col("n")
    roles = F.explode(F.array(
        F.struct(F.col("actual").alias("label"), n.alias("sup"),
                 F.when(F.col("actual") == F.col("predicted"), n).otherwise(F.lit(0)).alias("tp"),
                 F.lit(0).cast("bigint").alias("npred")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("sup"),
                 F.lit(0).cast("bigint").alias("tp"), n.alias("npred"))))
    t = (confusion.select(roles.alias("r")).select("r.*").groupBy("label")
         .agg(F.sum("sup").alias("support"), F.sum("tp").alias("tp"), F.sum("npred").alias("n_pred")))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_pred")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    t = t.withColumns({"precision": prec, "recall": rec})
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    return t.withColumn("f1", f1).select("label", "precision", "recall", "f1", F.col("support").cast("bigint").alias("support"), "tp")


def per_class(confusion: DataFrame) -> DataFrame:
    """label, precision, recall, f1, support: one row per class that occurs or is predicted."""
    return _class_rows(confusion).drop("tp")


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """M7: per-class rows plus 'accuracy', 'macro avg' and 'weighted avg' rows, all
    from one confusion-count aggregate (every branch reuses its exchange)."""
    cm = confusion_counts(df, actual, predicted)
    pc = per_class(cm)
    tot = F.sum("support")
    macro = pc.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                   F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                   tot.alias("support"))
    weighted = pc.agg(F.lit("weighted avg").alias("label"),
                      (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                      (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                      (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"),
                      tot.alias("support"))
    a = _accuracy(cm)
    acc = a.select(F.lit("accuracy").alias("label"), F.col("accuracy").alias("precision"),
                   F.col("accuracy").alias("recall"), F.col("accuracy").alias("f1"),
                   F.col("n").alias("support"))
    return pc.unionByName(acc).unionByName(macro).unionByName(weighted)


def classification_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """M5 + M6 + M9: accuracy and support-weighted precision / recall / F1 in one row, one aggregate over the class rows."""
    tot = F.sum("support")
    return _class_rows(confusion_counts(df, actual, predicted)).agg(
        (F.sum("tp") / tot).alias("accuracy"), tot.cast("bigint").alias("n"),
        *[(F.sum(F.col(c) * F.col("support")) / tot).alias(c) for c in ("precision", "recall", "f1")])
