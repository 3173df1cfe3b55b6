"""Evaluation metrics as DataFrame aggregates.

Each metric is a grouped aggregate, so one job scores many groups at once
(folds, parameter sets, segments): ``by=("fold",)`` etc.

``auc`` is the exact area under ROC (rank statistic, tied scores count
one half), computed without a global sort or a single-task window:

1. rows → distinct (group, score) with positive / negative counts
   (partial aggregation before the shuffle, so a score value that holds a
   third of all rows is one row after the map side); this table is
   checkpointed to the shared checkpoint folder, so the input (often a
   model's predictions) is computed exactly once and the later branches
   re-read a small table instead of re-running its lineage;
2. they are range-partitioned by (group, score) into ``buckets`` ranges of
   about equal size, whatever the groups' sizes and wherever their scores lie
   (a group with scores in a narrow band is cut there as finely as any);
3. running negative count inside each (range, group) by a window, summed up
   there; the ranges before a group's own add an offset, from a table of at
   most #groups + #ranges rows.

The float-returning ``evaluate`` wraps Spark's own evaluators.
"""

from __future__ import annotations

from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                   MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def regression_metrics(df: DataFrame, label: str | Column = "label",
                       prediction: str | Column = "prediction", by=()) -> DataFrame:
    """``n, mse, rmse, mae`` per group (``n`` = rows with both a label and a
    prediction, the rows the averages run over)."""
    err = _c(prediction).cast("double") - _c(label).cast("double")
    mse = F.avg(err * err)
    return df.groupBy(*by).agg(F.count(err).alias("n"), mse.alias("mse"),
                               F.sqrt(mse).alias("rmse"), F.avg(F.abs(err)).alias("mae"))


def accuracy(df: DataFrame, label: str | Column = "label",
             prediction: str | Column = "prediction", by=()) -> DataFrame:
    """``n, accuracy, test_error`` per group (over rows with both values)."""
    same = (_c(label).cast("double") == _c(prediction).cast("double")).cast("double")
    hit = F.avg(same)
    return df.groupBy(*by).agg(F.count(same).alias("n"), hit.alias("accuracy"),
                               (F.lit(1.0) - hit).alias("test_error"))


def auc(df: DataFrame, label: str | Column = "label", score: str | Column = "score",
        by=(), buckets: int | None = None) -> DataFrame:
    """Exact area under the ROC curve per group (``auc`` column).

    ``label`` is 1 for positives, 0 for negatives; ``score`` any double
    (higher = more positive). Groups with no positives or no negatives give
    NULL.
    """
    by = list(by)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    nb = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = df.select(*by, _c(score).cast("double").alias("_s"),
                  _c(label).cast("double").alias("_y"))
    # only scored, labelled rows can be ranked
    s = s.where(F.col("_s").isNotNull() & F.col("_y").isNotNull())
    d = s.groupBy(*by, "_s").agg(F.sum("_y").alias("_pos"), F.sum(F.lit(1.0) - F.col("_y")).alias("_neg"))
    order = [F.col(c) for c in by] + [F.col("_s")]
    # the range of a row is fixed by the checkpoint: its partition number is not computed again
    d = d.repartitionByRange(nb, *order).withColumn("_p", F.spark_partition_id()).checkpoint(eager=True)
    below = Window.partitionBy("_p", *by).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_below", F.coalesce(F.sum("_neg").over(below), F.lit(0.0)))
    parts = d.groupBy("_p", *by).agg(
        F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"),
        F.sum(F.col("_pos") * (F.col("_below") + F.lit(0.5) * F.col("_neg"))).alias("_inner"))
    # a group has a row for each range it reaches into
    earlier = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_off", F.coalesce(F.sum("_neg").over(earlier), F.lit(0.0)))
    num = F.sum(F.col("_inner") + F.col("_pos") * F.col("_off"))
    den = F.sum("_pos") * F.sum("_neg")
    return parts.groupBy(*by).agg(F.when(den > 0, num / den).alias("auc"))


def evaluate(predictions: DataFrame, metric: str, label: str = "label",
             prediction: str = "prediction", raw: str = "rawPrediction") -> float:
    """Spark evaluator by metric name: areaUnderROC / areaUnderPR, accuracy /
    f1 / weightedPrecision ..., rmse / mse / r2 / mae."""
    return evaluator(metric, label, prediction, raw).evaluate(predictions)


def evaluator(metric: str, label: str = "label", prediction: str = "prediction",
              raw: str = "rawPrediction"):
    if metric in ("areaUnderROC", "areaUnderPR"):
        return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw,
                                             metricName=metric, numBins=0)
    if metric in ("rmse", "mse", "r2", "mae", "var"):
        return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName=metric)
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                             metricName=metric)
