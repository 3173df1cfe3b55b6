"""Parameter grids, k-fold cross-validation and its report.

``cross_validate`` persists the training rows once (every fold fit and
evaluation re-reads them) and fits the grid in parallel threads; with a
``fold_col`` (see ``split.key_folds``) the folds are a pure function of
the key, so the result does not depend on partitioning. The best model is
picked in the evaluator's own direction (``isLargerBetter``).
Indexers that are not tuned belong outside the CV (see
``supervised.fit_preprocessing``): applied once, not per fold and grid point.
"""

from __future__ import annotations

from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, StringType,
                               StructField, StructType)

from ..session import held


def param_grid(estimator, **lists) -> list[dict]:
    """``param_grid(dt, maxDepth=[3,4,5], maxBins=[10,20,30])`` → cartesian grid."""
    b = ParamGridBuilder()
    for name, values in lists.items():
        b = b.addGrid(estimator.getParam(name), list(values))
    return b.build()


def cross_validate(estimator, grid: list[dict], evaluator, train: DataFrame, k: int = 3,
                   seed: int = 0, fold_col: str | None = None,
                   parallelism: int = 3) -> CrossValidatorModel:
    """k-fold CV. ``parallelism`` = grid points fitted at once; every fit is
    itself a distributed job using all cores, so a few concurrent fits
    fill the gaps between its small per-level stages while many oversubscribe
    the executors (measured on local[8]: 3 → 20 s, 8 → 27 s, 1 → 34 s)."""
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator,
                        numFolds=k, seed=seed, parallelism=parallelism)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    with held(train) as rows:
        return cv.fit(rows)


REPORT = StructType([StructField("grid_id", IntegerType()), StructField("params", StringType()),
                      StructField("avg_metric", DoubleType()),
                      StructField("std_metric", DoubleType()),
                      StructField("is_best", BooleanType())])


def cv_report(spark: SparkSession, cv_model: CrossValidatorModel) -> DataFrame:
    """One row per parameter map: ``grid_id, params, avg_metric, std_metric,
    is_best`` (best respects the metric's direction)."""
    maps = cv_model.getEstimatorParamMaps()
    avg = list(cv_model.avgMetrics)
    std = list(cv_model.stdMetrics) if cv_model.stdMetrics else [float("nan")] * len(avg)
    larger = cv_model.getEvaluator().isLargerBetter()
    best = max(range(len(avg)), key=lambda i: avg[i] if larger else -avg[i])
    rows = []
    for i, (m, a, s) in enumerate(zip(maps, avg, std)):
        p = ", ".join(f"{k.name}={v}" for k, v in sorted(m.items(), key=lambda kv: kv[0].name))
        rows.append((i, p, float(a), float(s), i == best))
    return spark.createDataFrame(rows, REPORT)

