"""Supervised learners: decision trees, logistic regression, GLMs.

Builders return MLlib estimators / pipelines; reports turn fitted models
into small DataFrames (bounded by the number of coefficients or tree
parameters, never by the data).

Classification pipelines follow the reference's shape — label indexer,
vector indexer, learner, label decoder — with its defects fixed: the
label indexer is fitted on the training rows, metrics are computed in indexed-label space, and
regression never decodes its predictions as class labels.
"""

from __future__ import annotations

from pyspark.errors import UnsupportedOperationException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassificationModel,
                                       DecisionTreeClassifier, LogisticRegression)
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.regression import (DecisionTreeRegressionModel, DecisionTreeRegressor,
                                   GeneralizedLinearRegression,
                                   GeneralizedLinearRegressionModel)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..session import ensure_checkpoint_dir, held
from .features import vector_indexer


def fit_spread(estimator, df: DataFrame, cols: list[str] | None = None):
    """Fit an iterative estimator on a persisted copy of just the columns it
    reads (see ``session.held``); released after the fit."""
    with held(df, cols) as x:
        return estimator.fit(x)


def fit_with_summary(estimator, df: DataFrame, report, cols: list[str] | None = None):
    """Fit, then build an eager report from the fitted model while the
    training rows are still persisted (GLM summary statistics — deviances,
    AIC, standard errors — re-read the training data lazily)."""
    with held(df, cols) as x:
        model = estimator.fit(x)
        return model, report(model)


def tree_classifier(label: str = "indexedLabel", features: str = "indexedFeatures",
                    max_depth: int = 5, max_bins: int = 32, impurity: str = "gini",
                    seed: int = 0, cache_node_ids: bool = False,
                    checkpoint_interval: int = 10, leaf_col: str = "") -> DecisionTreeClassifier:
    """``cache_node_ids`` (with checkpoints every ``checkpoint_interval``
    levels in the shared checkpoint folder) pays off for deep trees only.
    ``leaf_col`` names a column for the number of the leaf a row ends in."""
    if cache_node_ids:
        ensure_checkpoint_dir(SparkSession.active())
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, maxDepth=max_depth,
                                  maxBins=max_bins, impurity=impurity, seed=seed,
                                  cacheNodeIds=cache_node_ids, leafCol=leaf_col,
                                  checkpointInterval=checkpoint_interval)


def tree_regressor(label: str = "label", features: str = "indexedFeatures",
                   max_depth: int = 5, max_bins: int = 32, seed: int = 0,
                   cache_node_ids: bool = False,
                   checkpoint_interval: int = 10, leaf_col: str = "") -> DecisionTreeRegressor:
    if cache_node_ids:
        ensure_checkpoint_dir(SparkSession.active())
    return DecisionTreeRegressor(labelCol=label, featuresCol=features, maxDepth=max_depth,
                                 maxBins=max_bins, seed=seed, cacheNodeIds=cache_node_ids,
                                 leafCol=leaf_col, checkpointInterval=checkpoint_interval)


def logistic(label: str = "indexedLabel", features: str = "indexedFeatures",
             max_iter: int = 10, reg_param: float = 0.3,
             elastic_net: float = 0.8) -> LogisticRegression:
    return LogisticRegression(labelCol=label, featuresCol=features, maxIter=max_iter,
                              regParam=reg_param, elasticNetParam=elastic_net)


def glm(family: str = "gaussian", link: str = "identity", label: str = "label",
        features: str = "features", max_iter: int = 10,
        reg_param: float = 0.3) -> GeneralizedLinearRegression:
    return GeneralizedLinearRegression(family=family, link=link, labelCol=label,
                                       featuresCol=features, maxIter=max_iter,
                                       regParam=reg_param)


def classification_pipeline(learner, train: DataFrame, label: str = "label",
                            features: str = "features", max_categories: int = 4,
                            decode: bool = True, handle_invalid: str = "error") -> Pipeline:
    """[label indexer (fitted on ``train``), vector indexer, learner, decoder].

    The learner must read ``indexedLabel`` / ``indexedFeatures``. The label
    indexer is fitted once here so the decoder knows the labels. A label
    never seen in ``train`` raises (``handle_invalid='error'``); 'keep'
    would add an extra class, which binary metrics cannot score."""
    label_model = StringIndexer(inputCol=label, outputCol="indexedLabel",
                                handleInvalid=handle_invalid).fit(train)
    stages = [label_model, _fitted_vector_indexer(train, features, max_categories), learner]
    if decode:
        stages.append(IndexToString(inputCol="prediction", outputCol="predictedLabel",
                                    labels=list(label_model.labels)
                                    + (["__unseen__"] if handle_invalid == "keep" else [])))
    return Pipeline(stages=stages)


def regression_pipeline(learner, features: str = "features", max_categories: int = 4,
                        train: DataFrame | None = None) -> Pipeline:
    """[vector indexer, learner] — no label indexing or decoding. With
    ``train`` the (untuned) indexer is fitted once up front."""
    vi = (_fitted_vector_indexer(train, features, max_categories) if train is not None
          else vector_indexer(features, "indexedFeatures", max_categories, handle_invalid="keep"))
    return Pipeline(stages=[vi, learner])


def _fitted_vector_indexer(train: DataFrame, features: str, max_categories: int):
    """Fitted once on the training rows: inside cross-validation the indexer
    is not tuned, so refitting it per fold and per grid point is waste."""
    return vector_indexer(features, "indexedFeatures", max_categories,
                          handle_invalid="keep").fit(train.select(features))


def fit_preprocessing(train: DataFrame, features: str = "features", label: str | None = None,
                      max_categories: int = 4, handle_invalid: str = "error") -> PipelineModel:
    """Fitted [label indexer (when ``label``), vector indexer] on the training
    rows. Apply it once and tune only the learner: the indexers are not
    part of the grid, so refitting / re-applying them per fold and grid
    point is wasted work."""
    stages = []
    if label is not None:
        stages.append(StringIndexer(inputCol=label, outputCol="indexedLabel",
                                    handleInvalid=handle_invalid).fit(train))
    stages.append(_fitted_vector_indexer(train, features, max_categories))
    return PipelineModel(stages=stages)


def label_decoder(prep: PipelineModel, col: str = "prediction",
                  out: str = "predictedLabel") -> IndexToString:
    """``IndexToString`` for the label indexer inside ``prep``."""
    from pyspark.ml.feature import StringIndexerModel
    idx = find_stage(prep, StringIndexerModel)
    return IndexToString(inputCol=col, outputCol=out, labels=list(idx.labels))


def find_stage(model, kind):
    """The first stage of a (possibly nested) fitted pipeline of type ``kind``."""
    if isinstance(model, kind):
        return model
    if isinstance(model, PipelineModel):
        for st in model.stages:
            found = find_stage(st, kind)
            if found is not None:
                return found
    return None


_KV = StructType([StructField("key", StringType()), StructField("value", StringType())])


def tree_report(spark: SparkSession, model, feature_names: list[str] | None = None) -> DataFrame:
    """``key, value`` rows: impurity, maxBins, maxDepth, depth, numNodes,
    numFeatures, debug string, one rule for each leaf and the whole tree as a
    SQL expression — for classification *and* regression trees (taken from a
    fitted pipeline or the tree itself)."""
    from . import trees
    tree = find_stage(model, (DecisionTreeClassificationModel, DecisionTreeRegressionModel))
    if tree is None:
        raise ValueError("no decision tree in model")
    kind = "classification" if isinstance(tree, DecisionTreeClassificationModel) else "regression"
    rows = [("kind", kind), ("impurity", tree.getImpurity()),
            ("maxBins", str(tree.getMaxBins())), ("maxDepth", str(tree.getMaxDepth())),
            ("depth", str(tree.depth)), ("numNodes", str(tree.numNodes)),
            ("numFeatures", str(tree.numFeatures)), ("debugString", tree.toDebugString)]
    nodes = trees.tree_nodes(tree)
    for leaf, rule, prediction, _, n in trees.rules(nodes, feature_names):
        rows.append((f"rule {leaf}", f"if {rule} then {prediction!r} ({n} rows)"))
    slots = [f"`{c}`" for c in feature_names] if feature_names else (lambda i: f"features[{i}]")
    rows.append(("sql", trees.tree_case(nodes, slots)))
    return spark.createDataFrame(rows, _KV)


_STAT = StructType([StructField("stat", StringType()), StructField("term", StringType()),
                    StructField("value", DoubleType())])


def glm_summary(spark: SparkSession, model: GeneralizedLinearRegressionModel,
                feature_names: list[str] | None = None) -> DataFrame:
    """Inference summary as ``stat, term, value`` rows: coefficient, std_error,
    t_value, p_value per term (intercept last, as Spark orders them; NULL
    where the fit has no standard errors, such as collinear features), then
    dispersion, null_deviance, residual_dof_null, deviance, residual_dof, aic."""
    s = model.summary
    coefs = list(model.coefficients.toArray())
    names = list(feature_names or [f"x{i}" for i in range(len(coefs))])
    terms = names[:]
    vals = coefs[:]
    if model.getFitIntercept():
        terms.append("intercept")
        vals.append(model.intercept)
    rows = [("coefficient", t, float(v)) for t, v in zip(terms, vals)]
    for stat, attr in (("std_error", "coefficientStandardErrors"), ("t_value", "tValues"),
                       ("p_value", "pValues")):
        try:
            arr = list(getattr(s, attr))
        except UnsupportedOperationException:
            # MLlib has none when its solver fell back from the normal equations
            arr = [None] * len(terms)
        rows += [(stat, t, None if v is None else float(v)) for t, v in zip(terms, arr)]
    rows += [("dispersion", None, float(s.dispersion)),
             ("null_deviance", None, float(s.nullDeviance)),
             ("residual_dof_null", None, float(s.residualDegreeOfFreedomNull)),
             ("deviance", None, float(s.deviance)),
             ("residual_dof", None, float(s.residualDegreeOfFreedom)),
             ("aic", None, float(s.aic))]
    return spark.createDataFrame(rows, _STAT)


def glm_residuals(model: GeneralizedLinearRegressionModel, kind: str = "deviance") -> DataFrame:
    """Per-row residuals of the training data (``<kind>Residuals`` column)."""
    return model.summary.residuals(kind)
