"""The reference's ten programs, re-expressed as Spark jobs over files in
their original formats, so they can be run as they are today.

Each returns a dict of DataFrames (or small values): no printing, no
driver-side matrices, no timers — the caller shows or writes what it wants.
The reference's defects are fixed as recorded in the survey (metrics in
indexed-label space, best model in the metric's direction, no target leak,
distributed transpose, any number of non-empty clusters).
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.columns import with_row_index
from ..operators import cluster as CL
from ..operators import evaluate as EV
from ..operators import features as FT
from ..operators import linalg as LA
from ..operators import recommend as RC
from ..operators import split as S
from ..operators import supervised as SV
from ..operators import text as T
from ..operators import tuning as TU
from ..session import held, spread
from ..sources import (label_features, parse_numeric, read_lines, read_ratings,
                       read_table, write_vectors)
from ..sources.sinks import preview

# --- text mining ---------------------------------------------------------------

def text_mining(spark: SparkSession, path: str, k: int = 15, min_len: int = 6) -> dict:
    """Top-k words and the k rarest words of at least ``min_len`` letters."""
    lines = read_lines(spark, path)
    return {"top_words": T.top_words(lines, "value", k),
            "rare_words": T.rare_words(lines, "value", k, min_len)}


# --- supervised programs ---------------------------------------------------------

def read_labeled(spark: SparkSession, path: str, sep: str = ",", label_idx: int = 0,
                 start: int = 1, length: int = 28, header: bool = False) -> DataFrame:
    """Numeric text table → ``label, features`` plus a ``split_key``.

    The key hashes the line together with its position in the input
    (``with_row_index``): reproducible for the same files, and duplicate
    lines — a block of copies may be a third of the data — get different
    keys, so they are split like any other rows instead of all landing on
    one side."""
    lines = read_lines(spark, path)
    if header:
        first = lines.first()
        if first is not None:
            lines = lines.where(F.col("value") != first.value)
    need = max(start + length, label_idx + 1)
    keyed = with_row_index(lines, "_pos").withColumn(
        "split_key", F.xxhash64("value", "_pos")).drop("_pos")
    parsed = parse_numeric(keyed, sep, min_fields=need)
    return label_features(parsed.drop("value"), label_idx, start, length)


def _split(df: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    return S.key_split(df, "split_key", 0.7, seed)


def _indexer_rows(data: DataFrame, train: DataFrame, which: str) -> DataFrame:
    """The rows that label and vector indexers are fitted on: the training
    rows, or 'all' (a label that only test rows have is then known)."""
    if which not in ("train", "all"):
        raise ValueError(which)
    return data if which == "all" else train


def _tune(spark, train: DataFrame, learner, grid, ev, folds: int, seed: int,
          label: str | None, indexer_rows: DataFrame | None = None) -> tuple:
    """Fit the untuned indexers once (on ``indexer_rows``, by default
    ``train``), persist the indexed rows, cross-validate the bare learner;
    returns (preprocessing, cv model)."""
    train = spread(train).persist(StorageLevel.MEMORY_AND_DISK)
    indexed = None
    try:
        prep = SV.fit_preprocessing(train if indexer_rows is None else indexer_rows, "features", label)
        indexed = prep.transform(train).persist(StorageLevel.MEMORY_AND_DISK)
        indexed.count()
        train.unpersist()   # from here on only the indexed rows are read
        cvm = TU.cross_validate(learner, grid, ev, indexed, folds, seed, fold_col="fold")
    finally:
        train.unpersist()
        if indexed is not None:
            indexed.unpersist()
    return prep, cvm


def tree_classifier_cv(spark: SparkSession, path: str, *, sep: str = ",",
                       label_idx: int = 0, start: int = 1, length: int = 28,
                       header: bool = False, depths=(3, 4, 5), bins=(10, 20, 30),
                       folds: int = 3, seed: int = 100, fit_indexers_on: str = "train") -> dict:
    """Decision-tree classifier tuned by k-fold CV on AUC (indexed-label
    space); test accuracy / AUC of the refit best model; its tree report.
    ``fit_indexers_on='all'`` fits the indexers on all rows."""
    data = read_labeled(spark, path, sep, label_idx, start, length, header)
    train, test = _split(data, seed)
    learner = SV.tree_classifier()
    grid = TU.param_grid(learner, maxDepth=list(depths), maxBins=list(bins))
    ev = EV.evaluator("areaUnderROC", label="indexedLabel")
    prep, cvm = _tune(spark, S.key_folds(train, "split_key", folds, seed + 1), learner, grid,
                      ev, folds, seed, "label", _indexer_rows(data, train, fit_indexers_on))
    pred = SV.label_decoder(prep).transform(cvm.bestModel.transform(prep.transform(test)))
    return {"cv": TU.cv_report(spark, cvm),
            "test_accuracy": EV.accuracy(pred, "indexedLabel", "prediction"),
            "test_auc": EV.auc(pred, "indexedLabel", vector_to_array("probability")[1]),
            "preview": preview(pred, ["predictedLabel", "label", "features"], 5),
            "tree": SV.tree_report(spark, cvm.bestModel)}


def tree_regressor_cv(spark: SparkSession, path: str, *, sep: str = ",",
                      label_idx: int = 0, start: int = 1, length: int = 28,
                      header: bool = False, depths=(3, 4, 5), bins=(10, 20, 30),
                      folds: int = 3, seed: int = 100, index_features: bool = True) -> dict:
    """Decision-tree regressor tuned by k-fold CV on RMSE (lower is better).
    The wine program is ``sep=';', label_idx=11, start=0, length=11,
    header=True, depths=(1,3,5), bins=(5,10,20), folds=5,
    index_features=False``."""
    data = read_labeled(spark, path, sep, label_idx, start, length, header)
    train, test = _split(data, seed)
    feats = "indexedFeatures" if index_features else "features"
    learner = SV.tree_regressor(label="label", features=feats)
    grid = TU.param_grid(learner, maxDepth=list(depths), maxBins=list(bins))
    ev = EV.evaluator("rmse")
    prep, cvm = _tune(spark, S.key_folds(train, "split_key", folds, seed + 1), learner, grid,
                      ev, folds, seed, None)
    pred = cvm.bestModel.transform(prep.transform(test))
    return {"cv": TU.cv_report(spark, cvm),
            "test": EV.regression_metrics(pred, "label", "prediction"),
            "preview": preview(pred, ["prediction", "label", "features"], 5),
            "tree": SV.tree_report(spark, cvm.bestModel)}


def logistic_cv(spark: SparkSession, path: str, *, sep: str = ",", label_idx: int = 0,
                start: int = 1, length: int = 28, header: bool = False,
                reg_params=(0.3, 0.6, 0.9), folds: int = 3, seed: int = 100,
                metric: str = "areaUnderROC", fit_indexers_on: str = "train") -> dict:
    """Elastic-net logistic regression (maxIter 10, α 0.8) tuned by CV on
    ``metric`` (areaUnderROC or accuracy) in indexed-label space; predictions
    of the refit best model with their labels decoded."""
    data = read_labeled(spark, path, sep, label_idx, start, length, header)
    train, test = _split(data, seed)
    learner = SV.logistic()
    grid = TU.param_grid(learner, regParam=list(reg_params))
    ev = EV.evaluator(metric, label="indexedLabel")
    prep, cvm = _tune(spark, S.key_folds(train, "split_key", folds, seed + 1), learner, grid,
                      ev, folds, seed, "label", _indexer_rows(data, train, fit_indexers_on))
    pred = SV.label_decoder(prep).transform(cvm.bestModel.transform(prep.transform(test)))
    return {"cv": TU.cv_report(spark, cvm),
            "test_accuracy": EV.accuracy(pred, "indexedLabel", "prediction"),
            "test_auc": EV.auc(pred, "indexedLabel", vector_to_array("probability")[1]),
            "preview": preview(pred, ["predictedLabel", "label", "features"], 5)}


def glm_report(spark: SparkSession, path: str, target: str, *, id_cols=("Row_ID",),
               families=("gaussian", "poisson"), reg_param: float = 0.3,
               max_iter: int = 10, seed: int = 100) -> dict:
    """Claims-style table: CSV with header, inferred types, rows with nulls
    dropped; string columns frequency-indexed in one job; numeric columns
    kept numeric; target and id columns never become features. One GLM per
    family (identity link) with its summary, residuals and test RMSE."""
    raw = read_table(spark, path, infer_schema=True, drop_nulls=True)
    cats = [f.name for f in raw.schema.fields
            if not isinstance(f.dataType, NumericType) and f.name != target
            and f.name not in id_cols]
    nums = [f.name for f in raw.schema.fields
            if isinstance(f.dataType, NumericType) and f.name != target
            and f.name not in id_cols]
    data = with_row_index(raw, "_pos")
    data = (data.withColumn("split_key", F.xxhash64(*raw.columns, "_pos")).drop("_pos")
            .withColumn("label", F.col(target).cast("double")))
    train, test = _split(data, seed)
    if cats:
        train, test = (FT.index_columns(x, cats, "_idx", "keep", fit_on=train) for x in (train, test))
    feats = nums + [c + "_idx" for c in cats]
    train = FT.assemble(train, feats, label=target).select("label", "features")
    test = FT.assemble(test, feats, label=target)
    # every fit and every summary statistic re-reads the training rows
    train = spread(train).persist(StorageLevel.MEMORY_AND_DISK)
    out = {}
    try:
        for fam in families:
            m = SV.glm(fam, "identity", "label", "features", max_iter, reg_param).fit(train)
            pred = m.transform(test)
            out[fam] = {"test": EV.regression_metrics(pred, "label", "prediction"),
                        "summary": SV.glm_summary(spark, m, feats),   # built eagerly
                        "residuals": SV.glm_residuals(m)}
    finally:
        train.unpersist()
    return out


# --- matrix, clustering, recommendation --------------------------------------------

def read_matrix(spark: SparkSession, path: str, *, sep: str = ",", header: bool = True,
                drop_first: bool = True, take_rows: int | None = None,
                take_cols: int | None = None, min_partitions: int | None = None) -> DataFrame:
    """Numeric text matrix → ``id`` (0-based row position in scan order) and
    ``features``. ``drop_first`` drops an id/word column, ``take_cols`` keeps
    the first n remaining fields, ``take_rows`` the first n rows.

    With ``header`` the CSV reader drops the header line of *every* file
    (two files with headers give the data rows of both); fields are read as
    strings and cast strictly, so a bad number raises."""
    if header:
        raw = (spark.read.option("header", "true").option("sep", sep)
               .option("mode", "FAILFAST").csv(path))
        cols = raw.columns[1:] if drop_first else raw.columns
        if take_cols is not None:
            cols = cols[:take_cols]
        fields = F.array(*[F.col("`" + c.replace("`", "``") + "`") for c in cols])
        rows = with_row_index(raw.select(fields.alias("_f")), "id")
        ok = F.forall("_f", lambda x: x.try_cast("double").isNotNull())
        parsed = rows.where(F.when(ok, F.lit(True)).otherwise(
            F.raise_error(F.lit("malformed numeric row in " + str(path))))).select(
            "id", F.transform("_f", lambda x: x.try_cast("double")).alias("values"))
    else:
        parsed = parse_numeric(with_row_index(read_lines(spark, path), "id"), sep,
                               drop_first=drop_first, take=take_cols)
    if take_rows is not None:
        parsed = parsed.where(F.col("id") < take_rows)
    out = parsed.select("id", array_to_vector("values").alias("features"))
    if min_partitions:
        out = out.repartition(min_partitions)
    return out


def matrix_report(spark: SparkSession, path: str, *, k: int = 2, take_rows: int | None = None,
                  out_dir: str | None = None, min_partitions: int | None = None,
                  method: str = "cov") -> dict:
    """word × paper table → papers × words (distributed transpose), PCA-k
    with explained variance, un-centred projection (optionally saved as
    comma-joined text), truncated SVD with σ and σ². The transposed table
    is returned persisted (PCA, SVD and projection all read it); the caller
    unpersists it when done. ``method='svd'`` is for more words than a
    covariance matrix on the driver can hold."""
    words = read_matrix(spark, path, take_rows=take_rows, min_partitions=min_partitions)
    papers = LA.transpose(words, "id", "features").persist(StorageLevel.MEMORY_AND_DISK)
    r = LA.pca(papers, "features", k, method)
    projected = LA.project_pca(papers, "features", r, out="projected").select("id", "projected")
    if out_dir:
        write_vectors(projected, "projected", out_dir)
    sv = LA.svd(papers, "features", k, compute_u=True, id_col="id")
    svd_table = spark.createDataFrame(
        [(i + 1, float(s), float(s * s)) for i, s in enumerate(sv.s)],
        "component int, singular_value double, gram_eigenvalue double")
    pc_rows = [(j, [float(x) for x in r.pc[j]]) for j in range(r.pc.shape[0])]
    return {"transposed": papers, "projected": projected,
            "explained_variance": LA.variance_table(spark, r.explained_variance),
            "components": spark.createDataFrame(pc_rows, "row int, weights array<double>"),
            "svd": svd_table, "u": sv.U}


def cluster_report(spark: SparkSession, path: str, *, k: int = 5, max_iter: int = 100,
                   take_cols: int = 178, seed: int = 1) -> dict:
    """Profile table (header, id column dropped, first ``take_cols`` values):
    k-means centres, sizes, largest/smallest cluster and their distance.
    The parsed rows come back persisted as ``data`` (sizes and extremes
    read them); the caller unpersists them when done."""
    x = read_matrix(spark, path, take_cols=take_cols)
    x = spread(x).persist(StorageLevel.MEMORY_AND_DISK)
    model = CL.kmeans(x, k, max_iter, seed)
    centers = CL.cluster_centers(spark, model)
    sizes = CL.cluster_sizes(CL.assign(model, x))
    ext = CL.cluster_extremes(sizes)
    return {"centers": centers, "sizes": sizes,
            "extremes": CL.center_distances(ext, centers), "data": x}


def recommend_report(spark: SparkSession, train_path: str, test_path: str, *,
                     rank: int = 10, max_iter: int = 10, reg: float = 0.01, seed: int = 0,
                     k: int = 2, out_dir: str | None = None) -> dict:
    """ALS on ``user::item::rating::ts`` files: MSE on the scorable test
    pairs, PCA-k maps of item and user factors (ids kept)."""
    train = read_ratings(spark, train_path)
    test = read_ratings(spark, test_path)
    model = RC.als_fit(train, rank, max_iter, reg, seed)
    scored = RC.als_score(model, test)
    items = RC.factor_map(model, "item", k)
    users = RC.factor_map(model, "user", k)
    if out_dir:
        write_vectors(items, "projected", f"{out_dir}/items")
        write_vectors(users, "projected", f"{out_dir}/users")
    return {"mse": RC.als_mse(scored), "scored": scored, "item_map": items, "user_map": users}


def reduce_cluster_report(spark: SparkSession, path: str, *, k: int = 10,
                          max_iter: int = 250, take_cols: int = 256, share: float = 0.80,
                          seed: int = 1, top: int = 5, method: str = "cov") -> dict:
    """Space-separated table, first ``take_cols`` fields: k-means WSSSE on
    raw rows; P components keeping ``share`` of the variance; the top
    singular values of a P-SVD; k-means WSSSE after projecting on P."""
    x = read_matrix(spark, path, sep=" ", header=False, drop_first=False,
                    take_cols=take_cols)
    with held(x, ["features"]) as rows:
        r = CL.reduce_and_cluster(spark, rows, k, share, max_iter, seed, method=method)
        sv = LA.svd(rows, "features", r["components"])
    top_sv = spark.createDataFrame([(i + 1, float(s)) for i, s in enumerate(sv.s[:top])],
                                   "component int, singular_value double")
    summary = spark.createDataFrame(
        [(r["components"], r["wssse_raw"], r["wssse_reduced"])],
        "components int, wssse_raw double, wssse_reduced double")
    return {"summary": summary, "top_singular_values": top_sv,
            "explained_variance": LA.variance_table(spark, np.asarray(r["explained_variance"]))}
