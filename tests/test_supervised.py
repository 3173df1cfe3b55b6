import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import evaluate as EV
from tessera.operators import supervised as SV
from tessera.operators import tuning as TU


@pytest.fixture(scope="module")
def majority_one(spark):
    # 60 % label 1.0; the feature separates the classes
    rows = [(1.0, float(i % 50) + 100.0) for i in range(60)] + \
           [(0.0, float(i % 40)) for i in range(40)]
    df = spark.createDataFrame(rows, "label double, f double")
    return VectorAssembler(inputCols=["f"], outputCol="features").transform(df)


def test_metrics_in_indexed_label_space(spark, majority_one):
    pipe = SV.classification_pipeline(SV.tree_classifier(max_depth=2), majority_one)
    pred = pipe.fit(majority_one).transform(majority_one)
    # 1.0 is the majority → index 0; evaluated in indexed space the AUC is 1
    assert pred.select("indexedLabel").where("label = 1.0").first()[0] == 0.0
    auc = EV.evaluate(pred, "areaUnderROC", label="indexedLabel")
    assert auc == pytest.approx(1.0)
    acc = EV.accuracy(pred, "indexedLabel", "prediction").first().accuracy
    assert acc == 1.0
    assert pred.where("predictedLabel <> cast(label as string)").count() == 0


def test_tree_report_both_kinds(spark, majority_one):
    clf = SV.classification_pipeline(SV.tree_classifier(max_depth=2), majority_one).fit(
        majority_one)
    reg = SV.regression_pipeline(SV.tree_regressor(max_depth=3), "features").fit(majority_one)
    for model, kind in ((clf, "classification"), (reg, "regression")):
        rep = {r.key: r.value for r in SV.tree_report(spark, model).collect()}
        assert rep["kind"] == kind
        assert {"impurity", "maxBins", "maxDepth", "depth", "numNodes", "debugString"} <= set(rep)


def test_glm_summary_table(spark, majority_one):
    m = SV.glm("gaussian", "identity", "label", "features", 10, 0.0).fit(majority_one)
    s = SV.glm_summary(spark, m, ["f"])
    stats = {(r.stat, r.term) for r in s.collect()}
    for st in ("coefficient", "std_error", "t_value", "p_value"):
        assert (st, "f") in stats and (st, "intercept") in stats
    for st in ("dispersion", "null_deviance", "deviance", "aic", "residual_dof"):
        assert (st, None) in stats
    res = SV.glm_residuals(m)
    assert res.count() == 100 and "devianceResiduals" in res.columns


def test_poisson_reference_setting_fits(spark, majority_one):
    d = majority_one.withColumn("label", F.col("label") + 1.0)
    m = SV.glm("poisson", "identity", "label", "features", 10, 0.3).fit(d)
    assert SV.glm_summary(spark, m).count() >= 8


def test_cv_report_direction(spark, majority_one):
    d = majority_one.withColumn("fold", (F.col("f") % 3).cast("int"))
    learner = SV.tree_regressor(label="label", max_depth=1)
    pipe = SV.regression_pipeline(learner, "features")
    grid = TU.param_grid(learner, maxDepth=[1, 3])
    cvm = TU.cross_validate(pipe, grid, EV.evaluator("rmse"), d, k=3, fold_col="fold")
    rep = TU.cv_report(spark, cvm).collect()
    best = [r for r in rep if r.is_best]
    assert len(best) == 1 and best[0].avg_metric == min(r.avg_metric for r in rep)


def test_summary_keeps_rows_without_standard_errors(spark):
    """Collinear features: MLlib has no standard errors, the rows stay."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import functions as F
    df = spark.range(60).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") * 1.5 + 1).alias("label"))
    df = VectorAssembler(inputCols=["x", "x2"], outputCol="features").transform(df.withColumn("x2", F.col("x") * 2))
    _, rows = SV.fit_with_summary(SV.glm("gaussian", "identity", "label", "features", 10, 0.0), df,
                                  lambda m: SV.glm_summary(spark, m, ["x", "x2"]), ["label", "features"])
    got = {(r.stat, r.term): r.value for r in rows.collect()}
    for stat in ("std_error", "t_value", "p_value"):
        assert {t for s, t in got if s == stat} == {"x", "x2", "intercept"}
        assert all(v is None for (s, _), v in got.items() if s == stat)
    assert got["coefficient", "x"] is not None and got["deviance", None] is not None


def test_logistic_folds_hold_only_what_fits_read(spark, monkeypatch, tmp_path):
    """One persisted table, of the columns that the fits read, while the grid is fitted."""
    from tessera.plans import model_jobs as MJ
    li = [(i, 1 + i % 3, i % 20, float(1 + i % 50), (i % 11) / 100, (i % 9) / 100, 100.0 * (i % 50)) for i in range(600)]
    spark.createDataFrame(li, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_discount double, "
                              "l_tax double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, 900.0 + 40 * k, k % 7) for k in range(20)],
                          "p_partkey long, p_retailprice double, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    seen, fit = [], TU.cross_validate
    held = lambda: {e.getKey() for e in spark.sparkContext._jsc.getPersistentRDDs().entrySet()}
    before = held()

    def watch(learner, grid, ev, rows, **kw):
        seen.append((rows.columns, rows.storageLevel.useMemory, len(held() - before)))
        return fit(learner, grid, ev, rows, **kw)

    monkeypatch.setattr(TU, "cross_validate", watch)
    assert MJ.q_logistic_grid(spark, str(tmp_path)).count() == 4
    assert MJ.q_logistic_cv(spark, str(tmp_path)).count() == 3
    assert seen == [(["indexedLabel", "indexedFeatures", "fold"], True, 1)] * 2
    # tables of other tests may be cleaned up meanwhile
    assert not held() - before
