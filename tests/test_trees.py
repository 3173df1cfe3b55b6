import math
import random

import pytest
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.operators import evaluate as EV
from tessera.operators import supervised as SV
from tessera.operators import trees as TR
from tessera.operators import tuning as TU


@pytest.fixture(scope="module")
def rows(spark):
    """Two continuous slots and a categorical one, three classes, noise."""
    rnd = random.Random(4)
    data = []
    for i in range(3000):
        a, b, c = rnd.random() * 10, rnd.gauss(0, 3), float(rnd.choice([-2, -1, 0, 5]))
        y = 3 * (a > 4) + (b > 1) * (c in (0, 5)) + rnd.random()
        data.append((i % 3, a, b, c, float(int(y) % 3), float(y > 2.2), y * 2))
    df = spark.createDataFrame(data, "fold int, a double, b double, c double, three double, label double, target double")
    v = VectorAssembler(inputCols=["a", "b", "c"], outputCol="raw").transform(df)
    return VectorIndexer(inputCol="raw", outputCol="features", maxCategories=4).fit(v).transform(v).cache()


def trees_of(rows, depth=5, bins=32):
    return [SV.tree_regressor("target", "features", depth, bins).fit(rows),
            SV.tree_classifier("label", "features", depth, bins).fit(rows),
            SV.tree_classifier("three", "features", depth, bins).fit(rows)]


def test_compiled_tree_equals_transform_on_every_row(rows):
    for model in trees_of(rows):
        nodes = TR.tree_nodes(model)
        assert max(x.depth for x in nodes) == model.depth and len(nodes) == model.numNodes
        assert any(x.categories for x in nodes) and any(x.threshold is not None for x in nodes)
        want = model.setPredictionCol("want").transform(rows)
        both = TR.score(want, nodes, out="got")
        assert both.where("want != got").count() == 0
        # the same on plain columns, without a vector
        plain = both.withColumn("s", vector_to_array("features")).select(
            "want", F.col("s")[0].alias("x"), F.col("s")[1].alias("y z"), F.col("s")[2].alias("w"))
        assert plain.where(F.expr(TR.tree_case(nodes, ["x", "`y z`", "w"])) != F.col("want")).count() == 0
        assert "_slots" not in both.columns


def test_leaf_numbers_and_counts(rows):
    model = SV.tree_classifier("three", "features", 4, 16, leaf_col="leaf").fit(rows)
    nodes = TR.tree_nodes(model)
    number = [x.id for x in TR.leaves(nodes)]
    got = TR.score(model.transform(rows), nodes, out="node", value="id").select("leaf", "node").collect()
    assert all(number[int(r.leaf)] == r.node for r in got)
    counts = {i: 0 for i in number}
    for r in got:
        counts[r.node] += 1
    assert {x.id: x.n for x in TR.leaves(nodes)} == counts


def test_nan_and_extremes_go_where_the_model_sends_them(spark, rows):
    model = trees_of(rows)[0]
    odd = spark.createDataFrame([(x, y, 0.0) for x in (float("nan"), math.inf, -math.inf, 0.0, -0.0) for y in (float("nan"), 1e300, -1e300)],
                                "a double, b double, c double")
    odd = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features", handleInvalid="keep").transform(odd)
    both = TR.score(model.setPredictionCol("want").transform(odd), TR.tree_nodes(model), out="got")
    assert both.where("want != got").count() == 0


def test_truncated_tree_is_the_shallow_tree(rows):
    for depth in (0, 1, 2, 3, 4):
        for deep, shallow in zip(trees_of(rows, 5), trees_of(rows, depth)):
            cut, own = TR.truncate(TR.tree_nodes(deep), depth), TR.tree_nodes(shallow)
            assert [x.id for x in cut] == [x.id for x in own]
            for a, b in zip(cut, own):
                assert (a.feature, a.threshold, a.categories, a.n) == (b.feature, b.threshold, b.categories, b.n)
                assert a.prediction == pytest.approx(b.prediction, rel=1e-12)


@pytest.mark.parametrize("kind,label,metric", [("regressor", "target", "rmse"), ("classifier", "label", "areaUnderROC"),
                                               ("classifier", "three", "accuracy")])
def test_depths_from_deep_trees_equal_a_fit_for_each(rows, kind, label, metric):
    depths, bins = [1, 2, 3, 5], [8, 16]
    cv = TR.cross_validate_trees(rows, kind, label, "features", depths, bins, metric, 3, "fold")
    make = SV.tree_regressor if kind == "regressor" else SV.tree_classifier
    learner = make(label, "features")
    grid = TU.param_grid(learner, maxDepth=depths, maxBins=bins)
    full = TU.cross_validate(learner, grid, EV.evaluator(metric, label=label), rows, k=3, fold_col="fold")
    assert list(cv.averages) == pytest.approx(full.avgMetrics, abs=1e-9)
    a, b = (x.collect() for x in (cv.report(rows.sparkSession), TU.cv_report(rows.sparkSession, full)))
    assert [(r.grid_id, r.params) for r in a] == [(r.grid_id, r.params) for r in b]
    assert [r.std_metric for r in a] == pytest.approx([r.std_metric for r in b], abs=1e-9)
    best = [r.is_best for r in b].index(True)
    assert a[best].is_best or a[best].avg_metric == pytest.approx(max(cv.averages) if metric != "rmse" else min(cv.averages))
    assert cv.best.depth <= cv.grid[cv.best_index][0]


def test_tables_and_rules(spark, rows):
    model = trees_of(rows, 2)[0]
    nodes = TR.tree_nodes(model)
    table = {r.node: r for r in TR.node_table(spark, nodes, ["a", "b", "c"]).collect()}
    assert table[1].name in ("a", "b", "c") and table[1].n == 3000
    for r in table.values():
        if r.left:
            assert table[r.left].n + table[r.right].n == r.n
    leaves = TR.tree_rules(spark, nodes, ["a", "b", "c"]).collect()
    assert sum(r.n for r in leaves) == 3000
    # continuous rules are SQL conditions: each holds for just its rows
    indexed = rows.withColumn("s", vector_to_array("features")).select(F.col("s")[0].alias("a"), F.col("s")[1].alias("b"), F.col("s")[2].alias("c"))
    for r in leaves:
        assert indexed.where(r.rule.replace("{", "(").replace("}", ")")).count() == r.n
    report = {r.key: r.value for r in SV.tree_report(spark, model, ["a", "b", "c"]).collect()}
    assert report["sql"].startswith("CASE WHEN") and sum(k.startswith("rule ") for k in report) == len(leaves)


def test_single_leaf(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 5, "label double, x double")
    v = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    nodes = TR.tree_nodes(SV.tree_regressor("label", "features", 3).fit(v))
    assert TR.tree_case(nodes, ["x"]) == "CAST(1.0 AS DOUBLE)" and TR.rules(nodes)[0][1] == "always"
    with pytest.raises(ValueError):
        TR.tree_nodes(VectorAssembler(inputCols=["x"], outputCol="f"))


def test_rank_auc():
    assert TR.rank_auc({1.0: (2, 0), 0.0: (0, 3)}) == 1.0 and TR.rank_auc({1.0: (1, 1)}) == 0.5
    assert TR.rank_auc({}) == 0.0
