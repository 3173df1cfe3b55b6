import itertools
import random

import pytest

from tessera.operators import evaluate as EV


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("levels", [3, 50, 10_000])
def test_auc_matches_brute_force_with_ties(spark, levels):
    rnd = random.Random(levels)
    rows = []
    for g in ("a", "b"):
        for _ in range(400):
            y = rnd.random() < 0.4
            s = float(rnd.randrange(levels)) + (0.3 if y and rnd.random() < 0.5 else 0.0)
            rows.append((g, float(y), s))
    df = spark.createDataFrame(rows, "g string, label double, score double")
    got = {r.g: r.auc for r in EV.auc(df, "label", "score", by=["g"], buckets=7).collect()}
    for g in ("a", "b"):
        exp = brute_auc([(y, s) for gg, y, s in rows if gg == g])
        assert got[g] == pytest.approx(exp, abs=1e-12)
    whole = EV.auc(df, "label", "score").first().auc
    assert whole == pytest.approx(brute_auc([(y, s) for _, y, s in rows]), abs=1e-12)


def test_auc_equals_spark_evaluator(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.random() < 0.5), float(rnd.randrange(30))) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, score double")
    ours = EV.auc(df).first().auc
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    theirs = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_regression_and_accuracy(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (0.0, 0.0), (2.0, 0.0)],
                               "label double, prediction double")
    m = EV.regression_metrics(df).first()
    assert m.mse == pytest.approx(5 / 4) and m.rmse == pytest.approx((5 / 4) ** 0.5)
    assert m.mae == pytest.approx(3 / 4)
    a = EV.accuracy(df).first()
    assert a.accuracy == 0.5 and a.test_error == 0.5
    assert EV.evaluate(df, "rmse") == pytest.approx(m.rmse)


def test_auc_null_group_and_null_scores(spark):
    rows = [(None, 1.0, 0.9), (None, 0.0, 0.1), (None, 1.0, 0.4), (None, 0.0, 0.4),
            ("g", 1.0, 0.2), ("g", 0.0, 0.3), ("g", 1.0, None)]
    df = spark.createDataFrame(rows, "grp string, label double, score double")
    got = {r.grp: r.auc for r in EV.auc(df, "label", "score", by=["grp"]).collect()}
    assert got[None] == pytest.approx(brute_auc([(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.4)]))
    assert got["g"] == 0.0


def test_auc_of_a_group_in_a_narrow_band(spark):
    """Ranges follow rows: a group within 1e-9 is cut like one over thousands."""
    rnd = random.Random(9)
    rows = [("wide", float(rnd.random() < 0.3), rnd.random() * 1e6) for _ in range(1500)]
    rows += [("narrow", float(rnd.random() < 0.6), 0.5 + rnd.random() * 1e-9) for _ in range(1500)]
    rows += [(f"g{i}", float(i % 2), float(rnd.randrange(3))) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, label double, score double")
    got = {r.g: r.auc for r in EV.auc(df, "label", "score", by=["g"], buckets=16).collect()}
    for g in ("wide", "narrow"):
        assert got[g] == pytest.approx(brute_auc([(y, s) for x, y, s in rows if x == g]), abs=1e-12)
    assert got["g1"] is None and len(got) == 202
    # the widest range of (group, score) rows is near the mean
    d = df.groupBy("g", "score").count().repartitionByRange(16, "g", "score")
    from pyspark.sql import functions as F
    sizes = [r["count"] for r in d.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * sum(sizes) / 16
