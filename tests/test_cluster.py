import pytest
from pyspark.ml.feature import VectorAssembler

from tessera.operators import cluster as CL


@pytest.fixture(scope="module")
def planted3(spark):
    rows = [(float(g * 1000 + (i % 7)),) for g, n in ((0, 50), (1, 30), (2, 20)) for i in range(n)]
    df = spark.createDataFrame(rows, "x double")
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(df)


def test_planted_clusters(spark, planted3):
    m = CL.kmeans(planted3, 3, 20, seed=1)
    sizes = sorted(r.size for r in CL.cluster_sizes(CL.assign(m, planted3)).collect())
    assert sizes == [20, 30, 50]
    ext = CL.cluster_extremes(CL.cluster_sizes(CL.assign(m, planted3))).first()
    assert (ext.largest_size, ext.smallest_size) == (50, 20)
    d = CL.center_distances(CL.cluster_extremes(CL.cluster_sizes(CL.assign(m, planted3))),
                            CL.cluster_centers(spark, m)).first()
    c = {round(r.center[0]) for r in CL.cluster_centers(spark, m).collect()}
    assert c == {3, 1003, 2003}
    assert d.distance == pytest.approx(2000.0, abs=1.0)
    w = CL.wssse(spark, m, planted3).first().wssse
    assert w == pytest.approx(m.summary.trainingCost)


def test_wssse_falls_with_k(spark, planted3):
    costs = [CL.wssse(spark, CL.kmeans(planted3, k, 20, seed=1), planted3).first().wssse
             for k in (2, 3, 4)]
    assert costs[0] > costs[1] > costs[2]


def test_reduce_and_cluster(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    r = CL.reduce_and_cluster(spark, e, 3, 0.8, 20, 1)
    assert 1 <= r["components"] <= 64
    assert sum(r["explained_variance"][:r["components"]]) >= 0.8
    assert r["wssse_reduced"] <= r["wssse_raw"] + 1e-9


def test_reduce_and_cluster_asks_for_components_step_by_step(spark, monkeypatch):
    import numpy as np
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from tessera.operators import linalg as LA
    rng = np.random.default_rng(1)
    x = rng.normal(size=(150, 3)) @ rng.normal(size=(3, 40)) * 5 + 0.01 * rng.normal(size=(150, 40))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").select(array_to_vector("v").alias("features"))
    asked = []
    pca = LA.pca
    monkeypatch.setattr(LA, "pca", lambda d, c, k, m="cov": asked.append(k) or pca(d, c, k, m))
    wide = CL.reduce_and_cluster(spark, df, 2, 0.99, 20, 1, method="svd")
    full = CL.reduce_and_cluster(spark, df, 2, 0.99, 20, 1, method="cov")
    assert asked == [16, 40] and wide["components"] == full["components"] <= 3
    assert np.allclose(wide["explained_variance"], full["explained_variance"][:16], atol=1e-9)
    assert wide["wssse_raw"] == full["wssse_raw"]


def test_audit_of_a_fixed_point_and_of_an_early_stop(spark):
    import numpy as np
    rnd = np.random.default_rng(3)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in rnd.normal(size=(2000, 2))], "x double, y double")
    v = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)
    done = CL.audit(spark, CL.kmeans(v, 6, 500, seed=1, tol=1e-12), v).collect()
    assert len(done) == 6 and sum(r["size"] for r in done) == 2000
    assert all(r.nearest and r.fixed and r.shift < 1e-6 for r in done)
    early = CL.audit(spark, CL.kmeans(v, 6, 1, seed=1, init="random"), v, tol=1e-6).collect()
    assert all(r.nearest for r in early) and not all(r.fixed for r in early)
    moved = CL.audit(spark, CL.kmeans(v, 6, 500, seed=1), v.limit(100), tol=1e-6).collect()
    assert sum(r["size"] for r in moved) == 100
