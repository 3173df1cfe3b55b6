"""k-means clustering and its report tables.

The fit holds the input (Lloyd iterations re-read it every pass) unless the
caller has persisted it. Report tables are DataFrame
jobs: sizes are a partial+final count per cluster, extremes use
``max_by``/``min_by`` (ties → lower cluster id), distances and WSSSE join
the k centres, a table of exactly k rows (size bound known up front).
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import euclidean, squared_distance
from ..session import held
from . import linalg


def kmeans(df: DataFrame, k: int, max_iter: int = 20, seed: int = 1,
           features: str = "features", tol: float = 1e-4,
           init: str = "k-means||") -> KMeansModel:
    est = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features, tol=tol,
                 initMode=init, predictionCol="cluster")
    with held(df, [features]) as x:
        return est.fit(x)


def assign(model: KMeansModel, df: DataFrame) -> DataFrame:
    """Adds ``cluster`` (int)."""
    return model.transform(df)


def cluster_centers(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """``cluster, center`` (array<double>), k rows."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def cluster_sizes(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    return assigned.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))


def cluster_extremes(sizes: DataFrame, cluster: str = "cluster") -> DataFrame:
    """One row: largest / smallest cluster and their sizes."""
    big = F.struct(F.col("size"), -F.col(cluster))
    small = F.struct(F.col("size"), F.col(cluster))
    return sizes.agg(F.max_by(cluster, big).alias("largest"), F.max("size").alias("largest_size"),
                     F.min_by(cluster, small).alias("smallest"),
                     F.min("size").alias("smallest_size"))


def center_distances(extremes: DataFrame, centers: DataFrame) -> DataFrame:
    """Extremes + Euclidean distance between the largest and smallest centre."""
    a = centers.select(F.col("cluster").alias("largest"), F.col("center").alias("c1"))
    b = centers.select(F.col("cluster").alias("smallest"), F.col("center").alias("c2"))
    return (extremes.join(F.broadcast(a), "largest").join(F.broadcast(b), "smallest")
            .select("largest", "largest_size", "smallest", "smallest_size",
                    euclidean("c1", "c2").alias("distance")))


def with_cost(spark: SparkSession, model: KMeansModel, df: DataFrame,
              features: str = "features") -> DataFrame:
    """Assignment plus ``sq_dist`` to the assigned centre (k-row broadcast join)."""
    centers = cluster_centers(spark, model)
    a = assign(model, df).withColumn("_x", vector_to_array(features))
    return (a.join(F.broadcast(centers), "cluster")
            .withColumn("sq_dist", squared_distance("_x", "center")).drop("_x", "center"))


def audit(spark: SparkSession, model: KMeansModel, df: DataFrame, features: str = "features",
          tol: float = 1e-3) -> DataFrame:
    """Is the model a fixed point of Lloyd's steps on ``df``? One row for each
    centre: ``cluster, size, nearest`` (no member is closer to another
    centre), ``shift`` (how far the centre lies from the mean of its members)
    and ``fixed`` (shift within ``tol`` of the centre's own length, 1 at
    least). Every row is compared with the k broadcast centres; the mean of a
    dimension is one sum. Centres without members have size 0."""
    centers = cluster_centers(spark, model)
    every = [[float(x) for x in c] for c in model.clusterCenters()]
    table = spark.createDataFrame([(i, every) for i in range(len(every))], "cluster int, all array<array<double>>")
    rows = assign(model, df.select(features)).select("cluster", vector_to_array(features).alias("x")).join(F.broadcast(table), "cluster")
    distance = lambda c: F.aggregate(F.zip_with("x", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    own = distance(F.element_at("all", F.col("cluster") + 1))
    least = F.array_min(F.transform("all", distance))
    rows = rows.select("cluster", "x", (own <= least * (1 + 1e-9) + 1e-12).alias("near"))
    near = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.min("near").alias("nearest"))
    mean = rows.select("cluster", F.posexplode("x").alias("j", "v")).groupBy("cluster", "j").agg(F.avg("v").alias("m"))
    # k x width means against as many coordinates
    off = centers.select("cluster", F.posexplode("center").alias("j", "c")).join(mean, ["cluster", "j"], "left").groupBy("cluster").agg(
        F.sqrt(F.sum((F.col("c") - F.col("m")) ** 2)).alias("shift"), F.sqrt(F.sum(F.col("c") ** 2)).alias("length"))
    return off.join(near, "cluster", "left").select(
        "cluster", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("nearest", F.lit(True)).alias("nearest"), "shift",
        F.coalesce(F.col("shift") <= tol * F.greatest("length", F.lit(1.0)), F.lit(True)).alias("fixed"))


def wssse(spark: SparkSession, model: KMeansModel, df: DataFrame,
          features: str = "features", by=()) -> DataFrame:
    """Within-set sum of squared errors of ``df`` (any rows, not only the
    training ones), optionally per group."""
    return with_cost(spark, model, df, features).groupBy(*by).agg(
        F.sum("sq_dist").alias("wssse"), F.count(F.lit(1)).alias("n"))


def reduce_and_cluster(spark: SparkSession, df: DataFrame, k: int, share: float = 0.80,
                       max_iter: int = 250, seed: int = 1,
                       features: str = "features", method: str = "cov") -> dict:
    """k-means on the raw rows and on their projection onto the P principal
    components that keep ``share`` of the variance; returns P and both
    WSSSEs (as a small dict; the projected table stays distributed).

    ``method='cov'`` takes all components from one covariance matrix (n × n
    on the driver); ``'svd'``, for wide tables, asks for more components step
    by step until the share is reached, so it never makes n of them unless
    the share needs them."""
    with held(df, [features]) as x:
        n = linalg.matrix_width(x, features)
        step = n if method == "cov" else min(n, 16)
        while True:
            full = linalg.pca(x, features, step, method)
            if step == n or float(full.explained_variance.sum()) >= share:
                break
            step = min(n, 2 * step)
        p = linalg.components_for_variance(full.explained_variance, share)
        raw_model = kmeans(x, k, max_iter, seed, features)
        raw_cost = wssse(spark, raw_model, x, features).first()["wssse"]
        # the first P of the components found: one fit serves both
        proj = linalg.project(x, features, full.pc[:, :p], out="reduced")
        with held(proj, ["reduced"]) as rows:
            red_model = kmeans(rows, k, max_iter, seed, "reduced")
            red_cost = wssse(spark, red_model, rows, "reduced").first()["wssse"]
    return {"components": p, "wssse_raw": float(raw_cost), "wssse_reduced": float(red_cost),
            "explained_variance": [float(v) for v in full.explained_variance]}
