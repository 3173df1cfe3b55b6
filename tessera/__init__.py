"""tessera: reusable Spark jobs (DataFrame in, DataFrame out).

Text mining, reproducible splits, categorical encoding, tree / GLM /
logistic learners with inference summaries, cross-validated tuning,
evaluation metrics, distributed matrix work (transpose, PCA, SVD,
projection), k-means reports and ALS recommendation.

Every function takes DataFrames built by the caller's ``SparkSession``
and returns DataFrames; only small, bounded results (k centres, k x n
components, grid metrics) ever reach the driver.
"""

__version__ = "0.1.0"
