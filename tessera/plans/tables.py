"""Access to the driver tables and the stand-in inputs derived from them.

Every stand-in is a Spark expression over the given tables, so its size
grows with them (no fixed or made-up input).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str) -> None:
    for t in TABLES:
        table(spark, sf_dir, t).createOrReplaceTempView(t)


def returnflag_code() -> F.Column:
    """A, N, R → 1, 2, 3 (a small categorical slot without zero)."""
    return (F.when(F.col("l_returnflag") == "A", 1.0)
            .when(F.col("l_returnflag") == "N", 2.0).otherwise(3.0))


RETURNFLAG_CODE_SQL = "CASE WHEN l_returnflag = 'A' THEN 1.0 WHEN l_returnflag = 'N' THEN 2.0 ELSE 3.0 END"


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendation stand-in: customer × part with the mean quantity bought.

    ``orders ⋈ lineitem`` on the order key (both sides are large: a shuffle
    join, AQE may turn it into a broadcast only when its runtime size allows),
    then aggregated per (user, item) so repeated pairs do not fan out.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_custkey").cast("int").alias("user"),
                     F.col("l_partkey").cast("int").alias("item"))
            .agg(F.avg("l_quantity").alias("rating")))


RATINGS_SQL = """
SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(l_partkey AS INTEGER) AS item,
       avg(l_quantity) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY 1, 2"""
