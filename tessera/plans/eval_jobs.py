"""Evaluation metrics over scores derived from the driver tables.

Scores here are plain columns, so every metric has an exact SQL twin; the
same functions score model predictions elsewhere.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as EV
from .tables import table


def _scored(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag",
        "l_linestatus")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return li.join(p, li.l_partkey == p.p_partkey)


def q_regression_metrics(spark, sf_dir):
    """RMSE / MSE / MAE of list price × quantity against the extended price."""
    d = _scored(spark, sf_dir).withColumn(
        "prediction", F.col("l_quantity") * F.col("p_retailprice") * (1 - F.col("l_discount")))
    m = EV.regression_metrics(d, "l_extendedprice", "prediction", by=["l_returnflag"])
    return m.select("l_returnflag", "n", F.round("mse", 2).alias("mse"),
                    F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))


def q_accuracy(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select(
        "l_linestatus", (F.col("l_returnflag") == "R").cast("double").alias("label"),
        (F.col("l_discount") >= 0.05).cast("double").alias("prediction"))
    m = EV.accuracy(d, "label", "prediction", by=["l_linestatus"])
    return m.select("l_linestatus", "n", F.round("accuracy", 12).alias("accuracy"),
                    F.round("test_error", 12).alias("test_error"))


def q_auc_by_group(spark, sf_dir):
    """AUC of the discount as a score for 'returned' — 11 distinct scores,
    so nearly every pair is a tie: checks the tie rule per group."""
    d = table(spark, sf_dir, "lineitem").select(
        "l_linestatus", (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.col("l_discount").alias("score"))
    return EV.auc(d, "label", "score", by=["l_linestatus"]).select(
        "l_linestatus", F.round("auc", 12).alias("auc"))


def q_auc(spark, sf_dir):
    """AUC of the order total as a score for status 'F' (continuous score,
    one global group, scores spread over many ranges)."""
    d = table(spark, sf_dir, "orders").select(
        (F.col("o_orderstatus") == "F").cast("double").alias("label"),
        F.col("o_totalprice").alias("score"))
    return EV.auc(d, "label", "score").select(F.round("auc", 12).alias("auc"))


BAND = "CASE WHEN l_returnflag = 'A' THEN 0.5 + l_extendedprice * 1e-12 ELSE l_extendedprice END"


def q_auc_band(spark, sf_dir):
    """AUC for each return flag, where all scores of one flag lie within a
    band of 1e-6: ranges follow the rows, not the width of the scores."""
    d = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", (F.col("l_quantity") > 25).cast("double").alias("label"), F.expr(BAND).alias("score"))
    return EV.auc(d, "label", "score", by=["l_returnflag"]).select("l_returnflag", F.round("auc", 12).alias("auc"))


def _auc_sql(src: str, by: str | None) -> str:
    part = f"PARTITION BY {by} " if by else ""
    sel = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""
WITH s AS (SELECT {sel}score, sum(label) AS pos, sum(1 - label) AS neg FROM ({src}) GROUP BY {sel}score),
c AS (SELECT *, coalesce(sum(neg) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0) AS below FROM s)
SELECT {sel}round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 12) AS auc FROM c {grp}"""


QUERIES = {
    "regression_metrics": q_regression_metrics,
    "accuracy": q_accuracy,
    "auc_by_group": q_auc_by_group,
    "auc": q_auc,
    "auc_band": q_auc_band,
}

ORACLE = {
    "regression_metrics": """
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n,
       round(avg(power(l_quantity * p_retailprice * (1 - l_discount) - l_extendedprice, 2)), 2) AS mse,
       round(sqrt(avg(power(l_quantity * p_retailprice * (1 - l_discount) - l_extendedprice, 2))), 6) AS rmse,
       round(avg(abs(l_quantity * p_retailprice * (1 - l_discount) - l_extendedprice)), 6) AS mae
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_returnflag""",
    "accuracy": """
SELECT l_linestatus, CAST(count(*) AS BIGINT) AS n,
       round(avg(CASE WHEN (l_returnflag = 'R') = (l_discount >= 0.05) THEN 1.0 ELSE 0.0 END), 12) AS accuracy,
       round(1 - avg(CASE WHEN (l_returnflag = 'R') = (l_discount >= 0.05) THEN 1.0 ELSE 0.0 END), 12) AS test_error
FROM lineitem GROUP BY l_linestatus""",
    "auc_by_group": _auc_sql("SELECT l_linestatus, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END "
                             "AS label, l_discount AS score FROM lineitem", "l_linestatus"),
    "auc_band": _auc_sql(f"SELECT l_returnflag, CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END AS label, {BAND} AS score "
                         "FROM lineitem", "l_returnflag"),
    "auc": _auc_sql("SELECT CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS label, "
                    "o_totalprice AS score FROM orders", None),
}
