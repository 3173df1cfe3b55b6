"""Distributed matrix work: transpose, PCA, SVD, projection, variance share.

Closed-form twins: transpose (exact, long form), 2-column PCA (eigen of the
2×2 covariance) and 2-column SVD (eigen of the 2×2 Gram matrix), with
component signs removed (``abs``) because eigenvector signs are arbitrary.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..operators import linalg as LA
from .tables import table


def _embeddings(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>"))
                    .alias("features"))


def q_transpose(spark, sf_dir):
    """Transpose of the embedding matrix (rows = dimensions), in long form."""
    t = LA.transpose_long(_embeddings(spark, sf_dir), "vec_id", "features")
    return t.select(
        F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"),
        F.round("v", 6).alias("v"))


TRANSPOSE_SQL = """
SELECT CAST(pos - 1 AS BIGINT) AS i, CAST(vec_id AS BIGINT) AS j, round(CAST(e AS DOUBLE), 6) AS v
FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS pos
      FROM embeddings)"""


def _two_cols(spark, sf_dir, a, b):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                 F.expr(a).alias("a"), F.expr(b).alias("b"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(li)


PCA_A, PCA_B = "l_quantity", "l_extendedprice / 1000.0"


def q_pca_2d(spark, sf_dir):
    """PCA-2 of two correlated columns: explained-variance ratios and |weights|."""
    r = LA.pca(_two_cols(spark, sf_dir, PCA_A, PCA_B), "features", 2, method="cov")
    rows = [(i + 1, float(r.explained_variance[i]), float(abs(r.pc[0, i])), float(abs(r.pc[1, i])))
            for i in range(2)]
    return spark.createDataFrame(
        rows, "component int, explained_variance double, w_a double, w_b double").select(
        "component", *[F.round(c, 9).alias(c) for c in ("explained_variance", "w_a", "w_b")])


def _eig2_sql(a: str, b: str, c: str) -> str:
    """Eigenvalues l1 ≥ l2 and unit eigenvector of l1 for [[a, b], [b, c]]."""
    return f"""SELECT *, (({a}) + ({c})) / 2 + sqrt(power((({a}) - ({c})) / 2, 2) + power({b}, 2)) AS l1,
              (({a}) + ({c})) / 2 - sqrt(power((({a}) - ({c})) / 2, 2) + power({b}, 2)) AS l2"""


PCA_2D_SQL = f"""
WITH d AS (SELECT {PCA_A} AS a, {PCA_B} AS b FROM lineitem),
m AS (SELECT var_samp(a) AS saa, covar_samp(a, b) AS sab, var_samp(b) AS sbb FROM d),
e AS ({_eig2_sql('saa', 'sab', 'sbb')} FROM m),
v AS (SELECT *, sab / sqrt(sab * sab + power(l1 - saa, 2)) AS v1a,
              (l1 - saa) / sqrt(sab * sab + power(l1 - saa, 2)) AS v1b FROM e)
SELECT 1 AS component, round(l1 / (l1 + l2), 9) AS explained_variance,
       round(abs(v1a), 9) AS w_a, round(abs(v1b), 9) AS w_b FROM v
UNION ALL
SELECT 2, round(l2 / (l1 + l2), 9), round(abs(v1b), 9), round(abs(v1a), 9) FROM v"""


SVD_A, SVD_B = "l_quantity", "l_discount * 100"


def q_svd_2d(spark, sf_dir):
    """Truncated SVD (k=2) of an un-centred 2-column matrix: σ and σ²
    (eigenvalues of the Gram matrix XᵀX)."""
    r = LA.svd(_two_cols(spark, sf_dir, SVD_A, SVD_B), "features", 2)
    rows = [(i + 1, float(r.s[i]), float(r.gram_eigenvalues[i])) for i in range(len(r.s))]
    return spark.createDataFrame(
        rows, "component int, singular_value double, gram_eigenvalue double").select(
        "component", F.round("singular_value", 6).alias("singular_value"),
        F.round("gram_eigenvalue", 2).alias("gram_eigenvalue"))


SVD_2D_SQL = f"""
WITH d AS (SELECT {SVD_A} AS a, {SVD_B} AS b FROM lineitem),
m AS (SELECT sum(a * a) AS gaa, sum(a * b) AS gab, sum(b * b) AS gbb FROM d),
e AS ({_eig2_sql('gaa', 'gab', 'gbb')} FROM m)
SELECT 1 AS component, round(sqrt(l1), 6) AS singular_value, round(l1, 2) AS gram_eigenvalue FROM e
UNION ALL SELECT 2, round(sqrt(l2), 6), round(l2, 2) FROM e"""


def q_pca_projection(spark, sf_dir):
    """Rows projected (un-centred) on both principal components, |value|."""
    d = _two_cols(spark, sf_dir, PCA_A, PCA_B)
    r = LA.pca(d, "features", 2, method="cov")
    p = LA.project_pca(d, "features", r, out="projected")
    a = vector_to_array("projected")
    return p.select("l_orderkey", "l_linenumber", F.round(F.abs(a[0]), 6).alias("p1"),
                    F.round(F.abs(a[1]), 6).alias("p2"))


PCA_PROJECTION_SQL = f"""
WITH d AS (SELECT {PCA_A} AS a, {PCA_B} AS b FROM lineitem),
m AS (SELECT var_samp(a) AS saa, covar_samp(a, b) AS sab, var_samp(b) AS sbb FROM d),
e AS ({_eig2_sql('saa', 'sab', 'sbb')} FROM m),
v AS (SELECT sab / sqrt(sab * sab + power(l1 - saa, 2)) AS v1a,
             (l1 - saa) / sqrt(sab * sab + power(l1 - saa, 2)) AS v1b FROM e)
SELECT l_orderkey, l_linenumber,
       round(abs({PCA_A} * v1a + ({PCA_B}) * v1b), 6) AS p1,
       round(abs(-{PCA_A} * v1b + ({PCA_B}) * v1a), 6) AS p2
FROM lineitem, v"""


def q_svd_u(spark, sf_dir):
    """U of a k=2 SVD with row ids kept, |value| (signs are arbitrary)."""
    d = _two_cols(spark, sf_dir, SVD_A, SVD_B).withColumn("id", F.expr("l_orderkey * 8 + l_linenumber"))
    r = LA.svd(d, "features", 2, compute_u=True, id_col="id")
    a = vector_to_array("u")
    return r.U.select("id", F.round(F.abs(a[0]), 9).alias("u1"), F.round(F.abs(a[1]), 9).alias("u2"))


SVD_U_SQL = f"""
WITH d AS (SELECT {SVD_A} AS a, {SVD_B} AS b FROM lineitem),
m AS (SELECT sum(a * a) AS gaa, sum(a * b) AS gab, sum(b * b) AS gbb FROM d),
e AS ({_eig2_sql('gaa', 'gab', 'gbb')} FROM m),
v AS (SELECT l1, l2, gab / sqrt(gab * gab + power(l1 - gaa, 2)) AS va,
             (l1 - gaa) / sqrt(gab * gab + power(l1 - gaa, 2)) AS vb FROM e)
SELECT l_orderkey * 8 + l_linenumber AS id, round(abs({SVD_A} * va + {SVD_B} * vb) / sqrt(l1), 9) AS u1,
       round(abs(-{SVD_A} * vb + {SVD_B} * va) / sqrt(l2), 9) AS u2 FROM lineitem, v"""


def _variance_rows(spark, ratios):
    return LA.variance_table(spark, ratios).select(
        "component", *[F.round(c, 9).alias(c) for c in ("explained_variance", "cumulative")])


def q_variance_components(spark, sf_dir):
    """Explained variance of all components and the smallest P that keeps
    80 % (``is_cutoff``)."""
    r = LA.pca(_two_cols(spark, sf_dir, PCA_A, PCA_B), "features", 2, method="cov")
    p = LA.components_for_variance(r.explained_variance, 0.80)
    return _variance_rows(spark, r.explained_variance).withColumn("is_cutoff", F.col("component") == p)


def q_pca_wide(spark, sf_dir):
    """The ratios from the distributed SVD (the wide-table path): the same
    closed form. Wide tables are tested in pytest."""
    r = LA.pca(_two_cols(spark, sf_dir, PCA_A, PCA_B), "features", 2, method="svd")
    return _variance_rows(spark, np.asarray(r.explained_variance))


_RATIOS_SQL = f"""
WITH d AS (SELECT {PCA_A} AS a, {PCA_B} AS b FROM lineitem),
m AS (SELECT var_samp(a) AS saa, covar_samp(a, b) AS sab, var_samp(b) AS sbb FROM d),
e AS ({_eig2_sql('saa', 'sab', 'sbb')} FROM m),
r AS (SELECT l1 / (l1 + l2) AS r1, l2 / (l1 + l2) AS r2 FROM e),
t AS (SELECT 1 AS component, r1 AS v, r1 AS c FROM r UNION ALL SELECT 2, r2, r1 + r2 FROM r)"""
PCA_WIDE_SQL = _RATIOS_SQL + """
SELECT component, round(v, 9) AS explained_variance, round(c, 9) AS cumulative FROM t"""
VARIANCE_COMPONENTS_SQL = _RATIOS_SQL + """
SELECT component, round(v, 9) AS explained_variance, round(c, 9) AS cumulative,
       component = (SELECT min(component) FROM t WHERE c >= 0.8) AS is_cutoff FROM t"""


# --- blocked transpose ------------------------------------------------------------

TILE = 128


def q_transpose_tiles(spark, sf_dir):
    """Transpose of the embedding matrix in row form, by tiles: each output
    row is a part, at most 128 wide, of one dimension (in millionths)."""
    tiles = LA.to_tiles(_embeddings(spark, sf_dir), "vec_id", "features", TILE)
    rows = LA.tile_rows(LA.transpose_tiles(tiles), TILE)
    whole = F.transform("part", lambda v: F.round(v * 1000000).cast("bigint").cast("string"))
    return rows.select("id", F.col("col_block").alias("block"), F.array_join(whole, ",").alias("cells"))


TRANSPOSE_TILES_SQL = f"""
SELECT CAST(pos - 1 AS BIGINT) AS id, CAST(vec_id // {TILE} AS BIGINT) AS block,
       string_agg(CAST(CAST(round(CAST(e AS DOUBLE) * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY vec_id) AS cells
FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY ALL"""


# --- wide tables: the distributed solver, audited --------------------------------

AUDIT_K = 5


def _wide(spark, sf_dir):
    """192 columns: the embeddings and the products of their neighbouring and
    next-but-one components (beyond 100 columns the solver is distributed)."""
    e = F.col("embedding").cast("array<double>")
    n = F.size("embedding")
    apart = lambda k: F.transform(e, lambda x, i: x * F.element_at(e, F.pmod(i + k, n) + 1))
    d = table(spark, sf_dir, "embeddings").select("vec_id", F.concat(e, apart(1), apart(2)).alias("x"))
    return d.select("vec_id", "x", array_to_vector("x").alias("features"))


_WIDE_SQL = """
SELECT vec_id, generate_subscripts(embedding, 1) AS j, unnest(embedding) AS a, unnest(list_concat(embedding[2:], embedding[:1])) AS b,
       unnest(list_concat(embedding[3:], embedding[:2])) AS c FROM embeddings"""


def q_svd_wide_audit(spark, sf_dir):
    """Truncated SVD of the 192 columns (k = 5): every component's residuals
    within 1e-6, the squared sum of all cells, and how many U rows there are."""
    d = _wide(spark, sf_dir)
    r = LA.svd(d, "features", AUDIT_K, compute_u=True, id_col="vec_id")
    cells = d.agg(F.round(F.sum(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)), 4).alias("squares")).first().squares
    a = LA.svd_audit(d, "features", r)
    return a.select("component", "eigen_ok", "v_ok", "u_ok", F.lit(cells).alias("squares"), F.lit(r.U.count()).cast("long").alias("u_rows"))


SVD_WIDE_AUDIT_SQL = f"""
WITH w AS ({_WIDE_SQL}),
s AS (SELECT round(sum(CAST(a AS DOUBLE) * a + power(CAST(a AS DOUBLE) * b, 2) + power(CAST(a AS DOUBLE) * c, 2)), 4) AS squares FROM w),
n AS (SELECT count(*) AS u_rows FROM embeddings)
SELECT CAST(unnest(range(1, {AUDIT_K + 1})) AS INTEGER) AS component, TRUE AS eigen_ok, TRUE AS v_ok, TRUE AS u_ok, squares, u_rows FROM s, n"""


def q_pca_wide_audit(spark, sf_dir):
    """PCA (k = 5) of the 192 columns by the distributed solver: residuals
    against the covariance, and total variance."""
    d = _wide(spark, sf_dir)
    a = LA.pca_audit(d, "features", LA.pca(d, "features", AUDIT_K, method="svd"))
    total = (d.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.var_samp("v").alias("v"))
             .agg(F.round(F.sum("v"), 8).alias("v")).first().v)
    return a.select("component", "eigen_ok", "v_ok", "u_ok", F.lit(total).alias("variance"))


PCA_WIDE_AUDIT_SQL = f"""
WITH w AS ({_WIDE_SQL}),
v AS (SELECT var_samp(a) + var_samp(CAST(a AS DOUBLE) * b) + var_samp(CAST(a AS DOUBLE) * c) AS v FROM w GROUP BY j),
t AS (SELECT round(sum(v), 8) AS variance FROM v)
SELECT CAST(unnest(range(1, {AUDIT_K + 1})) AS INTEGER) AS component, TRUE AS eigen_ok, TRUE AS v_ok, TRUE AS u_ok, variance FROM t"""


def q_variance_embeddings(spark, sf_dir):
    """All 64 principal components of the embeddings: each a solution, their
    shares falling and adding up to 1; the 80 % cut-off lies among them."""
    d = _embeddings(spark, sf_dir)
    r = LA.pca(d, "features", 64, method="cov")
    p = LA.components_for_variance(r.explained_variance, 0.80)
    t = LA.variance_table(spark, r.explained_variance).join(LA.pca_audit(d, "features", r), "component")
    share = F.col("explained_variance")
    return t.agg(F.count(F.lit(1)).alias("components"), F.min(F.col("eigen_ok") & F.col("v_ok") & F.col("u_ok")).alias("solved"),
                 F.round(F.sum(share), 9).alias("total"), F.lit(bool(np.all(np.diff(r.explained_variance) <= 1e-12))).alias("falling"),
                 (F.min(F.when(F.col("component") == p, F.col("cumulative"))) >= 0.8).alias("reached"),
                 (F.coalesce(F.max(F.when(F.col("component") == p - 1, F.col("cumulative"))), F.lit(0.0)) < 0.8).alias("smallest"))


VARIANCE_EMBEDDINGS_SQL = """
SELECT CAST(max(len(embedding)) AS BIGINT) AS components, TRUE AS solved, 1.0::DOUBLE AS total, TRUE AS falling, TRUE AS reached,
       TRUE AS smallest FROM embeddings"""


QUERIES = {
    "transpose_tiles": q_transpose_tiles,
    "svd_wide_audit": q_svd_wide_audit,
    "pca_wide_audit": q_pca_wide_audit,
    "variance_embeddings": q_variance_embeddings,
    "transpose": q_transpose,
    "pca_2d": q_pca_2d,
    "pca_projection": q_pca_projection,
    "svd_2d": q_svd_2d,
    "svd_u": q_svd_u,
    "variance_components": q_variance_components,
    "pca_wide": q_pca_wide,
}

ORACLE = {
    "transpose_tiles": TRANSPOSE_TILES_SQL,
    "svd_wide_audit": SVD_WIDE_AUDIT_SQL,
    "pca_wide_audit": PCA_WIDE_AUDIT_SQL,
    "variance_embeddings": VARIANCE_EMBEDDINGS_SQL,
    "transpose": TRANSPOSE_SQL,
    "pca_2d": PCA_2D_SQL,
    "pca_projection": PCA_PROJECTION_SQL,
    "svd_2d": SVD_2D_SQL,
    "svd_u": SVD_U_SQL,
    "variance_components": VARIANCE_COMPONENTS_SQL,
    "pca_wide": PCA_WIDE_SQL,
}
