"""Supervised learners, their summaries and cross-validated tuning.

Queries with a closed form carry a SQL twin: tree stumps (best midpoint
split by exhaustive SQL search), gaussian GLM with ridge penalty (Spark's
weighted least squares: slope = cov / (var_x · (1 + λ/σ_y)), population
moments), its λ = 0 inference summary (OLS formulas), poisson/identity on
one 0/1 feature (group means), the reference logistic setting (all
coefficients 0 → intercept = logit of the base rate), and CV over λ for
the GLM (per-fold closed forms). Deeper trees and their grids are checked
by row counts and pytest.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from ..operators import evaluate as EV
from ..operators import features as FT
from ..operators import split as S
from ..operators import supervised as SV
from ..operators import trees as TR
from ..operators import tuning as TU
from ..session import spread
from .prep_jobs import FOLD_SEED, SPLIT_SEED, _hash_sql
from .tables import table

# --- stand-in tables ----------------------------------------------------------

def _lineitem_xy(spark, sf_dir):
    """label y = quantity, feature x = extended price / 1000 (one slot)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("label"),
        (F.col("l_extendedprice") / 1000.0).alias("x"))
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(li)


NUMERIC_FEATURES = ["l_quantity", "p_retailprice", "l_discount", "l_tax", "p_size", "neg_mod"]


def labeled_numeric(spark, sf_dir):
    """Label + 6 numeric features (one of them categorical) from
    lineitem ⋈ part. ``label`` (0/1) and ``target`` (revenue / 1000) are
    interactions of the features, so the learners have signal to find."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax",
        "l_extendedprice", (-(F.col("l_linenumber") % 3)).cast("double").alias("neg_mod"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice",
                                            F.col("p_size").cast("double").alias("p_size"))
    gross = F.col("l_quantity") * F.col("p_retailprice")
    d = (li.join(p, li.l_partkey == p.p_partkey)
         .withColumn("label", (gross > 35000).cast("double"))
         .withColumn("target", gross * (1 - F.col("l_discount")) / 1000.0))
    return VectorAssembler(inputCols=NUMERIC_FEATURES, outputCol="features").transform(d)


# --- tree stumps ---------------------------------------------------------------

def q_tree_regressor_stump(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    d = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li)
    model = SV.fit_spread(SV.tree_regressor(label="l_extendedprice", features="features",
                                            max_depth=1, max_bins=64),
                          d, ["l_extendedprice", "features"])
    return model.transform(d).select("l_orderkey", "l_linenumber",
                                     F.round("prediction", 4).alias("prediction"))


def _stump_cte(label_expr: str) -> str:
    return f"""
WITH v AS (SELECT l_quantity AS x, count(*) AS c, sum({label_expr}) AS s,
                  sum(({label_expr}) * ({label_expr})) AS ss FROM lineitem GROUP BY l_quantity),
cum AS (SELECT x, sum(c) OVER w AS cl, sum(s) OVER w AS sl, sum(ss) OVER w AS ssl,
               lead(x) OVER (ORDER BY x) AS nx FROM v
        WINDOW w AS (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
tot AS (SELECT sum(c) AS n, sum(s) AS s, sum(ss) AS ss FROM v),
cand AS (SELECT (cum.x + cum.nx) / 2 AS thr, cl, sl, ssl, tot.n - cl AS cr, tot.s - sl AS sr,
                tot.ss - ssl AS ssr FROM cum, tot WHERE cum.nx IS NOT NULL)"""


TREE_REGRESSOR_STUMP_SQL = _stump_cte("l_extendedprice") + """,
best AS (SELECT thr, sl / cl AS lm, sr / cr AS rm FROM cand
         ORDER BY (ssl - sl * sl / cl) + (ssr - sr * sr / cr) ASC, thr ASC LIMIT 1)
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN l_quantity <= thr THEN lm ELSE rm END, 4) AS prediction
FROM lineitem, best"""

STUMP_LABEL = "l_extendedprice + 1000 * l_quantity > 80000"


def q_tree_classifier_stump(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.expr(STUMP_LABEL).cast("double").alias("label"))
    d = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li)
    learner = SV.tree_classifier(max_depth=1, max_bins=64)
    train = d.select("label", "features")
    model = SV.fit_spread(SV.classification_pipeline(learner, train, "label", "features"), train)
    return model.transform(d).select("l_orderkey", "l_linenumber", "predictedLabel")


# gini: minimise n_l·g_l + n_r·g_r with g = 1 - p² - (1-p)²
TREE_CLASSIFIER_STUMP_SQL = _stump_cte(f"CASE WHEN {STUMP_LABEL} THEN 1.0 ELSE 0.0 END") + """,
best AS (SELECT thr, sl / cl AS lp, sr / cr AS rp FROM cand
         ORDER BY cl * (1 - power(sl / cl, 2) - power(1 - sl / cl, 2))
                + cr * (1 - power(sr / cr, 2) - power(1 - sr / cr, 2)) ASC, thr ASC LIMIT 1)
SELECT l_orderkey, l_linenumber,
       CASE WHEN (CASE WHEN l_quantity <= thr THEN lp ELSE rp END) > 0.5
            THEN '1.0' ELSE '0.0' END AS predictedLabel
FROM lineitem, best"""


# --- GLM ---------------------------------------------------------------------

def _coef_table(spark, names, coefs, intercept, digits=9):
    rows = [(n, float(c)) for n, c in zip(names, coefs)] + [("intercept", float(intercept))]
    return spark.createDataFrame(rows, "term string, value double").select(
        "term", F.round("value", digits).alias("value"))


def q_glm_gaussian(spark, sf_dir):
    """Gaussian / identity, λ = 0.3, 10 iterations (the reference setting)."""
    d = _lineitem_xy(spark, sf_dir)
    # weighted least squares: one aggregation pass, nothing to persist
    m = SV.glm("gaussian", "identity", "label", "features", 10, 0.3).fit(d)
    return _coef_table(spark, ["x"], m.coefficients.toArray(), m.intercept)


def _moments_sql(where: str = "TRUE") -> str:
    return f"""SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my,
        avg(x * x) - avg(x) * avg(x) AS vx, avg(x * y) - avg(x) * avg(y) AS cxy,
        avg(y * y) - avg(y) * avg(y) AS vy FROM d WHERE {where}"""


_XY_SQL = "SELECT l_quantity AS y, l_extendedprice / 1000.0 AS x FROM lineitem"

GLM_GAUSSIAN_SQL = f"""
WITH d AS ({_XY_SQL}), m AS ({_moments_sql()}),
c AS (SELECT cxy / (vx * (1 + 0.3 / sqrt(vy))) AS b1, mx, my FROM m)
SELECT 'x' AS term, round(b1, 9) AS value FROM c
UNION ALL SELECT 'intercept', round(my - b1 * mx, 9) FROM c"""

_SUMMARY_DIGITS = {"coefficient": 9, "std_error": 12, "t_value": 8, "p_value": 8, "dispersion": 9,
                   "null_deviance": 5, "residual_dof_null": 1, "deviance": 5,
                   "residual_dof": 1, "aic": 7}


def _round_stats(df, stats=None):
    expr = F.lit(None).cast("double")
    for stat, digits in (stats or _SUMMARY_DIGITS).items():
        expr = F.when(F.col("stat") == stat, F.round("value", digits)).otherwise(expr)
    return df.select("stat", "term", expr.alias("value"))


def _p_normal(t: str) -> str:
    """2 (1 - Φ(|t|)) by the series φ(t) Σ t^(2k+1) / (2k+1)!!."""
    z = f"greatest(abs({t}), 1e-300)"
    term = "exp((2 * k + 1) * ln(z) - lgamma(2 * k + 2) + k * ln(2) + lgamma(k + 1))"
    series = f"(SELECT sum({term}) FROM (SELECT {z} AS z, unnest(range(0, 200)) AS k))"
    return f"CASE WHEN abs({t}) > 8 THEN 0.0 ELSE 1 - 2 * exp(-({t}) * ({t}) / 2) / sqrt(2 * pi()) * {series} END"


def _p_student(t: str, dof: str, steps: int = 2000) -> str:
    """Two-sided tail of Student's t by Simpson's rule over its density."""
    density = (f"exp(lgamma((v + 1) / 2) - lgamma(v / 2) - ln(v * pi()) / 2 - (v + 1) / 2 * ln(1 + power(z * k / {steps}, 2) / v))")
    weight = f"CASE WHEN k IN (0, {steps}) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"
    area = (f"(SELECT sum({weight} * {density}) * max(z) / {3 * steps} FROM (SELECT abs({t}) AS z, CAST({dof} AS DOUBLE) AS v, "
            f"unnest(range(0, {steps + 1})) AS k))")
    return f"CASE WHEN abs({t}) > 40 THEN 0.0 ELSE 1 - 2 * {area} END"


def q_glm_gaussian_summary(spark, sf_dir):
    """Unpenalised gaussian fit: the full inference summary."""
    d = _lineitem_xy(spark, sf_dir)
    _, summary = SV.fit_with_summary(
        SV.glm("gaussian", "identity", "label", "features", 10, 0.0), d,
        lambda m: SV.glm_summary(spark, m, ["x"]), ["label", "features"])
    return _round_stats(summary)


_WEAK_DIGITS = {**_SUMMARY_DIGITS, "null_deviance": 3, "deviance": 3, "aic": 5}


def _ols_summary_sql(xy: str, term: str = "x", digits: dict[str, int] = _SUMMARY_DIGITS) -> str:
    def _r(expr: str, stat: str) -> str:
        return f"round({expr}, {digits[stat]})"

    return f"""
WITH d AS ({xy}), m AS ({_moments_sql()}),
c AS (SELECT n, mx, my, cxy / vx AS b1, my - cxy / vx * mx AS b0, vx * n AS sxx FROM m),
r AS (SELECT sum(power(y - b0 - b1 * x, 2)) AS rss, sum(power(y - my, 2)) AS tss
      FROM d, c),
s AS (SELECT c.*, rss, tss, rss / (n - 2) AS disp FROM c, r),
e AS (SELECT *, sqrt(disp / sxx) AS se1, sqrt(disp * (1.0 / n + mx * mx / sxx)) AS se0 FROM s),
t AS (SELECT *, b1 / se1 AS t1, b0 / se0 AS t0 FROM e),
p AS (SELECT *, {_p_student('t1', 'n - 2')} AS p1, {_p_student('t0', 'n - 2')} AS p0 FROM t)
SELECT 'coefficient' AS stat, '{term}' AS term, {_r('b1', 'coefficient')} AS value FROM p
UNION ALL SELECT 'coefficient', 'intercept', {_r('b0', 'coefficient')} FROM p
UNION ALL SELECT 'std_error', '{term}', {_r('se1', 'std_error')} FROM p
UNION ALL SELECT 'std_error', 'intercept', {_r('se0', 'std_error')} FROM p
UNION ALL SELECT 't_value', '{term}', {_r('t1', 't_value')} FROM p
UNION ALL SELECT 't_value', 'intercept', {_r('t0', 't_value')} FROM p
UNION ALL SELECT 'p_value', '{term}', {_r('p1', 'p_value')} FROM p
UNION ALL SELECT 'p_value', 'intercept', {_r('p0', 'p_value')} FROM p
UNION ALL SELECT 'dispersion', NULL, {_r('disp', 'dispersion')} FROM p
UNION ALL SELECT 'null_deviance', NULL, {_r('tss', 'null_deviance')} FROM p
UNION ALL SELECT 'residual_dof_null', NULL, {_r('n - 1', 'residual_dof_null')} FROM p
UNION ALL SELECT 'deviance', NULL, {_r('rss', 'deviance')} FROM p
UNION ALL SELECT 'residual_dof', NULL, {_r('n - 2', 'residual_dof')} FROM p
UNION ALL SELECT 'aic', NULL, {_r('n * (ln(2 * pi() * rss / n) + 1) + 2 + 4', 'aic')} FROM p"""


GLM_GAUSSIAN_SUMMARY_SQL = _ols_summary_sql(_XY_SQL)


def q_glm_weak_summary(spark, sf_dir):
    """The same on a feature that says next to nothing (tax): p-values well
    inside (0, 1)."""
    li = table(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") / 1000.0).alias("label"), (F.col("l_tax") * 100).alias("x"))
    d = VectorAssembler(inputCols=["x"], outputCol="features").transform(li)
    _, summary = SV.fit_with_summary(
        SV.glm("gaussian", "identity", "label", "features", 10, 0.0), d,
        lambda m: SV.glm_summary(spark, m, ["tax"]), ["label", "features"])
    return _round_stats(summary, _WEAK_DIGITS)


GLM_WEAK_SUMMARY_SQL = _ols_summary_sql("SELECT l_extendedprice / 1000.0 AS y, l_tax * 100 AS x FROM lineitem", "tax", _WEAK_DIGITS)


def _poisson_data(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("label"),
        (F.col("l_returnflag") == "R").cast("double").alias("g"))
    return VectorAssembler(inputCols=["g"], outputCol="features").transform(li)


def q_glm_poisson(spark, sf_dir):
    """Poisson / identity on one 0/1 feature, unpenalised: the MLE is the
    pair of group means."""
    m = SV.fit_spread(SV.glm("poisson", "identity", "label", "features", 25, 0.0),
                      _poisson_data(spark, sf_dir))
    return _coef_table(spark, ["g"], m.coefficients.toArray(), m.intercept, 6)


GLM_POISSON_SQL = """
WITH m AS (SELECT avg(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END) AS m0,
                  avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS m1 FROM lineitem)
SELECT 'g' AS term, round(m1 - m0, 6) AS value FROM m
UNION ALL SELECT 'intercept', round(m0, 6) FROM m"""


_POISSON_DIGITS = {"coefficient": 6, "std_error": 8, "t_value": 5, "p_value": 7, "dispersion": 6, "null_deviance": 4,
                   "residual_dof_null": 1, "deviance": 4, "residual_dof": 1, "aic": 3}


def q_glm_poisson_summary(spark, sf_dir):
    """Poisson / identity on one 0/1 feature, unpenalised: the inference
    summary has a closed form in the two group means."""
    _, summary = SV.fit_with_summary(
        SV.glm("poisson", "identity", "label", "features", 25, 0.0), _poisson_data(spark, sf_dir),
        lambda m: SV.glm_summary(spark, m, ["g"]))
    return _round_stats(summary, _POISSON_DIGITS)


def _rp(expr: str, stat: str) -> str:
    return f"round({expr}, {_POISSON_DIGITS[stat]})"


GLM_POISSON_SUMMARY_SQL = f"""
WITH d AS (SELECT CAST(l_quantity AS DOUBLE) AS y, l_returnflag = 'R' AS g FROM lineitem),
m AS (SELECT count(*) AS n, avg(y) AS my, avg(CASE WHEN g THEN NULL ELSE y END) AS m0, avg(CASE WHEN g THEN y END) AS m1,
             sum(CASE WHEN g THEN 0 ELSE 1 END) AS n0, sum(CASE WHEN g THEN 1 ELSE 0 END) AS n1 FROM d),
s AS (SELECT 2 * sum(y * ln(y / CASE WHEN g THEN m1 ELSE m0 END) - (y - CASE WHEN g THEN m1 ELSE m0 END)) AS dev,
             2 * sum(y * ln(y / my) - (y - my)) AS dev0,
             -2 * sum(y * ln(CASE WHEN g THEN m1 ELSE m0 END) - CASE WHEN g THEN m1 ELSE m0 END - lgamma(y + 1)) + 4 AS aic
      FROM d, m),
e AS (SELECT *, m1 - m0 AS b, sqrt(m0 / n0) AS se0, sqrt(m0 / n0 + m1 / n1) AS se1 FROM m, s)
SELECT 'coefficient' AS stat, 'g' AS term, {_rp('b', 'coefficient')} AS value FROM e
UNION ALL SELECT 'coefficient', 'intercept', {_rp('m0', 'coefficient')} FROM e
UNION ALL SELECT 'std_error', 'g', {_rp('se1', 'std_error')} FROM e
UNION ALL SELECT 'std_error', 'intercept', {_rp('se0', 'std_error')} FROM e
UNION ALL SELECT 't_value', 'g', {_rp('b / se1', 't_value')} FROM e
UNION ALL SELECT 't_value', 'intercept', {_rp('m0 / se0', 't_value')} FROM e
UNION ALL SELECT 'p_value', 'g', {_rp(_p_normal('b / se1'), 'p_value')} FROM e
UNION ALL SELECT 'p_value', 'intercept', {_rp(_p_normal('m0 / se0'), 'p_value')} FROM e
UNION ALL SELECT 'dispersion', NULL, 1.0
UNION ALL SELECT 'null_deviance', NULL, {_rp('dev0', 'null_deviance')} FROM e
UNION ALL SELECT 'residual_dof_null', NULL, {_rp('n - 1', 'residual_dof_null')} FROM e
UNION ALL SELECT 'deviance', NULL, {_rp('dev', 'deviance')} FROM e
UNION ALL SELECT 'residual_dof', NULL, {_rp('n - 2', 'residual_dof')} FROM e
UNION ALL SELECT 'aic', NULL, {_rp('aic', 'aic')} FROM e"""


def q_glm_poisson_reference(spark, sf_dir):
    """Poisson / identity in the reference setting, λ = 0.3 and 10 iterations:
    the whole summary, p-values included."""
    _, summary = SV.fit_with_summary(
        SV.glm("poisson", "identity", "label", "features", 10, 0.3), _poisson_data(spark, sf_dir),
        lambda m: SV.glm_summary(spark, m, ["g"]))
    return _round_stats(summary, _POISSON_DIGITS)


def _wls_sql(w0: str, w1: str, ridge: str) -> str:
    """Columns of one weighted ridge step on the 0/1 feature, from the counts
    n, sums s and squares q of its two groups with weights w0 and w1."""
    return f"""SELECT *, cxy / ({ridge}) AS b1, my - cxy / ({ridge}) * mx AS b0 FROM (
    SELECT *, s1 * w1 / w - mx * my AS cxy, mx - mx * mx AS vx FROM (
    SELECT *, n1 * w1 / w AS mx, (s0 * w0 + s1 * w1) / w AS my FROM (
    SELECT *, n0 * w0 + n1 * w1 AS w FROM (SELECT *, {w0} AS w0, {w1} AS w1 FROM """


# the steps of iteratively reweighted least squares as a recursive query: the
# first fit has weight 1 and a penalty on the standardised scale, each further
# one the inverse of the last means as weights and the penalty as it is
GLM_POISSON_REFERENCE_SQL = f"""
WITH RECURSIVE d AS (SELECT CAST(l_quantity AS DOUBLE) AS y, l_returnflag = 'R' AS g FROM lineitem),
a AS (SELECT count(*) AS n, avg(y) AS my0, CAST(count(*) FILTER (NOT g) AS DOUBLE) AS n0, CAST(count(*) FILTER (g) AS DOUBLE) AS n1,
        sum(y) FILTER (NOT g) AS s0, sum(y) FILTER (g) AS s1, var_pop(y) AS vy FROM d),
it AS (
  SELECT 0 AS i, b0, b1, CAST(NULL AS DOUBLE) AS o0, CAST(NULL AS DOUBLE) AS o1 FROM (
    {_wls_sql('1.0', '1.0', 'vx * (1 + 0.3 / sqrt(vy))')} a)))))
  UNION ALL
  SELECT i + 1, x0, x1, b0, b1 FROM (SELECT i, p0 AS b0, p1 AS b1, b0 AS x0, b1 AS x1 FROM (
    {_wls_sql('1.0 / p0', '1.0 / (p0 + p1)', 'vx + 0.3')} (SELECT a.*, i, it.b0 AS p0, it.b1 AS p1 FROM it, a
      WHERE i < 10 AND (o0 IS NULL OR greatest(abs(it.b0 - o0), abs(it.b1 - o1)) >= 1e-6))))))))),
f AS (SELECT a.*, b0, b1, o0, o1, n0 / o0 AS u0, n1 / (o0 + o1) AS u1 FROM it, a WHERE i = (SELECT max(i) FROM it)),
h AS (SELECT *, u0 + u1 AS w, u1 / (u0 + u1) AS mx, b0 + b1 AS m1 FROM f),
e AS (SELECT *, sqrt(1 / ((mx - mx * mx + 0.3) * w)) AS se1, sqrt((mx + 0.3) / ((mx - mx * mx + 0.3) * w)) AS se0 FROM h),
v AS (SELECT 2 * sum(y * ln(y / CASE WHEN g THEN m1 ELSE b0 END) - (y - CASE WHEN g THEN m1 ELSE b0 END)) AS dev,
        2 * sum(y * ln(y / my0) - (y - my0)) AS dev0,
        -2 * sum(y * ln(CASE WHEN g THEN m1 ELSE b0 END) - CASE WHEN g THEN m1 ELSE b0 END - lgamma(y + 1)) + 4 AS aic FROM d, e)
SELECT 'coefficient' AS stat, 'g' AS term, {_rp('b1', 'coefficient')} AS value FROM e
UNION ALL SELECT 'coefficient', 'intercept', {_rp('b0', 'coefficient')} FROM e
UNION ALL SELECT 'std_error', 'g', {_rp('se1', 'std_error')} FROM e
UNION ALL SELECT 'std_error', 'intercept', {_rp('se0', 'std_error')} FROM e
UNION ALL SELECT 't_value', 'g', {_rp('b1 / se1', 't_value')} FROM e
UNION ALL SELECT 't_value', 'intercept', {_rp('b0 / se0', 't_value')} FROM e
UNION ALL SELECT 'p_value', 'g', {_rp(_p_normal('b1 / se1'), 'p_value')} FROM e
UNION ALL SELECT 'p_value', 'intercept', {_rp(_p_normal('b0 / se0'), 'p_value')} FROM e
UNION ALL SELECT 'dispersion', NULL, 1.0
UNION ALL SELECT 'null_deviance', NULL, {_rp('dev0', 'null_deviance')} FROM v
UNION ALL SELECT 'residual_dof_null', NULL, {_rp('n - 1', 'residual_dof_null')} FROM e
UNION ALL SELECT 'deviance', NULL, {_rp('dev', 'deviance')} FROM v
UNION ALL SELECT 'residual_dof', NULL, {_rp('n - 2', 'residual_dof')} FROM e
UNION ALL SELECT 'aic', NULL, {_rp('aic', 'aic')} FROM v"""


def q_glm_residuals(spark, sf_dir):
    """Deviance residuals of the reference-setting gaussian fit (= y − ŷ)."""
    d = _lineitem_xy(spark, sf_dir)
    m = SV.glm("gaussian", "identity", "label", "features", 10, 0.3).fit(d)
    r = SV.glm_residuals(m, "deviance")
    return r.select(F.round("devianceResiduals", 6).alias("devianceResiduals"))


GLM_RESIDUALS_SQL = f"""
WITH d AS ({_XY_SQL}), m AS ({_moments_sql()}),
c AS (SELECT cxy / (vx * (1 + 0.3 / sqrt(vy))) AS b1, mx, my FROM m)
SELECT round(y - (my - b1 * mx) - b1 * x, 6) AS devianceResiduals FROM d, c"""


# --- logistic ------------------------------------------------------------------

LOGIT_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def q_logistic_ref(spark, sf_dir):
    """maxIter 10, regParam 0.3, elasticNet 0.8 on three weak features: the
    L1 part keeps every coefficient at 0, leaving the base-rate intercept."""
    li = table(spark, sf_dir, "lineitem").select(
        *LOGIT_FEATURES, (F.col("l_returnflag") == "A").cast("double").alias("label"))
    d = VectorAssembler(inputCols=LOGIT_FEATURES, outputCol="features").transform(li)
    m = SV.fit_spread(SV.logistic("label", "features", 10, 0.3, 0.8), d, ["label", "features"])
    return _coef_table(spark, LOGIT_FEATURES, m.coefficients.toArray(), m.intercept)


LOGISTIC_REF_SQL = """
WITH p AS (SELECT avg(CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.0 END) AS p FROM lineitem)
SELECT 'l_quantity' AS term, 0.0 AS value UNION ALL SELECT 'l_discount', 0.0
UNION ALL SELECT 'l_tax', 0.0 UNION ALL SELECT 'intercept', round(ln(p / (1 - p)), 9) FROM p"""


# --- cross-validation ----------------------------------------------------------

GLM_GRID = [0.3, 0.6, 0.9]


def q_cv_glm(spark, sf_dir):
    """3-fold CV (key folds) of the gaussian GLM over λ ∈ {0.3, 0.6, 0.9}, RMSE."""
    d = S.key_folds(_lineitem_xy(spark, sf_dir), "l_orderkey", 3, FOLD_SEED, "fold")
    est = GeneralizedLinearRegression(family="gaussian", link="identity", maxIter=10,
                                      labelCol="label", featuresCol="features")
    grid = TU.param_grid(est, regParam=GLM_GRID)
    cvm = TU.cross_validate(est, grid, EV.evaluator("rmse"), d, k=3, fold_col="fold")
    rep = TU.cv_report(spark, cvm)
    lam = F.element_at(F.array(*[F.lit(x) for x in GLM_GRID]), F.col("grid_id") + 1)
    return rep.select(lam.alias("reg_param"), F.round("avg_metric", 9).alias("avg_rmse"),
                      "is_best")


CV_GLM_SQL = f"""
WITH d AS (SELECT l_quantity AS y, l_extendedprice / 1000.0 AS x,
                  CAST({_hash_sql('l_orderkey', FOLD_SEED)} % 3 AS INTEGER) AS fold FROM lineitem),
f AS (SELECT DISTINCT fold AS vf FROM d),
g AS (SELECT CAST(unnest([{', '.join(str(x) for x in GLM_GRID)}]) AS DOUBLE) AS lam),
m AS (SELECT vf, avg(x) AS mx, avg(y) AS my, avg(x * x) - avg(x) * avg(x) AS vx,
             avg(x * y) - avg(x) * avg(y) AS cxy, avg(y * y) - avg(y) * avg(y) AS vy
      FROM f JOIN d ON d.fold <> f.vf GROUP BY vf),
c AS (SELECT vf, lam, cxy / (vx * (1 + lam / sqrt(vy))) AS b1, mx, my FROM m, g),
e AS (SELECT vf, lam, sqrt(avg(power(y - (my - b1 * mx) - b1 * x, 2))) AS rmse
      FROM c JOIN d ON d.fold = c.vf GROUP BY vf, lam),
a AS (SELECT lam, avg(rmse) AS avg_rmse FROM e GROUP BY lam)
SELECT lam AS reg_param, round(avg_rmse, 9) AS avg_rmse,
       avg_rmse = min(avg_rmse) OVER () AS is_best FROM a"""


TREE_GRID = {"maxDepth": [3, 4, 5], "maxBins": [10, 20, 30]}


def _cv_tree(spark, sf_dir, kind: str):
    d = S.key_folds(labeled_numeric(spark, sf_dir), "l_orderkey", 3, FOLD_SEED, "fold")
    train, test = S.key_split(d, "l_orderkey", 0.7, SPLIT_SEED)
    cols = ["label", "target", "features", "fold"]
    train = spread(train.select(*cols)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        label, metric = ("indexedLabel", "areaUnderROC") if kind == "classifier" else ("target", "rmse")
        prep = SV.fit_preprocessing(train, "features", "label" if kind == "classifier" else None)
        cv = TR.cross_validate_trees(prep.transform(train), kind, label, "indexedFeatures", TREE_GRID["maxDepth"],
                                     TREE_GRID["maxBins"], metric, 3, "fold")
    finally:
        train.unpersist()
    test_metric = EV.evaluator(metric, label=label).evaluate(cv.best.transform(prep.transform(test)))
    return (cv.report(spark).withColumn("metric", F.lit(metric))
            .withColumn("test_metric", F.when(F.col("is_best"), F.lit(test_metric))))


def q_cv_tree_classifier(spark, sf_dir):
    """Decision-tree classifier, depth {3,4,5} × bins {10,20,30}, 3 key folds,
    AUC in indexed-label space; test AUC of the refit best model."""
    return _cv_tree(spark, sf_dir, "classifier")


def q_cv_tree_regressor(spark, sf_dir):
    """Decision-tree regressor, same grid, RMSE (lower is better)."""
    return _cv_tree(spark, sf_dir, "regressor")


def q_tree_report(spark, sf_dir):
    d = labeled_numeric(spark, sf_dir)
    model = SV.fit_spread(SV.regression_pipeline(SV.tree_regressor(label="target", max_depth=3),
                                                 "features"), d, ["target", "features"])
    return SV.tree_report(spark, model, NUMERIC_FEATURES)


# --- trees as data: columns with fewer values than bins, so that every midpoint
# --- is a candidate and SQL can grow the same tree

RULE_FEATURES = ["l_quantity", "l_discount", "l_tax"]
RULE_LABEL = "l_extendedprice / 1000.0"


def _rule_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *RULE_FEATURES, F.expr(RULE_LABEL).alias("label"))
    return VectorAssembler(inputCols=RULE_FEATURES, outputCol="features").transform(li)


def _rule_tree(spark, sf_dir):
    d = _rule_rows(spark, sf_dir)
    learner = SV.tree_regressor(label="label", features="features", max_depth=2, max_bins=64)
    return d, TR.tree_nodes(SV.fit_spread(learner, d, ["label", "features"]))


def q_tree_rules(spark, sf_dir):
    """The depth-2 regression tree as data: each leaf's rule in SQL terms, its
    rows and its prediction."""
    _, nodes = _rule_tree(spark, sf_dir)
    return TR.tree_rules(spark, nodes, RULE_FEATURES).select("leaf", "n", F.round("prediction", 6).alias("prediction"))


def q_tree_case(spark, sf_dir):
    """Every row scored by the tree's SQL expression on plain columns (no
    model, no vector): its leaf and prediction."""
    d, nodes = _rule_tree(spark, sf_dir)
    return d.select("l_orderkey", "l_linenumber", F.expr(TR.tree_case(nodes, RULE_FEATURES, "id")).cast("bigint").alias("leaf"),
                    F.round(F.expr(TR.tree_case(nodes, RULE_FEATURES)), 6).alias("prediction"))


def _split_sql(rows: str, k: int, node: str) -> str:
    """CTEs of the best split of each (vf, node) of ``rows`` (node is a
    column): b{k} with feature f and threshold thr, rows{k} with the child."""
    value = "CASE f " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(RULE_FEATURES)) + " END"
    union = " UNION ALL ".join(f"SELECT vf, {node} AS node, {i} AS f, {c} AS x, y FROM {rows}" for i, c in enumerate(RULE_FEATURES))
    return f"""
v{k} AS (SELECT vf, node, f, x, count(*) AS c, sum(y) AS s, sum(y * y) AS ss FROM ({union}) GROUP BY ALL),
c{k} AS (SELECT vf, node, f, x, lead(x) OVER w AS nx, sum(c) OVER w AS cl, sum(s) OVER w AS sl, sum(ss) OVER w AS ssl,
         sum(c) OVER t AS ct, sum(s) OVER t AS st, sum(ss) OVER t AS sst FROM v{k}
         WINDOW w AS (PARTITION BY vf, node, f ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                t AS (PARTITION BY vf, node, f)),
b{k} AS (SELECT vf, node, f, (x + nx) / 2 AS thr FROM (SELECT *, row_number() OVER (PARTITION BY vf, node
           ORDER BY ssl - sl * sl / cl + (sst - ssl) - (st - sl) * (st - sl) / (ct - cl), f, x) AS place
           FROM (SELECT vf, node, f, x, nx, cl, sl, ssl, ct, st, sst FROM c{k} WHERE nx IS NOT NULL)) WHERE place = 1),
rows{k} AS (SELECT r.*, 2 * r.{node} + CASE WHEN {value} <= thr THEN 0 ELSE 1 END AS node{k}
          FROM {rows} r JOIN b{k} b ON r.vf = b.vf AND r.{node} = b.node)"""


TREE_DEPTH2_CTE = f"""
WITH rows0 AS (SELECT 0 AS vf, 1 AS node0, l_orderkey, l_linenumber, {', '.join(RULE_FEATURES)}, {RULE_LABEL} AS y FROM lineitem),
{_split_sql('rows0', 1, 'node0')}, {_split_sql('rows1', 2, 'node1')},
leaf AS (SELECT node2, count(*) AS n, avg(y) AS p FROM rows2 GROUP BY node2)"""

TREE_RULES_SQL = TREE_DEPTH2_CTE + """
SELECT CAST(node2 AS BIGINT) AS leaf, n, round(p, 6) AS prediction FROM leaf"""

TREE_CASE_SQL = TREE_DEPTH2_CTE + """
SELECT l_orderkey, l_linenumber, CAST(node2 AS BIGINT) AS leaf, round(p, 6) AS prediction FROM rows2 JOIN leaf USING (node2)"""


def q_cv_tree_depth(spark, sf_dir):
    """3-fold CV (key folds) of the tree depth, 1 and 2 read off one depth-2
    tree for each fold: average RMSE of each depth."""
    d = S.key_folds(_rule_rows(spark, sf_dir), "l_orderkey", 3, FOLD_SEED, "fold")
    cv = TR.cross_validate_trees(d.select("label", "features", "fold"), "regressor", "label", "features", [1, 2], [64], "rmse")
    return cv.report(spark).select((F.col("grid_id") + 1).alias("max_depth"), F.round("avg_metric", 8).alias("avg_rmse"), "is_best")


CV_TREE_DEPTH_SQL = f"""
WITH d AS (SELECT l_orderkey, l_linenumber, {', '.join(RULE_FEATURES)}, {RULE_LABEL} AS y,
                  CAST({_hash_sql('l_orderkey', FOLD_SEED)} % 3 AS INTEGER) AS fold FROM lineitem),
rows0 AS (SELECT vf, 1 AS node0, d.* FROM (SELECT DISTINCT fold AS vf FROM d) JOIN d ON d.fold <> vf),
{_split_sql('rows0', 1, 'node0')}, {_split_sql('rows1', 2, 'node1')},
p1 AS (SELECT vf, node1, avg(y) AS p FROM rows1 GROUP BY ALL),
p2 AS (SELECT vf, node2, avg(y) AS p FROM rows2 GROUP BY ALL),
t0 AS (SELECT fold AS vf, 1 AS node0, d.* FROM d),
t1 AS (SELECT t0.*, 2 * node0 + CASE WHEN CASE f {' '.join(f'WHEN {i} THEN {c}' for i, c in enumerate(RULE_FEATURES))} END <= thr THEN 0 ELSE 1 END AS node1
       FROM t0 JOIN b1 ON t0.vf = b1.vf),
t2 AS (SELECT t1.*, 2 * node1 + CASE WHEN CASE f {' '.join(f'WHEN {i} THEN {c}' for i, c in enumerate(RULE_FEATURES))} END <= thr THEN 0 ELSE 1 END AS node2
       FROM t1 JOIN b2 ON t1.vf = b2.vf AND t1.node1 = b2.node),
e AS (SELECT vf, 1 AS max_depth, sqrt(avg(power(y - p, 2))) AS rmse FROM t1 JOIN p1 USING (vf, node1) GROUP BY vf
      UNION ALL SELECT vf, 2, sqrt(avg(power(y - p, 2))) FROM t2 JOIN p2 USING (vf, node2) GROUP BY vf),
a AS (SELECT max_depth, avg(rmse) AS m FROM e GROUP BY max_depth)
SELECT max_depth, round(m, 8) AS avg_rmse, m = min(m) OVER () AS is_best FROM a"""


@contextmanager
def _indexed_folds(spark, sf_dir):
    """The labelled rows, indexed, with three key folds, in the columns that
    the fits read: held once, and the rows they come from are released before
    any fit."""
    d = S.key_folds(labeled_numeric(spark, sf_dir), "l_orderkey", 3, FOLD_SEED, "fold")
    d = spread(d.select("label", "features", "fold")).persist(StorageLevel.MEMORY_AND_DISK)
    rows = None
    try:
        prep = SV.fit_preprocessing(d, "features", "label")
        rows = prep.transform(d).select("indexedLabel", "indexedFeatures", "fold").persist(StorageLevel.MEMORY_AND_DISK)
        rows.count()
        d.unpersist()   # from here on only the indexed rows are read
        yield rows
    finally:
        d.unpersist()
        if rows is not None:
            rows.unpersist()


def q_logistic_cv(spark, sf_dir):
    """Logistic regression (elastic net .8) CV over regParam {.3,.6,.9},
    accuracy in indexed-label space, 3 key folds."""
    learner = SV.logistic()
    ev = EV.evaluator("accuracy", label="indexedLabel")
    grid = TU.param_grid(learner, regParam=[0.3, 0.6, 0.9])
    with _indexed_folds(spark, sf_dir) as rows:
        cvm = TU.cross_validate(learner, grid, ev, rows, k=3, fold_col="fold")
    rep = TU.cv_report(spark, cvm)
    lam = F.element_at(F.array(*[F.lit(x) for x in GLM_GRID]), F.col("grid_id") + 1)
    return rep.select(lam.alias("reg_param"), F.round("avg_metric", 9).alias("avg_accuracy"), "is_best")


# so strong a penalty leaves no coefficient: each fold predicts its majority
LOGISTIC_CV_SQL = f"""
WITH d AS (SELECT CASE WHEN l_quantity * p_retailprice > 35000 THEN 1.0 ELSE 0.0 END AS y,
                  CAST({_hash_sql('l_orderkey', FOLD_SEED)} % 3 AS INTEGER) AS fold
           FROM lineitem JOIN part ON l_partkey = p_partkey),
f AS (SELECT DISTINCT fold AS vf FROM d),
t AS (SELECT vf, CASE WHEN avg(y) > 0.5 THEN 1.0 ELSE 0.0 END AS major FROM f JOIN d ON d.fold <> f.vf GROUP BY vf),
a AS (SELECT vf, avg(CASE WHEN y = major THEN 1.0 ELSE 0.0 END) AS acc FROM t JOIN d ON d.fold = t.vf GROUP BY vf),
g AS (SELECT CAST(unnest([{', '.join(str(x) for x in GLM_GRID)}]) AS DOUBLE) AS lam)
SELECT lam AS reg_param, round((SELECT avg(acc) FROM a), 9) AS avg_accuracy,
       lam = {GLM_GRID[0]} AS is_best FROM g"""


def q_logistic_grid(spark, sf_dir):
    """The same learner tuned by exact AUC over a grid that separates, labels
    decoded: fold AUCs fall as the penalty grows (row-count check)."""
    learner = SV.logistic()
    grid = TU.param_grid(learner, regParam=[0.001, 0.01, 0.05, 0.3])
    with _indexed_folds(spark, sf_dir) as rows:
        cvm = TU.cross_validate(learner, grid, EV.evaluator("areaUnderROC", label="indexedLabel"),
                                rows, k=3, fold_col="fold")
    return TU.cv_report(spark, cvm)


CLAIM_CATS = ["p_brand", "p_type", "l_returnflag", "l_linestatus"]
CLAIM_NUMS = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]


def q_glm_claims(spark, sf_dir):
    """The claims-model program on lineitem ⋈ part: string columns indexed
    in one multi-column job (labels from the training rows), numeric columns
    kept, target never a feature; gaussian and poisson GLMs (identity link,
    λ = 0.3, 10 iterations): full summaries plus test RMSE."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_returnflag",
        "l_linestatus", (F.col("l_extendedprice") / 1000.0).alias("label"))
    p = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_type", F.col("p_size").cast("double").alias("p_size"),
        "p_retailprice")
    # the joined rows feed the indexer fit, both fits, every summary statistic
    # and the test scoring; all results below are built eagerly, so the join
    # is computed once and released before returning
    d = spread(li.join(p, li.l_partkey == p.p_partkey)).persist(StorageLevel.MEMORY_AND_DISK)
    out = train = None
    try:
        rows, test = S.key_split(d, "l_orderkey", 0.7, SPLIT_SEED)
        feats = CLAIM_NUMS + [c + "_idx" for c in CLAIM_CATS]
        labels = FT.fit_labels(rows, CLAIM_CATS)
        train, test = (FT.assemble(labels.transform(x, "_idx", "keep"), feats, label="label").select("label", "features")
                       for x in (rows, test))
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
        for fam in ("gaussian", "poisson"):
            m = SV.glm(fam, "identity", "label", "features", 10, 0.3).fit(train)
            rmse = EV.regression_metrics(m.transform(test), "label", "prediction").first().rmse
            rows = SV.glm_summary(spark, m, feats).union(spark.createDataFrame(
                [("test_rmse", None, float(rmse))], "stat string, term string, value double"))
            rows = rows.withColumn("family", F.lit(fam))
            out = rows if out is None else out.union(rows)
    finally:
        d.unpersist()
        if train is not None:
            train.unpersist()
    return out.select("family", "stat", "term", "value")


QUERIES = {
    "glm_claims": q_glm_claims,
    "tree_regressor_stump": q_tree_regressor_stump,
    "tree_classifier_stump": q_tree_classifier_stump,
    "glm_gaussian": q_glm_gaussian,
    "glm_gaussian_summary": q_glm_gaussian_summary,
    "glm_poisson": q_glm_poisson,
    "glm_poisson_summary": q_glm_poisson_summary,
    "glm_poisson_reference": q_glm_poisson_reference,
    "glm_weak_summary": q_glm_weak_summary,
    "glm_residuals": q_glm_residuals,
    "logistic_ref": q_logistic_ref,
    "cv_glm": q_cv_glm,
    "cv_tree_classifier": q_cv_tree_classifier,
    "cv_tree_regressor": q_cv_tree_regressor,
    "tree_report": q_tree_report,
    "tree_rules": q_tree_rules,
    "tree_case": q_tree_case,
    "cv_tree_depth": q_cv_tree_depth,
    "logistic_cv": q_logistic_cv,
    "logistic_grid": q_logistic_grid,
}

ORACLE = {
    "tree_regressor_stump": TREE_REGRESSOR_STUMP_SQL,
    "tree_classifier_stump": TREE_CLASSIFIER_STUMP_SQL,
    "glm_gaussian": GLM_GAUSSIAN_SQL,
    "glm_gaussian_summary": GLM_GAUSSIAN_SUMMARY_SQL,
    "glm_poisson": GLM_POISSON_SQL,
    "glm_residuals": GLM_RESIDUALS_SQL,
    "logistic_ref": LOGISTIC_REF_SQL,
    "cv_glm": CV_GLM_SQL,
    "tree_rules": TREE_RULES_SQL,
    "tree_case": TREE_CASE_SQL,
    "cv_tree_depth": CV_TREE_DEPTH_SQL,
    "glm_poisson_summary": GLM_POISSON_SUMMARY_SQL,
    "glm_poisson_reference": GLM_POISSON_REFERENCE_SQL,
    "glm_weak_summary": GLM_WEAK_SUMMARY_SQL,
    "logistic_cv": LOGISTIC_CV_SQL,
}
