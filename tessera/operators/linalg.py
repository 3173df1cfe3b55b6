"""Distributed matrix work on ``(id, vector)`` tables.

* ``to_long`` / ``from_long`` — coordinate (i, j, v) form ↔ row vectors.
* ``transpose_long`` — the transpose in coordinate form: i and j change
  places, no exchange, any size.
* ``transpose`` — the transpose as row vectors. Each output row is one input
  column, so it is as wide as the input has rows; for tables of any height
  use the long form or tiles.
* ``to_tiles`` / ``transpose_tiles`` / ``tile_rows`` — a blocked layout: dense
  tiles of at most tile x tile entries. The transpose turns each tile where it
  lies (no exchange); no row is wider than a tile is large.
* ``pca`` — ``method='cov'`` (default): MLlib ``PCA`` (n×n covariance on the
  driver, fine for n up to a few thousand); ``method='svd'``, for wide
  tables: centre the rows, then the distributed truncated SVD of
  ``RowMatrix`` (ARPACK on Gramian-vector products, no n×n matrix). The
  caller chooses; nothing switches by size.
* ``project`` — rows × (n×k) components, un-centred like MLlib's
  ``PCAModel.transform``; the k×n matrix is broadcast (bounded by the
  width, never by the row count) and applied to Arrow batches with numpy.
* ``svd`` — singular values, V, and optionally U with row ids kept
  (U = X V Σ⁻¹, computed row-wise by ``project``).
* ``svd_audit`` / ``pca_audit`` — residuals of a decomposition from sums over
  the rows: eigen equations, orthonormal V and U.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, PCAModel, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..session import held


def _as_array(df: DataFrame, col: str):
    if isinstance(df.schema[col].dataType, ArrayType):
        return F.col(col).cast("array<double>")
    return vector_to_array(col)


def to_long(df: DataFrame, id_col: str, vec_col: str, row: str = "i", col: str = "j",
            value: str = "v") -> DataFrame:
    """(id, vector) → (i, j, v), one row per entry."""
    return df.select(F.col(id_col).alias(row),
                     F.posexplode(_as_array(df, vec_col)).alias(col, value))


def from_long(df: DataFrame, n_cols: int, row: str = "i", col: str = "j", value: str = "v",
              out_id: str = "id", out: str = "features") -> DataFrame:
    """(i, j, v) → (id, dense vector of width ``n_cols``); missing entries are
    0. A position that occurs twice in a row, or outside it, raises."""
    entry = F.struct(F.col(col).cast("int").alias("k"), F.col(value).cast("double").alias("v"))
    g = df.groupBy(F.col(row).alias(out_id)).agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    # one pass over the sorted entries: each brings the zeros of the gap before it
    before = F.concat(F.array(F.lit(-1)), F.transform("_e", lambda e: e["k"]))
    gaps = F.zip_with("_e", before, lambda e, k: F.when(
        e.isNotNull(), F.when((e["k"] > k) & (e["k"] < n_cols), F.concat(
            F.array_repeat(F.lit(0.0), e["k"] - k - 1), F.array(e["v"]))).otherwise(
        F.raise_error(F.concat(F.lit("position repeated or out of range: "), e["k"].cast("string"))))))
    tail = F.array_repeat(F.lit(0.0), F.lit(n_cols - 1) - F.element_at("_e", -1)["k"])
    dense = F.concat(F.flatten(F.filter(gaps, lambda x: x.isNotNull())), tail)
    return g.select(out_id, array_to_vector(dense).alias(out))


def transpose_long(df: DataFrame, id_col: str, vec_col: str, row: str = "i", col: str = "j",
                   value: str = "v") -> DataFrame:
    """The transpose in coordinate form: entry (i, j) = input row j, column i."""
    return to_long(df, id_col, vec_col, col, row, value).select(row, col, value)


def transpose(df: DataFrame, id_col: str, vec_col: str, n_rows: int | None = None,
              out_id: str = "id", out: str = "features") -> DataFrame:
    """Transpose of a row matrix whose ids are row positions ``0..n_rows-1``,
    as row vectors. Output row j = input column j, entry i = input row i
    (absent ids → 0, repeated ids raise)."""
    if n_rows is None:
        n_rows = int(df.agg(F.coalesce(F.max(id_col), F.lit(-1))).first()[0]) + 1
    return from_long(transpose_long(df, id_col, vec_col), n_rows, out_id=out_id, out=out)


def to_tiles(df: DataFrame, id_col: str, vec_col: str, tile: int = 256, n_rows: int | None = None) -> DataFrame:
    """(id, vector) → ``row_block, col_block, cells`` (array of tile rows).

    Ids are row positions ``0..n_rows-1``; absent ones are rows of zeros as
    far as another id of their block is there, repeated ones raise. Tiles at
    the lower and right edge are smaller. One exchange, of slices that are at
    most ``tile`` wide; no output row holds more than tile x tile entries."""
    if n_rows is None:
        n_rows = int(df.agg(F.coalesce(F.max(id_col), F.lit(-1))).first()[0]) + 1
    x = df.select(F.col(id_col).cast("long").alias("i"), _as_array(df, vec_col).alias("x"))
    starts = F.sequence(F.lit(0), F.greatest(F.floor((F.size("x") - 1) / tile), F.lit(0)).cast("int"))
    parts = x.select("i", F.posexplode(F.transform(starts, lambda b: F.slice("x", b * tile + 1, tile))).alias("col_block", "part"))
    parts = parts.select(F.floor(F.col("i") / tile).alias("row_block"), F.col("col_block").cast("long").alias("col_block"),
                         F.struct(F.pmod("i", F.lit(tile)).cast("int").alias("r"), "part").alias("e"))
    rows = parts.groupBy("row_block", "col_block").agg(F.sort_array(F.collect_list("e")).alias("e"))
    height = F.least(F.lit(tile).cast("long"), F.lit(n_rows) - F.col("row_block") * tile).cast("int")
    zeros = F.array_repeat(F.lit(0.0), F.size(F.col("e")[0]["part"]))
    before = F.concat(F.array(F.lit(-1)), F.transform("e", lambda e: e["r"]))
    gaps = F.zip_with("e", before, lambda e, r: F.when(e.isNotNull(), F.when(e["r"] > r, F.concat(
        F.array_repeat(zeros, e["r"] - r - 1), F.array(e["part"]))).otherwise(
        F.raise_error(F.lit("row id repeated in a tile")))))
    tail = F.array_repeat(zeros, height - 1 - F.element_at("e", -1)["r"])
    return rows.select("row_block", "col_block", F.concat(F.flatten(F.filter(gaps, lambda g: g.isNotNull())), tail).alias("cells"))


def transpose_tiles(tiles: DataFrame) -> DataFrame:
    """The transpose of a tiled matrix: blocks change places, each tile is
    turned by itself."""
    width = F.size(F.col("cells")[0])
    turned = F.transform(F.sequence(F.lit(0), width - 1), lambda j: F.transform("cells", lambda row: row[j]))
    return tiles.select(F.col("col_block").alias("row_block"), F.col("row_block").alias("col_block"), turned.alias("cells"))


def tile_rows(tiles: DataFrame, tile: int = 256) -> DataFrame:
    """Tiles → ``id, col_block, part``: rows of the matrix, cut into parts at
    most ``tile`` wide."""
    return tiles.select("row_block", "col_block", F.posexplode("cells").alias("r", "part")).select(
        (F.col("row_block") * tile + F.col("r")).alias("id"), "col_block", "part")


def matrix_width(df: DataFrame, vec_col: str) -> int:
    return int(df.select(F.size(_as_array(df, vec_col))).first()[0])


@dataclass
class PCAResult:
    pc: np.ndarray                 # n × k, columns are components
    explained_variance: np.ndarray  # k ratios of total variance
    model: PCAModel | None = None   # set by method='cov'


def pca(df: DataFrame, vec_col: str, k: int, method: str = "cov") -> PCAResult:
    if method == "cov":
        model = PCA(k=k, inputCol=vec_col, outputCol="_pca").fit(df.select(vec_col))
        return PCAResult(model.pc.toArray(), model.explainedVariance.toArray(), model)
    if method != "svd":
        raise ValueError(method)
    x = df.select(vec_col)
    scaler = StandardScaler(withMean=True, withStd=False, inputCol=vec_col, outputCol="_c").fit(x)
    # each step of the solver reads all centred rows
    with held(scaler.transform(x), ["_c"]) as centred:
        res = _row_svd(centred, "_c", k)
    stats = x.select(Summarizer.metrics("variance", "count").summary(F.col(vec_col))
                     .alias("s")).first()["s"]
    m, var = int(stats["count"]), stats["variance"].toArray()
    ratios = (res.s ** 2 / (m - 1)) / float(var.sum())
    return PCAResult(res.V, ratios, None)


def project_pca(df: DataFrame, vec_col: str, res: PCAResult, k: int | None = None,
                out: str = "projected") -> DataFrame:
    """Project on the first ``k`` components of a PCA result: through MLlib's
    ``PCAModel.transform`` (JVM) when the covariance path produced a model
    with exactly these components, else through ``project``."""
    k = k or res.pc.shape[1]
    if res.model is not None and k == res.pc.shape[1]:
        m = res.model.copy().setInputCol(vec_col).setOutputCol(out)
        return m.transform(df)
    return project(df, vec_col, res.pc[:, :k], out)


def project(df: DataFrame, vec_col: str, pc: np.ndarray, out: str = "projected",
            scale: np.ndarray | None = None) -> DataFrame:
    """Append ``out`` = row · pc (un-centred), optionally divided by ``scale``
    per component. ``pc`` (n×k) is broadcast once; rows are multiplied in
    Arrow batches (one numpy matmul per batch)."""
    m = np.asarray(pc, dtype=np.float64)
    if scale is not None:
        m = m / np.asarray(scale, dtype=np.float64)[None, :]
    bc = df.sparkSession.sparkContext.broadcast(m)

    @F.pandas_udf(ArrayType(DoubleType()))
    def _proj(rows: pd.Series) -> pd.Series:
        if len(rows) == 0:
            return pd.Series([], dtype=object)
        x = np.stack(rows.to_numpy())
        return pd.Series(list(x @ bc.value))

    return df.withColumn(out, array_to_vector(_proj(_as_array(df, vec_col))))


@dataclass
class SVDResult:
    s: np.ndarray        # k singular values, descending
    V: np.ndarray        # n × k right singular vectors
    U: DataFrame | None = None  # (id, u vector) when requested

    @property
    def gram_eigenvalues(self) -> np.ndarray:
        """σ² = eigenvalues of XᵀX (Gram, not covariance)."""
        return self.s ** 2


def _row_svd(df: DataFrame, vec_col: str, k: int) -> SVDResult:
    mllib = MLUtils.convertVectorColumnsFromML(df.select(vec_col), vec_col)
    r = RowMatrix(mllib).computeSVD(k, computeU=False)
    return SVDResult(np.asarray(r.s.toArray()), np.asarray(r.V.toArray()))


def svd(df: DataFrame, vec_col: str, k: int, compute_u: bool = False,
        id_col: str | None = None, u_col: str = "u") -> SVDResult:
    """Truncated SVD of the (un-centred) row matrix. With ``compute_u`` the
    U rows keep ``id_col``."""
    with held(df, [vec_col]) as x:
        res = _row_svd(x, vec_col, k)
    if compute_u:
        keep = [id_col] if id_col else []
        s = np.where(res.s > 0, res.s, 1.0)
        u = project(df.select(*keep, vec_col), vec_col, res.V, out=u_col, scale=s)
        res.U = u.select(*keep, u_col)
    return res


def _eigen_sums(df: DataFrame, vec_col: str, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(XᵀXv, (Xv)ᵀXv, column sums of X and of Xv, rows) by sums over the rows
    in long form. What reaches the driver is as large as v."""
    n, k = v.shape
    rows = project(df.select(vec_col), vec_col, v, out="_p").select(_as_array(df, vec_col).alias("x"), vector_to_array("_p").alias("p"))
    cols = [F.col("p")[c] for c in range(k)]
    with held(rows) as held_rows:
        gram = np.zeros((n, k))
        x_sum = np.zeros(n)
        for r in (held_rows.select("p", F.posexplode("x").alias("j", "x")).groupBy("j").agg(
                F.sum("x").alias("s"), F.array(*(F.sum(F.col("x") * c) for c in cols)).alias("g")).collect()):
            gram[r.j], x_sum[r.j] = r.g, r.s
        pp, p_sum, m = np.zeros((k, k)), np.zeros(k), 0
        for r in (held_rows.select("p", F.posexplode("p").alias("c", "y")).groupBy("c").agg(
                F.count(F.lit(1)).alias("m"), F.sum("y").alias("s"), F.array(*(F.sum(F.col("y") * c) for c in cols)).alias("g")).collect()):
            pp[r.c], p_sum[r.c], m = r.g, r.s, r.m
    return gram, pp, x_sum, p_sum, m


_AUDIT = "component int, value double, eigen_ok boolean, v_ok boolean, u_ok boolean"


def _audit(spark: SparkSession, v: np.ndarray, values: np.ndarray, gram: np.ndarray, pp: np.ndarray, tol: float) -> DataFrame:
    scale = float(np.max(values)) if len(values) else 1.0
    eigen = np.abs(gram - v * values).max(axis=0) <= tol * scale
    orthonormal = np.abs(v.T @ v - np.eye(v.shape[1])).max(axis=0) <= tol
    size = np.sqrt(np.where(values > 0, values, 1.0))
    u = np.abs(pp / np.outer(size, size) - np.eye(len(values))).max(axis=0) <= tol
    return spark.createDataFrame([(i + 1, float(values[i]), bool(eigen[i]), bool(orthonormal[i]), bool(u[i]))
                                  for i in range(len(values))], _AUDIT)


def svd_audit(df: DataFrame, vec_col: str, res: SVDResult, tol: float = 1e-6) -> DataFrame:
    """Does a decomposition hold? One row for each component: its σ², and
    whether XᵀX v = σ² v (relative to the largest σ²), V is orthonormal in it,
    and U = X V Σ⁻¹ is."""
    gram, pp, _, _, _ = _eigen_sums(df, vec_col, res.V)
    return _audit(df.sparkSession, res.V, res.s ** 2, gram, pp, tol)


def pca_audit(df: DataFrame, vec_col: str, res: PCAResult, tol: float = 1e-6) -> DataFrame:
    """The same for principal components: their variance against the
    covariance matrix, and the covariance of the projected rows."""
    gram, pp, x_sum, p_sum, m = _eigen_sums(df, vec_col, res.pc)
    scale = max(m - 1, 1)
    gram, pp = (gram - np.outer(x_sum, p_sum) / max(m, 1)) / scale, (pp - np.outer(p_sum, p_sum) / max(m, 1)) / scale
    stats = df.select(Summarizer.metrics("variance").summary(F.col(vec_col)).alias("s")).first()["s"]
    total = float(stats["variance"].toArray().sum())
    return _audit(df.sparkSession, res.pc, res.explained_variance * total, gram, pp, tol)


def components_for_variance(ratios, share: float = 0.80) -> int:
    """Smallest P whose first P explained-variance ratios sum to ≥ ``share``."""
    c = np.cumsum(np.asarray(ratios, dtype=np.float64))
    hit = np.nonzero(c >= share)[0]
    return int(hit[0]) + 1 if len(hit) else len(c)


def variance_table(spark: SparkSession, ratios) -> DataFrame:
    """``component, explained_variance, cumulative`` (k rows)."""
    c = np.cumsum(ratios)
    return spark.createDataFrame(
        [(i + 1, float(r), float(cc)) for i, (r, cc) in enumerate(zip(ratios, c))],
        "component int, explained_variance double, cumulative double")
