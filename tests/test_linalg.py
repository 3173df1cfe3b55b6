import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array

from tessera.operators import linalg as LA


def _mat(spark, x):
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<double>").select(
        "id", array_to_vector("v").alias("features"))


def _local(df, col="features", id_col="id"):
    rows = sorted(df.select(id_col, vector_to_array(col).alias("a")).collect())
    return np.array([r.a for r in rows])


@pytest.fixture(scope="module")
def mats():
    rng = np.random.default_rng(0)
    small = np.array([[1.0, 2.0], [3.0, 4.0], [5.0, 7.0]])
    big = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 5)) + 3.0
    return small, big


def test_transpose_roundtrip(spark, mats):
    small, big = mats
    t = LA.transpose(_mat(spark, small), "id", "features")
    assert np.allclose(_local(t), small.T)
    tt = LA.transpose(LA.transpose(_mat(spark, big), "id", "features"), "id", "features")
    assert np.allclose(_local(tt), big)


def test_from_long_sparse_fill(spark):
    df = spark.createDataFrame([(0, 2, 5.0), (1, 0, 1.0)], "i long, j int, v double")
    out = _local(LA.from_long(df, 3))
    assert out.tolist() == [[0.0, 0.0, 5.0], [1.0, 0.0, 0.0]]
    wider = _local(LA.from_long(df, 5))
    assert wider.tolist() == [[0.0, 0.0, 5.0, 0.0, 0.0], [1.0, 0.0, 0.0, 0.0, 0.0]]


@pytest.mark.parametrize("entries", [[(0, 0, 1.0), (0, 0, 9.0), (0, 2, 3.0)], [(0, 3, 1.0)]])
def test_from_long_refuses_repeated_and_outside_positions(spark, entries):
    df = spark.createDataFrame(entries, "i long, j int, v double")
    with pytest.raises(Exception, match="repeated or out of range"):
        LA.from_long(df, 3).collect()


def test_from_long_wide_row_with_gaps(spark):
    from pyspark.sql import functions as F
    width = 16_000
    df = spark.range(width).where("id % 3 != 1").select(
        F.lit(7).alias("i"), F.col("id").cast("int").alias("j"), F.col("id").cast("double").alias("v"))
    (row,) = _local(LA.from_long(df, width))
    assert row.tolist() == [float(j) if j % 3 != 1 else 0.0 for j in range(width)]


def test_distributed_svd_path_on_wide_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6)) @ rng.normal(size=(6, 160)) + 0.1 * rng.normal(size=(400, 160))
    df = _mat(spark, x)
    wide, full = (LA.pca(df, "features", 5, method=m) for m in ("svd", "cov"))
    assert np.allclose(wide.explained_variance, full.explained_variance, rtol=1e-6)
    assert np.allclose(np.abs(wide.pc), np.abs(full.pc), atol=1e-6)
    r = LA.svd(df, "features", 3)
    assert np.allclose(r.s, np.linalg.svd(x, compute_uv=False)[:3])


def test_pca_ratios_and_methods(spark, mats):
    _, big = mats
    df = _mat(spark, big)
    full = LA.pca(df, "features", 5, method="cov")
    assert full.explained_variance.sum() == pytest.approx(1.0)
    ev = np.linalg.eigvalsh(np.cov(big, rowvar=False))[::-1]
    assert np.allclose(full.explained_variance, ev / ev.sum())
    wide = LA.pca(df, "features", 3, method="svd")
    assert np.allclose(wide.explained_variance, full.explained_variance[:3])
    assert np.allclose(np.abs(wide.pc), np.abs(full.pc[:, :3]), atol=1e-8)


def test_projection_uncentred_keeps_distances(spark, mats):
    _, big = mats
    df = _mat(spark, big)
    r = LA.pca(df, "features", 5, method="cov")
    p = _local(LA.project(df, "features", r.pc, "p"), "p")
    assert np.allclose(p, big @ r.pc)
    d0 = np.linalg.norm(big[0] - big[1])
    assert np.linalg.norm(p[0] - p[1]) == pytest.approx(d0)


def test_svd_gram_and_u(spark, mats):
    _, big = mats
    df = _mat(spark, big)
    r = LA.svd(df, "features", 2, compute_u=True, id_col="id")
    s = np.linalg.svd(big, compute_uv=False)
    assert np.allclose(r.s, s[:2])
    assert np.allclose(r.gram_eigenvalues, np.linalg.eigvalsh(big.T @ big)[::-1][:2])
    u = _local(r.U, "u")
    assert np.allclose(np.abs(u.T @ u), np.eye(2), atol=1e-8)


def test_components_for_variance():
    assert LA.components_for_variance([0.5, 0.25, 0.05, 0.2], 0.80) == 3  # reaches .80 exactly
    assert LA.components_for_variance([0.5, 0.25, 0.04, 0.21], 0.80) == 4
    assert LA.components_for_variance([0.5, 0.3, 0.2], 0.80) == 2
    assert LA.components_for_variance([0.9, 0.1], 0.80) == 1


def test_to_long(spark):
    df = _mat(spark, [[1.0, 2.0]])
    rows = sorted(tuple(r) for r in LA.to_long(df, "id", "features").collect())
    assert rows == [(0, 0, 1.0), (0, 1, 2.0)]


@pytest.mark.parametrize("n,m,tile", [(1, 1, 4), (7, 5, 4), (8, 4, 4), (13, 9, 4), (6, 20, 7)])
def test_tiles_transpose_like_numpy(spark, n, m, tile):
    x = np.arange(n * m, dtype=float).reshape(n, m) + 0.5
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(n)], "id long, v array<double>").repartition(3)
    tiles = LA.to_tiles(df, "id", "v", tile)
    assert all(len(r.cells) <= tile and len(c) <= tile for r in tiles.collect() for c in r.cells)
    for form, want in ((tiles, x), (LA.transpose_tiles(tiles), x.T)):
        got = np.full(want.shape, np.nan)
        for r in LA.tile_rows(form, tile).collect():
            got[r.id, r.col_block * tile:r.col_block * tile + len(r.part)] = r.part
        assert (got == want).all()
    back = LA.transpose_tiles(LA.transpose_tiles(tiles))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, tiles.collect()))


def test_tiles_with_absent_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (3, [4.0, 5.0, 6.0])], "id long, v array<double>")
    cells = {(r.row_block, r.col_block): r.cells for r in LA.to_tiles(df, "id", "v", 2, n_rows=5).collect()}
    assert cells == {(0, 0): [[0, 0], [1, 2]], (0, 1): [[0], [3]], (1, 0): [[0, 0], [4, 5]], (1, 1): [[0], [6]]}
    with pytest.raises(Exception, match="repeated"):
        LA.to_tiles(df.union(df), "id", "v", 2).collect()
    assert LA.to_tiles(df.limit(0), "id", "v", 2).count() == 0


def test_audits_see_right_and_wrong_decompositions(spark):
    rnd = np.random.default_rng(8)
    x = rnd.normal(size=(300, 130)) @ np.diag(np.linspace(3, 0.1, 130)) + rnd.normal(size=130)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, a array<double>").select(
        "id", array_to_vector("a").alias("v"))
    res = LA.svd(df, "v", 4)
    good = LA.svd_audit(df, "v", res).collect()
    assert all(r.eigen_ok and r.v_ok and r.u_ok for r in good)
    assert [r.value for r in good] == pytest.approx((np.linalg.svd(x)[1][:4] ** 2).tolist())
    for method in ("cov", "svd"):
        p = LA.pca(df, "v", 4, method)
        assert all(r.eigen_ok and r.v_ok and r.u_ok for r in LA.pca_audit(df, "v", p).collect())
        # components of the rows as they are, not centred, are no principal components
        wrong = LA.PCAResult(res.V, p.explained_variance)
        assert not all(r.eigen_ok for r in LA.pca_audit(df, "v", wrong).collect())
    turned = LA.SVDResult(res.s, res.V + 1e-3)
    assert not any(r.v_ok for r in LA.svd_audit(df, "v", turned).collect())
