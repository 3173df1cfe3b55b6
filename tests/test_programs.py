"""End-to-end runs of the reference programs on small files in their formats."""
import os

import numpy as np
import pytest

from tessera.plans import programs as P


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("progs")
    rng = np.random.default_rng(1)
    out = {}
    # text
    (d / "story.txt").write_text("All animals are equal.\nBut some animals are more equal\n\n"
                                "than others, said the pigs. Windmill windmill!\n")
    out["text"] = str(d / "story.txt")
    # wide numeric table: label first, 28 features
    x = rng.normal(size=(400, 28))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(float)
    lines = [",".join([f"{yy:.1f}"] + [f"{v:.5f}" for v in row]) for yy, row in zip(y, x)]
    (d / "wide.csv").write_text("\n".join(lines) + "\n")
    out["wide"] = str(d / "wide.csv")
    # wine-like: ';' header, 11 features then label
    w = rng.uniform(0, 10, size=(300, 11))
    q = np.round(w[:, 0] + w[:, 3] / 2)
    head = ";".join(f'"f{i}"' for i in range(11)) + ';"quality"'
    (d / "wine.csv").write_text(head + "\n" + "\n".join(
        ";".join(f"{v:.3f}" for v in row) + f";{qq:.0f}" for row, qq in zip(w, q)) + "\n")
    out["wine"] = str(d / "wine.csv")
    # claims-like
    rows = ["Row_ID,Vehicle,Cat1,Var1,Claim_Amount"]
    for i in range(200):
        cat = "ABC"[i % 3]
        v1 = float(rng.normal())
        rows.append(f"{i},{i % 7},{cat},{v1:.4f},{2.0 + (i % 3) + 0.5 * v1 + abs(rng.normal()) :.4f}")
    rows.append("999,,A,0.1,1.0")  # a null → dropped
    (d / "claims.csv").write_text("\n".join(rows) + "\n")
    out["claims"] = str(d / "claims.csv")
    # word x paper matrix
    m = rng.poisson(2.0, size=(10, 6)).astype(float)
    head = "word," + ",".join(f"p{j}" for j in range(6))
    (d / "word_paper.csv").write_text(head + "\n" + "\n".join(
        f"w{i}," + ",".join(f"{v:.0f}" for v in m[i]) for i in range(10)) + "\n")
    out["word_paper"], out["word_paper_m"] = str(d / "word_paper.csv"), m
    # profiles: id + 6 values, two planted groups
    prof = np.vstack([rng.normal(0, 1, size=(30, 6)), rng.normal(50, 1, size=(20, 6))])
    (d / "profiles.csv").write_text("id," + ",".join(f"c{j}" for j in range(6)) + "\n" + "\n".join(
        f"{i}," + ",".join(f"{v:.4f}" for v in r) for i, r in enumerate(prof)) + "\n")
    out["profiles"] = str(d / "profiles.csv")
    # ratings (rank 1) + test with an unseen user
    a, b = 1 + 0.1 * np.arange(15), 0.5 + 0.2 * np.arange(12)
    tr = [f"{u}::{i}::{a[u] * b[i]:.4f}::0" for u in range(15) for i in range(12) if (u + i) % 5]
    te = [f"{u}::{i}::{a[u] * b[i]:.4f}::0" for u in range(15) for i in range(12) if not (u + i) % 5]
    te.append("77::1::3.0::0")
    (d / "ratings.train").write_text("\n".join(tr) + "\n")
    (d / "ratings.test").write_text("\n".join(te) + "\n")
    out["train"], out["test"], out["n_test"] = str(d / "ratings.train"), str(d / "ratings.test"), len(te)
    # space separated, 12 fields, keep 10
    s = np.vstack([rng.normal(0, 1, size=(40, 12)), rng.normal(8, 1, size=(40, 12))])
    (d / "digits.txt").write_text("\n".join(" ".join(f"{v:.3f}" for v in r) for r in s) + "\n")
    out["digits"] = str(d / "digits.txt")
    out["dir"] = d
    return out


def test_text_mining(spark, files):
    r = P.text_mining(spark, files["text"], k=3, min_len=6)
    top = [(x.word, x.n) for x in r["top_words"].collect()]
    assert top[0] == ("animals", 2) and ("equal", 2) in top
    rare = [x.word for x in r["rare_words"].collect()]
    assert rare == ["others", "animals", "windmill"]   # count asc, then word


def test_tree_classifier_cv(spark, files):
    r = P.tree_classifier_cv(spark, files["wide"], depths=(2, 3), bins=(10,), folds=2)
    cv = r["cv"].collect()
    assert len(cv) == 2 and sum(x.is_best for x in cv) == 1
    assert r["test_accuracy"].first().accuracy > 0.7
    assert r["test_auc"].first().auc > 0.7
    assert r["preview"].count() == 5
    rep = {x.key: x.value for x in r["tree"].collect()}
    assert rep["kind"] == "classification"


def test_tree_regressor_cv_wine(spark, files):
    r = P.tree_regressor_cv(spark, files["wine"], sep=";", label_idx=11, start=0, length=11,
                            header=True, depths=(1, 3), bins=(5, 10), folds=3,
                            index_features=False)
    cv = r["cv"].collect()
    best = [x for x in cv if x.is_best][0]
    assert best.avg_metric == min(x.avg_metric for x in cv)   # lower RMSE is better
    assert r["test"].first().rmse < 2.0


def test_logistic_cv(spark, files):
    r = P.logistic_cv(spark, files["wide"], reg_params=(0.01, 0.3), folds=2)
    assert r["cv"].count() == 2 and r["test_accuracy"].first().accuracy > 0.5


def test_glm_report(spark, files):
    r = P.glm_report(spark, files["claims"], "Claim_Amount")
    g = r["gaussian"]
    terms = {x.term for x in g["summary"].where("stat = 'coefficient'").collect()}
    assert terms == {"Vehicle", "Var1", "Cat1_idx", "intercept"}   # no target, no Row_ID
    assert g["residuals"].count() > 0
    assert r["poisson"]["test"].first().n > 0


def test_matrix_report(spark, files):
    out = str(files["dir"] / "projected_out")
    r = P.matrix_report(spark, files["word_paper"], k=2, out_dir=out)
    m = files["word_paper_m"]
    t = sorted((x.id, list(x.features)) for x in r["transposed"].collect())
    assert np.allclose(np.array([v for _, v in t]), m.T)
    assert r["explained_variance"].count() == 2
    assert os.path.isdir(out) and len(r["projected"].collect()) == 6
    s = [x.singular_value for x in r["svd"].orderBy("component").collect()]
    assert np.allclose(s, np.linalg.svd(m.T, compute_uv=False)[:2])


def test_matrix_report_take_rows(spark, files):
    r = P.matrix_report(spark, files["word_paper"], k=2, take_rows=4)
    assert len(r["transposed"].first().features) == 4


def test_cluster_report(spark, files):
    r = P.cluster_report(spark, files["profiles"], k=2, max_iter=20, take_cols=5)
    e = r["extremes"].first()
    assert (e.largest_size, e.smallest_size) == (30, 20)
    assert e.distance == pytest.approx(50 * np.sqrt(5), rel=0.1)
    assert len(r["centers"].first().center) == 5


def test_recommend_report(spark, files):
    r = P.recommend_report(spark, files["train"], files["test"], rank=2, max_iter=15, reg=0.001)
    m = r["mse"].first()
    assert m.n == files["n_test"] - 1          # the unseen user is dropped
    assert m.mse < 0.05
    assert r["item_map"].count() == 12 and r["user_map"].count() == 15


def test_reduce_cluster_report(spark, files):
    r = P.reduce_cluster_report(spark, files["digits"], k=2, max_iter=20, take_cols=10)
    s = r["summary"].first()
    assert 1 <= s.components <= 10
    assert r["top_singular_values"].count() == min(5, s.components)


def test_matrix_report_wide_path(spark, files):
    """The distributed-SVD PCA: ratios and |projections| as numpy has them."""
    r = P.matrix_report(spark, files["word_paper"], method="svd", k=2)
    x = files["word_paper_m"].T                          # papers × words
    ev = np.linalg.eigvalsh(np.cov(x, rowvar=False))[::-1]
    got = [e.explained_variance for e in r["explained_variance"].orderBy("component").collect()]
    assert np.allclose(got, (ev / ev.sum())[:2])
    w, v = np.linalg.eigh(np.cov(x, rowvar=False))
    pc = v[:, ::-1][:, :2]
    proj = sorted((p.id, list(p.projected)) for p in r["projected"].collect())
    assert np.allclose(np.abs([p for _, p in proj]), np.abs(x @ pc), atol=1e-8)


def test_read_matrix_every_file_header_dropped(spark, tmp_path):
    d = tmp_path / "two"
    d.mkdir()
    (d / "a.csv").write_text("w,p0,p1\nx,1,2\ny,3,4\n")
    (d / "b.csv").write_text("w,p0,p1\nz,5,6\nq,7,8\n")
    m = P.read_matrix(spark, str(d))
    rows = sorted(list(r.features) for r in m.collect())
    assert rows == [[1.0, 2.0], [3.0, 4.0], [5.0, 6.0], [7.0, 8.0]]
    assert sorted(r.id for r in m.collect()) == [0, 1, 2, 3]
    (d / "c.csv").write_text("w,p0,p1\nbad,1,oops\n")
    from pyspark.errors import PySparkException
    with pytest.raises(PySparkException):
        P.read_matrix(spark, str(d)).collect()
