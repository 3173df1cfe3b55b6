import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tessera.operators import als_blocks
from tessera.operators import recommend as RC


def test_rank1_and_cold_start(spark):
    a = [1.0 + 0.1 * u for u in range(20)]
    b = [0.5 + 0.2 * i for i in range(15)]
    rows = [(u, i, a[u] * b[i]) for u in range(20) for i in range(15)]
    train = spark.createDataFrame(rows, "user int, item int, rating double")
    m = RC.als_fit(train, rank=2, max_iter=15, reg=0.001, seed=1)
    test = spark.createDataFrame([(0, 0, a[0] * b[0]), (3, 7, a[3] * b[7]), (99, 1, 1.0)],
                                 "user int, item int, rating double")
    scored = RC.als_score(m, test)
    assert sorted(r.user for r in scored.collect()) == [0, 3]   # unseen user dropped
    assert RC.als_mse(scored).first().mse < 1e-2
    f = RC.factors(m, "item")
    assert f.count() == 15 and f.first().features is not None
    mp = RC.factor_map(m, "item", 2)
    assert mp.count() == 15 and set(mp.columns) == {"id", "projected"}


def _ratings(spark, n=400, seed=2):
    rnd = np.random.default_rng(seed)
    rows = {(int(rnd.zipf(1.6)) % 40, int(rnd.integers(0, 25))): float(rnd.integers(1, 6)) for _ in range(n)}
    return spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "user int, item int, rating double")


def test_normal_equations_by_hand(spark):
    ratings = _ratings(spark)
    rows = ratings.collect()
    rnd = np.random.default_rng(1)
    vectors = {i: rnd.normal(size=3) for i in range(0, 25, 2)}      # odd items have no factors
    partners = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "id int, features array<double>")
    got = {r.id: r for r in RC.normal_equations(ratings, partners, 3).collect()}
    assert set(got) == {r.user for r in rows if r.item in vectors}
    for u, r in got.items():
        own = [(x.rating, vectors[x.item]) for x in rows if x.user == u and x.item in vectors]
        a = sum(np.outer(v, v) for _, v in own)
        assert r.n == len(own) and r.rr == pytest.approx(sum(x * x for x, _ in own))
        assert r.a == pytest.approx(a[np.triu_indices(3)].tolist()) and r.b == pytest.approx(sum(x * v for x, v in own).tolist())


def test_audit_of_a_fit_and_of_spoilt_factors(spark):
    ratings = _ratings(spark)
    model = RC.als_fit(ratings, rank=4, max_iter=5, reg=0.05, seed=1)
    users, items = ratings.select("user").distinct().count(), ratings.select("item").distinct().count()
    audit = {r.side: r for r in RC.als_audit(model, ratings, 0.05).collect()}
    assert (audit["user"].n, audit["user"].known, audit["user"].solved, audit["user"].not_better) == (users,) * 4
    assert audit["item"].n == audit["item"].known == audit["item"].bounded == items
    # the items were solved against other users: a further half step changes them
    assert audit["item"].solved < items and audit["item"].improvable > 0
    # a wrong penalty, and wrong factors, are seen
    wrong = {r.side: r for r in RC.als_audit(model, ratings, 0.5).collect()}
    assert wrong["user"].solved == 0
    equations = RC.normal_equations(ratings, model.itemFactors, 4)
    spoilt = model.userFactors.withColumn("features", F.transform("features", lambda x: x * 1.01))
    assert RC.with_residual(equations, spoilt, 4, 0.05).where("residual <= 1e-5").count() == 0


def test_equations_are_summed_up_where_an_id_has_its_ratings(spark, monkeypatch):
    """An id's sums do not travel from every task (only those of hot ids do),
    and an audit makes each side's equations once."""
    ratings = _ratings(spark)
    model = RC.als_fit(ratings, rank=4, max_iter=2, reg=0.05, seed=1)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    equations = RC.normal_equations(ratings, model.itemFactors, 4)
    assert plan(equations).count("RepartitionByExpression") == 1
    assert plan(RC.als_audit(model, ratings, 0.05)).count("Join Inner, (_partner") == 4
    rows = lambda df: {r.id: (r.n, [round(x, 6) for x in [*r.a, *r.b, r.rr]]) for r in df.collect()}
    whole = rows(equations)
    counts = sorted(n for n, _ in whole.values())
    monkeypatch.setattr(RC, "HOT_RATINGS", counts[len(counts) // 2])
    assert counts[0] <= RC.HOT_RATINGS < counts[-1]
    hot = rows(RC.normal_equations(ratings, model.itemFactors, 4))
    assert hot.keys() == whole.keys()
    assert all(hot[k][0] == n and hot[k][1] == pytest.approx(x) for k, (n, x) in whole.items())


def test_ratings_are_stored_as_parquet(spark):
    from tessera.plans import cluster_jobs
    stored = cluster_jobs._als_ratings(spark, "/root/testdata/sf0.001")
    assert stored.inputFiles() and all(f.endswith(".parquet") for f in stored.inputFiles())
    assert {f.split("/")[-2].split("-")[0] for f in stored.inputFiles()} == {"ratings"}


def test_fold_in_gives_new_users_the_factors_of_a_fit(spark):
    ratings = _ratings(spark)
    model = RC.als_fit(ratings, rank=4, max_iter=5, reg=0.05, seed=1)
    new = ratings.where("user < 5").withColumn("user", F.col("user") + 1000)
    equations = RC.normal_equations(new, model.itemFactors, 4)
    made = {r.id - 1000: r.features for r in RC.fold_in(equations, 4, 0.05).collect()}
    known = {r.id: r.features for r in model.userFactors.collect()}
    assert made and all(v == pytest.approx(known[u], rel=1e-3, abs=1e-4) for u, v in made.items())
    solved = RC.with_residual(equations, RC.fold_in(equations, 4, 0.05), 4, 0.05)
    assert solved.where("residual > 1e-9").count() == 0
    empty = RC.normal_equations(new.limit(0), model.itemFactors, 4)
    assert RC.fold_in(empty, 4, 0.05).count() == 0


@pytest.mark.parametrize("seed", [3, 4, 11])
def test_planted_products_at_several_seeds(spark, seed):
    rnd = np.random.default_rng(5)
    pairs = {(int(rnd.zipf(1.4)) % 300, int(rnd.integers(0, 120))) for _ in range(3000)}
    rows = [(u, i, (1 + u % 5) * (1 + i % 7) / 5.0, float(rnd.random())) for u, i in sorted(pairs)]
    df = spark.createDataFrame(rows, "user int, item int, rating double, h double")
    train, test = df.where("h < 0.7"), df.where("h >= 0.7")
    model = RC.als_fit(train, rank=1, max_iter=20, reg=1e-6, seed=seed, nonnegative=True)
    r = RC.als_mse(RC.als_score(model, test)).first()
    assert r.n == RC.scorable_pairs(train, test).count() > 0 and r.mse < 1e-6


def test_map_audit_sees_a_wrong_map(spark, monkeypatch):
    model = RC.als_fit(_ratings(spark), rank=4, max_iter=3, reg=0.05, seed=1)
    assert tuple(RC.map_audit(model).first())[1:] == (True, True)
    right = RC.factor_map(model)
    turned = right.select("id", array_to_vector(F.transform(vector_to_array("projected"), lambda x, i: x + i)).alias("projected"))
    skewed = turned.select("id", array_to_vector(F.array(vector_to_array("projected")[0], vector_to_array("projected")[0]
                                                         + vector_to_array("projected")[1])).alias("projected"))
    monkeypatch.setattr(RC, "factor_map", lambda *a: skewed)
    assert tuple(RC.map_audit(model).first())[1:] == (False, False)


# --- fits of more ratings than MLlib's blocks hold -----------------------------

def _fit_by_hand(rows, rank, iters, reg, seed):
    """ALS id by id from the same first factors."""
    first = als_blocks._kernels(rank, reg, seed, 1)[2]
    ids = np.array(sorted({r[0] for r in rows}), np.int32)
    x = dict(zip(ids.tolist(), first(ids)))

    def solved(side, v):
        out = {}
        for k in {r[side] for r in rows}:
            own = [(v[r[1 - side]].astype(float), float(np.float32(r[2]))) for r in rows if r[side] == k]
            a = sum(np.outer(y, y) for y, _ in own) + reg * len(own) * np.eye(rank)
            out[k] = np.linalg.solve(a, sum(y * q for y, q in own)).astype(np.float32)
        return out

    for _ in range(iters):
        y = solved(1, x)
        x = solved(0, y)
    return x, y


@pytest.mark.parametrize("piece, held, sort, interval", [(1 << 19, 1 << 25, 1 << 22, 10), (8, 0, 60, 2)])
def test_fit_in_blocks_equals_one_by_hand(spark, monkeypatch, piece, held, sort, interval):
    """In one piece a block and in many, with ids of several pieces, factors
    in files and a checkpoint; ids may be negative and pairs come twice."""
    for name, value in (("PIECE", piece), ("HELD", held), ("SORTED", sort)):
        monkeypatch.setattr(als_blocks, name, value)
    monkeypatch.setattr(RC, "MLLIB_RATINGS", 0)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    ratings = _ratings(spark).withColumn("user", F.col("user") * 1001 - 5)
    ratings = ratings.unionByName(ratings.where("item < 3").withColumn("rating", F.col("rating") + 1))
    rows = [tuple(r) for r in ratings.collect()]
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        model = RC.als_fit(ratings, rank=4, max_iter=5, reg=0.05, seed=1, checkpoint_interval=interval)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    for got, want in zip((model.userFactors, model.itemFactors), _fit_by_hand(rows, 4, 5, 0.05, 1)):
        got = {r.id: r.features for r in got.collect()}
        assert got.keys() == want.keys()
        assert all(v == pytest.approx(want[k].tolist(), rel=1e-4, abs=1e-4) for k, v in got.items())
    assert model.rank == 4 and RC.als_score(model, ratings.limit(3)).count() == 3
    assert RC.factor_map(model).count() == len(want)


def test_fit_in_blocks_is_audited_and_does_not_hang_on_the_layout(spark, monkeypatch):
    ratings = _ratings(spark)
    monkeypatch.setattr(RC, "MLLIB_RATINGS", 0)
    fit = lambda df: RC.als_fit(df, rank=4, max_iter=3, reg=0.05, seed=1)
    rows = lambda m: sorted((r.id, *r.features) for r in m.userFactors.collect())
    model = fit(ratings)
    audit = {r.side: r for r in RC.als_audit(model, ratings, 0.05).collect()}
    users, items = ratings.select("user").distinct().count(), ratings.select("item").distinct().count()
    assert (audit["user"].n, audit["user"].known, audit["user"].solved) == (users,) * 3
    assert audit["item"].n == audit["item"].known == audit["item"].bounded == items
    monkeypatch.setattr(als_blocks, "BLOCK", 30)        # more blocks than cores
    other = rows(fit(ratings.orderBy(F.desc("rating")).repartition(3)))
    assert [r[0] for r in other] == [r[0] for r in rows(model)]
    assert np.array(other) == pytest.approx(np.array(rows(model)), rel=1e-5, abs=1e-6)


def test_fit_in_blocks_frees_the_factors_it_has_used(spark, monkeypatch):
    """MLlib keeps the factors that all half iterations have sent until the
    fit ends."""
    freed, real = [], als_blocks._free
    monkeypatch.setattr(als_blocks, "_free", lambda sc, ids: (freed.append(list(ids)), real(sc, ids)))
    monkeypatch.setattr(RC, "MLLIB_RATINGS", 0)
    RC.als_fit(_ratings(spark), rank=2, max_iter=4, reg=0.05, seed=1)
    # the rows sorted for each side; after each half iteration what it has read; at the end the last factors and both sides
    assert [len(x) for x in freed] == [1, 1, 0, 1, 1, 1, 1, 1, 1, 3]
    assert len({k for x in freed for k in x}) == 2 + 7 + 2


@pytest.mark.parametrize("row", [(None, 1, 1.0), (1, None, 1.0), (1, 1, None), (1, 1, float("nan"))])
def test_fit_in_blocks_rejects_what_mllib_rejects(spark, monkeypatch, row):
    ratings = spark.createDataFrame([(1, 2, 1.0), row], "user int, item int, rating double")
    for most in (20_000_000, 0):
        monkeypatch.setattr(RC, "MLLIB_RATINGS", most)
        with pytest.raises(Exception, match="(?i)null"):
            RC.als_fit(ratings, rank=2, max_iter=1)


def test_hash_of_blocks_is_the_same_in_sql_and_numpy(spark):
    ids = np.array([0, 1, -1, 7, 2**31 - 1, -2**31, 123456], np.int32)
    x = ids.astype(np.uint32)
    for _ in range(2):
        x = (x ^ (x >> np.uint32(16))) * np.uint32(als_blocks.MIX)
    x = x ^ (x >> np.uint32(16))
    got = spark.createDataFrame([(int(i),) for i in ids], "id int").select(als_blocks.hashed(F.col("id")).alias("h"))
    assert [r.h for r in got.collect()] == x.tolist()


def test_audit_joins_the_factors_where_the_sums_were_made(spark):
    """Not after Python has solved the equations: Spark would move them all."""
    ratings = _ratings(spark)
    model = RC.als_fit(ratings, rank=4, max_iter=2, reg=0.05, seed=1)
    plan = RC.als_audit(model, ratings, 0.05)._jdf.queryExecution().optimizedPlan().toString()
    seen = [("solve" if "MapInArrow" in line else "join") for line in plan.split("\n") if "MapInArrow" in line or "Join LeftOuter, (id" in line]
    assert seen == ["solve", "join"] * 2
