"""Matrix-factorisation recommendation (ALS, explicit feedback): MLlib's up to
MLLIB_RATINGS ratings, ``als_blocks`` for more.

MLlib's ALS blocks users and items and shuffles factor blocks every half
iteration; its lineage is cut every ``checkpoint_interval`` iterations in
the session's shared checkpoint folder (see ``session.ensure_checkpoint_dir``),
so a lost executor does not replay the whole run. Pairs whose user or item
was never seen in training are dropped at scoring (cold start);
``scorable_pairs`` lists the others without a model, ``fold_in`` makes
factors for new users or items.

ALS solves, for each user (or item) with ratings r of partners with factors
v, the normal equations (Σ v vᵀ + λ n I) x = Σ r v. ``normal_equations``
rebuilds them with grouped sums, so a fit can be audited row by row
(``als_audit``) and a side can be solved anew (``fold_in``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import als_blocks

HOT_RATINGS = 100_000    # of an id whose ratings are summed up where they lie
MLLIB_RATINGS = 20_000_000   # at most for a fit by MLlib, which builds each of its 10 blocks in one task's heap


def als_fit(ratings: DataFrame, rank: int = 10, max_iter: int = 10, reg: float = 0.01,
            seed: int = 0, user: str = "user", item: str = "item", rating: str = "rating",
            checkpoint_interval: int = 10, blocks: int | None = None, nonnegative: bool = False) -> ALSModel:
    """Explicit ALS (rank 10, 10 iterations, λ = 0.01 by default). User and
    item ids must fit in an int; MLlib rejects larger ones. ``nonnegative``
    keeps all factors at 0 or above, which spares users and items of few
    ratings the stationary points with huge factors of both signs.

    MLlib deals the ratings out to its own blocks and holds those, so they are
    neither spread nor held before. Over MLLIB_RATINGS of them, ``als_blocks``
    solves the same equations in blocks of bounded size, from other first
    factors; a given number of MLlib's ``blocks`` and ``nonnegative`` factors
    are left to MLlib."""
    ensure_checkpoint_dir(ratings.sparkSession)
    kw = {}
    if blocks:
        kw = {"numUserBlocks": blocks, "numItemBlocks": blocks}
    est = ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed, userCol=user,
              itemCol=item, ratingCol=rating, coldStartStrategy="drop",
              checkpointInterval=checkpoint_interval, nonnegative=nonnegative, **kw)
    ratings = ratings.select(user, item, rating)
    if blocks or nonnegative or max_iter < 1 or (n := ratings.count()) <= MLLIB_RATINGS:
        return est.fit(ratings)
    return _block_fit(est, ratings, n)


def _block_fit(est: ALS, ratings: DataFrame, n: int) -> ALSModel:
    """The model of ``est`` for ``n`` ratings by ``als_blocks``. Rows that
    MLlib rejects raise as they do there."""
    spark = ratings.sparkSession

    def whole(name: str) -> F.Column:
        c = F.col(name)
        ok = c.isNotNull() & (c.cast("double") == F.expr(f"try_cast(`{name}` AS int)"))
        return F.when(ok, c.cast("int")).otherwise(F.raise_error(F.lit(f"ALS only supports non-Null values in Integer range and without fractional part for column {name}")))

    r = F.col(est.getRatingCol()).cast("float")
    rows = ratings.select(whole(est.getUserCol()).alias("user"), whole(est.getItemCol()).alias("item"),
                          F.when(r.isNotNull() & ~F.isnan(r), r).otherwise(F.raise_error(F.lit("Ratings MUST NOT be Null or NaN"))).alias("rating"))

    def stored(table: DataFrame, name: str) -> DataFrame:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        table.write.parquet(path)
        return spark.read.schema(table.schema).parquet(path)

    users, items = als_blocks.fit(rows, n, est.getRank(), est.getMaxIter(), est.getRegParam(), est.getSeed(),
                                  est.getCheckpointInterval(), stored)
    made = spark.sparkContext._jvm.org.apache.spark.ml.recommendation.ALSModel(est.uid, est.getRank(), users._jdf, items._jdf)
    return est._copyValues(est._create_model(made))


def als_score(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Adds ``prediction``; pairs with an unseen user or item are dropped."""
    return model.transform(pairs)


def scorable_pairs(train: DataFrame, pairs: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """The pairs a model fitted on ``train`` can score: those whose user and
    item both have a rating there (two semi-joins, no fit)."""
    return (pairs.join(train.select(user).distinct(), user, "left_semi")
            .join(train.select(item).distinct(), item, "left_semi"))


def als_mse(scored: DataFrame, rating: str = "rating",
            prediction: str = "prediction") -> DataFrame:
    err = F.col(rating).cast("double") - F.col(prediction).cast("double")
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse"))


def factors(model: ALSModel, which: str = "user") -> DataFrame:
    """``id, features array<float>`` of the user or item factor table."""
    return model.userFactors if which == "user" else model.itemFactors


def normal_equations(ratings: DataFrame, partners: DataFrame, rank: int, side: str = "user", partner: str = "item",
                     rating: str = "rating") -> DataFrame:
    """``id, n, a, b, rr``: for each ``side`` id its number of ratings, Σ v vᵀ
    (upper triangle, row by row), Σ r v and Σ r² over the factors v of its
    partners (``partners``: id, features). Ratings without a known partner
    take no part.

    One join on the partner, then plain sums. An id's sums are many times
    the size of a rating with its factors, and few of its ratings lie in one
    task after the join: so the ratings are moved to their id and summed up
    there. Only a user with over HOT_RATINGS ratings is summed up in each task
    before the shuffle."""
    v = partners.select(F.col("id").alias("_partner"), F.col("features").alias("_v"))
    rows = ratings.select(F.col(side).alias("id"), F.col(partner).alias("_partner"), F.col(rating).cast("double").alias("_r"))
    hot = F.broadcast(rows.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HOT_RATINGS).select("id"))

    def summed(own: DataFrame) -> DataFrame:
        x = own.select("id", "_r", *(F.col("_v")[i].cast("double").alias(f"_v{i}") for i in range(rank)))
        c = [F.col(f"_v{i}") for i in range(rank)]
        return x.groupBy("id").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("_r") * F.col("_r")).alias("rr"),
            *(F.sum(c[i] * c[j]).alias(f"a{i}_{j}") for i in range(rank) for j in range(i, rank)),
            *(F.sum(F.col("_r") * c[i]).alias(f"b{i}") for i in range(rank)))

    cold = summed(rows.join(hot, "id", "left_anti").join(v, "_partner").select("id", "_r", "_v").repartition("id"))
    sums = cold.unionByName(summed(rows.join(hot, "id", "left_semi").join(v, "_partner")))
    return sums.select("id", "n", F.array(*(f"a{i}_{j}" for i in range(rank) for j in range(i, rank))).alias("a"),
                       F.array(*(f"b{i}" for i in range(rank))).alias("b"), "rr")


def _matrix(rank: int, reg: float) -> list[list[F.Column]]:
    """Σ v vᵀ + λ n I as columns."""
    at = {k: n for n, k in enumerate((i, j) for i in range(rank) for j in range(i, rank))}
    cell = lambda i, j: F.col("a")[at[min(i, j), max(i, j)]]
    return [[cell(i, j) + (F.lit(reg) * F.col("n") if i == j else F.lit(0.0)) for j in range(rank)] for i in range(rank)]


def _errors(x: str, rank: int, reg: float) -> tuple[F.Column, F.Column]:
    """``residual`` and ``loss`` (see ``with_residual``) of the factors ``x``
    beside their equations."""
    total = lambda terms: sum(terms[1:], terms[0])
    x = [F.col(x)[i] for i in range(rank)]
    a = _matrix(rank, reg)
    product = [total([a[i][j] * x[j] for j in range(rank)]) for i in range(rank)]
    size = [total([F.abs(a[i][j] * x[j]) for j in range(rank)]) + F.abs(F.col("b")[i]) for i in range(rank)]
    off = [F.abs(product[i] - F.col("b")[i]) / F.when(size[i] > 0, size[i]).otherwise(1.0) for i in range(rank)]
    loss = total([x[i] * product[i] - 2 * F.col("b")[i] * x[i] for i in range(rank)]) + F.col("rr")
    return F.greatest(*off) if rank > 1 else off[0], loss


def _beside(equations: DataFrame, factors_: DataFrame) -> DataFrame:
    """Each id's equations and its factors x."""
    return equations.join(factors_.select("id", F.col("features").cast("array<double>").alias("x")), "id", "left")


def with_residual(equations: DataFrame, factors_: DataFrame, rank: int, reg: float) -> DataFrame:
    """Adds to each id's equations its factors x, the largest |(A x - b)_i|
    relative to the sizes of its terms (``residual``), and the regularised
    squared error xᵀA x - 2 bᵀx + Σ r² (``loss``)."""
    rows = _beside(equations, factors_)
    residual, loss = _errors("x", rank, reg)
    return rows.withColumn("residual", residual).withColumn("loss", loss)


def fold_in(equations: DataFrame, rank: int, reg: float) -> DataFrame:
    """``id, features``: the least-squares factors of each id's equations, for
    users or items that the model has never seen, or for a further half
    iteration. Batches of small systems are solved in Arrow tasks."""
    return _solved(equations.select("id", "n", "a", "b"), rank, reg).select("id", "features")


def _solved(equations: DataFrame, rank: int, reg: float) -> DataFrame:
    """The equations with their least-squares factors (``features``)."""
    upper = np.triu_indices(rank)

    def solve(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            k = batch.num_rows
            tri = batch.column("a").flatten().to_numpy().reshape(k, -1)
            a = np.zeros((k, rank, rank))
            a[:, upper[0], upper[1]] = tri
            a[:, upper[1], upper[0]] = tri
            a[:, range(rank), range(rank)] += reg * batch.column("n").to_numpy()[:, None]
            b = batch.column("b").flatten().to_numpy().reshape(k, rank, 1)
            # without a penalty few ratings leave a system of lower rank
            x = np.linalg.solve(a, b) if reg > 0 else np.linalg.pinv(a, hermitian=True) @ b
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(x[:, :, 0]), pa.list_(pa.float64()))],
                                             [*batch.schema.names, "features"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in equations.schema)
    return equations.mapInArrow(solve, f"{schema}, features array<double>")


def als_audit(model: ALSModel, ratings: DataFrame, reg: float, user: str = "user", item: str = "item",
              rating: str = "rating", tol: float = 1e-5) -> DataFrame:
    """Are the returned factors a solution? One row for each side: ``n`` ids
    with ratings, ``known`` with factors, ``solved`` (residual within ``tol``),
    ``not_better`` (the loss a new exact solution of the id's equations saves
    is within ``tol``), ``improvable`` (n - not_better).

    MLlib solves the users last, so every user's equations must hold for the
    returned item factors. The items were solved against the users before
    them; how many of them a further half iteration would change says how far
    the fit still is from its fixed point.

    A side's equations are made once. The returned factors are joined where
    the sums were made, before Python adds the exact solution: after it Spark
    would move the equations, many times the factors' size, once more."""
    out = None
    for side, partner, own, other in ((user, item, model.userFactors, model.itemFactors),
                                      (item, user, model.itemFactors, model.userFactors)):
        equations = normal_equations(ratings, other, model.rank, side, partner, rating)
        new = _solved(_beside(equations.where("id is not null"), own), model.rank, reg).withColumnRenamed("features", "new")
        residual, loss = _errors("x", model.rank, reg)
        both = new.withColumn("residual", residual).withColumn("loss", loss).withColumn("least", _errors("new", model.rank, reg)[1])
        close = F.col("loss") - F.col("least") <= tol * (F.abs("least") + F.lit(tol) * F.col("rr"))
        row = both.agg(F.lit("user" if side == user else "item").alias("side"), F.count(F.lit(1)).alias("n"),
                       F.count("x").alias("known"), F.coalesce(F.sum((F.col("residual") <= tol).cast("long")), F.lit(0)).alias("solved"),
                       F.coalesce(F.sum(close.cast("long")), F.lit(0)).alias("not_better"),
                       F.coalesce(F.sum((F.col("least") <= F.col("loss") + tol * F.col("rr")).cast("long")), F.lit(0)).alias("bounded"))
        row = row.withColumn("improvable", F.col("n") - F.col("not_better"))
        out = row if out is None else out.unionByName(row)
    return out


def gram(rows: DataFrame, col: str, k: int, centre: bool = False) -> DataFrame:
    """``i, j, v``: Σ x_i x_j over the rows of a k-vector column (i ≤ j),
    around the mean if asked for. Rotations and signs of the axes of a space
    spanned by the same vectors show in no sum of squares."""
    x = rows.select(*(F.col(col)[i].cast("double").alias(f"x{i}") for i in range(k)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    value = ((lambda i, j: F.covar_pop(f"x{i}", f"x{j}") * F.count(F.lit(1))) if centre
             else (lambda i, j: F.sum(F.col(f"x{i}") * F.col(f"x{j}"))))
    one = x.agg(F.array(*(value(i, j) for i, j in pairs)).alias("v"))
    entries = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col("v")[n].alias("v")) for n, (i, j) in enumerate(pairs)))
    return one.select(F.inline(entries))


def map_audit(model: ALSModel, which: str = "item", k: int = 2, tol: float = 1e-9) -> DataFrame:
    """Is ``factor_map`` the map of most variance? One row: ``n`` mapped ids,
    ``uncorrelated`` (the centred Gram matrix of the map is diagonal),
    ``top_variance`` (its diagonal holds the k largest eigenvalues of the
    factors' own centred Gram matrix). Both are free of rotation and sign.
    The matrices that reach the driver are rank x rank."""
    mapped = factor_map(model, which, k).withColumn("projected", vector_to_array("projected"))

    def matrix(rows: DataFrame, col: str, n: int) -> np.ndarray:
        out = np.zeros((n, n))
        for r in gram(rows, col, n, centre=True).collect():
            out[r.i, r.j] = out[r.j, r.i] = r.v
        return out

    own, whole = matrix(mapped, "projected", k), matrix(factors(model, which), "features", model.rank)
    top = np.linalg.eigvalsh(whole)[::-1][:k]
    scale = max(float(top[0]), np.finfo(float).tiny)
    flat = np.abs(own - np.diag(np.diag(own))).max() <= tol * scale
    same = np.abs(np.diag(own) - top).max() <= tol * scale
    return mapped.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(bool(flat)).alias("uncorrelated"), F.lit(bool(same)).alias("top_variance"))


def factor_map(model: ALSModel, which: str = "item", k: int = 2) -> DataFrame:
    """PCA-k map of a factor table, ids kept: ``id, projected`` (un-centred
    projection, like the reference's ``RowMatrix.multiply``)."""
    f = factors(model, which).select("id", array_to_vector(
        F.col("features").cast("array<double>")).alias("features"))
    p = PCA(k=k, inputCol="features", outputCol="projected").fit(f)
    return p.transform(f).select("id", "projected")
