"""Decision trees as data: node tables, rules, SQL expressions, and
cross-validation of the depth from trees that are grown once.

A fitted MLlib tree is read into a list of ``Node``s (a tree is on the driver
anyway). From it come

* ``node_table`` / ``tree_rules`` — the tree as rows: one for each node, or
  one readable rule for each leaf;
* ``tree_case`` — the tree as one SQL ``CASE`` expression, which scores rows
  in any engine and inside whole-stage codegen, without the model;
* ``truncate`` — the tree that a smaller ``maxDepth`` would have grown. MLlib
  grows level by level, so the upper levels of a deep tree are the shallow
  tree, down to its merging of sibling leaves that predict the same;
* ``cross_validate_trees`` — the grid depth x bins from one fit for each
  (fold, bins): the validation rows are counted once in the leaves of the
  deepest tree, and every depth is scored from those few counts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

import numpy as np
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import held
from . import supervised as SV
from .tuning import REPORT

LARGER_IS_BETTER = {"areaUnderROC": True, "accuracy": True, "rmse": False, "mse": False}


@dataclass(frozen=True)
class Node:
    """``id`` 1 is the root, the children of ``i`` are ``2 i`` and ``2 i + 1``.
    ``stats`` are the class counts of a classifier, (n, sum, sum of squares)
    of a regressor. A leaf has no feature; a split sends values up to
    ``threshold``, or those in ``categories``, to the left."""
    id: int
    depth: int
    prediction: float
    impurity: float
    stats: tuple[float, ...]
    n: int
    feature: int | None = None
    threshold: float | None = None
    categories: tuple[float, ...] | None = None
    gain: float | None = None

    @property
    def left(self) -> int | None:
        return None if self.feature is None else 2 * self.id

    @property
    def right(self) -> int | None:
        return None if self.feature is None else 2 * self.id + 1


def tree_nodes(model) -> list[Node]:
    """The nodes of a fitted tree (or of the tree in a fitted pipeline), each
    before its left and then its right subtree."""
    tree = SV.find_stage(model, (DecisionTreeClassificationModel, DecisionTreeRegressionModel))
    if tree is None:
        raise ValueError("no decision tree in model")
    out: list[Node] = []
    todo = [(tree._java_obj.rootNode(), 1, 0)]
    while todo:
        node, i, depth = todo.pop()
        calculator = node.impurityStats()
        own = Node(i, depth, node.prediction(), node.impurity(), tuple(calculator.stats()), int(calculator.rawCount()))
        if node.subtreeDepth() > 0:
            split = node.split()
            own = replace(own, feature=split.featureIndex(), gain=node.gain())
            if split.getClass().getSimpleName() == "ContinuousSplit":
                own = replace(own, threshold=split.threshold())
            else:
                own = replace(own, categories=tuple(sorted(split.leftCategories())))
            todo += [(node.rightChild(), 2 * i + 1, depth + 1), (node.leftChild(), 2 * i, depth + 1)]
        out.append(own)
    return out


def leaves(nodes: Sequence[Node]) -> list[Node]:
    """In the order of MLlib's leaf numbers (``leafCol``)."""
    return [x for x in nodes if x.feature is None]


def truncate(nodes: Sequence[Node], depth: int) -> list[Node]:
    """The tree that the same data grow with ``maxDepth`` ``depth``."""
    kept = {x.id: x for x in nodes if x.depth <= depth}
    for x in sorted(kept.values(), key=lambda x: -x.depth):
        if x.feature is None:
            continue
        cut = x.depth == depth
        if not cut:
            a, b = kept[x.left], kept[x.right]
            cut = a.feature is None and b.feature is None and a.prediction == b.prediction
            if cut:
                del kept[a.id], kept[b.id]
        if cut:
            kept[x.id] = replace(x, feature=None, threshold=None, categories=None, gain=None)
    return [kept[x.id] for x in nodes if x.id in kept]


def _number(x: float) -> str:
    if math.isinf(x) or math.isnan(x):
        return f"CAST('{'NaN' if math.isnan(x) else 'Infinity' if x > 0 else '-Infinity'}' AS DOUBLE)"
    return f"CAST({x!r} AS DOUBLE)"


def _test(node: Node, slot: Callable[[int], str]) -> str:
    x = slot(node.feature)
    if node.categories is None:
        return f"{x} <= {_number(node.threshold)}"
    return f"{x} IN ({', '.join(_number(c) for c in node.categories)})" if node.categories else "FALSE"


def tree_case(nodes: Sequence[Node], slots: Sequence[str] | Callable[[int], str], value: str = "prediction") -> str:
    """One SQL expression for the whole tree, ANSI ``CASE`` only. ``slots``
    gives the SQL of each feature; ``value`` is ``prediction`` or ``id`` (the
    leaf's node number). Like the model, it sends NaN to the right."""
    slot = slots if callable(slots) else slots.__getitem__
    by = {x.id: x for x in nodes}

    def sql(i: int) -> str:
        x = by[i]
        if x.feature is None:
            return _number(x.prediction) if value == "prediction" else str(x.id)
        return f"CASE WHEN {_test(x, slot)} THEN {sql(x.left)} ELSE {sql(x.right)} END"

    return sql(1)


def score(df: DataFrame, nodes: Sequence[Node], features: str = "features", out: str = "prediction",
          value: str = "prediction") -> DataFrame:
    """``out`` = the compiled tree on a vector column."""
    name = "_slots"
    while name in df.columns:
        name += "_"
    scored = F.expr(tree_case(nodes, lambda i: f"`{name}`[{i}]", value))
    return df.withColumn(name, vector_to_array(features)).withColumn(out, scored).drop(name)


NODE_SCHEMA = ("node long, depth int, feature int, name string, threshold double, categories array<double>, left long, "
               "right long, prediction double, impurity double, gain double, n long")


def node_table(spark: SparkSession, nodes: Sequence[Node], names: Sequence[str] | None = None) -> DataFrame:
    """One row for each node."""
    name = lambda f: None if f is None else names[f] if names else f"feature {f}"
    return spark.createDataFrame([(
        x.id, x.depth, x.feature, name(x.feature), x.threshold, None if x.categories is None else list(x.categories), x.left,
        x.right, x.prediction, x.impurity, x.gain, x.n) for x in nodes], NODE_SCHEMA)


def rules(nodes: Sequence[Node], names: Sequence[str] | None = None) -> list[tuple[int, str, float, float, int]]:
    """(leaf, rule, prediction, impurity, n) of each leaf, left to right; the
    rule joins the tests from the root on."""
    by = {x.id: x for x in nodes}
    slot = (lambda f: names[f]) if names else (lambda f: f"feature {f}")
    out = []
    for leaf in leaves(nodes):
        tests, i = [], leaf.id
        while i > 1:
            x = by[i // 2]
            if x.categories is None:
                tests.append(f"{slot(x.feature)} {'>' if i % 2 else '<='} {x.threshold!r}")
            else:
                tests.append(f"{slot(x.feature)} {'not in' if i % 2 else 'in'} {{{', '.join(map(repr, x.categories))}}}")
            i //= 2
        out.append((leaf.id, " and ".join(reversed(tests)) or "always", leaf.prediction, leaf.impurity, leaf.n))
    return out


def tree_rules(spark: SparkSession, nodes: Sequence[Node], names: Sequence[str] | None = None) -> DataFrame:
    """One row for each leaf: leaf, rule, prediction, impurity, n."""
    return spark.createDataFrame(rules(nodes, names), "leaf long, rule string, prediction double, impurity double, n long")


# --- depth by cross-validation --------------------------------------------------

def rank_auc(counts: dict[float, tuple[float, float]]) -> float:
    """Area under ROC from {score: (positives, negatives)}, ties one half."""
    below = hits = 0.0
    for s in sorted(counts):
        pos, neg = counts[s]
        hits += pos * (below + neg / 2)
        below += neg
    pos = sum(p for p, _ in counts.values())
    return hits / (pos * below) if pos and below else 0.0


def metric_of(nodes: Sequence[Node], counts: dict[int, dict[float, tuple[int, float, float]]], metric: str) -> float:
    """A metric of the tree from the rows counted in the leaves of it or of a
    deeper one: {leaf: {label or 0: (n, mean, population variance)}}."""
    by = {x.id: x for x in nodes}
    total = error = 0.0
    scores: dict[float, tuple[float, float]] = {}
    for i, groups in counts.items():
        while i not in by:
            i //= 2
        x = by[i]
        for label, (n, mean, var) in groups.items():
            total += n
            if metric in ("rmse", "mse"):
                error += n * (var + (mean - x.prediction) ** 2)
            elif metric == "accuracy":
                error += n * (label == x.prediction)
            else:   # the raw prediction of class 1, as MLlib's evaluator ranks by
                raw = x.stats[1] if len(x.stats) > 1 else 0.0
                pos, neg = scores.get(raw, (0.0, 0.0))
                scores[raw] = (pos + n, neg) if label == 1 else (pos, neg + n)
    if metric == "areaUnderROC":
        return rank_auc(scores)
    mean = error / total if total else float("nan")
    return math.sqrt(mean) if metric == "rmse" else mean


@dataclass
class TreeCV:
    """``grid`` lists (maxDepth, maxBins); ``folds`` has a row of metrics for
    each fold; ``best`` is the tree refitted on all rows."""
    grid: list[tuple[int, int]]
    folds: np.ndarray
    metric: str
    best: object
    best_index: int

    @property
    def averages(self) -> np.ndarray:
        return self.folds.mean(axis=0)

    def report(self, spark: SparkSession) -> DataFrame:
        """``grid_id, params, avg_metric, std_metric, is_best`` like ``cv_report``."""
        std = self.folds.std(axis=0)
        return spark.createDataFrame(
            [(i, f"maxBins={b}, maxDepth={d}", float(a), float(s), i == self.best_index)
             for i, ((d, b), a, s) in enumerate(zip(self.grid, self.averages, std))], REPORT)


def cross_validate_trees(train: DataFrame, kind: str, label: str, features: str, depths: Iterable[int], bins: Iterable[int],
                         metric: str, folds: int = 3, fold_col: str = "fold", parallelism: int = 3, **learner) -> TreeCV:
    """k-fold CV of a tree over depth x bins, with one fit for each (fold,
    bins). ``kind`` is ``classifier`` (labels 0, 1, ...) or ``regressor``;
    ``fold_col`` holds 0 to folds - 1. Equal metrics keep the first of the
    grid, depths outermost. The counts that reach the driver are bounded by
    leaves and classes."""
    depths, bins = list(depths), list(bins)
    grid = [(d, b) for d in depths for b in bins]
    make = SV.tree_classifier if kind == "classifier" else SV.tree_regressor

    def fitted(rows: DataFrame, depth: int, n_bins: int, **more):
        return make(label=label, features=features, max_depth=depth, max_bins=n_bins, **learner, **more).fit(rows)

    def of_fold(rows: DataFrame, fold: int, n_bins: int) -> list[float]:
        model = fitted(rows.where(F.col(fold_col) != fold), max(depths), n_bins, leaf_col="_leaf")
        nodes = tree_nodes(model)
        number = [x.id for x in leaves(nodes)]
        y = F.col(label).cast("double")
        group: Column = y if kind == "classifier" else F.lit(0.0)
        held_out = model.transform(rows.where(F.col(fold_col) == fold).select(label, features))
        counts: dict[int, dict[float, tuple[int, float, float]]] = {}
        for r in held_out.groupBy("_leaf", group.alias("_g")).agg(
                F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean"), F.var_pop(y).alias("var")).collect():
            counts.setdefault(number[int(r["_leaf"])], {})[r["_g"]] = (r.n, r["mean"], r["var"])
        return [metric_of(truncate(nodes, d), counts, metric) for d in depths]

    with held(train, [label, features, fold_col]) as rows:
        jobs = [(f, b) for f in range(folds) for b in bins]
        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            found = dict(zip(jobs, pool.map(lambda j: of_fold(rows, *j), jobs)))
        table = np.array([[found[f, b][depths.index(d)] for d, b in grid] for f in range(folds)])
        mean = table.mean(axis=0)
        best = int(np.argmax(mean) if LARGER_IS_BETTER[metric] else np.argmin(mean))
        return TreeCV(grid, table, metric, fitted(rows, *grid[best]), best)
