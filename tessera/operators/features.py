"""Categorical encoding and vector assembly (MLlib feature stages).

* ``fit_labels`` / ``index_columns`` — one label model for all columns
  (frequency desc, ties by the value's string form ascending).
* ``index_vector`` — ``VectorIndexer``: slots with ≤ ``max_categories``
  distinct values become categorical (0.0 always gets index 0, the others
  ascending); the rest stay continuous.
* ``assemble`` — ``VectorAssembler`` with a target-leak guard.
* ``decode_label`` — ``IndexToString`` back to the original label.

Scale: ``fit_labels`` builds one label table in Spark (one aggregation and
one distributed ranking for all columns), so it takes any number of distinct
values, and encodes a table with two exchanges at most, however many columns
there are. ``fit_indexer`` gives MLlib's own model, for ML pipelines; that
keeps every distinct label on the driver and in each task.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.feature import (IndexToString, StringIndexer, StringIndexerModel,
                                VectorAssembler, VectorIndexer)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import with_rank

def string_indexer(cols: list[str], suffix: str = "_idx", handle_invalid: str = "error",
                   order: str = "frequencyDesc") -> StringIndexer:
    return StringIndexer(inputCols=list(cols), outputCols=[c + suffix for c in cols],
                         handleInvalid=handle_invalid, stringOrderType=order)


def fit_indexer(df: DataFrame, cols: list[str], suffix: str = "_idx",
                handle_invalid: str = "error") -> StringIndexerModel:
    return string_indexer(cols, suffix, handle_invalid).fit(df)


@dataclass
class LabelModel:
    """The labels of several columns in one table: ``col`` (place in
    ``columns``), ``label``, ``n``, ``idx``. ``sizes`` has for each column
    (rows, labels, hot labels), ``hot`` its hot labels with their ranks and
    hashes (fewer than 1000 a column)."""
    columns: list[str]
    table: DataFrame
    sizes: list[tuple[int, int, int]]
    hot: list[list[tuple[str, int, int]]]

    def labels(self, col: str) -> DataFrame:
        """``label, n, idx`` of one column."""
        return self.table.where(F.col("col") == self.columns.index(col)).select("label", "n", "idx")

    def _hot(self, i: int) -> Column:
        """The rank of column i's value if it is a hot label, else null: a
        look-up in a constant table of hash buckets."""
        if not self.hot[i]:
            return F.lit(None).cast("double")
        n = 1 << (len(self.hot[i]) - 1).bit_length()
        buckets: list[list] = [[] for _ in range(n)]
        for label, idx, h in self.hot[i]:
            buckets[h % n].append({"l": label, "i": idx})
        table = F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<l:string,i:double>>>")
        value = F.col(self.columns[i]).cast("string")
        own = F.get(table, F.pmod(F.xxhash64(value), F.lit(n)).cast("int"))
        return F.get(F.filter(own, lambda e: e["l"] == value), F.lit(0))["i"]

    def transform(self, df: DataFrame, suffix: str = "_idx", handle_invalid: str = "error") -> DataFrame:
        """Adds ``<col><suffix>`` (double) for every column, in the order of
        the model. Null or unseen values: 'error' raises, 'skip' drops the
        row, 'keep' gives the number of labels.

        Hot labels are looked up in place. The look-ups of all other labels, of
        all columns, go through one exchange as (column, label) pairs, and
        through a second one back to their rows. Rows are known there by two
        hashes of their own values, so a lost task that is run again sends the
        same pairs; rows of equal values are put together before that exchange
        and taken apart behind it. (Map columns cannot be hashed.)"""
        if handle_invalid not in ("error", "skip", "keep"):
            raise ValueError(handle_invalid)
        own = df.columns
        tmp = lambda c: f"_{c}_of_label_model"
        df = df.select("*", *(self._hot(i).alias(tmp(i)) for i in range(len(self.columns))))
        cold = [i for i, (_, k, n_hot) in enumerate(self.sizes) if k > n_hot]
        if cold:
            df = self._cold(df, own, cold, tmp)
        if handle_invalid == "skip":
            df = df.na.drop("any", subset=[tmp(i) for i in range(len(self.columns))])
        out = []
        for i, c in enumerate(self.columns):
            found = F.col(tmp(i))
            if handle_invalid == "keep":
                found = F.coalesce(found, F.lit(float(self.sizes[i][1])))
            elif handle_invalid == "error":
                found = F.coalesce(found, F.raise_error(F.concat(
                    F.lit(f"{c}: unseen label "), F.coalesce(F.col(c).cast("string"), F.lit("NULL")))).cast("double"))
            out.append(found.alias(c + suffix))
        replaced = {c + suffix for c in self.columns}
        return df.select(*(c for c in own if c not in replaced), *out)

    def _cold(self, df: DataFrame, own: list[str], cold: list[int], tmp) -> DataFrame:
        key = [F.xxhash64(F.lit(seed), *(F.col(c) for c in own)).alias(tmp(f"key{seed}")) for seed in (0, 1)]
        rows = df.select(*key, F.struct(*df.columns).alias("row"))
        asked = rows.select(tmp("key0"), tmp("key1"), F.explode(F.array(*(F.struct(
            F.lit(i).alias("col"), F.when(F.col(f"row.{tmp(i)}").isNull(), F.col("row")[self.columns[i]].cast("string")).alias("label"))
            for i in cold))).alias("x")).select(tmp("key0"), tmp("key1"), "x.col", "x.label").where("label is not null")
        table = self.table.where(~F.col("hot")).select("col", "label", F.col("idx").cast("double").alias("idx"))
        answers = asked.join(table, ["col", "label"]).select(
            tmp("key0"), tmp("key1"), F.lit(None).cast(rows.schema["row"].dataType).alias("row"), F.struct("col", "idx").alias("found"))
        kind = answers.schema["found"].dataType
        both = rows.withColumn("found", F.lit(None).cast(kind)).unionByName(answers)
        # equal rows ask for equal labels: each answer is kept once
        whole = both.groupBy(tmp("key0"), tmp("key1")).agg(
            F.first("row", ignorenulls=True).alias("row"), F.count("row").alias("copies"), F.collect_set("found").alias("found"))
        whole = whole.withColumn("found", F.map_from_entries("found")).withColumn(
            "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        return whole.select(*(F.col("row")[c].alias(c) for c in own), *(
            (F.coalesce(F.col("row")[tmp(i)], F.col("found")[F.lit(i)]) if i in cold else F.col("row")[tmp(i)]).alias(tmp(i))
            for i in range(len(self.columns))))


def fit_labels(df: DataFrame, cols: list[str]) -> LabelModel:
    """Labels of all ``cols``: distinct non-null values as strings, how often
    each occurs, and its 0-based rank in its column by frequency (desc), then
    by the string (asc). One aggregation of (column, label) pairs and one
    distributed ranking for all columns together.

    A label that holds more than 1/1000 of its column's rows is ``hot``; a
    column has fewer than 1000 of those."""
    pairs = F.array(*(F.struct(F.lit(i).alias("col"), F.col(c).cast("string").alias("label")) for i, c in enumerate(cols)))
    counts = (df.select(F.explode(pairs).alias("x")).select("x.col", "x.label").where(F.col("label").isNotNull())
              .groupBy("col", "label").agg(F.count(F.lit(1)).alias("n")))
    ranked = with_rank(counts, [F.asc("col"), F.desc("n"), F.asc("label")], "place")
    # one row for each column
    of_col = ranked.groupBy("col").agg(F.min("place").alias("first"), F.sum("n").alias("total"))
    table = ranked.join(F.broadcast(of_col), "col").select(
        "col", "label", "n", (F.col("place") - F.col("first")).alias("idx"), (F.col("n") * 1000 > F.col("total")).alias("hot"))
    sizes, hot = [(0, 0, 0)] * len(cols), [[] for _ in cols]
    entry = F.when(F.col("hot"), F.struct("label", "idx", F.xxhash64("label").alias("h")))
    for r in table.groupBy("col").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("k"),
                                      F.collect_list(entry).alias("hot")).collect():
        hot[r.col] = [(x.label, x.idx, x.h) for x in r.hot]
        sizes[r.col] = (r.rows, r.k, len(r.hot))
    return LabelModel(list(cols), table, sizes, hot)


def label_table(df: DataFrame, col: str) -> DataFrame:
    """``label, n, idx`` of one column (see ``fit_labels``)."""
    return fit_labels(df, [col]).labels(col)


def index_columns(df: DataFrame, cols: list[str], suffix: str = "_idx",
                  handle_invalid: str = "error", fit_on: DataFrame | None = None) -> DataFrame:
    """Frequency-rank encode ``cols`` → ``<col><suffix>`` (double), like a
    fitted ``StringIndexer`` but for any number of labels. ``fit_on`` lets the
    labels come from the training rows only. To encode several tables alike,
    fit once with ``fit_labels``."""
    if handle_invalid not in ("error", "skip", "keep"):
        raise ValueError(handle_invalid)
    return fit_labels(fit_on if fit_on is not None else df, cols).transform(df, suffix, handle_invalid)


def index_vector(df: DataFrame, col: str = "features", out: str = "indexedFeatures",
                 max_categories: int = 4, fit_on: DataFrame | None = None,
                 handle_invalid: str = "error") -> DataFrame:
    model = vector_indexer(col, out, max_categories, handle_invalid).fit(
        fit_on if fit_on is not None else df)
    return model.transform(df)


def vector_indexer(col: str = "features", out: str = "indexedFeatures",
                   max_categories: int = 4, handle_invalid: str = "error") -> VectorIndexer:
    return VectorIndexer(inputCol=col, outputCol=out, maxCategories=max_categories,
                         handleInvalid=handle_invalid)


def assemble(df: DataFrame, cols: list[str], out: str = "features",
             label: str | None = None, allow_leak: bool = False,
             handle_invalid: str = "error", suffix: str = "_idx") -> DataFrame:
    """Assemble ``cols`` into one vector. The label, or its indexed form
    (label + ``suffix``), inside the features is a target leak and raises
    unless ``allow_leak``."""
    if label is not None and not allow_leak:
        leaks = [c for c in cols if c in (label, label + suffix)]
        if leaks:
            raise ValueError(f"target leak: {leaks} derive from label {label!r}")
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def decode_label(df: DataFrame, labels: list[str], col: str = "prediction",
                 out: str = "predictedLabel") -> DataFrame:
    return IndexToString(inputCol=col, outputCol=out, labels=list(labels)).transform(df)
