"""Train/test splits and k-fold assignment.

``random_split`` is Spark's ``randomSplit`` (per-partition Bernoulli
sampling: the same seed gives different rows when the partitioning
changes). ``key_split`` / ``key_folds`` hash a key column (and the
seed) instead, so the assignment is a pure function of the row: stable on
any cluster size, across re-reads, after executor loss, and reproducible
in plain SQL. Neither shuffles: both are a filter / projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import HASH_RANGE
from ..functions.columns import key_bucket, key_hash


def random_split(df: DataFrame, weights=(0.7, 0.3), seed: int = 100) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def split_cut(ratio: float) -> int:
    """Hash threshold for a ``ratio`` share of the key space."""
    if not 0.0 < ratio < 1.0:
        raise ValueError("ratio must be in (0, 1)")
    return int(round(ratio * HASH_RANGE))


def in_train(key: str | Column, ratio: float = 0.7, seed: int = 0) -> Column:
    return key_hash(key, seed) < F.lit(split_cut(ratio))


def key_split(df: DataFrame, key: str | Column, ratio: float = 0.7,
              seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash: ``ratio`` of the key space goes to train."""
    cond = in_train(key, ratio, seed)
    return df.where(cond), df.where(~cond)


def with_split(df: DataFrame, key: str | Column, ratio: float = 0.7, seed: int = 0,
               col: str = "part") -> DataFrame:
    """Adds ``col`` = 'train' / 'test'."""
    return df.withColumn(col, F.when(in_train(key, ratio, seed), "train").otherwise("test"))


def key_folds(df: DataFrame, key: str | Column, k: int = 3, seed: int = 0,
              col: str = "fold") -> DataFrame:
    """Adds an integer fold id ``0..k-1`` (usable as ``CrossValidator.foldCol``)."""
    return df.withColumn(col, key_bucket(key, k, seed))


PAIR_SHIFT = 2**31


def pair_key(a: str | Column, b: str | Column) -> Column:
    """One integer key from two int ids (e.g. user, item) for pair-level
    splits: ``a · 2³¹ + b`` (no overflow for int ids)."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return ca.cast("bigint") * F.lit(PAIR_SHIFT) + cb.cast("bigint")
