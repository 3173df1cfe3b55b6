"""Word-frequency mining over a text column.

Semantics (the text-mining job): split every line on ASCII ``\\W``, drop
empty tokens, lower-case, remove Spark's English stop words, count.
Top-k orders by count desc then word; rare words by count asc then word
(ties are broken by the word, so every k-list is deterministic).

Plan shape: scan → Generate(explode) → Filter → partial HashAggregate →
one hash shuffle on ``word`` → final HashAggregate → TakeOrderedAndProject.
Hot words (a third of all tokens) are pre-aggregated map-side, so the
shuffle carries at most (#distinct words × #map tasks) rows.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import ENGLISH_STOP_WORDS, WORD_SPLIT


def words(df: DataFrame, col: str = "value", min_len: int = 1,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat-map of ``col`` into raw tokens (``token``), empties dropped.
    ``min_len`` filters on the raw token length (``length >= min_len``).
    Runs in the partitions of the scan."""
    tok = df.select(*keep, F.explode(F.split(F.col(col), WORD_SPLIT)).alias("token"))
    cond = F.col("token") != ""
    if min_len > 1:
        cond = cond & (F.length("token") >= min_len)
    return tok.where(cond)


def clean_words(df: DataFrame, col: str = "value", min_len: int = 1,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Tokens lower-cased with stop words removed → column ``word``.

    Tokens from an ASCII ``\\W`` split are ASCII, so ``lower`` matches Java's
    ``toLowerCase``; the stop-word test is a hashed ``InSet`` on the JVM.
    """
    w = words(df, col, min_len, keep).select(*keep, F.lower("token").alias("word"))
    return w.where(~F.col("word").isin(list(ENGLISH_STOP_WORDS)))


def token_pipeline(input_col: str = "value", output_col: str = "filtered") -> Pipeline:
    """The ML-pipeline form: RegexTokenizer (default ``\\s+`` gaps, lower-case)
    then StopWordsRemover (Spark's English list, case-insensitive)."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=input_col, outputCol="_words"),
        StopWordsRemover(inputCol="_words", outputCol=output_col),
    ])


def word_counts(df: DataFrame, col: str = "value", min_len: int = 1) -> DataFrame:
    """``word, n`` for every distinct cleaned word."""
    return (clean_words(df, col, min_len)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def top_words(df: DataFrame, col: str = "value", k: int = 15) -> DataFrame:
    """The k most frequent words (count desc, word asc)."""
    return word_counts(df, col).orderBy(F.desc("n"), F.asc("word")).limit(k)


def rare_words(df: DataFrame, col: str = "value", k: int = 15,
               min_len: int = 6) -> DataFrame:
    """The k least frequent words of at least ``min_len`` characters
    (count asc, word asc). Words are exploded before grouping, so stop words
    vanish instead of merging into one empty group."""
    return (word_counts(df, col, min_len)
            .orderBy(F.asc("n"), F.asc("word")).limit(k))
