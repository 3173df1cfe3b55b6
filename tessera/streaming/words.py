"""Incremental word counts over a folder of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.text import clean_words


def stream_word_counts(spark: SparkSession, folder: str, min_len: int = 1,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``word, n`` over every line of every text file that lands in
    ``folder``. The aggregation state (one row per distinct word) lives in
    the state store and is checkpointed with the query, so a restarted query
    resumes from its last committed batch."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(folder)
    return clean_words(lines, "value", min_len).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))

