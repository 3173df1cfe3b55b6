"""The training-data pipeline: five stages from raw documents to token ids.

Each stage takes all documents that the stage before it kept and is written
as Parquet, which the next one reads. All but the last return the columns of
``documents``, whatever their names.

Rows are judged one by one, so null and repeated ids do no harm; repeated rows
are copies of each other. Null texts count as empty: clean, without benchmark
phrases, and equal to each other, so that one of them stays. An empty table
stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, exact_dedup, near_dedup, sentence_pieces, toxicity
from tessera.llm.common import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5 (operator 10). Labels train
    the model (those of its training part) and are never read for a score;
    without any toxic label all documents stay."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id (operator 4); null ids
    are smaller than any, of rows that repeat id and text one stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the
    smallest id (operator 8); null ids come after all others."""
    return near_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no phrase of the benchmark occurs (operator 7); with
    an empty benchmark all stay."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, decoded back as a check (operator 2); an
    empty text has none."""
    return sentence_pieces.encoded_digest(docs, sentence_pieces.Vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentence_pieces", encode),
]

# the trained tagger, the classes of near duplicates and the pieces have no
# SQL form; the stages are tested against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each but the last is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
