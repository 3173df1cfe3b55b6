"""Text-mining queries over ``documents.text`` and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..constants import ENGLISH_STOP_WORDS
from ..operators import text as T
from .sqlutil import sql_in_list
from .tables import table


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("text")


def q_word_counts(spark, sf_dir):
    return T.word_counts(_docs(spark, sf_dir), "text")


def q_top_words(spark, sf_dir):
    return T.top_words(_docs(spark, sf_dir), "text", k=15)


def q_rare_words(spark, sf_dir):
    return T.rare_words(_docs(spark, sf_dir), "text", k=15, min_len=6)


def _words_sql(min_len: int = 1) -> str:
    cond = "tok <> ''" + (f" AND length(tok) >= {min_len}" if min_len > 1 else "")
    return f"""
WITH toks AS (SELECT unnest(regexp_split_to_array(text, '\\W')) AS tok FROM documents),
     w AS (SELECT lower(tok) AS word FROM toks WHERE {cond})
SELECT word, CAST(count(*) AS BIGINT) AS n FROM w
WHERE word NOT IN {sql_in_list(ENGLISH_STOP_WORDS)}
GROUP BY word"""


QUERIES = {
    "word_counts": q_word_counts,
    "top_words": q_top_words,
    "rare_words": q_rare_words,
}

ORACLE = {
    "word_counts": _words_sql(),
    "top_words": f"SELECT * FROM ({_words_sql()}) ORDER BY n DESC, word ASC LIMIT 15",
    "rare_words": f"SELECT * FROM ({_words_sql(6)}) ORDER BY n ASC, word ASC LIMIT 15",
}
