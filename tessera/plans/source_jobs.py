"""Sources, sinks and the ML text pipeline on lines made of the driver tables.

Each job writes a table's columns as text in one of the programs' input
formats below the shared checkpoint folder and reads the files back through
the library's scans, so its work grows with the table.
"""

from __future__ import annotations

import uuid

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ENGLISH_STOP_WORDS
from ..functions.columns import with_row_index
from ..operators import text as T
from ..session import checkpoint_dir
from ..sources import first_rows, preview, read_lines, read_ratings, read_table, write_vectors
from .programs import read_labeled
from .tables import table

LINE_ID = "l_orderkey * 8 + l_linenumber"


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _lines(df: DataFrame, sep: str, cols: list[str]) -> DataFrame:
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]).alias("value"))


def q_numeric_lines(spark, sf_dir):
    """Semicolon lines with a header in every file → label (field 0) and a
    vector of the next three fields; the last field is left out."""
    li = table(spark, sf_dir, "lineitem").select(
        F.expr(LINE_ID).alias("id"), "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    path = _scratch(spark, "numeric-lines")
    li.write.option("sep", ";").option("header", True).csv(path)
    rows = read_labeled(spark, path, ";", 0, 1, 3, header=True)
    a = vector_to_array("features")
    return rows.select(F.col("label").cast("bigint").alias("id"), *[a[i].alias(f"f{i}") for i in range(3)])


NUMERIC_LINES_SQL = f"""
SELECT CAST({LINE_ID} AS BIGINT) AS id, CAST(l_quantity AS DOUBLE) AS f0,
       CAST(l_extendedprice AS DOUBLE) AS f1, CAST(l_discount AS DOUBLE) AS f2 FROM lineitem"""


def q_vector_lines(spark, sf_dir):
    """Vectors saved as comma-joined text, read back as lines."""
    li = table(spark, sf_dir, "lineitem").select(F.expr(LINE_ID).cast("double").alias("id"), "l_quantity", "l_discount")
    v = VectorAssembler(inputCols=["id", "l_quantity", "l_discount"], outputCol="features").transform(li)
    path = _scratch(spark, "vector-lines")
    write_vectors(v, "features", path)
    return read_lines(spark, path, min_partitions=4)


VECTOR_LINES_SQL = f"""
SELECT CAST(CAST({LINE_ID} AS DOUBLE) AS VARCHAR) || ',' || CAST(CAST(l_quantity AS DOUBLE) AS VARCHAR)
       || ',' || CAST(CAST(l_discount AS DOUBLE) AS VARCHAR) AS "value" FROM lineitem"""


def q_csv_table(spark, sf_dir):
    """Delimited table with header and inferred types, rows with nulls dropped."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderpriority")).alias("priority"), "o_totalprice")
    path = _scratch(spark, "csv-table")
    o.write.option("sep", ";").option("header", True).csv(path)
    rows = read_table(spark, path, sep=";", infer_schema=True, drop_nulls=True)
    return rows.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                       F.col("o_custkey").cast("bigint").alias("o_custkey"), "priority", "o_totalprice")


CSV_TABLE_SQL = """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
       o_orderpriority AS priority, CAST(o_totalprice AS DOUBLE) AS o_totalprice
FROM orders WHERE o_custkey % 5 <> 0 AND o_orderpriority IS NOT NULL"""


def q_rating_lines(spark, sf_dir):
    """``user::item::rating::timestamp`` lines → user, item, rating."""
    li = table(spark, sf_dir, "lineitem").withColumn("id", F.expr(LINE_ID))
    path = _scratch(spark, "rating-lines")
    _lines(li, "::", ["l_suppkey", "l_partkey", "l_quantity", "id"]).write.text(path)
    return read_ratings(spark, path, user="user_id", item="item_id")


RATING_LINES_SQL = """
SELECT CAST(l_suppkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS item_id,
       CAST(l_quantity AS DOUBLE) AS rating FROM lineitem"""


def q_line_positions(spark, sf_dir):
    """0-based positions of lines over several files, in file order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    path = _scratch(spark, "positions")
    _lines(o.repartitionByRange(5, "o_orderkey").sortWithinPartitions("o_orderkey"), ",", ["o_orderkey"]).write.text(path)
    return with_row_index(read_lines(spark, path), "pos").select("pos", F.col("value").cast("bigint").alias("o_orderkey"))


LINE_POSITIONS_SQL = """
SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, CAST(o_orderkey AS BIGINT) AS o_orderkey FROM orders"""


FIRST_ROWS = 1000


def q_first_rows(spark, sf_dir):
    """The first 1000 lines of a folder of many files, which needs the first
    files only."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    path = _scratch(spark, "first-rows")
    _lines(o.repartitionByRange(24, "o_orderkey").sortWithinPartitions("o_orderkey"), ",", ["o_orderkey"]).write.text(path)
    rows = first_rows(spark, path, FIRST_ROWS)
    return rows.select("position", F.col("value").cast("bigint").alias("o_orderkey"))


FIRST_ROWS_SQL = f"""
SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, CAST(o_orderkey AS BIGINT) AS o_orderkey
FROM orders ORDER BY o_orderkey LIMIT {FIRST_ROWS}"""


def q_preview_lines(spark, sf_dir):
    """A preview holds no more rows than asked for, and only rows of the
    table, whole."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    head = preview(o, ["o_orderkey", "o_custkey"], 20)
    known = head.join(o.select("o_orderkey", F.col("o_custkey").alias("c")), "o_orderkey", "left")
    return known.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("orders"),
                     F.min(F.col("o_custkey") == F.col("c")).alias("whole"))


PREVIEW_LINES_SQL = "SELECT least(count(*), 20) AS n, least(count(*), 20) AS orders, TRUE AS whole FROM orders"


def q_ml_tokens(spark, sf_dir):
    """The ML text pipeline (regex tokenizer, stop-word remover) on documents:
    number of tokens left and a checksum of their space-joined string."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("value"))
    out = T.token_pipeline("value", "filtered").fit(d).transform(d)
    return out.select("doc_id", F.size("filtered").cast("bigint").alias("n"),
                      F.md5(F.array_join("filtered", " ")).alias("tokens_md5"))


_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)
ML_TOKENS_SQL = f"""
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t\\n\\r\\x0B\\f]+'),
             lambda w: w <> '' AND w NOT IN ({_STOP})) AS w FROM documents)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n, md5(array_to_string(w, ' ')) AS tokens_md5 FROM t"""


QUERIES = {
    "numeric_lines": q_numeric_lines,
    "vector_lines": q_vector_lines,
    "csv_table": q_csv_table,
    "rating_lines": q_rating_lines,
    "line_positions": q_line_positions,
    "first_rows": q_first_rows,
    "preview_lines": q_preview_lines,
    "ml_tokens": q_ml_tokens,
}

ORACLE = {
    "numeric_lines": NUMERIC_LINES_SQL,
    "vector_lines": VECTOR_LINES_SQL,
    "csv_table": CSV_TABLE_SQL,
    "rating_lines": RATING_LINES_SQL,
    "line_positions": LINE_POSITIONS_SQL,
    "first_rows": FIRST_ROWS_SQL,
    "preview_lines": PREVIEW_LINES_SQL,
    "ml_tokens": ML_TOKENS_SQL,
}
