"""Splits, categorical encoding and vector indexing on the driver tables."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators import split as S
from .tables import RETURNFLAG_CODE_SQL, returnflag_code, table

SPLIT_SEED = 100
FOLD_SEED = 7


def _hash_sql(key: str, seed: int) -> str:
    return (f"CAST('0x' || substr(md5('{seed}:' || CAST(CAST(coalesce({key}, 0) AS BIGINT) AS VARCHAR)), 1, 8)"
            f" AS BIGINT)")


# --- splits -----------------------------------------------------------------

def q_key_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return S.with_split(o, "o_orderkey", 0.7, SPLIT_SEED, "part")


def q_key_folds(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return S.key_folds(o, "o_orderkey", 3, FOLD_SEED, "fold")


def q_split_sizes(spark, sf_dir):
    """Rows and revenue on each side of the 70/30 key split of lineitem."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    return (S.with_split(li, "l_orderkey", 0.7, SPLIT_SEED, "part")
            .groupBy("part").agg(F.count(F.lit(1)).alias("n"),
                                 F.round(F.sum("l_extendedprice"), 2).alias("revenue")))


def q_random_split(spark, sf_dir):
    """Spark's seeded randomSplit: which rows fall where depends on the
    layout, but each row falls on exactly one side (counts and checksums of
    both parts together equal the table's)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    train, test = S.random_split(o, (0.7, 0.3), SPLIT_SEED)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    per = both.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("sides"),
                                         F.max((F.col("part") == "train").cast("int")).alias("t"))
    share = F.avg("t")
    return per.select("o_orderkey", "sides", "t").groupBy("sides").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("key_sum"),
        share.between(0.6, 0.8).alias("share_ok")).select(F.col("sides").cast("bigint").alias("sides"), "rows", "key_sum", "share_ok")


# --- string indexing ---------------------------------------------------------

def q_string_index(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    cols = ["p_brand", "p_type", "p_size"]
    out = FT.index_columns(p, cols, "_idx")
    # MLlib's model decodes what the label table encoded: both rank alike
    brand_labels = FT.fit_indexer(p, ["p_brand"], "_idx").labelsArray[0]
    out = FT.decode_label(out, brand_labels, "p_brand_idx", "p_brand_decoded")
    return out.select("p_partkey", "p_brand_idx", "p_type_idx", "p_size_idx",
                      (F.col("p_brand_decoded") == F.col("p_brand")).alias("roundtrip_ok"))


def _rank_sql(col: str) -> str:
    return (f"(SELECT {col} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, "
            f"CAST({col} AS VARCHAR) ASC) - 1 AS DOUBLE) AS idx FROM part GROUP BY {col})")


STRING_INDEX_SQL = f"""
SELECT p_partkey, b.idx AS p_brand_idx, t.idx AS p_type_idx, s.idx AS p_size_idx,
       TRUE AS roundtrip_ok
FROM part
JOIN {_rank_sql('p_brand')} b ON part.p_brand = b.v
JOIN {_rank_sql('p_type')} t ON part.p_type = t.v
JOIN {_rank_sql('p_size')} s ON part.p_size = s.v"""


# --- vector indexing ---------------------------------------------------------

def q_vector_index(spark, sf_dir):
    """VectorIndexer(maxCategories=4) on [quantity, -(linenumber % 3), tax,
    returnflag code]: slots 1 and 3 become categorical, 0 and 2 stay."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax",
        (-(F.col("l_linenumber") % 3)).alias("neg_mod"), returnflag_code().alias("rf"))
    v = VectorAssembler(inputCols=["l_quantity", "neg_mod", "l_tax", "rf"],
                        outputCol="features").transform(li)
    out = FT.index_vector(v, "features", "indexed", max_categories=4)
    a = vector_to_array("indexed")
    return out.select("l_orderkey", "l_linenumber",
                      *[a[i].alias(f"f{i}") for i in range(4)])


def _cat_sql(expr: str) -> str:
    # categories ascending, except 0.0 which always gets index 0
    return (f"(SELECT v, CAST(row_number() OVER (ORDER BY v <> 0, v) - 1 AS DOUBLE) AS idx "
            f"FROM (SELECT DISTINCT CAST({expr} AS DOUBLE) AS v FROM lineitem))")


VECTOR_INDEX_SQL = f"""
SELECT l_orderkey, l_linenumber, l_quantity AS f0, c1.idx AS f1, l_tax AS f2, c3.idx AS f3
FROM lineitem
JOIN {_cat_sql('-(l_linenumber % 3)')} c1 ON CAST(-(l_linenumber % 3) AS DOUBLE) = c1.v
JOIN {_cat_sql(RETURNFLAG_CODE_SQL)} c3 ON CAST({RETURNFLAG_CODE_SQL} AS DOUBLE) = c3.v"""


QUERIES = {
    "key_split": q_key_split,
    "key_folds": q_key_folds,
    "split_sizes": q_split_sizes,
    "random_split": q_random_split,
    "string_index": q_string_index,
    "vector_index": q_vector_index,
}

_CUT = S.split_cut(0.7)

ORACLE = {
    "key_split": f"""SELECT o_orderkey, CASE WHEN {_hash_sql('o_orderkey', SPLIT_SEED)} < {_CUT}
        THEN 'train' ELSE 'test' END AS part FROM orders""",
    "key_folds": f"""SELECT o_orderkey, CAST({_hash_sql('o_orderkey', FOLD_SEED)} % 3 AS INTEGER)
        AS fold FROM orders""",
    "split_sizes": f"""SELECT CASE WHEN {_hash_sql('l_orderkey', SPLIT_SEED)} < {_CUT}
        THEN 'train' ELSE 'test' END AS part, CAST(count(*) AS BIGINT) AS n,
        round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1""",
    "random_split": """SELECT CAST(1 AS BIGINT) AS sides, count(*) AS "rows",
        CAST(sum(o_orderkey) AS BIGINT) AS key_sum, TRUE AS share_ok FROM orders""",
    "string_index": STRING_INDEX_SQL,
    "vector_index": VECTOR_INDEX_SQL,
}
