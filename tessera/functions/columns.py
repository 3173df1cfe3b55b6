"""Reusable column expressions.

All are built from ``pyspark.sql.functions`` (higher-order array functions
included), so they stay inside whole-stage codegen and never leave the JVM.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import HASH_RANGE


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def squared_distance(a: str | Column, b: str | Column) -> Column:
    """Σ (a_i - b_i)² over two equally long numeric arrays."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0), lambda acc, v: acc + v)


def euclidean(a: str | Column, b: str | Column) -> Column:
    """Euclidean distance between two numeric arrays."""
    return F.sqrt(squared_distance(a, b))


def key_hash(key: str | Column, seed: int = 0) -> Column:
    """Deterministic hash in ``[0, HASH_RANGE)`` of an integer key and a seed:
    the first 8 hex digits of md5('<seed>:<key>').

    The seed goes through the hash with the key, so other seeds give
    independent splits. Any engine with md5 computes the same assignment, on
    any cluster size and partitioning (unlike ``randomSplit``, whose
    per-partition sampling changes with the layout).
    """
    # a NULL key hashes like 0, so its row still lands on exactly one side
    k = F.coalesce(_c(key).cast("bigint"), F.lit(0)).cast("string")
    digest = F.md5(F.concat(F.lit(f"{int(seed)}:"), k))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def key_bucket(key: str | Column, n: int, seed: int = 0) -> Column:
    """Bucket ``0..n-1`` from ``key_hash``."""
    return F.pmod(key_hash(key, seed), F.lit(int(n))).cast("int")


def with_row_index(df: DataFrame, col: str = "row_id") -> DataFrame:
    """Dense 0-based row positions, without a single-task pass over the rows.

    Rows of a file scan are numbered by file path, then by place in the file:
    each scanned block (one file split) gets an offset from the row counts of
    the blocks before it. Spark packs blocks into partitions by size; the
    positions do not depend on that, nor on the split size or the core count.
    The table of blocks has a row for each split. Rows that come from no file
    are numbered by partition.
    """
    try:
        keyed = df.select("*", F.col("_metadata.file_path").alias("_file"),
                          F.col("_metadata.file_block_start").alias("_block"))
    except AnalysisException:
        keyed = df.select("*", F.lit("").alias("_file"),
                          F.spark_partition_id().cast("long").alias("_block"))
    # a block lies in one partition, so its rows have consecutive numbers
    keyed = keyed.withColumn("_mono", F.monotonically_increasing_id())
    blocks = keyed.groupBy("_file", "_block").agg(F.min("_mono").alias("_first"),
                                                  F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_file", "_block", "_first",
                            F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (keyed.join(F.broadcast(offsets), ["_file", "_block"])
            .withColumn(col, F.col("_off") + F.col("_mono") - F.col("_first"))
            .drop("_file", "_block", "_mono", "_first", "_off"))


def with_rank(df: DataFrame, order: list[Column], col: str = "rank") -> DataFrame:
    """0-based ranks in a total order, without a single-task sort: the rows
    are range-partitioned and sorted, numbered in each partition, and offset
    by the partitions before. The sorted rows are checkpointed, so that the
    numbers hold when executors are lost; meant for aggregated tables."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    rows = (df.repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("_mono", F.monotonically_increasing_id()).checkpoint(eager=True))
    part = F.shiftright("_mono", 33)
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off")))
    return (rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(col, F.col("_off") + F.col("_mono").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_mono", "_part", "_off"))
