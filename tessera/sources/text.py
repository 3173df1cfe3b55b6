"""Scans of text-based inputs, all expressed as DataFrame reads.

* ``read_lines``   — plain text, one ``value`` row per line.
* ``first_rows``   — the first n rows in file order, reading a prefix of the files.
* ``read_table``   — CSV with header / delimiter / schema, optional null drop.
* ``parse_numeric``— split a line and cast every field to double, strictly.
* ``read_ratings`` — ``user::item::rating::timestamp`` lines, exactly 4 fields.
* ``label_features`` — positional label + feature-vector slice of a parsed row.

Strictness: a malformed line raises (``raise_error``) instead of silently
producing a short vector or a NULL. The check sits in a filter, so it
holds even when the caller later selects only some columns (column pruning
would otherwise skip the parse of unselected fields).
"""

from __future__ import annotations

import re

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import with_row_index


def read_lines(spark: SparkSession, path: str | list[str],
               min_partitions: int | None = None) -> DataFrame:
    """Text-line scan → ``value STRING``.

    ``min_partitions`` mirrors ``textFile(path, n)``: file splitting never goes
    below the open-cost size, so a small file would stay in one task; the
    lines are dealt out over ``n`` partitions.
    """
    df = spark.read.text(path)
    return df.repartition(min_partitions) if min_partitions else df


def first_rows(spark: SparkSession, path: str | list[str], n: int, format: str = "text",
               position: str = "position", **options) -> DataFrame:
    """The first ``n`` rows of a folder of files, in the order of file paths
    and places in the files, with their 0-based ``position``.

    Only a prefix of the files is read: the rows of the first file are
    counted, then of the next two, four, ... until there are ``n``; then these
    files alone are scanned. What is read follows ``n``, not the folder: at
    most about twice the files that hold the rows, and these twice. (The
    driver lists file names, as Spark does for any scan.)"""
    reader = spark.read.format(format).options(**options)
    files = sorted(reader.load(path).inputFiles())
    known, taken, step = 0, 0, 1
    while taken < len(files) and known < n:
        known += reader.load(files[taken:taken + step]).count()
        taken, step = taken + step, step * 2
    whole = reader.load(path)
    if n <= 0 or not files:
        return whole.withColumn(position, F.lit(0).cast("long")).limit(0)
    # an inferred schema stays that of the whole folder
    rows = spark.read.format(format).options(**options).schema(whole.schema).load(files[:taken])
    return with_row_index(rows, position).where(F.col(position) < n)


def read_table(spark: SparkSession, path: str | list[str], *,
               schema: StructType | str | None = None, sep: str = ",",
               header: bool = True, infer_schema: bool = False,
               drop_nulls: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """Delimited table scan. An explicit schema avoids the inference pass;
    ``infer_schema=True`` reproduces the reference's inferred-type read.
    With ``header=True`` every file's header line is dropped (two files with
    headers give the data rows of both).

    Caveat (Spark's CSV reader): with column pruning a ``FAILFAST`` read only
    parses the selected columns, so a bad value in an unselected column is
    not reported. Numeric files that must be checked field by field go
    through ``read_lines`` + ``parse_numeric`` (strict on every field)."""
    reader = (spark.read.option("header", str(header).lower())
              .option("sep", sep).option("mode", mode))
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    df = reader.csv(path)
    return df.na.drop("any") if drop_nulls else df


def parse_numeric(df: DataFrame, sep: str = ",", col: str = "value",
                  out: str = "values", drop_first: bool = False,
                  take: int | None = None, min_fields: int | None = None) -> DataFrame:
    """Split each line on the literal ``sep`` and cast every field to double.

    ``drop_first`` drops an id column (field 0); ``take`` keeps the first n of
    the remaining fields; ``min_fields`` makes short rows fail instead of
    yielding a shorter vector. Any field that is not a number raises.
    """
    fields = F.split(F.col(col), re.escape(sep))
    if drop_first:
        fields = F.slice(fields, 2, F.greatest(F.size(fields) - 1, F.lit(0)))
    need = min_fields if min_fields is not None else take
    parsed = df.select("*", fields.alias("_f"))
    check = F.forall("_f", lambda s: s.try_cast("double").isNotNull())
    if need is not None:
        check = check & (F.size("_f") >= need)
    parsed = parsed.where(
        F.when(check, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("malformed numeric line: "), F.col(col)))))
    arr = F.transform("_f", lambda s: s.try_cast("double"))
    if take is not None:
        arr = F.slice(arr, 1, take)
    return parsed.withColumn(out, arr).drop("_f")


def label_features(df: DataFrame, label_idx: int | None, start: int, length: int,
                   arr: str = "values", label: str = "label",
                   features: str = "features") -> DataFrame:
    """Positional slice of a parsed row: label = field ``label_idx`` and
    features = fields ``[start, start+length)`` as a dense ml vector.
    Rows too short for the slice raise."""
    need = max(start + length, (label_idx or 0) + 1)
    checked = df.where(
        F.when(F.size(arr) >= need, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit(f"row has fewer than {need} fields: "),
                                   F.size(arr).cast("string")))))
    cols = []
    if label_idx is not None:
        cols.append(F.element_at(arr, label_idx + 1).alias(label))
    cols.append(array_to_vector(F.slice(arr, start + 1, length)).alias(features))
    keep = [c for c in checked.columns if c != arr]
    return checked.select(*keep, *cols)


def read_ratings(spark: SparkSession, path: str | list[str], sep: str = "::",
                 user: str = "user", item: str = "item",
                 rating: str = "rating") -> DataFrame:
    """``user<sep>item<sep>rating<sep>timestamp`` lines → ``user INT, item INT,
    rating DOUBLE``; the timestamp is dropped. A line without exactly four
    fields, or with non-numeric ids/ratings, raises — also when the caller
    selects only some columns."""
    lines = spark.read.text(path)
    f = F.split("value", re.escape(sep))
    parts = lines.select(f.alias("_f"), F.col("value"))
    ok = ((F.size("_f") == 4)
          & F.element_at("_f", 1).try_cast("int").isNotNull()
          & F.element_at("_f", 2).try_cast("int").isNotNull()
          & F.element_at("_f", 3).try_cast("double").isNotNull())
    parts = parts.where(F.when(ok, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("malformed rating line: "), F.col("value")))))
    return parts.select(
        F.element_at("_f", 1).try_cast("int").alias(user),
        F.element_at("_f", 2).try_cast("int").alias(item),
        F.element_at("_f", 3).try_cast("double").alias(rating))
