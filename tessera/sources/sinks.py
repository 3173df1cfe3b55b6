"""Sinks: vectors as comma-joined text, and bounded previews."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def vectors_as_text(df: DataFrame, col: str, sep: str = ",") -> DataFrame:
    """One ``value`` line per row: the vector's entries joined by ``sep``."""
    arr = F.col(col) if isinstance(df.schema[col].dataType, ArrayType) else vector_to_array(col)
    return df.select(F.array_join(F.transform(arr, lambda x: x.cast("string")), sep).alias("value"))


def write_vectors(df: DataFrame, col: str, path: str, sep: str = ",",
                  mode: str = "errorifexists") -> None:
    """Save a vector (or numeric array) column as text, one part file per
    partition; by default fails when ``path`` already exists."""
    vectors_as_text(df, col, sep).write.mode(mode).text(path)


def preview(df: DataFrame, cols: list[str] | None = None, n: int = 5) -> DataFrame:
    """First ``n`` rows of the selected columns (the caller shows them)."""
    return (df.select(*cols) if cols else df).limit(n)
