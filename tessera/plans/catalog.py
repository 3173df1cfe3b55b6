"""Registry of every implemented query (Spark) and its DuckDB twin (SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import cluster_jobs, eval_jobs, matrix_jobs, model_jobs, prep_jobs, source_jobs, text_jobs

_MODULES = [text_jobs, source_jobs, prep_jobs, eval_jobs, model_jobs, matrix_jobs, cluster_jobs]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out
