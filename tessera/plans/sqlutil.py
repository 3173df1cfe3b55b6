"""Helpers for writing the DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Iterable


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_in_list(values: Iterable[str]) -> str:
    return "(" + ", ".join(sql_str(v) for v in values) + ")"
