"""JSON sinks: rows as JSON lines, or pre-rendered JSON text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from batchkit.sinks.text import write_text


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Each row as one JSON object per line (one file per partition)."""
    df.write.mode(mode).json(path)
    return path


def write_json_text(df: DataFrame, column: str, path: str, mode: str = "errorifexists") -> str:
    """A column that already holds JSON documents (e.g. ``login_rollup``'s ``j``),
    written one document per line."""
    return write_text(df, path, column, mode)
