"""Catalog views: temp, replaceable temp, global temp."""

from __future__ import annotations

from pyspark.sql import DataFrame


def create_view(df: DataFrame, name: str, replace: bool = True, global_scope: bool = False) -> str:
    """Register ``df`` under ``name``; returns the name to query it by.

    ``replace=False`` errors if the view exists.  Global views live in
    ``global_temp`` and are visible to every session of the application."""
    if global_scope:
        (df.createOrReplaceGlobalTempView if replace else df.createGlobalTempView)(name)
        return f"global_temp.{name}"
    (df.createOrReplaceTempView if replace else df.createTempView)(name)
    return name
