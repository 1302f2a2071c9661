"""Nested data: building arrays of structs in bounded blocks, struct paths, explode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchkit._util import as_col


def explode_column(df: DataFrame, array_col, alias: str, keep=None) -> DataFrame:
    """``LATERAL VIEW explode``: one row per element; rows with null/empty arrays vanish."""
    carried = list(df.columns if keep is None else keep)
    return df.select(*carried, F.explode(as_col(array_col)).alias(alias))


def nest(df: DataFrame, by, fields, name: str, block, cluster_by=None) -> DataFrame:
    """Collect ``struct(fields)`` per key into an array column ``name``.

    ``block`` (a required expression, e.g. ``id div 64``) bounds each array: a key's
    structs are spread over one row per (key, block), so no key's elements land in a
    single huge row.
    ``cluster_by`` (a subset of the keys plus ``"block"``) sets the shuffle keys, so
    that a following aggregation on those columns needs no second shuffle.
    """
    keys = [by] if isinstance(by, str) else list(by)
    rows = df.select(*keys, as_col(block).alias("block"), F.struct(*[as_col(f) for f in fields]).alias("_s"))
    # collect_list does not shrink map-side: one shuffle on (key, block), then aggregate.
    shuffle_keys = list(cluster_by) if cluster_by else [*keys, "block"]
    return rows.repartition(*shuffle_keys).groupBy(*keys, "block").agg(F.collect_list("_s").alias(name))
