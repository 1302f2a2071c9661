"""Table sinks: partitioned managed tables and partitioned parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _clustered(df: DataFrame, by: str) -> DataFrame:
    """Rows rebalanced by the partition column: a value's rows come together in few tasks.

    The hint leaves the number of tasks to adaptive execution, which merges small
    values into one task and splits a value that is larger than the advisory partition
    size, so there are few files per value and no task holds a hot one.
    """
    return df.hint("rebalance", F.col(by))


def save_partitioned_table(df: DataFrame, name: str, by: str, mode: str = "errorifexists") -> str:
    """``write.partitionBy(by).saveAsTable(name)`` (parquet; errors if it exists by
    default); the partition column comes last in the table's schema."""
    _clustered(df, by).write.mode(mode).partitionBy(by).saveAsTable(name)
    return name


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "errorifexists") -> str:
    """Partitioned parquet folder (``by=value/`` sub-folders) at ``path``; readers
    filtering on ``by`` prune whole folders."""
    _clustered(df, by).write.mode(mode).partitionBy(by).parquet(path)
    return path


def save_bucketed_table(df: DataFrame, name: str, by: str, num_buckets: int, mode: str = "errorifexists") -> str:
    """Managed table hashed into ``num_buckets`` buckets on ``by`` and sorted within them.

    Two tables bucketed on their join key with the same bucket count join without
    a shuffle on either side (the layout is paid once, at write time), which is
    how a large fact-to-fact join is made repeatable and cheap.
    """
    df.write.mode(mode).bucketBy(num_buckets, by).sortBy(by).saveAsTable(name)
    return name
