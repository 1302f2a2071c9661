"""Text sinks: one file per partition, and grouped ``(key,[values])`` lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchkit._util import as_col
from batchkit.operators.aggregates import group_into_bags


def write_text(df: DataFrame, path: str, column=None, mode: str = "errorifexists") -> str:
    """``saveAsTextFile``: one string column, one file per partition (no funnel
    into a single task).  Returns the path."""
    col = as_col(column) if column is not None else F.col(df.columns[0])
    df.select(col.cast("string").alias("value")).write.mode(mode).text(path)
    return path


def write_grouped_text(df: DataFrame, key, value, num_files: int, path: str,
                       mode: str = "errorifexists", rows_per_block: int = 10_000) -> str:
    """``groupByKey(n).saveAsTextFile``: lines ``(key,[v1, v1, v2])`` in at most ``num_files`` files.

    A line holds at most ``rows_per_block`` values: equal values are counted first, a
    key's values ranked, and each block of ranks is a line (see
    :func:`batchkit.operators.blocks.rank_blocks`), so a key of any size, or one value
    repeated very often, is many lines, dealt to the files by key and block.  All lines
    of a key together are the key's bag; a null prints ``null``.  ``num_files`` is also
    the number of writer tasks, so choose it from the output size.
    """
    bags = group_into_bags(df.select(as_col(key).alias("k"), as_col(value).cast("string").alias("v")), "k", "v", rows_per_block, sep=", ")
    lines = bags.repartition(num_files, "k", "block").select(
        F.format_string("(%s,[%s])", F.coalesce(F.col("k").cast("string"), F.lit("null")), "vals").alias("value"))
    lines.write.mode(mode).text(path)
    return path
