"""Generated rows: a key range derived from a table's own bounds, and records held by the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def key_range(spark: SparkSession, lo: int, hi: int, step: int = 1,
              num_partitions: int | None = None) -> DataFrame:
    """``spark.range(lo, hi + 1)`` – rows are generated on the executors, not shipped."""
    return spark.range(lo, hi + 1, step, num_partitions)


# Rows generated per partition when the caller does not choose a partition count.
ROWS_PER_PARTITION = 10_000_000


def range_over(df: DataFrame, column: str, num_partitions: int | None = None) -> DataFrame:
    """Every integer between ``min(column)`` and ``max(column)`` of ``df``, column ``id``.

    Only the two bounds pass through the driver; the rows are generated on the
    executors, ``ROWS_PER_PARTITION`` per partition unless ``num_partitions`` is given.
    """
    row = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    if row["lo"] is None:
        return df.sparkSession.range(0, 0).select(F.col("id"))
    lo, hi = int(row["lo"]), int(row["hi"])
    if num_partitions is None:
        num_partitions = max(1, (hi - lo + 1 + ROWS_PER_PARTITION - 1) // ROWS_PER_PARTITION)
    return key_range(df.sparkSession, lo, hi, 1, num_partitions)


def from_records(spark: SparkSession, records: list[dict], schema) -> DataFrame:
    """A typed dataset of records that the caller holds (bean-like dicts); ``schema`` is checked, not inferred.

    The records travel in the plan, so this is for few rows: missing fields are null.
    """
    names = [f.name for f in (spark.createDataFrame([], schema).schema)]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)
