"""Sorts, positions in a global order, and top-k without a full sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_LOCAL_BITS = 33  # monotonically_increasing_id = (partition index << 33) + row number in partition


def sort_desc(df: DataFrame, *cols) -> DataFrame:
    """``sortByKey(false)``: a range-partitioned global sort, descending on ``cols``."""
    return df.orderBy(*[F.col(c).desc() if isinstance(c, str) else c for c in cols])


def with_position(df: DataFrame, order: list, name: str = "pos") -> DataFrame:
    """Number rows 1..N in a global order without moving all rows into one task.

    A window without ``partitionBy`` would gather every row into one partition.
    Instead: a range-partitioned sort; each row's id inside its sorted partition
    (``monotonically_increasing_id``); per-partition row counts (one row per
    partition, so its size is bounded by the partition count, not the data) turned
    into offsets and broadcast; position = offset + local index + 1.  The sorted
    frame is checkpointed to the shared checkpoint folder so both uses see the
    same partitions and lineage is cut.
    """
    from batchkit.session import checkpoint_base

    checkpoint_base(df.sparkSession)
    ordered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    part = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    local = F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1)
    counts = ordered.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    running = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_c").over(running), F.lit(0)).alias("_off"))
    placed = ordered.join(F.broadcast(offsets), part == F.col("_p"))
    cols = [c for c in df.columns]
    return placed.select((F.col("_off") + local + 1).alias(name), *cols)


def top_k(df: DataFrame, n: int, *order) -> DataFrame:
    """Smallest ``n`` rows by ``order`` (``takeOrdered``): TakeOrderedAndProject,
    i.e. each partition keeps its own top ``n`` and only those are merged."""
    return df.orderBy(*order).limit(n)


def take_first(df: DataFrame, n: int, *order) -> DataFrame:
    """``take(n)`` / ``first()``.  With ``order`` the answer is repeatable (top-k);
    without it, the first ``n`` rows in partition order (``limit``), as ``take`` gives."""
    return top_k(df, n, *order) if order else df.limit(n)


def shortest(df: DataFrame, column: str, n: int) -> DataFrame:
    """``takeOrdered(n, by length)`` over distinct values; ties broken by the value.

    One plan: partial distinct, a shuffle of the distinct values, and
    TakeOrderedAndProject, in which each task keeps a heap of ``n``.
    """
    keyed = df.select(F.col(column).alias("k")).distinct()
    return top_k(keyed, n, F.length("k"), F.col("k"))
