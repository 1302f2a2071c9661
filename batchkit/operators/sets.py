"""Set operations by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union keeping duplicates (no shuffle)."""
    return a.unionByName(b)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union, then one copy of each row (one aggregate, partial per side)."""
    return a.unionByName(b).distinct()


def _stand_in(dtype: T.DataType):
    """A non-null literal of ``dtype`` used in place of null when keys are compared
    null-safely (the accompanying ``isnull`` flag keeps null and the stand-in apart)."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                          T.DecimalType)):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.DateType):
        return F.lit("1970-01-01").cast(dtype)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dtype)
    return None


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows present in both, each once (nulls compare equal, as in INTERSECT).

    Each side is de-duplicated on null-safe key parts – ``coalesce(c, stand-in)``
    and ``isnull(c)`` per column, which together identify the value – so partial
    aggregation shrinks both inputs before the shuffle and the aggregate's hash
    partitioning is exactly what the semi join needs: one exchange per side.
    Column types without a stand-in fall back to a null-safe semi join over the
    de-duplicated sides.
    """
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError(f"intersect needs the same columns, got {a.columns} and {b.columns}")
    cols = a.columns
    stand_ins = [_stand_in(a.schema[c].dataType) for c in cols]
    if any(s is None for s in stand_ins):
        right = b.select(*[F.col(c).alias(f"_r_{c}") for c in cols]).distinct()
        cond = reduce(lambda x, y: x & y, [a[c].eqNullSafe(right[f"_r_{c}"]) for c in cols])
        return a.distinct().join(right, cond, "left_semi")

    def parts(df: DataFrame, prefix: str) -> DataFrame:
        keyed = []
        for i, (c, s) in enumerate(zip(cols, stand_ins)):
            keyed += [F.coalesce(F.col(c), s).alias(f"{prefix}v{i}"), F.isnull(F.col(c)).alias(f"{prefix}n{i}")]
        return df.select(*keyed).distinct()

    left, right = parts(a, "_l"), parts(b, "_r")
    n = len(cols)
    cond = reduce(lambda x, y: x & y, [(left[f"_lv{i}"] == right[f"_rv{i}"]) & (left[f"_ln{i}"] == right[f"_rn{i}"])
                                       for i in range(n)])
    both = left.join(right, cond, "left_semi")
    return both.select(*[F.when(F.col(f"_ln{i}"), F.lit(None)).otherwise(F.col(f"_lv{i}")).cast(a.schema[c].dataType)
                         .alias(c) for i, c in enumerate(cols)])
