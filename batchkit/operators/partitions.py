"""Partition-level operators: per-partition functions, partition index, re-layout, pipe."""

from __future__ import annotations

import sys
from typing import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit._util import sql_ident, sql_string


def map_partitions(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                   schema) -> DataFrame:
    """``mapPartitions``: ``fn`` is called once per partition with an iterator of Arrow
    batches, so set-up cost is paid once per partition and rows move as columns.

    Functions defined in this package are shipped by value, so executors need no
    copy of the package installed.
    """
    module = sys.modules.get(getattr(fn, "__module__", "") or "")
    if module is not None and module.__name__.split(".")[0] == "batchkit":
        cloudpickle.register_pickle_by_value(module)
    return df.mapInArrow(fn, schema)


def with_partition_index(df: DataFrame, name: str = "pidx") -> DataFrame:
    """``mapPartitionsWithIndex``: tag each row with the index of its partition."""
    return df.withColumn(name, F.spark_partition_id())


def num_partitions(df: DataFrame) -> int:
    """``getNumPartitions`` (planning only for file scans).  Where the RDD API is not
    available (Spark Connect) the distinct partition ids are counted instead."""
    try:
        rdd = df.rdd
    except PySparkException:  # no RDD API in this session
        return df.select(F.spark_partition_id().alias("p")).distinct().count()
    return rdd.getNumPartitions()


def coalesce_to(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions without a shuffle (merges neighbouring partitions).

    Being narrow, it also runs the work before it in the same stage with only
    ``n`` tasks; when that work is heavy, ``repartition_to`` (one shuffle) keeps
    the upstream parallelism instead."""
    return df.coalesce(max(1, n))


def repartition_to(df: DataFrame, n: int, *cols) -> DataFrame:
    """More (or re-keyed) partitions: a hash shuffle on ``cols``, or round robin."""
    return df.repartition(n, *cols) if cols else df.repartition(n)


def repartition_sorted(df: DataFrame, n: int, key: str, *sort_cols, partitioner=None) -> DataFrame:
    """``repartitionAndSortWithinPartitions``: one shuffle of the rows, then a sort by key and ``sort_cols`` inside each partition.

    ``partitioner`` says which of the ``n`` partitions a row goes to:

    * None: ranges of (key, sort columns, a hash of the row) sampled by Spark, so that a
      key with any share of the rows spans as many neighbouring partitions as it fills, and the
      partitions are in global order up to that hash;
    * a list of ascending bounds: a row goes to the partition numbered by how many bounds
      are at or below its key, a null key to partition 0; there must be fewer
      bounds than partitions;
    * a function from the key Column to an int Column, the partition's number (taken modulo n).

    With the latter two the rows of a key share a partition by the caller's wish.
    """
    if partitioner is None:
        return df.repartitionByRange(n, key, *sort_cols, F.xxhash64(*df.columns)).sortWithinPartitions(key, *sort_cols)
    if callable(partitioner):
        number = partitioner(F.col(key))
    else:
        bounds = list(partitioner)
        if bounds != sorted(bounds):
            raise ValueError("repartition_sorted: bounds must ascend")
        if len(bounds) >= n:
            raise ValueError(f"repartition_sorted: {len(bounds)} bounds make {len(bounds) + 1} partitions, more than {n}")
        number = F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(key))), F.lit(0)) if bounds else F.lit(0)
    return df.repartitionById(n, F.pmod(number.cast("int"), F.lit(n))).sortWithinPartitions(key, *sort_cols)


# What a line of the pipe can't hold as it is: escape character, column and line separators.
_ESCAPES = [("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")]


def escaped(column: Column) -> Column:
    """Text without tabs and line ends: these and the backslash as a backslash and a character."""
    out = column.cast("string")
    for raw, code in _ESCAPES:
        out = F.replace(out, F.lit(raw), F.lit(code))
    return out


def unescaped(column: Column) -> Column:
    """What :func:`escaped` made, as it was: escaped backslashes part the text, and no other escape reaches over them."""
    def plain(part: Column) -> Column:
        for raw, code in _ESCAPES[1:]:
            part = F.replace(part, F.lit(code), F.lit(raw))
        return part

    return F.array_join(F.transform(F.split(column, r"\\\\", -1), plain), "\\")


def pipe(df: DataFrame, columns: list[str], command: str, out_schema: str, view: str) -> DataFrame:
    """``pipe``: stream each partition's rows, tab-separated, through ``command`` on the
    executors (``SELECT TRANSFORM ... USING``); the command's lines become rows.

    The command sees one line a row: columns as text, in which a backslash, a tab and the line ends are
    written ``\\\\``, ``\\t``, ``\\n`` and ``\\r``, and a null is ``\\N``.  Its output is read the same way, so any
    text and null comes through a command that passes fields on.  ``out_schema`` names
    the output columns with types (``"k string, n bigint"``); text that doesn't fit a type is null.
    """
    fields = T.StructType.fromDDL(out_schema).fields
    df.select(*[escaped(F.col(c)).alias(c) for c in columns]).createOrReplaceTempView(view)
    cols = ", ".join(sql_ident(c) for c in columns)
    out = ", ".join(f"{sql_ident(f.name)} string" for f in fields)
    lines = df.sparkSession.sql(
        f"SELECT TRANSFORM({cols}) ROW FORMAT DELIMITED FIELDS TERMINATED BY '\\t' NULL DEFINED AS '\\\\N' USING {sql_string(command)} AS ({out}) "
        f"ROW FORMAT DELIMITED FIELDS TERMINATED BY '\\t' NULL DEFINED AS '\\\\N' FROM {sql_ident(view)}")
    return lines.select(*[unescaped(F.col(sql_ident(f.name))).alias(f.name) if isinstance(f.dataType, T.StringType)
                          else F.col(sql_ident(f.name)).try_cast(f.dataType).alias(f.name) for f in fields])
