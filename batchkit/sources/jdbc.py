"""JDBC sources: plain, pushed-down subquery, and partitioned by a numeric key.

Credentials come from the caller's options (never from code).  A partitioned
read opens one connection per partition; the bounds set the stride only, they
do not filter rows.  The option sets are built by plain functions, so they can
be checked without a database; only ``load()`` connects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, dbtable: str, options: dict | None = None, column: str | None = None,
                 lower=None, upper=None, num_partitions: int | None = None,
                 fetch_size: int | None = None, query_timeout: int | None = None) -> dict:
    """The reader options of a JDBC scan (all values as strings, as Spark takes them)."""
    opts = {k: str(v) for k, v in (options or {}).items()}
    opts.update({"url": url, "dbtable": dbtable})
    if column is not None:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("a partitioned read needs lower, upper and num_partitions")
        if num_partitions < 1:
            raise ValueError("num_partitions must be >= 1")
        opts.update({"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
                     "numPartitions": str(num_partitions)})
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    if query_timeout:
        opts["queryTimeout"] = str(query_timeout)
    return opts


def _load(spark: SparkSession, opts: dict) -> DataFrame:
    return spark.read.format("jdbc").options(**opts).load()


def read_jdbc(spark: SparkSession, url: str, table: str, options: dict | None = None) -> DataFrame:
    """Whole table in one partition (no split column)."""
    return _load(spark, jdbc_options(url, table, options))


def bounds_query(table: str, column: str) -> str:
    """Subquery text the database runs to find a key's bounds."""
    return f"(select min({column}) lo, max({column}) hi from {table}) q"


def jdbc_query(spark: SparkSession, url: str, query: str, options: dict | None = None) -> DataFrame:
    """A subquery run by the database, e.g. ``select min(id) lo, max(id) hi from t``."""
    return _load(spark, jdbc_options(url, f"({query}) q", options))


def jdbc_bounds(spark: SparkSession, url: str, table: str, column: str, options: dict | None = None):
    """(min, max) of ``column``, computed by the database; returns two scalars."""
    row = _load(spark, jdbc_options(url, bounds_query(table, column), options)).first()
    return row[0], row[1]


def read_jdbc_partitioned(spark: SparkSession, url: str, table: str, column: str, lower, upper,
                          num_partitions: int, options: dict | None = None,
                          fetch_size: int | None = None, query_timeout: int | None = None) -> DataFrame:
    """``num_partitions`` parallel range reads on ``column`` between ``lower`` and ``upper``."""
    return _load(spark, jdbc_options(url, table, options, column, lower, upper, num_partitions,
                                     fetch_size, query_timeout))


def read_jdbc_by_bounds(spark: SparkSession, url: str, table: str, column: str, num_partitions: int,
                        options: dict | None = None, fetch_size: int | None = None,
                        query_timeout: int | None = None) -> DataFrame:
    """The whole flow: the database computes the key's bounds (two scalars to the
    driver), then ``num_partitions`` connections read the table in strides."""
    lower, upper = jdbc_bounds(spark, url, table, column, options)
    if lower is None:
        return read_jdbc(spark, url, table, options)  # empty table: nothing to split
    return read_jdbc_partitioned(spark, url, table, column, lower, upper, num_partitions, options,
                                 fetch_size, query_timeout)
