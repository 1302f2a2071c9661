"""Delimited text: a raw split reader, a schema-driven CSV reader, and a reader for position-prefixed headers."""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from batchkit.functions.text import java_trim, literal


def read_split(spark: SparkSession, path: str, sep: str, names: Sequence[str],
               types: Sequence[str] | None = None, header_line: str | None = None) -> DataFrame:
    """Lines split on the plain separator ``sep`` (not a pattern) into named fields (the bean / reflection reader).

    Fields are not trimmed.  A header line is data unless ``header_line`` (its exact
    text) is given, in which case lines equal to it are dropped.  ``types`` casts
    each field (ANSI casts: bad text raises).  Missing fields are null.
    """
    lines = spark.read.text(path)
    if header_line is not None:
        lines = lines.where(F.col("value") != F.lit(header_line))
    parts = F.split("value", literal(sep))
    types = list(types) if types else ["string"] * len(names)
    return lines.select(*[F.get(parts, i).cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))])


def read_with_schema(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",",
                     header: bool = False, trim: Sequence[str] = ()) -> DataFrame:
    """Delimited rows with a programmatic schema (CSV reader; file splits in parallel).

    ``trim`` names string fields to strip of chars <= U+0020, as ``String.trim``.
    """
    df = spark.read.schema(schema).option("sep", sep).option("header", header).option("mode", "FAILFAST").csv(path)
    if trim:
        df = df.select(*[java_trim(c).alias(c) if c in trim else F.col(c) for c in df.columns])
    return df


# Fixed value: header names carry a position prefix such as "0_key", "8_day".
_INDEX_PREFIX = re.compile(r"^[0-9]+_")


def read_indexed_header(spark: SparkSession, path: str, sep: str = "\t",
                        types: dict[str, str] | None = None) -> DataFrame:
    """Delimited files whose header line names columns with a position prefix
    (``0_key``, ``1_title``, ...): the header is skipped, the prefix dropped from
    the names, and ``types`` (name -> SQL type) applied with ANSI casts."""
    df = spark.read.option("sep", sep).option("header", True).option("mode", "FAILFAST").csv(path)
    df = df.toDF(*[_INDEX_PREFIX.sub("", c) for c in df.columns])
    if types:
        df = df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
    return df
