"""Row-wise operators over text and fields: lines, tokens, field projection, filters."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchkit._util import as_col
from batchkit.functions.text import java_split, literal


def lines(df: DataFrame, column, keep: Iterable[str] = (), sep: str = "\n",
          name: str = "line") -> DataFrame:
    """One row per line of a text column (a text-line scan over a column), whole texts."""
    return df.select(*keep, F.explode(F.split(as_col(column), literal(sep))).alias(name))


def tokens(df: DataFrame, column, sep: str, keep: Iterable[str] = (), name: str = "w",
           java: bool = False) -> DataFrame:
    """``flatMap(split)``: one row per token.  ``sep`` is a plain separator; ``java=True`` drops trailing empty tokens."""
    parts = java_split(column, literal(sep)) if java else F.split(as_col(column), literal(sep))
    return df.select(*keep, F.explode(parts).alias(name))


def word_count(df: DataFrame, column, sep: str = " ", java: bool = False) -> DataFrame:
    """Tokens counted per distinct token: explode -> partial count -> shuffle -> final count."""
    return tokens(df, column, sep, java=java).groupBy("w").agg(F.count(F.lit(1)).alias("n"))


def field(column, index: int, sep: str) -> Column:
    """Field ``index`` (0-based) of a delimited line; a line with fewer fields raises
    (ANSI array index), as indexing the split line would.  ``sep`` is a plain separator."""
    return F.split(as_col(column), literal(sep)).getItem(index)


def flat_fields(df: DataFrame, keep: Sequence[str], fields: Sequence, name: str = "v") -> DataFrame:
    """``flatMap`` emitting several fields of a row as separate rows."""
    return df.select(*keep, F.explode(F.array(*[as_col(f) for f in fields])).alias(name))


def drop_containing(df: DataFrame, column, needle: str) -> DataFrame:
    """Drop every row whose text contains ``needle`` anywhere (not only a header)."""
    return df.where(~F.contains(as_col(column), F.lit(needle)))


def increment(column, by: int = 1, cast: str | None = "int") -> Column:
    """``value + by``, optionally after casting the value."""
    c = as_col(column)
    return (c.cast(cast) if cast else c) + F.lit(by)


def prefixed(column, prefix: str) -> Column:
    """Map a row to ``prefix + value``."""
    return F.concat(F.lit(prefix), as_col(column))
