"""Small shared helpers for operator signatures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_col(c) -> Column:
    """A column name or a Column -> Column."""
    return c if isinstance(c, Column) else F.col(c)


def as_lit(v) -> Column:
    """A Column stays as is; any Python value becomes a literal."""
    return v if isinstance(v, Column) else F.lit(v)


def require_type(df: DataFrame, column, allowed: tuple, what: str) -> None:
    """Raise ``TypeError`` unless ``column`` (a name or a Column) of ``df`` has one of ``allowed`` types."""
    if isinstance(column, str) and column not in df.columns:
        raise ValueError(f"{what}: column {column!r} not found in {df.columns}")
    dtype = df.select(as_col(column).alias("c")).schema["c"].dataType
    if not isinstance(dtype, allowed):
        names = ", ".join(t.__name__ for t in allowed)
        shown = repr(column) if isinstance(column, str) else "argument"
        raise TypeError(f"{what}: column {shown} must be {names}, got {dtype.simpleString()}")


STRINGS = (T.StringType, T.CharType, T.VarcharType)


def sql_string(text: str) -> str:
    """``text`` as a single-quoted Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_ident(name: str) -> str:
    """``name`` as a back-quoted Spark SQL identifier."""
    return "`" + name.replace("`", "``") + "`"
