"""String helpers with Java text semantics, as built-in Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit._util import as_col

# Fixed value: Java's String.trim removes every char up to and including U+0020.
JAVA_WHITESPACE = "".join(chr(i) for i in range(0x21))


_REGEX_META = set(".$|()[]{}^?*+\\")


def literal(sep: str) -> str:
    """A plain separator as a pattern that matches exactly it."""
    return "".join(f"\\{ch}" if ch in _REGEX_META else ch for ch in sep)


def java_trim(c) -> Column:
    """``String.trim``: strip chars <= U+0020 from both ends (Spark ``trim`` strips spaces only)."""
    return F.btrim(as_col(c), F.lit(JAVA_WHITESPACE))


def java_split(c, sep_regex: str) -> Column:
    """``String.split(regex)``: like ``split`` but trailing empty strings are dropped.

    ``'a:1:2:'`` gives 3 parts (Spark's ``split`` gives 4); ``':1:2'`` keeps the
    leading empty part; a string made only of separators gives an empty array.
    """
    s = as_col(c)
    if len(sep_regex) == 1 and sep_regex not in _REGEX_META:
        stripped = F.rtrim(s, F.lit(sep_regex))  # a plain char: no regex needed
    else:
        stripped = F.regexp_replace(s, f"(?:{sep_regex})+$", "")
    parts = F.split(stripped, sep_regex)
    return F.when((stripped == "") & (s != ""), F.array().cast("array<string>")).otherwise(parts)


def day_of(ts) -> Column:
    """Day text of a timestamp or timestamp string: ``substr(cast(ts as string), 1, 10)``."""
    return F.substring(as_col(ts).cast("string"), 1, 10)


def day_key(df, c) -> Column:
    """Grouping key for "the day of" a column of ``df``.

    For timestamp/date columns this is ``to_date`` (a 4-byte key, cheap to hash
    and shuffle); for text columns it is :func:`day_of`.  Casting the key to
    string gives the same ``yyyy-MM-dd`` text as :func:`day_of` in both cases, so
    format it once per output row instead of once per input row.
    """
    name = c if isinstance(c, str) else None
    if name is not None and isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.to_date(F.col(name))
    return day_of(c)


def hash_block(c, hex_digits: int) -> Column:
    """Deterministic block id: the first ``hex_digits`` hex chars of ``md5(cast(c as string))``.

    Equal in every engine that has md5, independent of partition layout; used to
    split a hot group into ``16 ** hex_digits`` bounded pieces.
    """
    if hex_digits <= 0:
        return F.lit("")
    return F.substring(F.md5(as_col(c).cast("string")), 1, hex_digits)
