"""Ranges of a sort order, and rank blocks cut along them: groups of any size in blocks of a stated number of values.

Ranges are a function of the rows' values, not of where the rows happen to lie: their
bounds are quantiles of a hash sample and reach the plan as one scalar subquery.  So
every use of them, every retried task and every layout sees the same ranges, and nothing has to
be written or computed ahead of the query.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchkit._util import sql_ident

#: Distinct rows in the sample that the bounds are taken from, on average.
SAMPLE = 4096
#: Ranges at most: four sampled rows each.
MAX_RANGES = 1024
#: Bounds compared at a time; beyond as many, every such bound is compared first.
FAN = 32


def range_count(df: DataFrame) -> int:
    """As many ranges as the session has shuffle partitions, at most MAX_RANGES."""
    return max(1, min(MAX_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def range_bounds(df: DataFrame, columns: Sequence[str], ranges: int, copies: str | None = None) -> Column:
    """The bounds of ``ranges`` ranges with about equally many rows of ``df``, whose rows are distinct in ``columns``.

    A scalar subquery: an ascending array of at most ``ranges - 1`` structs.  A row is in the
    sample if the hash of its columns falls under SAMPLE / (number of rows), so
    the sample depends on the rows alone and has SAMPLE rows, give or take its
    square root's multiple, at any size.  ``copies`` names a column that is computed along
    with the rows, so that the subquery can share the shuffle that makes them.
    """
    there = f"{sql_ident(copies)} >= 0" if copies else "true"
    listed = ", ".join(map(sql_ident, columns))
    rows = df.where(there).agg(F.count(F.lit(1)).alias("n")).scalar()
    # one condition, so that it stays above the rows' aggregate, whose shuffle is there already
    mark = F.expr(f"CASE WHEN {there} THEN cast(shiftrightunsigned(xxhash64({listed}), 11) AS double) END")
    found = df.where(mark < F.lit(float(SAMPLE) * (1 << 53)) / rows).agg(F.expr(f"sort_array(collect_list(struct({listed})))").alias("s"))
    picked = f"array_distinct(transform(filter(transform(sequence(1, {ranges - 1}), i -> cast(size(s) * i div {ranges} AS int)), i -> i > 0), i -> element_at(s, i)))"
    return found.select(F.expr(picked if ranges > 1 else "slice(s, 1, 0)").alias("bounds")).scalar()


def _range_sql(columns: Sequence[str], ranges: int) -> str:
    """SQL for how many of ``_bounds`` lie below the row's columns (nulls come first)."""
    row = f"struct({', '.join(map(sql_ident, columns))})"
    if ranges <= FAN:
        return f"size(filter(_bounds, b -> b < {row}))"
    every = f"filter(sequence(1, greatest(size(_bounds), 1), {FAN}), i -> i <= size(_bounds))"
    first = f"(greatest(size(filter({every}, i -> element_at(_bounds, i) < {row})) - 1, 0) * {FAN})"
    return f"{first} + size(filter(slice(_bounds, {first} + 1, {FAN}), b -> b < {row}))"


def with_range(df: DataFrame, columns: Sequence[str], name: str = "_range", bounds: Column | None = None, copies: str | None = None) -> DataFrame:
    """``df`` with the number of the range that a row's ``columns`` are in, from 0; ``bounds`` may come from other rows."""
    ranges = range_count(df)
    if bounds is None:
        bounds = range_bounds(df, columns, ranges, copies)
    held = df.select("*", bounds.alias("_bounds"))  # a column first: a subquery may not stand inside a higher-order function
    return held.select(*[sql_ident(c) for c in df.columns], F.expr(_range_sql(columns, ranges)).alias(name))


def rank_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_block: int,
                copies: str = "copies") -> DataFrame:
    """Block numbers by rank within a key, for rows that stand for ``copies`` equal values.

    ``df`` holds each (keys, order) once with its number of copies.  The values of a
    key are ranked by ``order`` from 0, and block = rank div ``rows_per_block``; a value
    whose copies reach into several blocks comes out once per block with its share.
    Nulls are values like any other and come first.

    No key is ranked in one task: rows are dealt by (keys, range), where the ranges
    cut the order of (keys, order) into about equal parts; a running sum starts, in each
    range, from the sum of the key's earlier ranges.  Only a range that begins inside a key
    has such an offset, so there are fewer offsets than ranges and they are broadcast.
    """
    if rows_per_block < 1:
        raise ValueError("rows_per_block must be at least 1")
    ranged = with_range(df, [*keys, *order], copies=copies).repartition(*keys, "_range")
    by = ", ".join(map(sql_ident, keys))
    n = sql_ident(copies)
    offsets = ranged.groupBy(*keys, "_range").agg(F.sum(copies).alias("_sum")).selectExpr(
        *[f"{sql_ident(k)} AS _key{i}" for i, k in enumerate(keys)], "_range AS _r",
        f"sum(_sum) OVER (PARTITION BY {by} ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _offset").where("_offset > 0")
    same = F.expr(" AND ".join(["_range = _r", *(f"{sql_ident(k)} <=> _key{i}" for i, k in enumerate(keys))]))  # a null key is a key
    within = f"sum({n}) OVER (PARTITION BY {by}, _range ORDER BY {', '.join(map(sql_ident, order))} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ends = ranged.selectExpr("*", f"{within} AS _running").join(F.broadcast(offsets), same, "left").selectExpr("*", "coalesce(_offset, 0) + _running AS _end")
    cut = ends.selectExpr("*", f"explode(sequence((_end - {n}) div {rows_per_block}, (_end - 1) div {rows_per_block})) AS block")
    share = f"cast(least(_end, (block + 1) * {rows_per_block}) - greatest(_end - {n}, block * {rows_per_block}) AS int) AS {n}"
    return cut.selectExpr(*[share if c == copies else sql_ident(c) for c in df.columns], "block")
