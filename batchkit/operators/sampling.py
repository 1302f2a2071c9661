"""Sampling: Bernoulli, repeatable hash sampling, fixed-size samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit._util import as_col
from batchkit.operators.blocks import with_range


def sample_fraction(df: DataFrame, fraction: float, seed: int | None = None,
                    with_replacement: bool = False) -> DataFrame:
    """Spark's sampler: each row kept with probability ``fraction`` (per-partition RNG)."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def hash_key(key, seed=None) -> Column:
    """``md5(cast(key as string))`` – or ``md5(key || ':' || seed)`` – as hex text."""
    k = as_col(key).cast("string")
    if seed is not None:
        k = F.concat(k, F.lit(f":{seed}"))
    return F.md5(k)


def hash_threshold(fraction: float, digits: int = 8) -> str:
    """Hex prefix below which a fraction of uniformly spread md5 values fall."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    top = 16 ** digits
    cut = int(round(fraction * top))
    if cut >= top:
        return "g" * digits  # above every hex prefix: keep all rows
    return format(cut, "x").rjust(digits, "0")


def sample_by_hash(df: DataFrame, key, fraction: float, seed=None, digits: int = 8) -> DataFrame:
    """Repeatable sample: keep a row when the md5 prefix of its key is below the
    threshold for ``fraction``.  Same rows on every run and every partition layout,
    and in any engine with md5; pushes no state through the driver."""
    return df.where(F.substring(hash_key(key, seed), 1, digits) < F.lit(hash_threshold(fraction, digits)))


def take_sample(df: DataFrame, key, n: int, seed: int = 1) -> DataFrame:
    """``takeSample(false, n, seed)``: the ``n`` rows with the smallest seeded md5 of
    the key (ties by key) – a top-k, so no full sort and no collect."""
    return df.orderBy(hash_key(key, seed), as_col(key)).limit(n)


#: Hex digits of an md5 that make a uniform number: 52 bits, exact as a double.
UNIFORM_DIGITS = 13


def poisson_thresholds(fraction: float, digits: int = UNIFORM_DIGITS) -> list[str]:
    """Ascending hex prefixes: a uniform md5 prefix that reaches the first k of them stands for a Poisson count of at least k.

    The list ends where the chance of a higher count is below the resolution of the prefix.
    """
    if not 0.0 <= fraction <= 100.0:
        raise ValueError("fraction must be in [0, 100]")
    top = 16 ** digits
    out, chance, total, k = [], math.exp(-fraction), math.exp(-fraction), 0
    while fraction and (cut := round(total * top)) < top:
        out.append(format(cut, "x").rjust(digits, "0"))
        k += 1
        chance *= fraction / k
        if total + chance == total and k > fraction:
            break
        total += chance
    return out


def sample(df: DataFrame, key, fraction: float, seed: int = 1, with_replacement: bool = False) -> DataFrame:
    """``sample(withReplacement, fraction, seed)``, the same rows at every run and on every layout, as a row's lot depends on its key and the seed only.

    The generator is counter-based: the md5 of key and seed, of which 52 bits are a
    uniform number.  Without replacement a row stays if that is below ``fraction``; with
    replacement it comes as often as a Poisson variable of mean ``fraction`` says at that
    place of its distribution, so a row may come several times.  Narrow: no shuffle, no
    state.  Rows of one key share their lot, so the key should tell rows apart; a
    null key counts as the empty text.
    """
    mark = F.substring(F.md5(F.concat(F.coalesce(as_col(key).cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, UNIFORM_DIGITS)
    if not with_replacement:
        return df.where(mark < F.lit(hash_threshold(fraction, UNIFORM_DIGITS)))
    copies = F.lit(0)
    for cut in poisson_thresholds(fraction):
        copies = copies + F.when(mark >= F.lit(cut), 1).otherwise(0)
    drawn = df.withColumn("_copies", copies).where("_copies > 0")
    return drawn.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies", "_copy")


def take_sample_with_replacement(df: DataFrame, key, n: int, seed: int = 1) -> DataFrame:
    """``takeSample(true, n, seed)``: ``n`` independent draws, columns ``draw`` (from 0) and the key.

    Draw i is a uniform position in the order of the keys (60 bits of the md5 of i and
    seed, modulo the number of rows; nulls come first), and takes the row there: every
    row is equally likely in each draw, and one row may be drawn again.  Neither the table
    is sorted nor its rows multiplied: equal keys are counted, the order is cut into ranges,
    the ranges' counts give each position its range, and only
    ranges with a position are ranked.  The work is that of the rows plus the draws.
    """
    name = key if isinstance(key, str) else "key"
    counted = df.select(as_col(key).alias("_v")).groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    ranged = with_range(counted, ["_v"], copies="_n")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    starts = ranged.groupBy("_range").agg(F.sum("_n").alias("_c")).withColumn("_start", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    total = starts.agg(F.sum("_c").alias("total")).scalar()
    mark = F.md5(F.concat(F.col("draw").cast("string"), F.lit(f":{seed}")))
    draws = df.sparkSession.range(n).select(F.col("id").alias("draw"), F.conv(F.substring(mark, 1, 15), 16, 10).cast("bigint").alias("_u")) \
              .withColumn("_pos", F.col("_u") % total).drop("_u")
    listed = starts.agg(F.sort_array(F.collect_list(F.struct("_start", "_range"))).alias("s")).scalar()
    at = draws.withColumn("_s", listed).withColumn("_hit", F.try_element_at(F.filter("_s", lambda s: s["_start"] <= F.col("_pos")), F.lit(-1))) \
              .select("draw", "_pos", F.col("_hit._range").alias("_range"), (F.col("_pos") - F.col("_hit._start")).alias("_within")).where("_within is not null")  # none of an empty table
    within = Window.partitionBy("_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    held = ranged.join(at.select("_range").distinct(), "_range", "left_semi").withColumn("_end", F.sum("_n").over(within))
    # rows at their first position and draws at theirs, in one order: a draw takes the last row before it
    marks = held.select("_range", (F.col("_end") - F.col("_n")).alias("_at"), F.struct("_v").alias("_row"), F.lit(None).cast("bigint").alias("draw")) \
                .unionByName(at.select("_range", F.col("_within").alias("_at"), F.lit(None).cast(T.StructType([T.StructField("_v", counted.schema["_v"].dataType)])).alias("_row"), "draw"))
    order = Window.partitionBy("_range").orderBy("_at", F.asc_nulls_first("draw")).rowsBetween(Window.unboundedPreceding, 0)
    return marks.withColumn("_row", F.last("_row", ignorenulls=True).over(order)).where("draw is not null").select("draw", F.col("_row._v").alias(name))
