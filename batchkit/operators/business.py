"""The five business operators, each a built-in expression or DataFrame transform.

* ``event_rate``        – per group, rows of one event type over rows of another.
* ``int_to_percent``    – ``num / denom`` as whole-percent text, rounded half-even.
* ``explode_item_list`` – ``sku:qty:price,...`` strings into rows, validated.
* ``login_rollup``      – day -> province -> distinct users, as JSON documents.
* ``int_average``       – mean of longs with integer (truncating) division.

None of them runs Python per row: they are Catalyst expressions, so the
aggregates get partial (map-side) aggregation and everything stays in
whole-stage codegen.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit._util import STRINGS, as_col, as_lit, require_type
from batchkit.functions.text import java_split, java_trim
from batchkit.operators.blocks import rank_blocks

# Error texts and output column names of the item-list explode.
ITEM_FRAGMENT_ERROR = "Invalid item_list fragment: "
ITEM_NUMBER_ERROR = "Invalid {field} value in item_list fragment: "
ITEM_FIELDS = ("sku_id", "qty", "price")


# --------------------------------------------------------------------------- event_rate
def event_rate(event, numerator, denominator) -> Column:
    """Aggregate: count(event == numerator) / count(event == denominator).

    ``event`` is a column (name or Column); ``numerator`` / ``denominator`` are
    event names (Python values become literals) or Columns that may vary per row.
    A row counts only when all three inputs are non-null; when both names are
    equal a row raises both counters (rate 1.0).  Null when no row matches the
    denominator.  Planned as two ``count_if`` with partial aggregation.
    """
    e, n, d = as_col(event), as_lit(numerator), as_lit(denominator)
    num = F.count_if((e == n) & d.isNotNull())
    den = F.count_if((e == d) & n.isNotNull())
    return F.try_divide(num, den)


def event_rate_by(df: DataFrame, by: Iterable, event, numerator, denominator,
                  name: str = "event_rate") -> DataFrame:
    """``df.groupBy(*by).agg(event_rate(...))`` with the argument checks of the UDAF.

    ``event`` must be a string column (name or Column); numerator / denominator must
    be strings (literal names) or string Columns of ``df``; types are resolved against
    ``df`` before anything runs.
    """
    require_type(df, event, STRINGS, "event_rate")
    for arg in (numerator, denominator):
        if isinstance(arg, Column):
            require_type(df, arg, STRINGS, "event_rate")
        elif not isinstance(arg, str):
            raise TypeError(f"event_rate: event names must be strings, got {type(arg).__name__}")
    return df.groupBy(*by).agg(event_rate(event, numerator, denominator).alias(name))


# ------------------------------------------------------------------------ int_to_percent
def int_to_percent(num, denom) -> Column:
    """Whole-percent text of ``num / denom``: double division, times 100, half-even.

    1/4 -> '25%', 1/8 -> '12%', 3/8 -> '38%', -1/1000 -> '0%', 5000/1 -> '500000%'.
    Null when either input is null or the denominator is 0.
    """
    ratio = as_col(num).cast("double") / F.nullif(as_col(denom), F.lit(0)).cast("double")
    # decimal(38,0) rather than bigint: bigint inputs (counts) may exceed the long range
    whole = F.bround(ratio * F.lit(100.0), 0).cast("decimal(38,0)")
    return F.concat(whole.cast("string"), F.lit("%"))


def int_to_percent_checked(df: DataFrame, num: str, denom: str) -> Column:
    """``int_to_percent`` with the UDF's strict argument check: both columns INT."""
    require_type(df, num, (T.IntegerType,), "int_to_percent")
    require_type(df, denom, (T.IntegerType,), "int_to_percent")
    return int_to_percent(num, denom)


# ------------------------------------------------------------------- item_list explode
def _parse_int(text: Column, field: str, fragment: Column, on_error: str) -> Column:
    value = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))  # null on bad text or overflow
    if on_error == "drop":
        return value
    return F.coalesce(value, F.raise_error(F.concat(F.lit(ITEM_NUMBER_ERROR.format(field=field)), fragment)))


def parse_item_list(item_list, on_error: str = "raise") -> Column:
    """``array<struct<sku_id string, qty int, price int>>`` parsed from ``sku:qty:price,...``.

    Java text rules: items split on ','; each item trimmed (chars <= U+0020) and
    blank items skipped; an item is split on ':' dropping trailing empty parts and
    must have exactly 3 parts; numbers are optional sign + digits within int range.
    Validation happens here, before any explode, so a bad item raises even when
    later selects prune fields or only count rows.  ``on_error='drop'`` removes bad
    items instead of raising.

    Built as staged ``transform`` calls so each trim / split runs once per item
    (expressions inside one lambda are not de-duplicated).
    """
    if on_error not in ("raise", "drop"):
        raise ValueError("on_error must be 'raise' or 'drop'")
    frags = F.filter(F.transform(F.split(as_col(item_list), ","), java_trim), lambda t: t != "")
    split = F.transform(frags, lambda t: F.struct(t.alias("frag"), java_split(t, ":").alias("p")))
    fields = F.transform(split, lambda s: F.struct(
        s["frag"].alias("frag"), F.size(s["p"]).alias("n"), java_trim(F.get(s["p"], 0)).alias("sku"),
        java_trim(F.get(s["p"], 1)).alias("q"), java_trim(F.get(s["p"], 2)).alias("pr")))

    def to_row(s: Column) -> Column:
        qty = _parse_int(s["q"], "qty", s["frag"], on_error)
        price = _parse_int(s["pr"], "price", s["frag"], on_error)
        row = F.struct(s["sku"].alias("sku_id"), qty.alias("qty"), price.alias("price"))
        if on_error == "drop":
            return F.when((s["n"] == 3) & qty.isNotNull() & price.isNotNull(), row)
        return F.when(s["n"] == 3, row).otherwise(F.raise_error(F.concat(F.lit(ITEM_FRAGMENT_ERROR), s["frag"])))

    parsed = F.transform(fields, to_row)
    if on_error == "drop":
        parsed = F.filter(parsed, lambda r: r.isNotNull())
    return parsed


def explode_item_list(df: DataFrame, column: str, on_error: str = "raise",
                      keep: Iterable[str] | None = None) -> DataFrame:
    """Lateral explode of an item-list column: one row per item, adding sku_id, qty, price.

    Null or blank lists give no rows (never ``explode_outer``).  ``keep`` chooses
    the input columns carried along (default: all).  Narrow: no shuffle.
    """
    require_type(df, column, STRINGS, "item_list_explode")
    carried = list(df.columns if keep is None else keep)
    item = F.explode(parse_item_list(column, on_error)).alias("_item")
    return df.select(*carried, item).select(*carried, *[F.col(f"_item.{f}").alias(f) for f in ITEM_FIELDS])


# --------------------------------------------------------------------------- login roll-up
# Positions of user, province and day in a tab-separated login row.
LOGIN_FIELDS = {"user": 0, "province": 3, "dt": 9}
LOGIN_ROW_ERROR = "Invalid login row: "


def parse_login_lines(df: DataFrame, column: str = "value", on_error: str = "raise") -> DataFrame:
    """Tab-separated login rows -> ``(user, province, dt)`` text columns.

    Java ``split("\t")`` rules (trailing empty fields dropped); a row needs the
    field at position 9, otherwise it raises (``on_error='raise'``) or is dropped
    (``'drop'``).  A header line is data, as in the upstream stream of rows.
    """
    if on_error not in ("raise", "drop"):
        raise ValueError("on_error must be 'raise' or 'drop'")
    require_type(df, column, STRINGS, "login rows")
    parts = java_split(column, "\t")
    need = max(LOGIN_FIELDS.values()) + 1
    rows = df.select(parts.alias("_f"), F.col(column).alias("_line"))
    if on_error == "drop":
        rows = rows.where(F.size("_f") >= need)
    else:
        rows = rows.where(F.when(F.size("_f") >= need, F.lit(True))
                          .otherwise(F.raise_error(F.concat(F.lit(LOGIN_ROW_ERROR), F.col("_line")))))
    return rows.select(*[F.col("_f").getItem(i).alias(name) for name, i in LOGIN_FIELDS.items()])


#: (province, user) entries in a document of the login roll-up.
ENTRIES_PER_BLOCK = 100_000


def login_rollup(df: DataFrame, day, province, user, entries_per_block: int = ENTRIES_PER_BLOCK) -> DataFrame:
    """Distinct users per (day, province), in JSON documents of bounded size per day.

    Output columns ``dt``, ``block``, ``j`` where ``j`` is
    ``{"dt": ..., "provinces": [{"province": ..., "user_list": [...]}]}`` with
    provinces and users sorted.  A day's distinct (province, user) entries are ranked
    and block = rank div ``entries_per_block`` (see :func:`rank_blocks`): one rule at
    every size, a day with fewer entries is the one document of block 0, and a day's
    documents together are its roll-up.  A null user is no user and isn't listed.

    ``day`` may be a date (e.g. :func:`batchkit.functions.day_key`) or text; it is
    formatted as text only on the output rows.

    Plan: distinct entries with partial aggregation, a range sort of them for the
    ranks, one shuffle on (dt, block) and the two aggregations on it.
    """
    users = df.select(as_col(day).alias("dt"),
                      as_col(province).cast("string").alias("province"),
                      as_col(user).cast("string").alias("user"))
    entries = users.where(F.col("user").isNotNull()).distinct().withColumn("copies", F.lit(1))
    placed = rank_blocks(entries, ["dt"], ["province", "user"], entries_per_block).repartition("dt", "block")
    per_province = (placed.groupBy("dt", "block", "province")
                    .agg(F.sort_array(F.collect_list("user")).alias("user_list")))
    per_day = (per_province.groupBy("dt", "block")
               .agg(F.sort_array(F.collect_list(F.struct("province", "user_list"))).alias("provinces")))
    per_day = per_day.withColumn("dt", F.col("dt").cast("string"))  # format once per output row
    return per_day.select("dt", "block", F.to_json(F.struct("dt", "provinces")).alias("j"))


# ------------------------------------------------------------------------- int_average
def int_average(c, exact: bool = False) -> Column:
    """Aggregate: ``cast(sum(v) div count(v) as double)`` – the division truncates.

    (1, 2) -> 1.0; (-1, -2) -> -1.0; no rows -> null.  ``exact=True`` gives ``avg``.
    The input must be an integral column (``div`` is integer division).
    """
    v = as_col(c)
    if exact:
        return F.avg(v)
    # The sum runs in decimal(38,0): a long sum of many large keys can leave the long
    # range at scale; the truncated mean itself always fits a long.
    return F.call_function("div", F.sum(v.cast("decimal(38,0)")), F.count(v)).cast("double")
