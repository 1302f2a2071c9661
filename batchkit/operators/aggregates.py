"""Grouping family: keyed reduce/count, bags of values, min/max bounds, observed metrics.

Every keyed aggregate here is a built-in aggregate, so Catalyst plans a partial
(map-side) aggregate, one shuffle on the keys, and a final aggregate – the
combine-before-shuffle that ``reduceByKey`` is chosen for.  Bags of values first
count equal values the same way and are then cut into blocks of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit._util import as_col
from batchkit.operators.blocks import rank_blocks


def _keys(by) -> list:
    return [by] if isinstance(by, (str, Column)) else list(by)


def reduce_all(df: DataFrame, value, name: str = "total") -> DataFrame:
    """Global ``reduce(+)``: one row ``sum(value)``."""
    return df.agg(F.sum(as_col(value)).alias(name))


def reduce_pair(df: DataFrame, key, value) -> DataFrame:
    """Reduce over (k, v) pairs: the values are summed, the smallest key is kept.

    The RDD version keeps whichever key comes first, which depends on layout;
    ``min`` makes it deterministic.  Integral values are summed in decimal(38,0): a
    long sum of dense keys leaves the long range at scale.
    """
    v = as_col(value)
    if isinstance(df.select(v.alias("v")).schema["v"].dataType, T.IntegralType):
        v = v.cast("decimal(38,0)")
    return df.agg(F.min(as_col(key)).alias("k"), F.sum(v).alias("v"))


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    """Row count as a one-row DataFrame (stays distributed until the caller acts)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_by_key(df: DataFrame, by, name: str = "n") -> DataFrame:
    """``countByKey`` without pulling the map to the driver."""
    return df.groupBy(*_keys(by)).agg(F.count(F.lit(1)).alias(name))


def reduce_by_key(df: DataFrame, by, value, name: str = "v") -> DataFrame:
    """Per-key sum with map-side combine (partial + final HashAggregate)."""
    return df.groupBy(*_keys(by)).agg(F.sum(as_col(value)).alias(name))


def aggregate_by_key(df: DataFrame, by, *aggs: Column) -> DataFrame:
    """``aggregateByKey``: the zero / within-partition / merge functions of a built-in
    aggregate are Catalyst's partial and final aggregation modes."""
    return df.groupBy(*_keys(by)).agg(*aggs)


def distinct_values(df: DataFrame, value, name: str = "v") -> DataFrame:
    """``distinct`` of one projected field."""
    return df.select(as_col(value).alias(name)).distinct()


def key_bounds(df: DataFrame, key) -> DataFrame:
    """``min`` and ``max`` of a key, e.g. to split a range scan into strides."""
    k = as_col(key)
    return df.agg(F.min(k).alias("lo"), F.max(k).alias("hi"))


#: Values in a block of a bag.
ROWS_PER_BLOCK = 100_000


def group_into_bags(df: DataFrame, by, value, rows_per_block: int = ROWS_PER_BLOCK, sep: str = ",") -> DataFrame:
    """``groupBy``/``groupByKey`` into bags, in blocks of at most ``rows_per_block`` values.

    A bag is never gathered whole: equal values of a key are counted first (partial
    aggregation), then ranked, and block = rank div ``rows_per_block`` (see
    :func:`rank_blocks`), the same rule at every size: a small key has the one block 0,
    a value repeated often continues in further blocks.  Each (key, block) row has its
    number of values ``n`` and the values in order, joined by ``sep``, in ``vals``; a
    null value counts, comes first and prints ``null``.  A key's blocks are its bag.
    """
    keys = _keys(by)
    names = [k if isinstance(k, str) else f"k{i}" for i, k in enumerate(keys)]
    rows = df.select(*[as_col(k).alias(n) for k, n in zip(keys, names)], as_col(value).alias("_v"))
    counted = rows.groupBy(*names, "_v").agg(F.count(F.lit(1)).alias("_n"))
    # a block is bounded and its rows don't combine: one shuffle on (key, block), then the aggregate
    cut = rank_blocks(counted, names, ["_v"], rows_per_block, copies="_n").repartition(*names, "block")
    held = F.sort_array(F.collect_list(F.struct("_v", "_n")))
    texts = F.flatten(F.transform(held, lambda s: F.array_repeat(F.coalesce(s["_v"].cast("string"), F.lit("null")), s["_n"])))
    return cut.groupBy(*names, "block").agg(F.sum("_n").alias("n"), F.array_join(texts, sep).alias("vals"))


def observe_sum(df: DataFrame, value, name: str = "s") -> tuple[DataFrame, Observation]:
    """Accumulator done right: a named metric computed once per action.

    Returns the observed frame, which holds the value column only (so a scan reads
    that column alone), and the ``Observation``; read ``obs.get`` after an action on
    the frame.  Unlike an accumulator updated in a ``map``, a retried task or a second
    plan is not counted twice.
    """
    obs = Observation(f"observe_{name}")
    values = df.select(as_col(value).alias("value"))
    return values.observe(obs, F.sum("value").alias(name), F.count(F.lit(1)).alias("rows")), obs


def metric_frame(df: DataFrame, obs: Observation, schema: str) -> DataFrame:
    """Run ``df`` through a no-op sink once and return the observed metrics as one row of ``schema``.

    An empty input gives null for a sum and 0 for a count.
    """
    df.write.format("noop").mode("overwrite").save()
    metrics = obs.get
    fields = T.StructType.fromDDL(schema)
    return df.sparkSession.createDataFrame([tuple(metrics[f.name] for f in fields)], schema=fields)
