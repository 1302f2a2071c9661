"""Plan shape: pushdown, pruning, partial aggregation, join strategy, no Python in the row path."""

import pytest

from conftest import SF001
from batchkit.plans import catalog
from batchkit.plans.inspect import physical_plan

Q = catalog.queries()
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "AggregateInPandas")
PYTHON_ON_PURPOSE = {"map_partitions", "fold_int_average_sql"}  # the function of the caller is the operator


def plan(df) -> str:
    return physical_plan(df)


def test_filter_pushed_to_scan(spark):
    p = plan(Q["filter_gt"](spark, SF001))
    assert "GreaterThan(o_orderkey,100)" in p


def test_projection_pruned_to_scan(spark):
    p = plan(Q["map_increment"](spark, SF001))
    assert "struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in p.replace(" ", "")


def test_event_rate_partial_aggregate(spark):
    df = Q["event_rate"](spark, SF001)
    df.collect()
    p = plan(df)
    assert "partial_count_if" in p or "partial_count" in p


def test_small_dimension_join_is_broadcast(spark):
    df = Q["join_inner"](spark, SF001)
    df.collect()
    assert "BroadcastHashJoin" in plan(df)


def test_semi_join_broadcast_by_measured_size(spark):
    df = Q["broadcast_semi"](spark, SF001)
    df.collect()
    assert "BroadcastHashJoin" in plan(df) and "LeftSemi" in plan(df)


def test_top_k_without_full_sort(spark):
    for key in ("take_first_n", "take_ordered_by_len", "take_sample_fixed"):
        assert "TakeOrderedAndProject" in plan(Q[key](spark, SF001)), key


@pytest.mark.parametrize("key", sorted(k for k in Q if k not in PYTHON_ON_PURPOSE))
def test_no_python_in_row_path(spark, key):
    p = plan(Q[key](spark, SF001))
    assert not any(node in p for node in PYTHON_NODES), key


def test_broadcast_only_by_size_or_the_callers_word(spark):
    from batchkit.operators import joins

    big = spark.range(0, 1000).withColumnRenamed("id", "k")
    side = spark.range(0, 100).withColumnRenamed("id", "k")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = joins.join(big, side, "k", "inner", broadcast_right=True)
        plain = joins.join(big, side, "k", "inner")
        assert "BroadcastHashJoin" in plan(told)
        assert "SortMergeJoin" in plan(plain) and "BroadcastHashJoin" not in plan(plain)
        assert told.count() == plain.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


@pytest.mark.parametrize("key", ["broadcast_semi", "take_ordered_by_len", "join_left"])
def test_planning_runs_no_job(spark, key):
    Q[key](spark, SF001)  # table definitions are read once
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    spark.sparkContext.setJobGroup(f"plan-{key}", key)
    Q[key](spark, SF001)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(f"plan-{key}") in ([], ()) and before is not None


def test_observed_scan_reads_one_column(spark):
    from batchkit.operators import aggregates as agg
    from batchkit.session import table

    observed, _ = agg.observe_sum(table(spark, SF001, "lineitem"), "l_linenumber", "s")
    assert "ReadSchema: struct<l_linenumber:int>" in plan(observed)


def test_partitioned_table_reads_prune_folders(spark):
    read = Q["managed_table_roundtrip"](spark, SF001)
    assert "PartitionFilters: [isnotnull(event_type" in plan(read.where("event_type = 'purchase'"))


# Global aggregates merge one partial row per partition in a single task; the
# position offsets of sort_by_key_desc hold one row per partition; the bounds of ranges
# are taken from a sample of fixed size, and the offsets of a sample's ranges are one row
# per range; the totals that tell hot keys are global sums.  Nothing else may funnel
# through a single partition.
SINGLE_PARTITION_OK = {"reduce_sum", "reduce_pair", "count_rows", "key_bounds", "text_total_length",
                       "text_file_lines", "sort_by_key_desc", "text_min_partitions", "partition_count",
                       "group_mod3", "group_mod3_auto", "group_by_key", "login_rollup", "login_rollup_daily", "login_rollup_tsv",
                       "take_sample_replacement", "join_full", "join_full_hot"}


@pytest.mark.parametrize("key", sorted(Q))
def test_no_single_partition_funnel(spark, key):
    p = plan(Q[key](spark, SF001))
    if "SinglePartition" in p:
        assert key in SINGLE_PARTITION_OK, key
        assert "partial_" in p or key == "sort_by_key_desc", key  # only merges of partial results


@pytest.mark.parametrize("key", ["group_mod3", "group_mod3_auto", "group_by_key", "login_rollup", "login_rollup_daily"])
def test_rank_blocks_write_and_run_nothing_ahead(spark, key, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def never(*_, **__):
        raise AssertionError("no checkpoint")

    monkeypatch.setattr(DataFrame, "checkpoint", never)
    Q[key](spark, SF001)  # table definitions are read once
    spark.sparkContext.setJobGroup(f"ahead-{key}", key)
    out = Q[key](spark, SF001)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(f"ahead-{key}") in ([], ())
    final = [r for r in out.collect()]
    assert final and "ReusedExchange" in plan(out)  # ranges, offsets and rows read one shuffle of the counted values


def test_range_bounds_cut_evenly(spark):
    from pyspark.sql import functions as F

    from batchkit.operators import blocks

    df = spark.range(200_000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"), F.lit(1).alias("copies"))
    sizes = [r["count"] for r in blocks.with_range(df, ["k", "v"], copies="copies").groupBy("_range").count().collect()]
    assert len(sizes) == blocks.range_count(df) and max(sizes) < 1.3 * 200_000 / len(sizes)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")  # more ranges than are compared at a time
    try:
        held = blocks.with_range(df.where("v < 3000"), ["k", "v"]).select("k", "v", "_range").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ordered = [r["_range"] for r in sorted(held, key=lambda r: (r["k"], r["v"]))]
    assert ordered == sorted(ordered) and set(ordered) == set(range(100))
    assert all(20 <= ordered.count(k) <= 40 for k in range(100))
