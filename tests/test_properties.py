"""Properties for the keys without an exact oracle, and layout invariance."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from batchkit.operators import business as biz
from batchkit.operators import partitions, sampling
from batchkit.session import table
from conftest import SF001

Q = E.queries()


def test_sample_fraction_is_subset_of_right_size(spark):
    s = Q["sample_fraction"](spark, SF001)
    n_all = table(spark, SF001, "events").count()
    n = s.count()
    assert abs(n - n_all * 0.5) < 5 * (n_all * 0.25) ** 0.5
    assert s.join(table(spark, SF001, "events"), "event_id", "left_anti").count() == 0
    assert s.distinct().count() == n


def test_hash_sample_same_on_any_layout(spark):
    ev = table(spark, SF001, "events").select("event_id")
    a = {r[0] for r in sampling.sample_by_hash(ev.repartition(1), "event_id", 0.3, seed=5).collect()}
    b = {r[0] for r in sampling.sample_by_hash(ev.repartition(17), "event_id", 0.3, seed=5).collect()}
    assert a == b and 0.25 < len(a) / ev.count() < 0.35


def test_udf_random_range_and_not_constant(spark):
    from batchkit.functions.registry import register_all

    register_all(spark)
    rs = [r["r"] for r in table(spark, SF001, "events").select(F.expr("udf_random()").alias("r")).collect()]
    assert all(0.0 <= r < 1.0 for r in rs)
    assert len(set(rs)) > len(rs) * 0.99


def test_partition_index_rows(spark):
    out = partitions.with_partition_index(table(spark, SF001, "orders").select("o_orderkey"))
    n_parts = out.rdd.getNumPartitions()
    rows = out.collect()
    assert len(rows) == table(spark, SF001, "orders").count()
    assert {r["pidx"] for r in rows} <= set(range(n_parts))


def test_repartition_sorted_partitions(spark):
    rows = Q["repartition_sorted"](spark, SF001).collect()
    by_part = {}
    for r in sorted(rows, key=lambda r: (r["pidx"], r["pos"])):
        by_part.setdefault(r["pidx"], []).append((r["l_orderkey"], r["l_linenumber"]))
    assert sorted(by_part) == list(range(6))
    assert all(held == sorted(held) for held in by_part.values())
    assert all(k % 6 == p for p, held in by_part.items() for k, _ in held)  # the caller's partitioner
    assert all(r["in_order"] for r in Q["repartition_spread"](spark, SF001).collect())


def test_coalesce_and_repartition_counts(spark):
    li = table(spark, SF001, "lineitem")
    n = li.rdd.getNumPartitions()
    assert partitions.coalesce_to(li, 1).rdd.getNumPartitions() == 1
    assert partitions.repartition_to(li, 7).rdd.getNumPartitions() == 7
    assert Q["coalesce_rows"](spark, SF001).rdd.getNumPartitions() <= max(1, n // 2)


def test_map_partitions_runs_once_per_partition(spark):
    import pyarrow as pa

    def tag(batches):
        calls = 0
        rows = 0
        for b in batches:
            rows += b.num_rows
        calls += 1
        yield pa.RecordBatch.from_arrays([pa.array([calls], pa.int32()), pa.array([rows], pa.int64())],
                                         names=["calls", "rows"])

    df = spark.range(0, 10, 1, 2)
    out = partitions.map_partitions(df, tag, "calls int, rows long").collect()
    assert len(out) == 2 and sum(r["rows"] for r in out) == 10


@pytest.mark.parametrize("n_parts", [1, 17])
def test_business_operators_layout_invariant(spark, n_parts):
    ev = table(spark, SF001, "events")
    base = {r["dt"]: r["r"] for r in Q["event_rate"](spark, SF001).collect()}
    moved = ev.repartition(n_parts).groupBy(F.substring(F.col("ts").cast("string"), 1, 10).alias("dt")).agg(
        biz.event_rate("event_type", "purchase", "view").alias("r"))
    assert {r["dt"]: r["r"] for r in moved.collect()} == base
    roll = {(r["dt"], r["block"]): r["j"] for r in Q["login_rollup"](spark, SF001).collect()}
    roll2 = biz.login_rollup(ev.repartition(n_parts), F.substring(F.col("ts").cast("string"), 1, 10),
                             "event_type", "user_id", entries_per_block=64)
    assert {(r["dt"], r["block"]): r["j"] for r in roll2.collect()} == roll


def test_transform_rows_through_cat(spark):
    out = Q["transform_rows"](spark, SF001)
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF001, "documents").select("doc_id", "text").collect()}
    assert {r["doc_id"]: r["text"] for r in out.collect()} == texts
