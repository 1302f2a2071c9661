"""Small literals with their known results, through the library operators."""

import pytest
from pyspark.sql import functions as F

from batchkit.operators import aggregates as agg
from batchkit.operators import joins, partitions, sets, sorting
from batchkit.plans.inspect import physical_plan


def test_reduce_sum_1_to_10(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 11)], "v int")
    assert agg.reduce_all(df, "v").first()["total"] == 55


def test_reduce_pair_keeps_min_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 4)], "k string, v int")
    assert tuple(agg.reduce_pair(df, "k", "v").first()) == ("a", 8)


def test_count_by_key(spark):
    df = spark.createDataFrame([(k,) for k in "aaabab"], "k string")
    assert {r["k"]: r["n"] for r in agg.count_by_key(df, "k").collect()} == {"a": 4, "b": 2}


def test_union_and_intersection(spark):
    a = spark.createDataFrame([(i,) for i in range(1, 11)], "v int")
    b = spark.createDataFrame([(10,)], "v int")
    assert sets.union_all(a, b).count() == 11
    assert sets.union_distinct(a, b).count() == 10
    c = spark.createDataFrame([(1,), (1,)] + [(i,) for i in range(2, 11)], "v int")
    d = spark.createDataFrame([(10,), (1,), (1,)], "v int")
    assert sorted(r["v"] for r in sets.intersect_distinct(c, d).collect()) == [1, 10]


def test_joins_of_a_key_without_partner(spark):
    pages = spark.createDataFrame([("it", "p7"), ("it", "p8"), ("it", "p9")], "k string, page string")
    prices = spark.createDataFrame([("it", 31), ("no", 17), ("se", 23)], "k string, price int")
    out = joins.join(pages, prices, "k", "inner", broadcast_right=True).collect()
    assert len(out) == 3 and {r["price"] for r in out} == {31}
    assert joins.join(pages, prices, "k", "full").count() == 5
    assert joins.join(prices, pages, "k", "left").count() == 5
    assert joins.join(pages, prices, "k", "right").count() == 5


def test_partition_index_two_partitions(spark):
    df = spark.range(1, 11, 1, 2).select(F.col("id").alias("v"))
    got = {r["v"]: r["pidx"] for r in partitions.with_partition_index(df).collect()}
    assert got == {**{i: 0 for i in range(1, 6)}, **{i: 1 for i in range(6, 11)}}


def test_broadcast_filter(spark):
    words = spark.createDataFrame([(w,) for w in ["ebb tide", "flood tide", "slack water", "calm", "gale"]], "w string")
    wanted = spark.createDataFrame([("ebb tide",), ("calm",)], "w string")
    out = joins.broadcast_semi(words, wanted, "w")
    assert sorted(r["w"] for r in out.collect()) == ["calm", "ebb tide"]
    assert "BroadcastHashJoin" in physical_plan(out)


def test_accumulator_as_observation(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 5, 6)], "v int")
    observed, obs = agg.observe_sum(df, "v")
    m = agg.metric_frame(observed, obs, "s bigint, rows bigint").first()
    assert (m["s"], m["rows"]) == (17, 5)
    none, obs = agg.observe_sum(df.where("v > 100"), "v")
    assert tuple(agg.metric_frame(none, obs, "s bigint, rows bigint").first()) == (None, 0)


def test_take_ordered_by_length(spark):
    names = ["long winter", "harbour", "stone bridge", "low tide", "old clocktower", "fog"]
    df = spark.createDataFrame([(n,) for n in names * 2], "name string")
    assert [r["k"] for r in sorting.shortest(df, "name", 2).collect()] == ["fog", "harbour"]


def test_mod3_groups(spark):
    df = spark.createDataFrame([(i,) for i in range(30)], "v int")
    bags = agg.group_into_bags(df.select((F.col("v") % 3).alias("k"), "v"), "k", "v").collect()
    assert {r["k"]: (r["n"], r["vals"]) for r in bags}[1] == (10, "1,4,7,10,13,16,19,22,25,28")
    blocked = agg.group_into_bags(df.select((F.col("v") % 3).alias("k"), "v"), "k", "v", rows_per_block=4).collect()
    assert sorted(int(x) for r in blocked if r["k"] == 1 for x in r["vals"].split(",")) == list(range(1, 30, 3))
    assert all(r["n"] == len(r["vals"].split(",")) for r in blocked)


def test_with_position_matches_row_number(spark):
    df = spark.createDataFrame([(i % 7, f"k{i}") for i in range(200)], "n int, k string").repartition(5)
    got = sorting.with_position(df, [F.col("n").desc(), F.col("k")]).orderBy("pos").collect()
    expected = sorted(((r["n"], r["k"]) for r in df.collect()), key=lambda t: (-t[0], t[1]))
    assert [(r["n"], r["k"]) for r in got] == expected
    assert [r["pos"] for r in got] == list(range(1, 201))


@pytest.mark.parametrize("seps", [",", "\t"])
def test_word_count_tokens(spark, seps):
    from batchkit.operators.rows import word_count

    df = spark.createDataFrame([("a,b,a",)], "s string")
    assert word_count(df, "s", seps).count() == (2 if seps == "," else 1)


def test_registered_filter_gt_on_range(spark):
    from batchkit.functions.registry import register_all

    register_all(spark)
    assert spark.sql("select id from range(1000) where filter_gt(id)").count() == 899


def test_typed_map_increment(spark):
    from batchkit.operators.rows import increment

    df = spark.createDataFrame([(1,), (2,), (3,)], "value long")
    assert [r[0] for r in df.select(increment("value", cast=None).alias("value")).collect()] == [2, 3, 4]


def test_explode_lateral_view(spark):
    spark.createDataFrame([([1, 2],), ([3, 4],)], "a array<int>").createOrReplaceTempView("arr_t")
    assert [r[0] for r in spark.sql("select v from arr_t lateral view explode(a) t as v").collect()] == [1, 2, 3, 4]


def test_sql_functions_coerce_like_spark(spark):
    from batchkit.functions.registry import register_all

    register_all(spark)
    assert spark.sql("select int_to_percent('1', 4) p").first()["p"] == "25%"
    assert spark.sql("select udf_increment(41) v").first()["v"] == 42


def test_first_element(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "v int").repartition(3)
    assert [r["v"] for r in sorting.take_first(df, 1, "v").collect()] == [1]
    assert len(sorting.take_first(df, 2).collect()) == 2  # partition order, like take(2)


def test_original_sql_names_still_work(spark):
    from batchkit.functions.registry import register_all

    names = register_all(spark)
    assert {"int_to_precent", "random1", "filterGt"} <= set(names)
    r = spark.sql("select int_to_precent(1, 4) p, random1(1) i, filterGt(200) g, filterGt(5) s").first()
    assert (r["p"], r["i"], r["g"], r["s"]) == ("25%", 2, True, False)


def test_shortest_exact_when_smallest_values_repeat(spark):
    rows = [("a",)] * 500 + [("bb",)] * 500 + [("ccc",), ("dd",), ("e",)]
    df = spark.createDataFrame(rows, "name string").repartition(4)
    assert [r["k"] for r in sorting.shortest(df, "name", 3).collect()] == ["a", "e", "bb"]


def test_intersection_nulls_and_types(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y"), (2, None), (2, None), (3, "z")], "k int, s string")
    b = spark.createDataFrame([(None, "y"), (2, None), (3, "q"), (0, "y")], "k int, s string")
    got = sorted(sets.intersect_distinct(a, b).collect(), key=lambda r: (r["k"] is None, r["k"] or 0))
    assert [tuple(r) for r in got] == [(2, None), (None, "y")]
    # 0 / '' stand-ins never match a null
    c = spark.createDataFrame([(0, "")], "k int, s string")
    d = spark.createDataFrame([(None, None)], "k int, s string")
    assert sets.intersect_distinct(c, d).count() == 0
    assert sets.intersect_distinct(c, c).count() == 1
