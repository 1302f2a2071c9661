"""Joins with hot keys, layout-independent samples, planned text ranges, caller's partitioners, pipe codec, JSON arrays."""

import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from batchkit.operators import joins, partitions, sampling
from batchkit.plans.inspect import physical_plan, shuffles
from batchkit.sources import json as json_src
from batchkit.sources import text as text_src


def rows_of(df):
    return Counter(map(tuple, df.collect()))


# ---------------------------------------------------------------- joins
def sides(spark, seed, hot_left=True, hot_right=True):
    r = random.Random(seed)
    key = lambda hot: None if r.random() < 0.1 else 7 if hot and r.random() < 0.34 else r.randint(0, 40)
    left = [(key(hot_left), i) for i in range(300)]
    right = [(key(hot_right), i) for i in range(200)]
    return (spark.createDataFrame(left, "a int, x int"), spark.createDataFrame(right, "b int, y int"))


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("seed, hot_left, hot_right", [(1, True, True), (2, True, False), (3, False, True)])
def test_spread_join_is_the_join(spark, how, seed, hot_left, hot_right):
    left, right = sides(spark, seed, hot_left, hot_right)
    want = left.join(right, left.a == right.b, how)
    assert rows_of(joins.spread_join(left, right, [("a", "b")], how)) == rows_of(want)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_spread_join_with_a_hot_key_of_one_side(spark, how):
    left = spark.createDataFrame([(7, i) for i in range(400)] + [(i, i) for i in range(100, 200)], "a int, x int")
    right = spark.createDataFrame([(i, i) for i in range(150, 160)] + [(9, i) for i in range(300)], "b int, y int")
    assert rows_of(joins.spread_join(left, right, [("a", "b")], how)) == rows_of(left.join(right, left.a == right.b, how))


def test_spread_join_on_two_columns_and_empty_sides(spark):
    left = spark.createDataFrame([(1, "p", 1), (1, "q", 2), (1, None, 3), (None, "p", 4)] * 30, "a int, b string, x int")
    right = spark.createDataFrame([(1, "p", 1), (2, "p", 2), (1, None, 3)] * 20, "c int, d string, y int")
    on = [("a", "c"), ("b", "d")]
    condition = (left.a == right.c) & (left.b == right.d)
    assert rows_of(joins.spread_join(left, right, on)) == rows_of(left.join(right, condition, "full"))
    none = right.where("c > 5")
    assert rows_of(joins.spread_join(left, none, on)) == rows_of(left.join(none, condition, "full"))
    with pytest.raises(ValueError, match="both sides"):
        joins.spread_join(left, left, on)
    with pytest.raises(ValueError, match="how"):
        joins.spread_join(left, right, on, "cross")


def test_spread_join_deals_a_hot_key_to_many_tasks(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).cast("int").alias("a"), F.col("id").alias("x"))
    right = spark.range(600).select(F.when(F.col("id") % 3 == 0, 7).otherwise(-F.col("id")).cast("int").alias("b"), F.col("id").alias("y"))
    out = joins.spread_join(left, right, [("a", "b")], "full")
    assert out.where("a = 7 and b = 7").count() == 1000 * 200
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tasks = joins.spread_join(left, right, [("a", "b")], "full").where("a = 7 and b = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 100_000


def test_spread_join_deals_small_sides_out_too(spark):
    """Sides that Spark would broadcast, each scanned by one task: the product is made by many, in the session as it is."""
    left = spark.range(0, 3000, 1, 1).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).alias("a"), F.col("id").alias("x"))
    right = spark.range(0, 600, 1, 1).select(F.when(F.col("id") % 3 == 0, 7).otherwise(-F.col("id")).alias("b"), F.col("id").alias("y"))
    made = joins.spread_join(left, right, [("a", "b")], "full").groupBy(F.spark_partition_id()).agg(F.expr("count_if(a = b)").alias("n")).collect()
    assert sum(r["n"] for r in made) == 1000 * 200
    assert len([r for r in made if r["n"]]) >= 4 and max(r["n"] for r in made) < 1000 * 200 // 2


@pytest.mark.parametrize("hot", [True, False])
def test_spread_join_makes_copies_in_many_tasks_and_rows_once(spark, hot):
    """Rows are dealt out before they are copied, as a small file is scanned by one task; where no key is cold, nothing makes the product's rows again."""
    key = F.col("id") % 5 if hot else F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") + 10)
    left = spark.range(0, 600, 1, 2).select(key.alias("a"), F.col("id").alias("x"))
    right = spark.range(0, 120, 1, 2).select(key.alias("b"), F.col("id").alias("y"))
    out = joins.spread_join(left, right, [("a", "b")], "full")
    want = left.join(right, left.a == right.b, "full")
    assert out.dtypes == want.dtypes and rows_of(out) == rows_of(want)
    done = physical_plan(out).split("\n+- == Initial Plan")[0]
    done = [x.strip(" :+-") for x in done[done.index("== Final Plan"):].splitlines()]
    copies = [i for i, x in enumerate(done) if "Generate explode" in x]
    assert len(copies) == 2
    for i in copies:
        below = next(x for x in done[i + 1:] if "Exchange" in x or "Range" in x)
        assert "RoundRobinPartitioning" in below, below
    if hot:
        top = next(x for x in done[1:] if not x.startswith(("ResultQueryStage", "Coalesce")))
        assert "Project" not in top, top


# ---------------------------------------------------------------- samples
def test_samples_are_the_same_on_any_layout(spark):
    df = spark.range(5000)
    for replaced, fraction in ((False, 0.3), (True, 0.3), (True, 2.5), (True, 0.0), (False, 1.0)):
        a = rows_of(sampling.sample(df.repartition(3), "id", fraction, seed=5, with_replacement=replaced))
        assert a == rows_of(sampling.sample(df.repartition(11), "id", fraction, seed=5, with_replacement=replaced))
        n = sum(a.values())
        assert abs(n - 5000 * fraction) <= 6 * (5000 * fraction) ** 0.5
        assert replaced or max(a.values(), default=1) == 1
    assert rows_of(sampling.sample(df, "id", 0.3, seed=6)) != rows_of(sampling.sample(df, "id", 0.3, seed=5))


def test_sample_with_replacement_is_poisson(spark):
    counts = Counter(rows_of(sampling.sample(spark.range(20_000), "id", 1.5, seed=3, with_replacement=True)).values())
    import math
    counts[0] = 20_000 - sum(counts.values())
    for k in range(6):
        p = math.exp(-1.5) * 1.5 ** k / math.factorial(k)
        assert abs(counts[k] - 20_000 * p) < 5 * (20_000 * p) ** 0.5
    assert sampling.poisson_thresholds(0.0) == [] and sampling.poisson_thresholds(1.5) == sorted(sampling.poisson_thresholds(1.5))
    assert sum(rows_of(sampling.sample(spark.range(50), "id", 90.0, with_replacement=True)).values()) > 3000
    with pytest.raises(ValueError):
        sampling.poisson_thresholds(-1)


def test_draws_with_replacement_by_position(spark):
    import hashlib
    values = [None, None] + [5] * 700 + list(range(100, 400)) * 2
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    ordered = sorted(values, key=lambda v: (v is not None, v or 0))
    got = {r["draw"]: r["v"] for r in sampling.take_sample_with_replacement(df, "v", 300, seed=4).collect()}
    assert got == {i: ordered[int(hashlib.md5(f"{i}:4".encode()).hexdigest()[:15], 16) % len(values)] for i in range(300)}
    assert sampling.take_sample_with_replacement(df.where("v > 9999"), "v", 10).collect() == []


def test_draws_do_not_multiply_the_table(spark):
    plan = sampling.take_sample_with_replacement(spark.range(1000), "id", 50)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan


# ---------------------------------------------------------------- text ranges
def test_min_partitions_without_a_shuffle(spark, tmp_path):
    lines = [f"line {i}" for i in range(1000)]
    (tmp_path / "t.txt").write_text("\n".join(lines[:500]) + "\r\n" + "\r\n".join(lines[500:]))
    df = text_src.read_lines(spark, str(tmp_path / "t.txt"), min_partitions=9)
    assert partitions.num_partitions(df) >= 9 and df.columns == ["value"]
    assert [r["value"] for r in df.collect()] == lines
    assert shuffles(df) == 0
    assert len([1 for r in df.groupBy(F.spark_partition_id()).count().collect()]) >= 9
    assert text_src.read_lines(spark, str(tmp_path / "t.txt")).count() == 1000


# ---------------------------------------------------------------- sorted repartition
def layout(df):
    return [(r["p"], *list(r)[:-2]) for r in sorted(df.withColumn("p", F.spark_partition_id()).withColumn("m", F.monotonically_increasing_id()).collect(), key=lambda r: r["m"])]


def test_partitioner_by_bounds_and_by_function(spark):
    df = spark.createDataFrame([(i * 7 % 50, -i) for i in range(200)] + [(None, 1)], "k int, v int").repartition(4)
    got = layout(partitions.repartition_sorted(df, 4, "k", "v", partitioner=[10, 20, 40]))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    rows = [tuple(r) for r in df.collect()]
    place = lambda k: 0 if k is None else sum(b <= k for b in (10, 20, 40))
    assert got == [(p, *r) for p in range(4) for r in sorted((r for r in rows if place(r[0]) == p), key=key)]
    got = layout(partitions.repartition_sorted(df.where("k is not null"), 3, "k", "v", partitioner=lambda k: -k))
    assert got == [(p, *r) for p in range(3) for r in sorted((r for r in rows if r[0] is not None and -r[0] % 3 == p), key=key)]
    for bad in ([3, 1], [1, 2, 3, 4]):
        with pytest.raises(ValueError):
            partitions.repartition_sorted(df, 4, "k", partitioner=bad)


def test_a_hot_key_spans_partitions_by_default(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("k"), F.lit(0).alias("v"), "id")
    out = partitions.repartition_sorted(df, 8, "k", "v")
    assert shuffles(out) == 1
    rows = layout(out)
    assert len({p for p, k, *_ in rows if k == 1}) >= 4
    assert [r[1:3] for r in rows] == sorted(r[1:3] for r in rows)
    sizes = Counter(p for p, *_ in rows)
    assert max(sizes.values()) < 2000


# ---------------------------------------------------------------- pipe
def test_pipe_keeps_any_text_and_null(spark):
    texts = ["plain", "", None, "a\tb", "a\nb\r\nc", "\\", "\\t", "\\\\t\t\\\n", "\\N", "tail\\", "\t", " spaced ", "é😀", "\\\\\\n"]
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "i int, t string, u string").repartition(3)
    out = partitions.pipe(df, ["i", "t", "u"], "cat", "i int, t string, u string", "pipe_texts")
    assert sorted(map(tuple, out.collect())) == [(i, t, t) for i, t in enumerate(texts)]
    one = partitions.pipe(df, ["t"], "cat", "t string", "pipe_one")
    assert Counter(r["t"] for r in one.collect()) == Counter(texts)


def test_pipe_through_a_command_that_counts(spark):
    df = spark.createDataFrame([("x y",), ("z",)], "t string").coalesce(1)
    out = partitions.pipe(df, ["t"], "wc -l", "n bigint", "pipe_count")
    assert [r["n"] for r in out.collect()] == [2]


# ---------------------------------------------------------------- JSON arrays
def records(n, seed=1):
    r = random.Random(seed)
    parts = ['}', '{', '"', '\\', 'a', ',', ']', '[', 'é', '\n', '\\"', '}{', ' ']
    return [{"id": i, "s": "".join(r.choice(parts) for _ in range(r.randint(0, 12))), "o": {"p": [{"q": i}] * (i % 3), "t": "{" * (i % 4)}} for i in range(n)]


@pytest.mark.parametrize("block, n, indent", [("64", 25, None), ("300", 40, 2), ("700", 120, None), ("5000", 150, 2), ("1000000", 150, None)])
def test_json_array_in_byte_ranges(spark, tmp_path, block, n, indent):
    rows = records(n)
    rows[20]["s"] = "x}" * 200  # longer than several ranges
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.json").write_text(json.dumps(rows, indent=indent), encoding="utf-8")
    (tmp_path / "a" / "two.json").write_text(json.dumps(records(20, 2), ensure_ascii=False) + "\n", encoding="utf-8")
    (tmp_path / "a" / "none.json").write_text("[]")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, block if "max" in k else "1")
    try:
        got = json_src.json_array_elements(spark, str(tmp_path / "a")).collect()
        df = json_src.read_json_array(spark, str(tmp_path / "a"))
        parsed = sorted((r["id"], r["s"], r["o"]["t"], [q["q"] for q in r["o"]["p"]]) for r in df.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = rows + records(20, 2)
    key = lambda d: json.dumps(d, sort_keys=True)
    assert sorted((json.loads(r["value"]) for r in got), key=key) == sorted(want, key=key)
    assert parsed == sorted((d["id"], d["s"], d["o"]["t"], [q["q"] for q in d["o"]["p"]]) for d in want)


def test_json_array_with_schema_and_more_than_one_task(spark, tmp_path):
    path = str(tmp_path / "big.json")
    with open(path, "w") as f:
        f.write(json.dumps([{"id": i, "name": f"n{i}", "pad": "p" * 50} for i in range(40_000)]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(os.path.getsize(path) // 6))
    try:
        df = json_src.read_json_array(spark, path, "id bigint, name string")
        assert rows_of(df) == Counter((i, f"n{i}") for i in range(40_000))
        tasks = json_src.json_array_elements(spark, path).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(tasks) >= 4
    assert rows_of(spark.read.option("multiLine", True).json(path).select("id", "name")) == Counter((i, f"n{i}") for i in range(40_000))
