"""A hot key holding a third of the rows stays bounded and complete; Python registration surface."""

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit.functions.registry import register_python
from batchkit.functions.text import hash_block
from batchkit.operators import aggregates as agg
from batchkit.operators import business as biz
from batchkit.operators import nested
from batchkit.sinks import text as text_sinks
from batchkit.sinks.tables import write_partitioned
from batchkit.sources import text as text_src


def _hot(spark, n=3000):
    # key 0 holds a third of all rows
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                 F.col("id").alias("v"))


def test_bags_of_a_hot_key_are_bounded_and_complete(spark):
    df = _hot(spark)
    bags = agg.group_into_bags(df, "k", "v", rows_per_block=100).collect()
    hot = [b for b in bags if b["k"] == 0]
    assert max(b["n"] for b in hot) <= 100
    assert sorted(int(x) for b in hot for x in b["vals"].split(",")) == list(range(0, 3000, 3))


def test_nest_of_a_hot_key_is_bounded(spark):
    df = _hot(spark)
    rows = nested.nest(df, "k", ["v"], "vs", block=hash_block("v", 2)).collect()
    hot = [r for r in rows if r["k"] == 0]
    assert len(hot) > 100 and sum(len(r["vs"]) for r in hot) == 1000


def test_login_rollup_hot_day_split_into_blocks(spark):
    df = spark.range(3000).select(F.lit("2024-01-01").alias("dt"), F.lit("BJ").alias("p"),
                                  F.col("id").cast("string").alias("u"))
    docs = biz.login_rollup(df, "dt", "p", "u", entries_per_block=50).collect()
    users = [u for d in docs for p in json.loads(d["j"])["provinces"] for u in p["user_list"]]
    assert len(docs) == 60 and sorted(users) == sorted(str(i) for i in range(3000))
    assert max(len(json.loads(d["j"])["provinces"][0]["user_list"]) for d in docs) == 50


def test_grouped_text_hot_key(spark, tmp_path):
    df = _hot(spark).select("k", F.lit(1).alias("one"))
    out = text_sinks.write_grouped_text(df, "k", "one", 3, str(tmp_path / "hot"), rows_per_block=50)
    lines = [r[0] for r in text_src.read_lines(spark, out).collect()]
    hot = [ln for ln in lines if ln.startswith("(0,[")]
    assert sum(len(ln[len("(0,["):-2].split(", ")) for ln in hot) == 1000
    assert max(len(ln[len("(0,["):-2].split(", ")) for ln in hot) <= 50


def test_grouped_text_key_in_several_files(spark, tmp_path):
    import os

    df = spark.range(300_000).select(F.lit("one").alias("k"), F.col("id").alias("v"))
    out = text_sinks.write_grouped_text(df, "k", "v", 4, str(tmp_path / "files"), rows_per_block=10_000)
    filled = [f for f in os.listdir(out) if f.startswith("part-") and os.path.getsize(os.path.join(out, f))]
    assert len(filled) > 1
    assert text_src.read_lines(spark, out).count() == 30


def _files(path):
    import os

    return sum(len([f for f in files if f.endswith(".parquet")]) for _, _, files in os.walk(path))


def test_partitioned_write_keeps_few_files_and_splits_a_hot_value(spark, tmp_path):
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(10_000).select("id", (F.col("id") % 5).cast("string").alias("kind"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
        path = write_partitioned(df, str(tmp_path / "few"), "kind")  # a map column is no obstacle
        assert _files(path) <= 10 and spark.read.parquet(path).count() == 10_000
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
        hot = spark.range(0, 30_000, 1, 8).select("id", F.md5(F.col("id").cast("string")).alias("h"), F.when(F.col("id") % 3 == 0, "x").otherwise("hot").alias("kind"))
        path = write_partitioned(hot, str(tmp_path / "hot"), "kind")
        assert 1 < _files(path + "/kind=hot") <= 64 and spark.read.parquet(path).count() == 30_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_register_python_surface(spark):
    def plus_one(s: pd.Series) -> pd.Series:
        return s + 1

    f = register_python(spark, "py_increment", plus_one, T.LongType())
    assert f.deterministic
    assert spark.sql("select py_increment(id) v from range(3)").collect()[2]["v"] == 3

    def rnd(s: pd.Series) -> pd.Series:
        import numpy as np
        return pd.Series(np.random.random(len(s)))

    r = register_python(spark, "py_random", rnd, T.DoubleType(), deterministic=False)
    assert not r.deterministic
    vals = [x["r"] for x in spark.sql("select py_random(id) r from range(100)").collect()]
    assert all(0 <= v < 1 for v in vals) and len(set(vals)) > 90


def test_bags_keep_nulls_and_split_a_repeated_value(spark):
    rows = spark.createDataFrame([(1, 5), (1, None), (1, None), (None, 7), (None, None)], "k int, v int")
    got = {r["k"]: (r["block"], r["n"], r["vals"]) for r in agg.group_into_bags(rows, "k", "v").collect()}
    assert got == {1: (0, 3, "null,null,5"), None: (0, 2, "null,7")}
    same = spark.range(300_000).select(F.lit("a").alias("k"), F.lit(9).alias("v"))
    bags = agg.group_into_bags(same, "k", "v", rows_per_block=1000).collect()
    assert sorted(b["block"] for b in bags) == list(range(300)) and {b["n"] for b in bags} == {1000}


def test_rank_blocks_against_a_model(spark):
    import random

    r = random.Random(4)
    rows = [(r.choice([None, 0, 1, 2]), r.choice([None, *range(6)])) for _ in range(700)]
    model = {}
    for k in {k for k, _ in rows}:
        values = sorted((v for kk, v in rows if kk == k), key=lambda v: (v is not None, v or 0))
        for i in range(0, len(values), 7):
            model[k, i // 7] = ",".join("null" if v is None else str(v) for v in values[i:i + 7])
    df = spark.createDataFrame(rows, "k int, v int")
    for parts in (1, 5):
        got = agg.group_into_bags(df.repartition(parts), "k", "v", rows_per_block=7).collect()
        assert {(g["k"], g["block"]): g["vals"] for g in got} == model


def test_grouped_text_prints_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("a", None), (None, "x")], "k string, v string")
    out = text_sinks.write_grouped_text(df, "k", "v", 2, str(tmp_path / "nulls"))
    assert sorted(r[0] for r in text_src.read_lines(spark, out).collect()) == ["(a,[null, null])", "(null,[x])"]


def test_repartition_sorted_spreads_a_hot_key(spark):
    from batchkit.operators.partitions import repartition_sorted

    df = _hot(spark)  # key 0 holds a third of the rows
    out = repartition_sorted(df, 6, "k", "v")
    tagged = out.select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m"), "k", "v").collect()
    parts = {}
    for r in sorted(tagged, key=lambda r: r["m"]):
        parts.setdefault(r["p"], []).append((r["k"], r["v"]))
    assert all(rows == sorted(rows) for rows in parts.values())
    assert len({p for p, rows in parts.items() if any(k == 0 for k, _ in rows)}) > 1  # hot key split
    assert max(len(rows) for rows in parts.values()) < 1000
    ordered = [rows for _, rows in sorted(parts.items())]
    assert all(a[-1] <= b[0] for a, b in zip(ordered, ordered[1:]) if a and b)  # global order
    assert sum(len(rows) for rows in parts.values()) == 3000
