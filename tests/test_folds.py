"""User-defined folds: values, partial states, merging, hot keys, SQL names, argument checks."""

import math
from collections import Counter, defaultdict
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from batchkit.operators import folds


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


# ---------------------------------------------------------------- event rate
EVENTS = [("a", "tap", "tap", "look"), ("a", "look", "tap", "look"), ("a", "look", "tap", "look"), ("a", None, "tap", "look"),
          ("b", "tap", "tap", "look"), ("c", "look", None, "look"), ("c", "look", "tap", "look"), ("d", "tap", "tap", "tap"), (None, "look", "tap", "look"), ("e", "tap", "tap", None)]


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(EVENTS, "k string, e string, n string, d string")


WANTED = {"a": 0.5, "b": None, "c": 0.0, "d": 1.0, None: 0.0, "e": None}


def test_event_rate_fold(spark, events):
    got = folds.fold_by_key(events, "k", ["e", "n", "d"], folds.event_rate_fold(), "r")
    assert got.columns == ["k", "r"]
    assert as_dict(got) == WANTED


def test_event_rate_fold_by_sql_name(spark, events):
    folds.register_fold(spark, "rate", folds.event_rate_fold(), keys="k string")
    events.createOrReplaceTempView("fold_events")
    got = spark.sql("select k, rate(state) r from rate_states(table(select k, e, n, d from fold_events)) group by k")
    assert as_dict(got) == WANTED


def test_event_rate_partial_states_merge(spark, events):
    fold = folds.event_rate_fold()
    states = []
    for part in (EVENTS[:2], EVENTS[2:4], EVENTS[4:]):
        columns = [pa.array([r[i] for r in part if r[0] == "a"], pa.string()) for i in (1, 2, 3)]
        states.append(fold.update(fold.zero(), *columns))
    assert [(s["numerator_count"], s["denominator_count"]) for s in states] == [(1, 1), (0, 1), (0, 0)]
    total = fold.zero()
    for s in states:
        total = fold.merge(total, s)
    assert fold.finish(total) == 0.5
    assert fold.finish(fold.zero()) is None
    assert fold.finish(fold.merge(fold.zero(), {"numerator_count": None, "denominator_count": None})) is None  # a partial with no counts


@pytest.mark.parametrize("values, message", [(["e", "n"], "requires 3"), (["e", "n", "x"], "argument 3"), (["x", "n", "d"], "argument 1")])
def test_arguments_are_checked_before_anything_runs(events, values, message):
    with pytest.raises(TypeError, match=message):
        folds.fold_by_key(events.withColumn("x", F.lit(1)), "k", values, folds.event_rate_fold())


def test_char_and_varchar_are_strings(events):
    got = folds.fold_by_key(events, "k", [F.col("e").cast("varchar(9)"), F.col("n"), F.col("d")], folds.event_rate_fold(), "r")
    assert as_dict(got) == WANTED


@pytest.mark.parametrize("columns, message", [("k, e, n", "requires 4"), ("k, e, n, 1", "column 4")])
def test_sql_names_check_their_arguments(spark, events, columns, message):
    folds.register_fold(spark, "rate", folds.event_rate_fold(), keys="k string")
    events.createOrReplaceTempView("fold_events")
    with pytest.raises(Exception, match=message):
        spark.sql(f"select k, rate(state) r from rate_states(table(select {columns} from fold_events)) group by k").collect()


# ---------------------------------------------------------------- integer mean
def test_int_mean(spark):
    rows = [("p", 1), ("p", 2), ("n", -1), ("n", -2), ("z", None), ("z", 7), ("o", None), ("h", 2**63 - 1), ("h", 2**63 - 1), ("h", 2**63 - 3)]
    df = spark.createDataFrame(rows, "k string, v bigint").repartition(3)
    got = as_dict(folds.fold_by_key(df, "k", "v", folds.int_mean_fold(), "m"))
    assert got == {"p": 1.0, "n": -1.0, "z": 7.0, "o": None, "h": float(2**63 - 2)}


def test_global_fold_and_no_rows(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 1001)], "v bigint").repartition(7)
    assert folds.fold_by_key(df, [], "v", folds.int_mean_fold(), "m").collect()[0]["m"] == 500.0
    nothing = df.where("v < 0")
    assert [r["m"] for r in folds.fold_by_key(nothing, [], "v", folds.int_mean_fold(), "m").collect()] == [None]
    assert folds.fold_by_key(nothing.withColumn("k", F.lit(1)), "k", "v", folds.int_mean_fold()).collect() == []


def test_global_aggregate_by_sql_name(spark):
    folds.register_fold(spark, "mean_of_longs", folds.int_mean_fold())
    spark.createDataFrame([(3000,), (4500,), (3500,), (4000,)], "salary bigint").createOrReplaceTempView("fold_staff")
    got = spark.sql("select mean_of_longs(state) m from mean_of_longs_states(table(select salary from fold_staff))")
    assert got.collect()[0]["m"] == 3750.0


# ---------------------------------------------------------------- own folds
def test_row_fold_with_a_state_of_its_own(spark):
    # zero, step, merge, finish as aggregateByKey and an Aggregator take them: the longest run's word and all lengths seen
    fold = folds.Fold.by_row(lambda: {"longest": "", "lengths": []},
                             lambda s, w: {"longest": max(s["longest"], w or "", key=lambda x: (len(x), x)), "lengths": sorted({*s["lengths"], len(w or "")})},
                             lambda a, b: {"longest": max(a["longest"], b["longest"], key=lambda x: (len(x), x)), "lengths": sorted({*a["lengths"], *b["lengths"]})},
                             lambda s: f"{s['longest']}:{len(s['lengths'])}",
                             inputs="w string", state="struct<longest string, lengths array<int>>", result="string")
    rows = [(i % 5, "x" * (i % 7) + str(i % 3)) for i in range(500)] + [(9, None)]
    got = as_dict(folds.fold_by_key(spark.createDataFrame(rows, "k int, w string").repartition(6), "k", "w", fold))
    want = {}
    for k in {r[0] for r in rows}:
        words = [w or "" for q, w in rows if q == k]
        want[k] = f"{max(words, key=lambda x: (len(x), x))}:{len({len(w) for w in words})}"
    assert got == want


def test_count_per_key_like_the_built_in(spark):
    count = folds.Fold.by_row(lambda: 0, lambda s, one: s + one, lambda a, b: a + b, inputs="one int", state="bigint")
    rows = [(f"chapter {i * i % 11}", 1) for i in range(300)]
    got = as_dict(folds.fold_by_key(spark.createDataFrame(rows, "k string, one int").repartition(5), "k", "one", count))
    assert got == Counter(r[0] for r in rows)


def test_histogram_against_a_model(spark):
    nan, edges = float("nan"), [0.0, 1.5, 10.0]
    rows = [(i % 3, (i * 37 % 29) - 5.0) for i in range(400)] + [(0, None), (1, nan), (2, 1.5), (2, float("inf")), (2, float("-inf"))]
    got = as_dict(folds.fold_by_key(spark.createDataFrame(rows, "k int, v double").repartition(4), "k", "v", folds.histogram(edges)))
    want = defaultdict(lambda: [0] * 4)
    for k, v in rows:
        if v is not None and not math.isnan(v):
            want[k][sum(e <= v for e in edges)] += 1
    assert got == dict(want)


def test_keys_of_all_atomic_kinds(spark):
    nan = float("nan")
    rows = [(nan, None, Decimal("1.50"), 1), (nan, None, Decimal("1.50"), 2), (-0.0, b"\x00a", None, 3), (0.0, b"\x00a", None, 4), (None, b"", Decimal("2.00"), 5)]
    df = spark.createDataFrame(rows, "f double, b binary, d decimal(5,2), v bigint").repartition(5)
    got = folds.fold_by_key(df, ["f", "b", "d"], "v", folds.int_mean_fold(), "m")
    plain = lambda r: (r["f"] if r["f"] is None or r["f"] == r["f"] else "nan", None if r["b"] is None else bytes(r["b"]), r["d"], r["m"])
    assert sorted((plain(r) for r in got.collect()), key=str) == sorted([("nan", None, Decimal("1.50"), 1.0), (0.0, b"\x00a", None, 3.0), (None, b"", Decimal("2.00"), 5.0)], key=str)
    with pytest.raises(TypeError, match="atomic"):
        folds.fold_by_key(df.withColumn("a", F.array("f")), "a", "v", folds.int_mean_fold())


def test_a_hot_key_moves_one_state_a_task(spark):
    tasks = 6
    df = spark.range(0, 60_000, 1, tasks).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), F.col("id").alias("v"))
    arrow = [pa.string()]
    partial = df.mapInArrow(folds._partial(folds.int_mean_fold(), 1, arrow, pa.struct([("total", pa.decimal128(38, 0)), ("n", pa.int64())])),
                            "k0 string, state struct<total decimal(38,0), n bigint>, salt int")
    assert partial.where("k0 = 'hot'").count() == tasks
    assert partial.groupBy("k0").count().agg(F.max("count")).first()[0] <= tasks
    got = as_dict(folds.fold_by_key(df, "k", "v", folds.int_mean_fold()))
    assert got["hot"] == float(sum(range(0, 60_000, 3)) // 20_000) and len(got) == 51


def test_many_keys_pass_through_bounded_states(spark, monkeypatch):
    monkeypatch.setattr(folds, "MAX_KEYS", 100)
    df = spark.range(0, 20_000, 1, 3).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    got = as_dict(folds.fold_by_key(df, "k", "v", folds.int_mean_fold()))
    assert got == {k: float(sum(range(k, 20_000, 1000)) // 20) for k in range(1000)}
