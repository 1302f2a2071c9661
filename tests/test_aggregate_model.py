"""Randomised checks of event_rate, int_average and login_rollup against plain-Python models."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from batchkit.operators import business as biz

EVENTS = ["view", "pay", "click", None]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    return [(rng.randint(0, 40), rng.choice(EVENTS), rng.choice(["pay", "pay", None]), rng.choice(["view", "click", None]),
             rng.choice([None] + list(range(-50, 51)))) for _ in range(20000)]


def test_event_rate_model(spark, rows):
    num, den = defaultdict(int), defaultdict(int)
    groups = set()
    for g, e, n, d, _ in rows:
        groups.add(g)
        if e is not None and n is not None and d is not None:
            num[g] += e == n
            den[g] += e == d
    expected = {g: (num[g] / den[g] if den[g] else None) for g in groups}
    df = spark.createDataFrame(rows, "g int, e string, n string, d string, v int").repartition(13)
    got = {r["g"]: r["r"] for r in df.groupBy("g").agg(biz.event_rate("e", F.col("n"), F.col("d")).alias("r")).collect()}
    assert got == expected


def test_int_average_model(spark, rows):
    sums, counts = defaultdict(int), defaultdict(int)
    groups = set()
    for g, *_, v in rows:
        groups.add(g)
        if v is not None:
            sums[g] += v
            counts[g] += 1

    def trunc_div(a, b):
        q = abs(a) // b
        return float(-q if a < 0 else q)

    expected = {g: (trunc_div(sums[g], counts[g]) if counts[g] else None) for g in groups}
    df = spark.createDataFrame(rows, "g int, e string, n string, d string, v int").repartition(13)
    got = {r["g"]: r["a"] for r in df.groupBy("g").agg(biz.int_average(F.col("v").cast("bigint")).alias("a")).collect()}
    assert got == expected


def test_login_rollup_model(spark):
    import json

    rng = random.Random(5)
    users = ["u1", "u2", "u10", "é", "字", "Z", None]
    provinces = ["BJ", "SH", "GD", "字省"]
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    rows = [(rng.choice(users), rng.choice(provinces), rng.choice(days)) for _ in range(3000)]
    expected = defaultdict(lambda: defaultdict(set))
    for u, p, d in rows:
        if u is not None:
            expected[d][p].add(u)
    df = spark.createDataFrame(rows, "u string, p string, d string").repartition(7)
    for per in (1, 5, 100_000):
        merged = defaultdict(lambda: defaultdict(set))
        for r in biz.login_rollup(df, "d", "p", "u", entries_per_block=per).collect():
            doc = json.loads(r["j"])
            assert doc["dt"] == r["dt"]
            names = [p["province"] for p in doc["provinces"]]
            assert names == sorted(names)
            for p in doc["provinces"]:
                assert p["user_list"] == sorted(p["user_list"]) and len(set(p["user_list"])) == len(p["user_list"])
                assert not merged[r["dt"]][p["province"]] & set(p["user_list"])  # an entry is in one block
                merged[r["dt"]][p["province"]].update(p["user_list"])
            assert sum(len(p["user_list"]) for p in doc["provinces"]) <= per
        assert {d: dict(v) for d, v in merged.items()} == {d: dict(v) for d, v in expected.items()}


def test_int_average_sums_beyond_the_long_range(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 20), rng.randint(-2**63, 2**63 - 1)) for _ in range(20000)]
    sums, counts = defaultdict(int), defaultdict(int)
    for g, v in rows:
        sums[g] += v
        counts[g] += 1
    assert max(abs(v) for v in sums.values()) > 2**63  # a long sum would overflow

    def trunc_div(a, b):
        q = abs(a) // b
        return float(-q if a < 0 else q)

    df = spark.createDataFrame(rows, "g int, v bigint").repartition(5)
    got = {r["g"]: r["a"] for r in df.groupBy("g").agg(biz.int_average("v").alias("a")).collect()}
    assert got == {g: trunc_div(sums[g], counts[g]) for g in sums}
