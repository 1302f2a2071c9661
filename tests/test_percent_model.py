"""Randomised check of int_to_percent against a model of whole-percent, half-even formatting."""

import random
from decimal import ROUND_HALF_EVEN, Decimal

from batchkit.functions.registry import register_all
from batchkit.operators import business as biz


def model(n, d):
    if n is None or d is None or d == 0:
        return None
    pct = (n / d) * 100  # double division, then times 100, as the formatter sees it
    whole = Decimal(repr(pct)).quantize(Decimal(1), rounding=ROUND_HALF_EVEN)
    return f"{int(whole)}%"


def test_int_to_percent_matches_model(spark):
    rng = random.Random(7)
    pairs = [(rng.randint(-1000, 1000), rng.randint(-1000, 1000)) for _ in range(4000)]
    pairs += [(rng.randint(-2**31, 2**31 - 1), rng.choice([rng.randint(-2**31, 2**31 - 1), rng.randint(-50, 50)]))
              for _ in range(3000)]  # the whole int range
    pairs += [(k, 8) for k in range(-20, 21)] + [(k, 40) for k in range(-3, 44)] + [(1, 0), (None, 3), (3, None)]
    df = spark.createDataFrame(pairs, "n int, d int")
    got = [r["p"] for r in df.select(biz.int_to_percent("n", "d").alias("p")).collect()]
    assert got == [model(n, d) for n, d in pairs]
    register_all(spark)
    df.createOrReplaceTempView("pct_model")
    assert [r["p"] for r in spark.sql("select int_to_percent(n, d) p from pct_model").collect()] == got
