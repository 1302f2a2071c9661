"""Randomised check of the item-list parser against a brute-force model of the Java text rules."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from batchkit.functions.registry import register_all
from batchkit.operators import business as biz


class Bad(Exception):
    pass


def j_trim(s):
    a, b = 0, len(s)
    while a < b and ord(s[a]) <= 0x20:
        a += 1
    while b > a and ord(s[b - 1]) <= 0x20:
        b -= 1
    return s[a:b]


def j_split(s, sep):
    if sep not in s:
        return [s]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def j_int(t, field, frag):
    body = t[1:] if t[:1] in ("+", "-") else t
    if not body or not body.isascii() or not body.isdigit():
        raise Bad(f"Invalid {field} value in item_list fragment: {frag}")
    v = int(t)
    if not -2**31 <= v < 2**31:
        raise Bad(f"Invalid {field} value in item_list fragment: {frag}")
    return v


def model(text, drop):
    if text is None or j_trim(text) == "":
        return []
    out = []
    for item in j_split(text, ","):
        frag = j_trim(item)
        if frag == "":
            continue
        try:
            parts = j_split(frag, ":")
            if len(parts) != 3:
                raise Bad(f"Invalid item_list fragment: {frag}")
            out.append((j_trim(parts[0]), j_int(j_trim(parts[1]), "qty", frag), j_int(j_trim(parts[2]), "price", frag)))
        except Bad:
            if not drop:
                raise
    return out


SKUS = ["a", "sku01", " x ", "", "\tb", "c d"]
NUMS = ["1", "+2", "-3", "0", "42", "x", "", " 4 ", "\t5", "2147483647", "2147483648", "-2147483648", "1.5", "07"]


def random_list(rng):
    if rng.random() < 0.05:
        return None
    items = []
    for _ in range(rng.randint(0, 4)):
        kind = rng.random()
        if kind < 0.7:
            item = f"{rng.choice(SKUS)}:{rng.choice(NUMS)}:{rng.choice(NUMS)}"
        elif kind < 0.8:
            item = f"{rng.choice(SKUS)}:{rng.choice(NUMS)}"
        elif kind < 0.9:
            item = f"{rng.choice(SKUS)}:{rng.choice(NUMS)}:{rng.choice(NUMS)}" + ":" * rng.randint(1, 2)
        else:
            item = rng.choice(["", " ", ":::", "a:1:2:3", "\t"])
        items.append(item)
    return ",".join(items) + ("," if rng.random() < 0.1 else "")


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(20240501)
    return [random_list(rng) for _ in range(3000)]


def _parsed(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, item_list string")
    out = biz.explode_item_list(df, "item_list", keep=["id"], **kw).collect()
    got = {}
    for r in out:
        got.setdefault(r["id"], []).append((r["sku_id"], r["qty"], r["price"]))
    return got


def test_drop_mode_matches_model(spark, cases):
    got = _parsed(spark, cases, on_error="drop")
    for i, text in enumerate(cases):
        assert sorted(got.get(i, [])) == sorted(model(text, drop=True)), repr(text)


def _valid(text):
    try:
        model(text, drop=False)
        return True
    except Bad:
        return False


def test_raise_mode_on_valid_lists_matches_model(spark, cases):
    valid = [t for t in cases if _valid(t)]
    assert len(valid) > 300
    got = _parsed(spark, valid)
    for i, text in enumerate(valid):
        assert sorted(got.get(i, [])) == sorted(model(text, drop=False)), repr(text)


def test_sql_table_function_matches_model(spark, cases):
    register_all(spark)
    valid = [t for t in cases if _valid(t)]
    spark.createDataFrame(list(enumerate(valid)), "id int, s string").createOrReplaceTempView("il_model")
    rows = spark.sql("select t.id, f.* from il_model t, lateral item_list_explode(t.s) f").collect()
    got = {}
    for r in rows:
        got.setdefault(r["id"], []).append((r["sku_id"], r["qty"], r["price"]))
    for i, text in enumerate(valid):
        assert sorted(got.get(i, [])) == sorted(model(text, drop=False)), repr(text)


def test_raise_mode_errors_match_model(spark, cases):
    invalid = [t for t in cases if not _valid(t)][:12]
    for text in invalid:
        with pytest.raises(Bad) as expected:
            model(text, drop=False)
        df = spark.createDataFrame([(text,)], "item_list string")
        with pytest.raises(PySparkException) as got:
            biz.explode_item_list(df, "item_list").count()
        # items are checked in list order, qty before price: the first error is the model's
        assert str(expected.value) in str(got.value)
