"""Hypothesis: java_trim / java_split against a Python model over arbitrary Unicode text."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from batchkit.functions.text import java_split, java_trim


def model_trim(s):
    a, b = 0, len(s)
    while a < b and ord(s[a]) <= 0x20:
        a += 1
    while b > a and ord(s[b - 1]) <= 0x20:
        b -= 1
    return s[a:b]


def model_split(s, sep):
    if sep not in s:
        return [s]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


ALPHABET = st.sampled_from(list("ab:,\t ") + ["\x00", "\x1f", "\x7f", "\u0085", " ", " ", "é", "字", "\U0001f600"])
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=50, max_size=200)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(texts=TEXTS)
def test_java_trim_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r[0] for r in df.select(java_trim("s")).collect()] == [model_trim(t) for t in texts]


@SETTINGS
@given(texts=TEXTS, sep=st.sampled_from([":", ",", "\t"]))
def test_java_split_model(spark, texts, sep):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [list(r[0]) for r in df.select(java_split("s", sep)).collect()]
    assert got == [model_split(t, sep) for t in texts]
