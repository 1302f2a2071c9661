"""Column helpers with Java text semantics and small operator helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from batchkit.functions.text import day_key, day_of, hash_block, java_split, java_trim
from batchkit.operators import rows, sampling, sorting


@pytest.mark.parametrize("text,sep,expected", [
    ("a:1:2:", ":", ["a", "1", "2"]),
    ("a::", ":", ["a"]),
    (":1:2", ":", ["", "1", "2"]),
    (":::", ":", []),
    ("", ":", [""]),
    ("a\tb\t\t", "\t", ["a", "b"]),
    ("a|b||", r"\|", ["a", "b"]),
    ("x", ":", ["x"]),
])
def test_java_split(spark, text, sep, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(java_split("s", sep).alias("p")).first()["p"] == expected


def test_java_trim_strips_control_chars_only(spark):
    df = spark.createDataFrame([("\x00\t\n a b \r\x1f",), (" x ",)], "s string")
    assert [r[0] for r in df.select(java_trim("s")).collect()] == ["a b", " x "]


def test_day_key_and_day_of(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 23, 59), "2024-01-02 23:59:00")], "ts timestamp_ntz, s string")
    r = df.select(day_key(df, "ts").cast("string").alias("a"), day_key(df, "s").alias("b"),
                  day_of("ts").alias("c")).first()
    assert (r["a"], r["b"], r["c"]) == ("2024-01-02", "2024-01-02", "2024-01-02")


def test_hash_block_and_threshold(spark):
    df = spark.createDataFrame([(5,)], "v int")
    assert df.select(hash_block("v", 2).alias("b")).first()["b"] == "e4"  # md5('5') starts e4
    assert df.select(hash_block("v", 0).alias("b")).first()["b"] == ""
    assert sampling.hash_threshold(0.5) == "80000000"
    assert sampling.hash_threshold(0.0) == "00000000"
    assert sampling.hash_threshold(1 - 1e-12) == "gggggggg"  # rounds up to the top: keep everything
    assert sampling.hash_threshold(0.25, digits=1) == "4"
    with pytest.raises(ValueError):
        sampling.hash_threshold(1.5)
    ev = spark.range(1000)
    assert sampling.sample_by_hash(ev, "id", 1.0).count() == 1000
    assert sampling.sample_by_hash(ev, "id", 0.0).count() == 0


def test_sample_with_replacement(spark):
    out = sampling.sample_fraction(spark.range(2000), 1.0, seed=3, with_replacement=True)
    assert out.count() > 1500 and out.distinct().count() < out.count()


def test_sort_desc_and_top_k(spark):
    df = spark.createDataFrame([(1, "a"), (3, "b"), (2, "c")], "n int, k string")
    assert [r["n"] for r in sorting.sort_desc(df, "n").collect()] == [3, 2, 1]
    assert [r["k"] for r in sorting.top_k(df, 2, F.col("n").desc()).collect()] == ["b", "c"]


def test_tokens_java_mode(spark):
    df = spark.createDataFrame([("a\tb\t\t",)], "s string")
    assert [r["w"] for r in rows.tokens(df, "s", "\t", java=True).collect()] == ["a", "b"]
    assert [r["w"] for r in rows.tokens(df, "s", "\t").collect()] == ["a", "b", "", ""]


def test_lines_and_fields(spark):
    df = spark.createDataFrame([(1, "x\ny\n"), (2, "z")], "id int, text string")
    assert rows.lines(df, "text", keep=["id"]).count() == 4  # Spark split keeps the trailing empty line
    f = spark.createDataFrame([("a\tb\tc",)], "value string").select(rows.field("value", 2, "\t").alias("f"))
    assert f.first()["f"] == "c"


def test_table_definitions_reused_per_session(spark):
    from batchkit.session import table

    a = table(spark, "/root/testdata/sf0.001", "nation")
    assert table(spark, "/root/testdata/sf0.001", "nation") is a
    assert a.count() == 25


def test_table_definition_follows_rewritten_files(spark, tmp_path):
    from batchkit.session import table

    spark.range(5).write.parquet(str(tmp_path / "t.parquet"))
    assert table(spark, str(tmp_path), "t").count() == 5
    spark.range(7).write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
    assert table(spark, str(tmp_path), "t").count() == 7


def test_scratch_is_dropped(spark):
    import os

    from batchkit.session import drop_scratch, scratch_database, shared_dir

    path = shared_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    db = scratch_database(spark)
    spark.range(3).write.saveAsTable(f"{db}.t")
    assert drop_scratch(spark) >= 2
    assert not os.path.exists(path.removeprefix("file://")) and not spark.catalog.databaseExists(db)
    assert drop_scratch(spark) == 0


def test_sql_quoting_of_paths_and_commands(spark, tmp_path):
    from batchkit.operators.partitions import pipe
    from batchkit.sources.json import create_file_view, sql_on_file

    odd = tmp_path / "it's `odd`"
    spark.createDataFrame([(1, "a")], "id int, s string").write.json(str(odd))
    assert sql_on_file(spark, "json", str(odd)).count() == 1
    assert create_file_view(spark, "odd view", "json", str(odd)).count() == 1
    out = pipe(spark.createDataFrame([("x'y",)], "v string"), ["v"], "sed 's/x/z/'", "v string", "pipe_quote")
    assert [r["v"] for r in out.collect()] == ["z'y"]


def test_explode_column_and_in_list(spark):
    from batchkit.operators.joins import in_list
    from batchkit.operators.nested import explode_column

    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, a array<int>")
    out = explode_column(df, "a", "v", keep=["id"]).collect()
    assert [(r["id"], r["v"]) for r in out] == [(1, 1), (1, 2)]  # empty and null arrays give no rows
    seg = spark.createDataFrame([("BUILDING",), ("AUTO",)], "s string")
    assert seg.where(in_list(F.col("s"), ["BUILDING"])).count() == 1
    assert seg.where(in_list("s", ("AUTO", "X"))).count() == 1


def test_shared_dirs_are_separate_and_under_checkpoint_dir(spark):
    from batchkit.session import checkpoint_base, shared_dir

    a, b = shared_dir(spark, "out"), shared_dir(spark, "out")
    assert a != b and a.startswith(checkpoint_base(spark)) and b.startswith(checkpoint_base(spark))
