"""Sources and sinks on our own small fixtures written to a temp folder."""

import json
import os

import pytest
from pyspark.sql import functions as F

from batchkit.operators import aggregates as agg
from batchkit.operators import business as biz
from batchkit.operators import rows
from batchkit.sinks import tables as table_sinks
from batchkit.sinks import text as text_sinks
from batchkit.sinks.views import create_view
from batchkit.sources import delimited, generated
from batchkit.sources import json as json_src
from batchkit.sources import text as text_src
from batchkit.plans.inspect import physical_plan


def _crew(ship, harbour, sailors):
    return {"ship": ship, "harbour": harbour, "built": 1987, "flag": "blue", "afloat": True,
            "sailors": [{"name": m, "rank": 3 + i, "berth": f"b{i}", "skills": [f"s{i}{j}" for j in range(3)]}
                        for i, m in enumerate(sailors)]}


@pytest.fixture()
def crews_path(tmp_path):
    one = _crew("Grey Heron", "Lowport", ["Ada", "Bo", "Cy"])
    two = _crew("Long Tide", "Highcliff", ["Dee", "Eli", "Flo"])
    p = tmp_path / "crews.json"
    p.write_text(json.dumps([one, one, two, two, two]))  # one line, one array of 5 records
    return str(p)


def test_json_array_line_gives_rows_and_alphabetical_schema(spark, crews_path):
    df = json_src.read_json(spark, crews_path)
    assert df.count() == 5
    assert df.schema.simpleString() == (
        "struct<afloat:boolean,built:bigint,flag:string,harbour:string,sailors:array<struct<berth:string,name:string,"
        "rank:bigint,skills:array<string>>>,ship:string>")


def test_double_explode_and_views(spark, crews_path):
    df = json_src.read_json(spark, crews_path)
    name = create_view(df, "crews_view")
    out = spark.sql(f"""select ship, sailor.name, skill from {name}
                        lateral view explode(sailors) m as sailor lateral view explode(sailor.skills) p as skill""")
    assert out.count() == 45
    g = create_view(df, "crews_global", global_scope=True)
    assert spark.sql(f"select * from {g} where sailors is not null").count() == 5
    with pytest.raises(Exception):
        create_view(df, "crews_view", replace=False)


def test_sql_on_file_and_ddl_view(spark, crews_path):
    assert json_src.sql_on_file(spark, "json", crews_path).count() == 5
    v = json_src.create_file_view(spark, "crews_ddl", "json", crews_path)
    assert v.where(F.col("ship").like("%Heron%")).count() == 2
    prefixed = v.where(F.col("ship").like("%Heron%")).select(rows.prefixed("ship", "ship: ").alias("s"))
    assert {r["s"] for r in prefixed.collect()} == {"ship: Grey Heron"}


def test_int_average_of_a_json_column(spark, tmp_path):
    p = tmp_path / "catches.json"
    p.write_text("\n".join(json.dumps({"day": d, "fish": s}) for d, s in
                           [("mon", 12), ("tue", 31), ("wed", 8), ("thu", 22)]))
    df = json_src.read_json(spark, str(p))
    assert df.agg(biz.int_average("fish").alias("a")).first()["a"] == 18.0


def test_text_lines_and_total_length(spark, tmp_path):
    p = tmp_path / "text.properties"
    p.write_text("name=batch\nmode=local\n" + "x" * 14 + "\n")
    df = text_src.read_lines(spark, str(p), min_partitions=2)
    assert df.rdd.getNumPartitions() >= 2
    assert df.agg(F.sum(F.length("value")).alias("n")).first()["n"] == 10 + 10 + 14


def _shelf_lines():
    """A header whose names carry their position, then 30 rows of 9 fields; field 4 is the shelf."""
    shelves = ["maps", "logs", "charts", "tables", "letters", "songs"]
    names = ["key", "title", "pages", "state", "shelf", "row_id", "lent", "made", "day"]
    out = ["\t".join(f"{i}_{c}" for i, c in enumerate(names))]
    for i in range(1, 31):
        out.append("\t".join([str(i), f"vol {i}", str(40 + i), "fine", shelves[i % 6], f"r{i}", "no", "1950", "1950-06-01"]))
    return out


def test_raw_tab_lines_keep_header_and_filter_contains(spark, tmp_path):
    p = tmp_path / "shelves.tsv"
    p.write_text("\n".join(_shelf_lines()) + "\n")
    lines = text_src.read_lines(spark, str(p))
    shelves = lines.select(rows.field("value", 4, "\t").alias("c"))
    counts = {r["c"]: r["n"] for r in agg.count_by_key(shelves, "c").collect()}
    assert counts["4_shelf"] == 1 and sum(counts.values()) == 31
    body = rows.drop_containing(lines, "value", "id")
    assert body.count() == 30
    pages = body.select(rows.field("value", 2, "\t").cast("int").alias("d"))
    bags = agg.group_into_bags(pages.select((F.col("d") % 3).alias("k"), "d"), "k", "d").collect()
    assert sorted(r["n"] for r in bags) == [10, 10, 10]


@pytest.mark.parametrize("sep", ["|", ".", "||", "$"])
def test_separators_are_plain_text(spark, tmp_path, sep):
    p = tmp_path / "rows.txt"
    p.write_text(f"a{sep}1\nb{sep}2\n")
    got = delimited.read_split(spark, str(p), sep, ["a", "b"], ["string", "int"]).orderBy("b").collect()
    assert [tuple(r) for r in got] == [("a", 1), ("b", 2)]
    df = spark.createDataFrame([(f"x{sep}y{sep}x{sep}",)], "s string")
    assert {r["w"]: r["n"] for r in rows.word_count(df, "s", sep).collect()} == {"x": 2, "y": 1, "": 1}
    assert {r["w"]: r["n"] for r in rows.word_count(df, "s", sep, java=True).collect()} == {"x": 2, "y": 1}
    assert df.select(rows.field("s", 1, sep).alias("f")).first()["f"] == "y"


def test_delimited_readers(spark, tmp_path):
    p = tmp_path / "ships.txt"
    p.write_text("ship,harbour,built\nGrey Heron, Lowport ,1987\nLong Tide,\tHighcliff\t,1991\n")
    raw = delimited.read_split(spark, str(p), ",", ["ship", "harbour", "built"])
    assert raw.count() == 3  # the header is a row unless named
    typed = delimited.read_split(spark, str(p), ",", ["ship", "harbour", "built"], ["string", "string", "int"],
                                 header_line="ship,harbour,built")
    assert [r["harbour"] for r in typed.orderBy("built").collect()] == [" Lowport ", "\tHighcliff\t"]
    schema = delimited.read_with_schema(spark, str(p), "ship string, harbour string, built int",
                                        header=True, trim=["harbour"])
    assert [r["harbour"] for r in schema.orderBy("built").collect()] == ["Lowport", "Highcliff"]


def test_text_sinks(spark, tmp_path):
    df = spark.createDataFrame([(c,) for c in ["a", "b", "c", "d", "e", "f", "g"]], "c string").repartition(2)
    out = text_sinks.write_text(df, str(tmp_path / "single"))
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert 1 <= len(parts) <= 2
    assert sorted(r[0] for r in text_src.read_lines(spark, out).collect()) == list("abcdefg")
    multi = text_sinks.write_grouped_text(df, "c", F.lit(1), 3, str(tmp_path / "multi"))
    files = [f for f in os.listdir(multi) if f.startswith("part-")]
    assert len(files) <= 3
    assert sorted(r[0] for r in text_src.read_lines(spark, multi).collect()) == [f"({c},[1])" for c in "abcdefg"]


def test_grouped_text_bounds_lines(spark, tmp_path):
    df = spark.createDataFrame([("k", 1)] * 25 + [("k", 2)] * 3, "k string, v int")
    out = text_sinks.write_grouped_text(df, "k", "v", 2, str(tmp_path / "bounded"), rows_per_block=10)
    lines = [r[0] for r in text_src.read_lines(spark, out).collect()]
    values = [v for line in lines for v in line[len("(k,["):-2].split(", ")]
    assert sorted(values) == ["1"] * 25 + ["2"] * 3
    assert max(len(line[len("(k,["):-2].split(", ")) for line in lines) == 10


def test_partitioned_table_and_pruning(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, kind string")
    path = table_sinks.write_partitioned(df, str(tmp_path / "by_kind"), "kind")
    back = json_src.sql_on_file(spark, "parquet", path, where="kind = 'a'")
    assert sorted(r["id"] for r in back.collect()) == [1, 3]
    assert back.columns == ["id", "kind"]  # partition column moved last
    plan = physical_plan(back)
    assert "PartitionFilters: [isnotnull(kind" in plan and "= a)]" in plan


def test_managed_partitioned_table(spark, tmp_path):
    db = f"db_{os.getpid()}"
    spark.sql(f"create database if not exists {db} location '{tmp_path / 'wh'}'")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, kind string")
    name = f"{db}.orders_by_kind"
    table_sinks.save_partitioned_table(df, name, "kind")
    assert spark.table(name).count() == 2
    assert spark.table(name).columns == ["id", "kind"]
    with pytest.raises(Exception):
        table_sinks.save_partitioned_table(df, name, "kind")  # error if it exists
    spark.sql(f"drop table {name}")


def test_generated_range(spark):
    base = spark.createDataFrame([(5,), (9,)], "k long")
    assert [r["id"] for r in generated.range_over(base, "k", 2).collect()] == [5, 6, 7, 8, 9]


def test_login_documents_as_json_lines(spark, tmp_path):
    from batchkit.sinks.json import write_json, write_json_text

    df = spark.createDataFrame([("u1", "BJ", "2024-01-01"), ("u2", "SH", "2024-01-01")], "u string, p string, dt string")
    docs = biz.login_rollup(df, "dt", "p", "u")
    path = write_json_text(docs, "j", str(tmp_path / "docs"))
    back = json_src.read_json(spark, path).collect()
    assert len(back) == 1 and back[0]["dt"] == "2024-01-01"
    assert [(p["province"], list(p["user_list"])) for p in back[0]["provinces"]] == [("BJ", ["u1"]), ("SH", ["u2"])]
    rows_path = write_json(df, str(tmp_path / "rows"))
    assert json_src.read_json(spark, rows_path).count() == 2


def test_job_entry_point(spark, tmp_path, capsys):
    from batchkit.__main__ import main, run

    assert main(["--list"]) == 0
    assert "event_rate *" in capsys.readouterr().out
    out = run(spark, "event_rate", "/root/testdata/sf0.001", str(tmp_path / "rate"))
    assert spark.read.parquet(out).count() > 0
    with pytest.raises(KeyError):
        run(spark, "nope", "/root/testdata/sf0.001", str(tmp_path / "x"))


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    from batchkit.session import table as load
    from batchkit.sinks.tables import save_bucketed_table

    db = f"bk_{os.getpid()}"
    spark.sql(f"create database if not exists {db} location '{tmp_path / 'bk'}'")
    li = load(spark, "/root/testdata/sf0.001", "lineitem").select("l_orderkey", "l_quantity")
    od = load(spark, "/root/testdata/sf0.001", "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    save_bucketed_table(li, f"{db}.li_b", "l_orderkey", 8)
    save_bucketed_table(od, f"{db}.od_b", "l_orderkey", 8)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(f"{db}.li_b").join(spark.table(f"{db}.od_b"), "l_orderkey")
        plan = physical_plan(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == li.join(od, "l_orderkey").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_split_reader_short_rows_are_null(spark, tmp_path):
    p = tmp_path / "short.txt"
    p.write_text("a,1,x\nb\n")
    df = delimited.read_split(spark, str(p), ",", ["k", "n", "s"], ["string", "int", "string"])
    assert sorted(tuple(r) for r in df.collect()) == [("a", 1, "x"), ("b", None, None)]


def test_jdbc_option_sets_without_a_database():
    from batchkit.sources.jdbc import bounds_query, jdbc_options

    plain = jdbc_options("jdbc:x://h/db", "orders", {"user": "u", "password": "p", "driver": "D"})
    assert plain == {"user": "u", "password": "p", "driver": "D", "url": "jdbc:x://h/db", "dbtable": "orders"}
    part = jdbc_options("jdbc:x://h/db", "orders", None, "id", 0, 14999, 4, fetch_size=1000, query_timeout=30)
    assert part["partitionColumn"] == "id" and part["lowerBound"] == "0" and part["upperBound"] == "14999"
    assert part["numPartitions"] == "4" and part["fetchsize"] == "1000" and part["queryTimeout"] == "30"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x://h/db", "orders", None, "id", 0, None, 4)
    assert bounds_query("orders", "id") == "(select min(id) lo, max(id) hi from orders) q"


def test_indexed_header_reader(spark, tmp_path):
    p = tmp_path / "shelves_typed.tsv"
    p.write_text("\n".join(_shelf_lines()) + "\n")
    df = delimited.read_indexed_header(spark, str(p), types={"key": "int", "pages": "int", "made": "bigint"})
    assert df.columns[:3] == ["key", "title", "pages"] and df.columns[-1] == "day"
    assert df.count() == 30 and dict(df.dtypes)["pages"] == "int"
    counts = {r["shelf"]: r["n"] for r in agg.count_by_key(df, "shelf").collect()}
    assert "4_shelf" not in counts and sum(counts.values()) == 30
