"""The five business operators: documented values and edge cases."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from batchkit.functions.registry import event_rate_sql, int_average_sql, register_all
from batchkit.operators import business as biz
from batchkit.plans.inspect import physical_plan


# ----------------------------------------------------------------------------- event_rate
def _events(spark, rows):
    return spark.createDataFrame(rows, "g int, e string")


def test_event_rate_whole(spark):
    df = _events(spark, [(1, e) for e in ["open", "open", "buy", "open", "skip", "buy", "open", "buy"]])
    r = df.groupBy("g").agg(biz.event_rate("e", "buy", "open").alias("r")).first()["r"]
    assert r == pytest.approx(0.75, abs=1e-6)


def test_event_rate_two_partials_merge(spark):
    # rows of one group in two partitions, merged after the shuffle
    df = _events(spark, [(1, e) for e in ["open", "buy", "open", "skip", "open"]]).repartition(2)
    plan = df.groupBy("g").agg(biz.event_rate("e", "buy", "open").alias("r"))
    assert plan.first()["r"] == pytest.approx(1 / 3, abs=1e-6)


def test_event_rate_nulls_equal_names_and_empty(spark):
    df = _events(spark, [(1, "view"), (1, "pay"), (1, None), (1, "view"), (2, "pay")])
    out = {r["g"]: r["r"] for r in df.groupBy("g").agg(biz.event_rate("e", "pay", "view").alias("r")).collect()}
    assert out[1] == pytest.approx(0.5)
    assert out[2] is None  # no denominator rows
    same = df.groupBy("g").agg(biz.event_rate("e", "view", "view").alias("r")).where("g = 1").first()["r"]
    assert same == 1.0


def test_event_rate_per_row_names(spark):
    df = spark.createDataFrame([("a", "a", "b"), ("b", "a", "b"), ("b", "a", None), ("a", None, "b")],
                               "e string, n string, d string")
    # rows with a null name do not count at all
    assert df.agg(biz.event_rate("e", F.col("n"), F.col("d")).alias("r")).first()["r"] == 1.0


def test_event_rate_type_checks(spark):
    df = spark.createDataFrame([(1, 2)], "g int, e int")
    with pytest.raises(TypeError):
        biz.event_rate_by(df, ["g"], "e", "pay", "view")
    with pytest.raises(TypeError):
        biz.event_rate_by(_events(spark, [(1, "x")]), ["g"], "e", 1, "view")
    with pytest.raises(ValueError):
        biz.event_rate_by(_events(spark, [(1, "x")]), ["g"], "nope", "pay", "view")
    text = _events(spark, [(1, "x")])
    for args in ((F.col("g"), "pay", "view"), ("e", F.col("g"), "view"), ("e", "pay", F.lit(1)), (F.col("e"), "pay", F.col("g"))):
        with pytest.raises(TypeError):  # Columns are resolved before anything runs
            biz.event_rate_by(text, ["g"], *args)
    assert biz.event_rate_by(text, ["g"], F.upper("e"), F.lit("X"), F.col("e")).columns == ["g", "event_rate"]


def test_event_rate_sql_text(spark):
    rows = [(7, e) for e in ("open", "skip", "open", "buy", "open", "buy", "open", "open")]
    _events(spark, rows).createOrReplaceTempView("ev_t")
    rate = lambda over: event_rate_sql("e", "'buy'", f"'{over}'")
    q = f"select g, {rate('open')} r from ev_t group by g"
    assert spark.sql(q).first()["r"] == pytest.approx(0.4)
    assert "partial_count" in physical_plan(spark.sql(q))
    assert spark.sql(f"select {rate('never')} r from ev_t").first()["r"] is None


# ------------------------------------------------------------------------- int_to_percent
@pytest.mark.parametrize("n,d,expected", [
    (3, 12, "25%"), (1, 200, "0%"), (3, 200, "2%"), (-3, 200, "-2%"), (-1, 999, "0%"), (7, 0, None), (None, 9, None),
    (81, 3, "2700%"), (4, 7, "57%"), (5, 11, "45%"), (9, 16, "56%"),
])
def test_int_to_percent_values(spark, n, d, expected):
    df = spark.createDataFrame([(n, d)], "n int, d int")
    assert df.select(biz.int_to_percent("n", "d").alias("p")).first()["p"] == expected


def test_int_to_percent_checks(spark):
    df = spark.createDataFrame([("7", 20, 7)], "s string, d int, n int")
    with pytest.raises(TypeError):
        biz.int_to_percent_checked(df, "s", "d")
    assert df.select(biz.int_to_percent_checked(df, "n", "d").alias("p")).first()["p"] == "35%"


def test_int_to_percent_sql(spark):
    register_all(spark)
    assert spark.sql("select int_to_percent(13, 20) p").first()["p"] == "65%"
    with pytest.raises(PySparkException):
        spark.sql("select int_to_percent(1) p").collect()


# ---------------------------------------------------------------------- item_list_explode
def _items(spark, s):
    return spark.createDataFrame([(1, s)], "id int, item_list string")


def test_item_list_two_items(spark):
    out = biz.explode_item_list(_items(spark, "pen7:4:120,cup9:3:85"), "item_list", keep=["id"])
    assert out.columns == ["id", "sku_id", "qty", "price"]
    assert [tuple(r)[1:] for r in out.collect()] == [("pen7", 4, 120), ("cup9", 3, 85)]


@pytest.mark.parametrize("text,expected", [
    ("a:1:2:", [("a", 1, 2)]),           # Java drops the trailing empty part
    (":1:2", [("", 1, 2)]),              # leading empty sku kept
    ("\ta:1:2\t, b :3: 4 ", [("a", 1, 2), ("b", 3, 4)]),  # Java trim, tabs included
    ("a:1:2,,  ,b:3:4", [("a", 1, 2), ("b", 3, 4)]),      # blank items skipped
    ("   ", []), (None, []),             # blank / null list gives no rows
    ("x:+5:-7", [("x", 5, -7)]),
])
def test_item_list_edges(spark, text, expected):
    out = biz.explode_item_list(_items(spark, text), "item_list", keep=[])
    assert [tuple(r) for r in out.collect()] == expected


@pytest.mark.parametrize("text,msg", [
    ("a:1", "Invalid item_list fragment: a:1"),
    ("a:x:2", "Invalid qty value in item_list fragment: a:x:2"),
    ("a::2", "Invalid qty value in item_list fragment: a::2"),
    ("a:1:2:3", "Invalid item_list fragment: a:1:2:3"),
    ("a:1:99999999999", "Invalid price value in item_list fragment: a:1:99999999999"),
])
def test_item_list_errors_survive_pruning(spark, text, msg):
    out = biz.explode_item_list(_items(spark, text), "item_list", keep=["id"])
    for action in (lambda d: d.collect(), lambda d: d.select("sku_id").collect(), lambda d: d.count(),
                   lambda d: d.groupBy().count().collect(), lambda d: d.limit(1).collect()):
        with pytest.raises(PySparkException, match=msg.replace("+", r"\+")):
            action(out)
    assert biz.explode_item_list(_items(spark, text), "item_list", on_error="drop").count() == 0


def test_item_list_type_check(spark):
    with pytest.raises(TypeError):
        biz.explode_item_list(spark.createDataFrame([(1,)], "item_list int"), "item_list")
    with pytest.raises(ValueError):
        biz.parse_item_list("item_list", on_error="ignore")


def test_item_list_sql_table_function(spark):
    register_all(spark)
    spark.createDataFrame([(1, "pen7:4:120,cup9:3:85"), (2, " a:1:2: ,, \t:3:4\t"), (3, None)],
                          "id int, s string").createOrReplaceTempView("il_t")
    got = [tuple(r) for r in spark.sql("select t.id, f.* from il_t t, lateral item_list_explode(t.s) f").collect()]
    assert got == [(1, "pen7", 4, 120), (1, "cup9", 3, 85), (2, "a", 1, 2), (2, "", 3, 4)]
    with pytest.raises(PySparkException):
        spark.sql("select * from item_list_explode()").collect()  # wrong argument count
    spark.createDataFrame([(1, "a:1")], "id int, s string").createOrReplaceTempView("il_bad")
    with pytest.raises(PySparkException, match="Invalid item_list fragment: a:1"):
        spark.sql("select count(*) from il_bad t, lateral item_list_explode(t.s) f").collect()


# --------------------------------------------------------------------------- login_rollup
LOGINS = [  # user_id, province, dt
    ("u1", "BJ", "2024-01-01"), ("u2", "BJ", "2024-01-01"), ("u1", "BJ", "2024-01-01"),
    ("u3", "SH", "2024-01-01"), ("u1", "SH", "2024-01-02"),
]


def test_login_rollup_one_document_per_day(spark):
    df = spark.createDataFrame(LOGINS, "user_id string, province string, dt string")
    out = {r["dt"]: r["j"] for r in biz.login_rollup(df, "dt", "province", "user_id").collect()}
    assert out == {
        "2024-01-01": '{"dt":"2024-01-01","provinces":[{"province":"BJ","user_list":["u1","u2"]},'
                      '{"province":"SH","user_list":["u3"]}]}',
        "2024-01-02": '{"dt":"2024-01-02","provinces":[{"province":"SH","user_list":["u1"]}]}',
    }


def test_login_rollup_blocks_union_to_the_day(spark):
    import json

    df = spark.createDataFrame(LOGINS, "user_id string, province string, dt string")
    merged = {}
    for r in biz.login_rollup(df, "dt", "province", "user_id", entries_per_block=2).collect():
        for p in json.loads(r["j"])["provinces"]:
            merged.setdefault((r["dt"], p["province"]), set()).update(p["user_list"])
    assert merged == {("2024-01-01", "BJ"): {"u1", "u2"}, ("2024-01-01", "SH"): {"u3"},
                      ("2024-01-02", "SH"): {"u1"}}


def test_login_rollup_ignores_null_users(spark):
    df = spark.createDataFrame(LOGINS + [(None, "BJ", "2024-01-01")], "user_id string, province string, dt string")
    got = {r["dt"]: r["j"] for r in biz.login_rollup(df, "dt", "province", "user_id").collect()}
    assert '"user_list":["u1","u2"]' in got["2024-01-01"] and len(got) == 2


def test_login_rollup_blocks_by_rank(spark):
    import json

    small = spark.createDataFrame(LOGINS, "user_id string, province string, dt string")
    docs = biz.login_rollup(small, "dt", "province", "user_id").collect()
    assert {r["block"] for r in docs} == {0} and len(docs) == 2  # small days: one document each
    big = spark.range(5000).select(F.lit("2024-01-01").alias("dt"), F.lit("BJ").alias("p"),
                                   F.col("id").cast("string").alias("u"))
    docs = biz.login_rollup(big, "dt", "p", "u", entries_per_block=1000).collect()
    sizes = [len(json.loads(d["j"])["provinces"][0]["user_list"]) for d in docs]
    assert sorted(d["block"] for d in docs) == [0, 1, 2, 3, 4] and sizes == [1000] * 5


def _login_line(user, province, day):
    """Ten tab-separated fields, of which only positions 0, 3 and 9 are read."""
    fields = [f"f{i}" for i in range(10)]
    fields[0], fields[3], fields[9] = user, province, day
    return "\t".join(fields)


def test_login_rows_from_tab_lines(spark):
    lines = [_login_line("who", "where", "when")] + [_login_line(*x) for x in [
        ("u77", "north", "1999-12-31"), ("u12", "north", "1999-12-31"), ("u77", "north", "1999-12-31"), ("u5", "coast", "1999-12-31")]]
    parsed = biz.parse_login_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    docs = {r["dt"]: r["j"] for r in biz.login_rollup(parsed, "dt", "province", "user").collect()}
    assert docs["1999-12-31"] == ('{"dt":"1999-12-31","provinces":[{"province":"coast","user_list":["u5"]},'
                                  '{"province":"north","user_list":["u12","u77"]}]}')
    assert "when" in docs  # no header skip: a header line is data


def test_login_rows_short_row(spark):
    empty_day = _login_line("u1", "north", "")
    lines = spark.createDataFrame([("u1\tx\ty\tnorth",), (empty_day,)], "value string")
    with pytest.raises(PySparkException, match="Invalid login row"):
        biz.parse_login_lines(lines).count()
    assert biz.parse_login_lines(lines, on_error="drop").count() == 0  # trailing empty field is dropped too


# ---------------------------------------------------------------------------- int_average
@pytest.mark.parametrize("values,expected", [([1, 2], 1.0), ([-1, -2], -1.0), ([], None),
                                             ([100, 250, 71, 83], 126.0), ([-3], -3.0)])
def test_int_average(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    assert df.agg(biz.int_average("v").alias("a")).first()["a"] == expected


def test_int_average_exact_and_sql(spark):
    df = spark.createDataFrame([(1,), (2,)], "v bigint")
    assert df.agg(biz.int_average("v", exact=True).alias("a")).first()["a"] == 1.5
    df.createOrReplaceTempView("avg_t")
    assert spark.sql(f"select {int_average_sql('v')} a from avg_t").first()["a"] == 1.0


def test_sums_beyond_the_long_range_agree(spark):
    from batchkit.operators import aggregates as agg

    df = spark.createDataFrame([("a", 1 << 62)] * 3, "k string, v bigint")
    df.createOrReplaceTempView("big_t")
    mean = float(1 << 62)
    assert df.agg(biz.int_average("v").alias("a")).first()["a"] == mean
    assert spark.sql(f"select {int_average_sql('v')} a from big_t").first()["a"] == mean
    assert int(agg.reduce_pair(df, "k", "v").first()["v"]) == 3 << 62
