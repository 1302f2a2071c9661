"""Every operator as a named query over the driver tables, with an ANSI-SQL oracle.

``QUERIES[key](spark, sf_dir)`` returns a DataFrame built from the library's
operators; ``ORACLE[key]`` is SQL that an independent engine (DuckDB) runs on
the same parquet tables.  Keys without an oracle have results that depend on
layout or randomness and are covered by property tests instead.
Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

import textwrap
import uuid
from typing import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from batchkit.functions.registry import event_rate_sql, int_average_sql, register_all
from batchkit.functions.text import day_key
from batchkit.operators import aggregates as agg
from batchkit.operators import business as biz
from batchkit.operators import folds, joins, nested, partitions, rows, sampling, sets, sorting
from batchkit.session import scratch_database, shared_dir, table
from batchkit.sinks import tables as table_sinks
from batchkit.sinks import text as text_sinks
from batchkit.sinks.views import create_view
from batchkit.sources import delimited, generated, json as json_src, text as text_src

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = textwrap.dedent(oracle).strip()
        return fn
    return deco


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


# ============================================================ business operators
@query("event_rate", """
    select substr(cast(ts as varchar), 1, 10) dt,
           count(*) filter (where event_type = 'purchase')
             / nullif(count(*) filter (where event_type = 'view'), 0) r
    from events group by 1""")
def q_event_rate(spark, sf):
    ev = table(spark, sf, "events")
    daily = ev.groupBy(day_key(ev, "ts").alias("dt")).agg(biz.event_rate("event_type", "purchase", "view").alias("r"))
    return daily.select(F.col("dt").cast("string").alias("dt"), "r")


@query("event_rate_sql", ORACLE["event_rate"])
def q_event_rate_sql(spark, sf):
    view = create_view(table(spark, sf, "events"), _name("events"))
    rate = event_rate_sql("event_type", "'purchase'", "'view'")
    return spark.sql(f"select cast(to_date(ts) as string) dt, {rate} r from {view} group by to_date(ts)")


@query("event_rate_null", """
    select substr(cast(ts as varchar), 1, 10) dt, user_id, count(*) filter (where event_type = 'purchase')
             / nullif(count(*) filter (where event_type = 'signup'), 0) r
    from events group by 1, 2""")
def q_event_rate_null(spark, sf):
    # Few users sign up on a given day: most (day, user) groups lack the denominator and are null.
    ev = table(spark, sf, "events")
    ev = ev.withColumn("dt", day_key(ev, "ts"))
    out = biz.event_rate_by(ev, ["dt", "user_id"], "event_type", "purchase", "signup", name="r")
    return out.withColumn("dt", F.col("dt").cast("string"))


@query("event_rate_by_user_day", """
    select substr(cast(ts as varchar), 1, 10) dt, user_id,
           count(*) filter (where event_type = 'purchase')
             / nullif(count(*) filter (where event_type = 'click'), 0) r
    from events group by 1, 2""")
def q_event_rate_user_day(spark, sf):
    ev = table(spark, sf, "events")
    out = ev.groupBy(day_key(ev, "ts").alias("dt"), "user_id").agg(
        biz.event_rate("event_type", "purchase", "click").alias("r"))
    return out.select(F.col("dt").cast("string").alias("dt"), "user_id", "r")


@query("int_average", """
    select l_returnflag, cast(sum(l_partkey) // count(l_partkey) as double) a
    from lineitem group by 1""")
def q_int_average(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(biz.int_average("l_partkey").alias("a"))


@query("int_average_sql", ORACLE["int_average"])
def q_int_average_sql(spark, sf):
    view = create_view(table(spark, sf, "lineitem"), _name("lineitem"))
    return spark.sql(f"select l_returnflag, {int_average_sql('l_partkey')} a from {view} group by l_returnflag")


@query("int_to_percent", """
    select c_nationkey,
           concat(cast(cast(round_even(cast(count(*) filter (where c_mktsegment = 'BUILDING') as double)
                  / count(*) * 100, 0) as bigint) as varchar), '%') p
    from customer group by 1""")
def q_int_to_percent(spark, sf):
    cu = table(spark, sf, "customer")
    return cu.groupBy("c_nationkey").agg(
        biz.int_to_percent(F.count_if(F.col("c_mktsegment") == "BUILDING"), F.count(F.lit(1))).alias("p"))


@query("int_to_percent_rational", """
    select p_partkey, concat(cast(cast(round_even(cast(p_size as double) / 40 * 100, 0) as bigint) as varchar), '%') p
    from part""")
def q_int_to_percent_rational(spark, sf):
    parts = table(spark, sf, "part").withColumn("d", F.lit(40))
    return parts.select("p_partkey", biz.int_to_percent_checked(parts, "p_size", "d").alias("p"))


@query("int_to_percent_sql", """
    select p_partkey, concat(cast(cast(round_even(cast(p_size as double) / 40 * 100, 0) as bigint) as varchar), '%') p
    from part""")
def q_int_to_percent_sql(spark, sf):
    # The scalar function called by its SQL name.
    register_all(spark)
    view = create_view(table(spark, sf, "part"), _name("part"))
    return spark.sql(f"select p_partkey, int_to_percent(p_size, 40) p from {view}")


def _item_text():
    """``sku<partkey>:<qty>:<price>`` for one line item."""
    return F.concat(F.lit("sku"), F.lpad(F.col("l_partkey").cast("string"), 10, "0"), F.lit(":"),
                    F.col("l_quantity").cast("int").cast("string"), F.lit(":"),
                    F.floor("l_extendedprice").cast("int").cast("string"))


def _item_lists(spark, sf) -> DataFrame:
    """Item lists as an upstream table holds them: one ``sku:qty:price,...`` text per
    order, built from lineitem (in blocks of at most 64 lines, so even a huge order
    never becomes one unbounded string or one task's work)."""
    li = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.call_function("div", F.col("l_linenumber"), F.lit(64)).alias("blk"),
        "l_partkey", "l_quantity", "l_extendedprice")
    # collect_list keeps every element, so a map-side partial aggregate saves nothing:
    # shuffle the compact numeric columns once on the full group key, then format the
    # item text and aggregate after the shuffle, at full parallelism.
    return (li.repartition("k", "blk").groupBy("k", "blk")
            .agg(F.array_join(F.sort_array(F.collect_list(_item_text())), ",").alias("item_list")))


@query("item_list_explode", """
    select l_orderkey k, concat('sku', lpad(cast(l_partkey as varchar), 10, '0')) sku_id,
           cast(l_quantity as int) qty, cast(floor(l_extendedprice) as int) price
    from lineitem""")
def q_item_list_explode(spark, sf):
    return biz.explode_item_list(_item_lists(spark, sf), "item_list", keep=["k"])


@query("item_list_explode_sql", """
    select l_orderkey k, concat('sku', lpad(cast(l_partkey as varchar), 10, '0')) sku_id,
           cast(l_quantity as int) qty, cast(floor(l_extendedprice) as int) price
    from lineitem""")
def q_item_list_explode_sql(spark, sf):
    register_all(spark)
    view = create_view(_item_lists(spark, sf), _name("item_lists"))
    return spark.sql(f"select t.k, f.sku_id, f.qty, f.price from {view} t, lateral item_list_explode(t.item_list) f")


_ROLLUP_ORACLE = """
    with entries as (select distinct substr(cast(ts as varchar), 1, 10) dt, event_type province,
                            cast(user_id as varchar) u from events where user_id is not null),
    ranked as (select *, (row_number() over (partition by dt order by province, u) - 1) // {per} block from entries),
    lists as (select dt, block, province, list(u order by u) user_list from ranked group by 1, 2, 3)
    select dt, block, cast(to_json({{'dt': dt, 'provinces': list({{'province': province, 'user_list': user_list}}
                                   order by province)}}) as varchar) j
    from lists group by dt, block"""
ROLLUP_ENTRIES = 64


@query("login_rollup", _ROLLUP_ORACLE.format(per=ROLLUP_ENTRIES))
def q_login_rollup(spark, sf):
    ev = table(spark, sf, "events")
    return biz.login_rollup(ev, day_key(ev, "ts"), "event_type", "user_id", entries_per_block=ROLLUP_ENTRIES)


@query("login_rollup_daily", _ROLLUP_ORACLE.format(per=biz.ENTRIES_PER_BLOCK))
def q_login_rollup_daily(spark, sf):
    # Documents of the default size: a day is the one document of block 0 until it has more entries.
    ev = table(spark, sf, "events")
    return biz.login_rollup(ev, day_key(ev, "ts"), "event_type", "user_id")


@query("login_rollup_tsv", ORACLE["login_rollup"])
def q_login_rollup_tsv(spark, sf):
    # Login rows as an upstream job emits them: tab-separated text, user in field 0,
    # province in field 3, day in field 9; written, read back as lines, parsed.
    ev = table(spark, sf, "events")
    ts = F.col("ts").cast("string")
    fields = [F.col("user_id").cast("string"), F.col("event_id").cast("string"),
              F.concat(F.lit("user"), F.col("user_id").cast("string")), F.col("event_type"), F.lit("0"), F.lit("0"),
              ts, ts, F.date_format("ts", "yyyyMMdd"), F.substring(ts, 1, 10)]
    path = text_sinks.write_text(ev.select(F.concat_ws("\t", *fields)), shared_dir(spark, "login_rows"))
    rows_ = biz.parse_login_lines(text_src.read_lines(spark, path))
    return biz.login_rollup(rows_, "dt", "province", "user", entries_per_block=ROLLUP_ENTRIES)


# ============================================================ aggregations
@query("order_daily_total", """
    select dt, sum(order_amount) total
    from (select substr(cast(o_orderdate as varchar), 1, 10) dt, o_orderkey,
                 sum(cast(l_quantity * l_extendedprice as decimal(18, 2))) order_amount
          from orders join lineitem on o_orderkey = l_orderkey group by 1, 2)
    group by dt""")
def q_order_daily_total(spark, sf):
    li = table(spark, sf, "lineitem")
    amount = (F.col("l_quantity") * F.col("l_extendedprice")).cast("decimal(18,2)")
    # Aggregate lineitem to one row per order *before* the join (partial aggregation
    # shrinks the big side), join the order's day, then the small per-day sum.
    # The big per-order sum adds exact cents as longs: a decimal(18,2) sum needs a
    # decimal(28,2) buffer, which is not long-backed (ANSI raises on overflow).
    cents = (amount * F.lit(100)).cast("bigint")
    per_order = li.groupBy("l_orderkey").agg(F.sum(cents).alias("order_cents"))
    orders = table(spark, sf, "orders")
    orders = orders.select("o_orderkey", day_key(orders, "o_orderdate").alias("dt"))
    joined = per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
    daily = joined.groupBy("dt").agg(F.sum(F.col("order_cents").cast("decimal(38,0)")).alias("cents"))
    total = (F.col("cents") / F.lit(100)).cast("decimal(38,2)")
    return daily.select(F.col("dt").cast("string").alias("dt"), total.alias("total"))


@query("order_daily_total_sql", ORACLE["order_daily_total"])
def q_order_daily_total_sql(spark, sf):
    # The same two-level roll-up as SQL over temp views.  Catalyst does not push an
    # aggregate below a join, so the SQL aggregates lineitem per order first itself
    # (the big side shrinks before the join), then sums per day.
    o = create_view(table(spark, sf, "orders"), _name("orders"))
    li = create_view(table(spark, sf, "lineitem"), _name("lineitem"))
    return spark.sql(f"""
        with per_order as (
            select l_orderkey, sum(cast(l_quantity * l_extendedprice as decimal(18, 2))) order_amount
            from {li} group by l_orderkey)
        select cast(to_date(o_orderdate) as string) dt, sum(order_amount) total
        from per_order join {o} on o_orderkey = l_orderkey
        group by to_date(o_orderdate)""")


@query("reduce_sum", "select cast(sum(l_linenumber) as bigint) total from lineitem")
def q_reduce_sum(spark, sf):
    return agg.reduce_all(table(spark, sf, "lineitem"), "l_linenumber", "total")


@query("reduce_pair", "select min(o_orderpriority) k, cast(sum(o_orderkey) as decimal(38, 0)) v from orders")
def q_reduce_pair(spark, sf):
    return agg.reduce_pair(table(spark, sf, "orders"), "o_orderpriority", "o_orderkey")


@query("count_rows", "select count(*) n from lineitem")
def q_count_rows(spark, sf):
    return agg.count_rows(table(spark, sf, "lineitem"))


@query("count_by_key", "select l_returnflag k, count(*) n from lineitem group by 1")
def q_count_by_key(spark, sf):
    return agg.count_by_key(table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("k")), "k")


@query("reduce_by_key", "select l_returnflag k, cast(sum(l_linenumber) as bigint) v from lineitem group by 1")
def q_reduce_by_key(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("k"), "l_linenumber")
    return agg.reduce_by_key(li, "k", "l_linenumber")


@query("aggregate_by_key", """
    select l_returnflag, l_linestatus, count(*) n, cast(sum(l_linenumber) as bigint) s
    from lineitem group by 1, 2""")
def q_aggregate_by_key(spark, sf):
    return agg.aggregate_by_key(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"],
                                F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("s"))


_PRICE_EDGES = list(range(0, 100_001, 10_000))


@query("fold_histogram", """
    with b as (select l_returnflag, l_linestatus, len(list_filter(range(0, 100001, 10000), lambda e: e <= l_extendedprice)) bucket from lineitem),
    g as (select distinct l_returnflag, l_linestatus from lineitem)
    select g.l_returnflag, g.l_linestatus, cast(i.bucket as integer) bucket, count(b.bucket) n
    from g cross join (select unnest(range(12)) bucket) i
    left join b on b.l_returnflag = g.l_returnflag and b.l_linestatus = g.l_linestatus and b.bucket = i.bucket
    group by 1, 2, 3""")
def q_fold_histogram(spark, sf):
    # aggregateByKey with a state of its own: price histograms, merged bucket by bucket.
    li = table(spark, sf, "lineitem")
    held = folds.fold_by_key(li, ["l_returnflag", "l_linestatus"], "l_extendedprice", folds.histogram(_PRICE_EDGES), "h")
    return held.select("l_returnflag", "l_linestatus", F.posexplode("h").alias("bucket", "n"))


@query("fold_event_rate", ORACLE["event_rate_null"])
def q_fold_event_rate(spark, sf):
    # The rate as a fold with numerator and denominator counts as its state; many small groups.
    ev = table(spark, sf, "events")
    out = folds.fold_by_key(ev, [day_key(ev, "ts").alias("dt"), "user_id"], ["event_type", F.lit("purchase"), F.lit("signup")], folds.event_rate_fold(), "r")
    return out.withColumn("dt", F.col("dt").cast("string"))


@query("fold_int_average_sql", ORACLE["int_average"])
def q_fold_int_average_sql(spark, sf):
    # A user-defined aggregate by its SQL names: states in each task, then the aggregate over states.
    folds.register_fold(spark, "int_mean", folds.int_mean_fold(), keys="l_returnflag string")
    view = create_view(table(spark, sf, "lineitem"), _name("lineitem"))
    return spark.sql(f"""select l_returnflag, int_mean(state) a
                         from int_mean_states(table(select l_returnflag, l_partkey from {view})) group by l_returnflag""")


@query("key_bounds", "select min(o_orderkey) lo, max(o_orderkey) hi from orders")
def q_key_bounds(spark, sf):
    return agg.key_bounds(table(spark, sf, "orders"), "o_orderkey")


@query("distinct_values", "select distinct o_orderstatus v from orders")
def q_distinct_values(spark, sf):
    return agg.distinct_values(table(spark, sf, "orders"), "o_orderstatus")


_BAGS_ORACLE = """
    with ranked as (select {key} k, {value} v, (row_number() over (partition by {key} order by {value}) - 1) // {per} block from {table})
    select k, block, count(*) n, string_agg(cast(v as varchar), ',' order by v) vals from ranked group by 1, 2"""


@query("group_mod3", _BAGS_ORACLE.format(key="p_size % 3", value="p_partkey", per=500, table="part"))
def q_group_mod3(spark, sf):
    pa_ = table(spark, sf, "part")
    return agg.group_into_bags(pa_.select((F.col("p_size") % 3).alias("k"), "p_partkey"), "k", "p_partkey", rows_per_block=500)


@query("group_mod3_auto", _BAGS_ORACLE.format(key="p_size % 3", value="p_partkey", per=agg.ROWS_PER_BLOCK, table="part"))
def q_group_mod3_auto(spark, sf):
    # Blocks of the default size.
    pa_ = table(spark, sf, "part")
    return agg.group_into_bags(pa_.select((F.col("p_size") % 3).alias("k"), "p_partkey"), "k", "p_partkey")


@query("group_by_key", _BAGS_ORACLE.format(key="c_nationkey", value="c_mktsegment", per=25, table="customer"))
def q_group_by_key(spark, sf):
    # Five segments repeat within each key: a block may begin and end inside one value's copies.
    cu = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), "c_mktsegment")
    return agg.group_into_bags(cu, "k", "c_mktsegment", rows_per_block=25)


@query("word_count", """
    select w, count(*) n from (select unnest(string_split(p_name, ' ')) w from part) group by w""")
def q_word_count(spark, sf):
    return rows.word_count(table(spark, sf, "part"), "p_name", " ")


@query("text_total_length", """
    select cast(sum(length(line)) as bigint) total_length
    from (select unnest(string_split(text, chr(10))) line from documents)""")
def q_text_total_length(spark, sf):
    lines = rows.lines(table(spark, sf, "documents"), "text")
    return lines.agg(F.sum(F.length("line")).alias("total_length"))


@query("text_file_lines", r"""
    select count(*) n_lines, cast(sum(length(line)) as bigint) total_length
    from (select unnest(regexp_split_to_array(text, '\r\n|\r|\n')) line from documents where text is not null)""")
def q_text_file_lines(spark, sf):
    # Whole document texts written as text files, then scanned line by line as a
    # text source does (a line ends at \n, \r\n or \r).
    docs = table(spark, sf, "documents").where(F.col("text").isNotNull())
    path = text_sinks.write_text(docs.select("text"), shared_dir(spark, "documents_txt"))
    lines = text_src.read_lines(spark, path)
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("total_length"))


@query("observe_sum", "select cast(sum(l_linenumber) as bigint) s, count(*) rows from lineitem")
def q_observe_sum(spark, sf):
    observed, obs = agg.observe_sum(table(spark, sf, "lineitem"), "l_linenumber", "s")
    return agg.metric_frame(observed, obs, "s bigint, rows bigint")


# ============================================================ rows, filters, projections
@query("map_increment", "select l_orderkey, l_linenumber, cast(l_quantity as int) + 1 v from lineitem")
def q_map_increment(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", rows.increment("l_quantity").alias("v"))


@query("typed_map_increment", "select o_orderkey + 1 as value from orders")
def q_typed_map_increment(spark, sf):
    return table(spark, sf, "orders").select(rows.increment("o_orderkey", cast=None).alias("value"))


@query("line_filter_contains", "select doc_id from documents where not contains(text, 'id')")
def q_line_filter_contains(spark, sf):
    return rows.drop_containing(table(spark, sf, "documents"), "text", "id").select("doc_id")


@query("flatmap_fields", "select doc_id, unnest([lang, source]) v from documents")
def q_flatmap_fields(spark, sf):
    return rows.flat_fields(table(spark, sf, "documents"), ["doc_id"], ["lang", "source"])


@query("like_prefix", "select concat('name: ', p_name) as value from part where p_name like '%ring%'")
def q_like_prefix(spark, sf):
    pa_ = table(spark, sf, "part")
    return pa_.where(F.col("p_name").like("%ring%")).select(rows.prefixed("p_name", "name: ").alias("value"))


@query("filter_gt", "select o_orderkey id from orders where o_orderkey > 100")
def q_filter_gt(spark, sf):
    register_all(spark)
    # The registered SQL function is inlined, so the predicate still reaches the scan.
    return table(spark, sf, "orders").where(F.expr("filter_gt(o_orderkey)")).select(F.col("o_orderkey").alias("id"))


@query("in_list", """
    select c_custkey, c_mktsegment from customer where c_mktsegment in ('BUILDING', 'MACHINERY')""")
def q_in_list(spark, sf):
    cu = table(spark, sf, "customer")
    return cu.where(joins.in_list("c_mktsegment", ["BUILDING", "MACHINERY"])).select("c_custkey", "c_mktsegment")


@query("view_not_null", "select event_id, props from events where props is not null")
def q_view_not_null(spark, sf):
    view = create_view(table(spark, sf, "events"), _name("events"))
    return spark.sql(f"select event_id, props from {view} where props is not null")


@query("global_view", "select c_custkey, c_name from customer")
def q_global_view(spark, sf):
    view = create_view(table(spark, sf, "customer"), _name("customers"), global_scope=True)
    return spark.sql(f"select c_custkey, c_name from {view}")


@query("select_nested", "select c_name as name, c_nationkey as nation from customer")
def q_select_nested(spark, sf):
    cu = table(spark, sf, "customer").select(
        F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).alias("member"))
    return cu.select("member.name", "member.nation")


@query("explode_array", "select unnest([c_custkey, cast(c_nationkey as bigint)]) v from customer")
def q_explode_array(spark, sf):
    view = create_view(table(spark, sf, "customer"), _name("customers"))
    return spark.sql(f"select v from {view} lateral view explode(array(c_custkey, cast(c_nationkey as bigint))) t as v")


@query("nested_explode", """
    select r_name, n_name, c_custkey as power
    from region join nation on r_regionkey = n_regionkey join customer on c_nationkey = n_nationkey""")
def q_nested_explode(spark, sf):
    cu, na, re_ = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    flat = (cu.join(na, cu.c_nationkey == na.n_nationkey).join(re_, na.n_regionkey == re_.r_regionkey)
            .select("r_name", "n_name", "c_custkey"))
    blk = F.call_function("div", F.col("c_custkey"), F.lit(64))
    # clustered on (region, block): the crews aggregation below reuses this shuffle
    members = nested.nest(flat, ["r_name", "n_name"], ["c_custkey"], "ks", block=blk, cluster_by=["r_name", "block"])
    members = members.select("r_name", "block", F.struct(F.col("n_name").alias("name"),
                             F.transform("ks", lambda s: s["c_custkey"]).alias("powers")).alias("m"))
    crews = members.groupBy("r_name", "block").agg(F.collect_list("m").alias("members"))
    view = _name("crews")
    create_view(crews, view, replace=False)
    return spark.sql(f"""select r_name, member.name as n_name, power from {view}
                         lateral view explode(members) m as member
                         lateral view explode(member.powers) p as power""")


# ============================================================ joins and sets
@query("join_inner", """
    select s_name, n_name, concat_ws(',', s_name, n_name) pair
    from supplier join nation on s_nationkey = n_nationkey""")
def q_join_inner(spark, sf):
    su, na = table(spark, sf, "supplier"), table(spark, sf, "nation")
    # nation is a dimension: Spark's size estimate broadcasts it; no hint needed.
    joined = joins.join(su, na, su.s_nationkey == na.n_nationkey, "inner")
    return joined.select("s_name", "n_name", F.concat_ws(",", "s_name", "n_name").alias("pair"))


@query("join_left", "select c_custkey, s_name from customer left join supplier on c_custkey = s_suppkey")
def q_join_left(spark, sf):
    # Customers outnumber suppliers, so most customer keys have no supplier of that number.
    cu, su = table(spark, sf, "customer"), table(spark, sf, "supplier")
    return joins.join(cu, su, cu.c_custkey == su.s_suppkey, "left").select("c_custkey", "s_name")


@query("join_right", "select s_name, p_partkey from supplier right join part on s_suppkey = p_partkey")
def q_join_right(spark, sf):
    su, pa_ = table(spark, sf, "supplier"), table(spark, sf, "part")
    return joins.join(su, pa_, su.s_suppkey == pa_.p_partkey, "right").select("s_name", "p_partkey")


@query("join_full", """
    select c_custkey, c_mktsegment, o_custkey, n
    from customer full join (select o_custkey, count(*) n from orders group by 1) on c_custkey = o_custkey""")
def q_join_full(spark, sf):
    # Whole tables: customers without orders have no count. No key's rows meet in one task.
    cu = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return joins.spread_join(cu, counts, [("c_custkey", "o_custkey")], "full")


@query("join_full_hot", """
    select c_custkey, c_nationkey, s_suppkey, s_nationkey
    from customer full join supplier on c_nationkey = s_nationkey""")
def q_join_full_hot(spark, sf):
    # 25 keys, each a hot one on both sides: rows meet piece by piece.
    cu = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    su = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return joins.spread_join(cu, su, [("c_nationkey", "s_nationkey")], "full")


@query("broadcast_semi", """
    select o_orderkey from orders
    where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')""")
def q_broadcast_semi(spark, sf):
    o = table(spark, sf, "orders")
    members = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("o_custkey"))
    return joins.broadcast_semi(o, members, "o_custkey").select("o_orderkey")


@query("union_all", "select s_nationkey k from supplier union all select c_nationkey k from customer")
def q_union_all(spark, sf):
    return sets.union_all(table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")),
                          table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")))


@query("union_distinct", "select s_nationkey k from supplier union select c_nationkey k from customer")
def q_union_distinct(spark, sf):
    return sets.union_distinct(table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")),
                               table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")))


@query("intersection_distinct", """
    select l_suppkey k from lineitem where l_returnflag = 'A'
    intersect select l_suppkey k from lineitem where l_returnflag = 'R'""")
def q_intersection_distinct(spark, sf):
    li = table(spark, sf, "lineitem")
    a = li.where(F.col("l_returnflag") == "A").select(F.col("l_suppkey").alias("k"))
    r = li.where(F.col("l_returnflag") == "R").select(F.col("l_suppkey").alias("k"))
    return sets.intersect_distinct(a, r)


# ============================================================ sorts, top-k, sampling
@query("sort_by_key_desc", """
    select cast(row_number() over (order by n desc, k) as bigint) pos, n, k
    from (select p_brand k, count(*) n from part group by 1)""")
def q_sort_by_key_desc(spark, sf):
    counts = agg.count_by_key(table(spark, sf, "part").select(F.col("p_brand").alias("k")), "k")
    return sorting.with_position(counts.select("n", "k"), [F.col("n").desc(), F.col("k")])


@query("take_first_n", "select o_orderkey, o_orderstatus from orders order by o_orderkey limit 4")
def q_take_first_n(spark, sf):
    return sorting.take_first(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), 4, "o_orderkey")


@query("take_ordered_by_len", "select k from (select distinct p_name k from part) order by length(k), k limit 2")
def q_take_ordered_by_len(spark, sf):
    return sorting.shortest(table(spark, sf, "part"), "p_name", 2)


@query("take_sample_fixed", """
    select event_id from events order by md5(concat(cast(event_id as varchar), ':1')), event_id limit 4""")
def q_take_sample_fixed(spark, sf):
    return sampling.take_sample(table(spark, sf, "events").select("event_id"), "event_id", 4, seed=1)


@query("take_sample_replacement", """
    with ordered as (select event_id, row_number() over (order by event_id) - 1 pos, count(*) over () n from events),
    draws as (select unnest(generate_series(0, 499)) draw)
    select draw, event_id from draws
    join ordered on pos = cast(concat('0x', substr(md5(concat(cast(draw as varchar), ':1')), 1, 15)) as bigint) % n""")
def q_take_sample_replacement(spark, sf):
    return sampling.take_sample_with_replacement(table(spark, sf, "events").select("event_id"), "event_id", 500, seed=1)


@query("sample_by_hash", """
    select event_id from events where substr(md5(cast(event_id as varchar)), 1, 8) < '80000000'""")
def q_sample_by_hash(spark, sf):
    return sampling.sample_by_hash(table(spark, sf, "events").select("event_id"), "event_id", 0.5)


@query("sample_fraction", """
    select event_id from events where substr(md5(concat(cast(event_id as varchar), ':7')), 1, 13) < '8000000000000'""")
def q_sample_fraction(spark, sf):
    return sampling.sample(table(spark, sf, "events").select("event_id"), "event_id", 0.5, seed=7)


@query("sample_replacement", """
    with recursive poisson(k, chance, total) as (
      select 0, exp(-1.5), exp(-1.5) union all select k + 1, chance * (1.5::double / (k + 1)), total + chance * (1.5::double / (k + 1)) from poisson where k < 30),
    drawn as (select event_id, cast(concat('0x', substr(md5(concat(cast(event_id as varchar), ':7')), 1, 13)) as bigint) u from events)
    select event_id from drawn join poisson on u >= cast(round(total * 4503599627370496) as bigint) and round(total * 4503599627370496) < 4503599627370496""")
def q_sample_replacement(spark, sf):
    # sample(withReplacement = true, 1.5): a row comes as often as a Poisson variable of that mean.
    return sampling.sample(table(spark, sf, "events").select("event_id"), "event_id", 1.5, seed=7, with_replacement=True)


# ============================================================ partition-level operators
def _plus_one_batches(batches):
    # Set-up happens once per partition (this function body), then whole Arrow batches.
    for b in batches:
        q = pc.cast(b.column("l_quantity"), pa.int32(), safe=False)
        yield pa.RecordBatch.from_arrays([b.column("l_orderkey"), b.column("l_linenumber"), pc.add(q, pa.scalar(1, pa.int32()))],
                                         names=["l_orderkey", "l_linenumber", "v"])


@query("map_partitions", "select l_orderkey, l_linenumber, cast(l_quantity as int) + 1 v from lineitem")
def q_map_partitions(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return partitions.map_partitions(li, _plus_one_batches, "l_orderkey bigint, l_linenumber int, v int")


@query("partition_index", "select o_orderkey as value, true as in_range from orders")
def q_partition_index(spark, sf):
    # Which partition holds a row depends on the layout; that its index counts the partitions doesn't.
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("value"))
    n = partitions.num_partitions(orders)
    tagged = partitions.with_partition_index(orders)
    return tagged.select("value", ((F.col("pidx") >= 0) & (F.col("pidx") < n)).alias("in_range"))


@query("partition_count", """
    select 6 as n_partitions, count(*) n_rows from (select unnest(generate_series(lo, hi)) id
      from (select min(o_orderkey) lo, max(o_orderkey) hi from orders))""")
def q_partition_count(spark, sf):
    keys = generated.range_over(table(spark, sf, "orders"), "o_orderkey", num_partitions=6)
    return keys.agg(F.lit(partitions.num_partitions(keys)).alias("n_partitions"), F.count(F.lit(1)).alias("n_rows"))


@query("text_min_partitions", r"""
    select true as at_least, count(*) n_lines
    from (select unnest(regexp_split_to_array(text, '\r\n|\r|\n')) line from documents where text is not null)""")
def q_text_min_partitions(spark, sf):
    docs = table(spark, sf, "documents").where(F.col("text").isNotNull())
    path = text_sinks.write_text(docs.select("text"), shared_dir(spark, "documents_txt"))
    lines = text_src.read_lines(spark, path, min_partitions=12)
    enough = partitions.num_partitions(lines) >= 12
    return lines.agg(F.lit(enough).alias("at_least"), F.count(F.lit(1)).alias("n_lines"))


@query("partition_index_range", """
    select id as value, cast(((id - lo + 1) * 4 - 1) // (hi - lo + 1) as integer) pidx
    from (select unnest(generate_series(lo, hi)) id, lo, hi
          from (select min(o_orderkey) lo, max(o_orderkey) hi from orders))""")
def q_partition_index_range(spark, sf):
    # A generated collection sliced into 4 partitions: slice i holds elements
    # [floor(i*N/4), floor((i+1)*N/4)), so each element's partition index is fixed.
    keys = generated.range_over(table(spark, sf, "orders"), "o_orderkey", num_partitions=4)
    return partitions.with_partition_index(keys.select(F.col("id").alias("value")))


@query("coalesce_rows", "select l_orderkey, l_linenumber from lineitem")
def q_coalesce_rows(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return partitions.coalesce_to(li, partitions.num_partitions(li) // 2)


@query("repartition_rows", "select l_orderkey, l_linenumber from lineitem")
def q_repartition_rows(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return partitions.repartition_to(li, 2 * partitions.num_partitions(li), "l_orderkey")


@query("repartition_sorted", """
    select cast(l_orderkey % 6 as integer) pidx,
           row_number() over (partition by l_orderkey % 6 order by l_orderkey, l_linenumber) - 1 pos, l_orderkey, l_linenumber from lineitem""")
def q_repartition_sorted(spark, sf):
    # A partitioner of the caller's; each row shows its partition and its place there.
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    dealt = partitions.repartition_sorted(li, 6, "l_orderkey", "l_linenumber", partitioner=lambda k: k % 6)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return dealt.select(F.spark_partition_id().alias("pidx"), place.alias("pos"), "l_orderkey", "l_linenumber")


@query("repartition_spread", "select l_returnflag, l_orderkey, true as in_order from lineitem")
def q_repartition_spread(spark, sf):
    # Three keys, each a third of the rows: they span several partitions, in global order.
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey")
    spread = partitions.repartition_sorted(li, 12, "l_returnflag", "l_orderkey").withColumn("at", F.monotonically_increasing_id())
    before = F.lag(F.struct("l_returnflag", "l_orderkey")).over(Window.partitionBy(F.shiftright("at", 33)).orderBy("at"))
    return spread.select("l_returnflag", "l_orderkey", F.coalesce(before <= F.struct("l_returnflag", "l_orderkey"), F.lit(True)).alias("in_order"))


@query("transform_rows", "select doc_id, text, case when doc_id % 3 > 0 then source end source from documents")
def q_transform_rows(spark, sf):
    # Whole texts with their tabs, line ends and backslashes, and nulls, through a command and back.
    docs = table(spark, sf, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 3 > 0, F.col("source")).alias("source"))
    return partitions.pipe(docs, ["doc_id", "text", "source"], "cat", "doc_id bigint, text string, source string", _name("pipe_in"))


# ============================================================ UDF surface and generated rows
@query("udf_increment", "select l_orderkey, l_linenumber, l_linenumber + 1 v from lineitem")
def q_udf_increment(spark, sf):
    register_all(spark)
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.expr("udf_increment(l_linenumber)").alias("v"))


@query("udf_random", "select event_id, true as in_range from events")
def q_udf_random(spark, sf):
    register_all(spark)
    drawn = table(spark, sf, "events").select("event_id", F.expr("udf_random()").alias("r"))
    return drawn.select("event_id", ((F.col("r") >= 0) & (F.col("r") < 1)).alias("in_range"))


@query("dataset_from_records", """
    select n_name, r_name, count(*) n from nation join region on n_regionkey = r_regionkey
    join customer on c_nationkey = n_nationkey group by 1, 2""")
def q_dataset_from_records(spark, sf):
    # Records held by the caller (the nations, 25 at every size) as a typed dataset, joined to a table.
    held = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey").collect()
    nations = generated.from_records(spark, [r.asDict() for r in held], "n_nationkey int, n_name string, n_regionkey int")
    cu, re_ = table(spark, sf, "customer"), table(spark, sf, "region")
    joined = cu.join(nations, cu.c_nationkey == nations.n_nationkey).join(re_, nations.n_regionkey == re_.r_regionkey)
    return joined.groupBy("n_name", "r_name").agg(F.count(F.lit(1)).alias("n"))


@query("range_source", """
    select unnest(generate_series(lo, hi)) id
    from (select min(o_orderkey) lo, max(o_orderkey) hi from orders)""")
def q_range_source(spark, sf):
    return generated.range_over(table(spark, sf, "orders"), "o_orderkey")


# ============================================================ sources and sinks (round trips)
_CUSTOMER_JSON_ORACLE = """
    select c_custkey, c_name, cast(c_nationkey as bigint) c_nationkey, c_acctbal, c_mktsegment from customer"""


def _customer_json(spark, sf) -> str:
    path = shared_dir(spark, "customer_json")
    table(spark, sf, "customer").write.json(path)
    return path


@query("json_scan", _CUSTOMER_JSON_ORACLE)
def q_json_scan(spark, sf):
    return json_src.read_json(spark, _customer_json(spark, sf))


@query("sql_on_json_file", _CUSTOMER_JSON_ORACLE)
def q_sql_on_json_file(spark, sf):
    return json_src.sql_on_file(spark, "json", _customer_json(spark, sf))


@query("json_array_scan", _CUSTOMER_JSON_ORACLE)
def q_json_array_scan(spark, sf):
    # Customers as arrays of at most 1,000, each on one line of the files.
    cu = table(spark, sf, "customer")
    block = F.call_function("div", F.col("c_custkey"), F.lit(1000))
    texts = cu.groupBy(block.alias("b")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct(*cu.columns))), ","), F.lit("]")).alias("a"))
    path = text_sinks.write_text(texts.select("a"), shared_dir(spark, "customer_arrays"))
    return json_src.read_json_array(spark, path)


@query("ddl_json_view", _CUSTOMER_JSON_ORACLE)
def q_ddl_json_view(spark, sf):
    return json_src.create_file_view(spark, _name("customer_json"), "json", _customer_json(spark, sf))


_SUPPLIER_HEADER = "s_suppkey,s_name,s_nationkey,s_acctbal"


def _supplier_text(spark, sf) -> str:
    """Supplier rows as comma-separated text, a header line in every file; names
    padded with a space and a tab so that trimming is visible."""
    su = table(spark, sf, "supplier").select(
        "s_suppkey", F.concat(F.lit(" "), "s_name", F.lit("\t")).alias("s_name"), "s_nationkey", "s_acctbal")
    path = shared_dir(spark, "supplier_txt")
    (su.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


@query("delimited_inferred", """
    select s_suppkey, concat(' ', s_name, chr(9)) s_name, s_nationkey, s_acctbal from supplier""")
def q_delimited_inferred(spark, sf):
    return delimited.read_split(spark, _supplier_text(spark, sf), ",",
                                ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
                                ["bigint", "string", "int", "double"], header_line=_SUPPLIER_HEADER)


@query("delimited_schema", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def q_delimited_schema(spark, sf):
    return delimited.read_with_schema(spark, _supplier_text(spark, sf),
                                      "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
                                      header=True, trim=["s_name"])


@query("write_text_single", "select distinct p_brand as value from part")
def q_write_text_single(spark, sf):
    path = text_sinks.write_text(table(spark, sf, "part").select("p_brand").distinct(), shared_dir(spark, "brands"))
    return text_src.read_lines(spark, path)


@query("write_text_multi", """
    with ranked as (select c_nationkey k, c_mktsegment v,
                           (row_number() over (partition by c_nationkey order by c_mktsegment) - 1) // 25 block from customer)
    select concat('(', cast(k as varchar), ',[', string_agg(v, ', ' order by v), '])') as value from ranked group by k, block""")
def q_write_text_multi(spark, sf):
    path = text_sinks.write_grouped_text(table(spark, sf, "customer"), "c_nationkey", "c_mktsegment", 3,
                                         shared_dir(spark, "segment_bags"), rows_per_block=25)
    return text_src.read_lines(spark, path)


@query("partitioned_table_roundtrip", "select event_id, ts, user_id, value, props, event_type from events")
def q_partitioned_table_roundtrip(spark, sf):
    path = table_sinks.write_partitioned(table(spark, sf, "events"), shared_dir(spark, "events_by_type"), "event_type")
    return json_src.sql_on_file(spark, "parquet", path)


@query("managed_table_roundtrip", "select event_id, user_id, event_type from events")
def q_managed_table_roundtrip(spark, sf):
    name = f"{scratch_database(spark)}.{_name('events_by_type')}"
    table_sinks.save_partitioned_table(table(spark, sf, "events").select("event_id", "user_id", "event_type"),
                                       name, "event_type")
    return spark.table(name)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
