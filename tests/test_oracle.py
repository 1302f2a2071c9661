"""Every keyed query against its DuckDB oracle at sf0.01 (the correctness gate)."""

import datetime as dt
import decimal

import pytest

import __spark_entry__ as E
from conftest import SF001
from batchkit.plans import catalog

ORACLE = catalog.oracle_sql()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_a_callable():
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    assert set(ORACLE) <= set(qs)
    assert len(qs) >= 60


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, key):
    df = catalog.QUERIES[key](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(df.columns, rows) == _canon(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["dt", "r"]
    assert df.count() > 0


SENSITIVE = ["event_rate", "login_rollup", "order_daily_total", "item_list_explode", "int_average", "int_to_percent",
             "partitioned_table_roundtrip", "delimited_inferred", "sample_by_hash"]
JOINS = ["order_daily_total", "order_daily_total_sql", "join_inner", "join_left", "join_right", "join_full",
         "broadcast_semi", "intersection_distinct", "nested_explode"]


@pytest.mark.parametrize("conf,keys", [
    ({"spark.sql.ansi.enabled": "false"}, SENSITIVE),
    ({"spark.sql.session.timeZone": "America/Los_Angeles"}, SENSITIVE),
    # what runs at scale: no side is small enough for Spark to broadcast on its own
    ({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}, JOINS),
])
def test_results_do_not_depend_on_session_settings(spark, duck, conf, keys):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for k in keys:
            df = catalog.QUERIES[k](spark, SF001)
            res = duck.execute(ORACLE[k])
            ocols = [d[0] for d in res.description]
            assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(ocols, res.fetchall()), k
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
