"""SQL names for the operators, registered per session.

Scalar and table functions are SQL functions: Catalyst inlines their bodies, so
they keep predicate pushdown and whole-stage codegen and run no Python.  A SQL
function cannot hold an aggregate, so ``event_rate`` and ``int_average`` are
offered to SQL as expression text (:func:`event_rate_sql`, :func:`int_average_sql`)
built from built-in aggregates, which aggregate partially before the shuffle.
"""

from __future__ import annotations

import weakref

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit.functions.text import JAVA_WHITESPACE
from batchkit.operators.business import ITEM_FRAGMENT_ERROR, ITEM_NUMBER_ERROR

_WS_SQL = "'" + "".join(f"\\u{ord(ch):04x}" for ch in JAVA_WHITESPACE) + "'"


def _sql_trim(e: str) -> str:
    return f"btrim({e}, {_WS_SQL})"


def _sql_int(e: str, field: str, frag: str) -> str:
    msg = ITEM_NUMBER_ERROR.format(field=field)
    return (f"coalesce(CASE WHEN {e} RLIKE '^[+-]?[0-9]+$' THEN try_cast({e} AS INT) END, "
            f"raise_error(concat('{msg}', {frag})))")


def item_list_sql(arg: str = "item_list") -> str:
    """SQL text of the validated ``array<struct<sku_id, qty, price>>`` for ``arg``
    (same staged plan as :func:`batchkit.operators.business.parse_item_list`)."""
    frags = f"filter(transform(split({arg}, ','), x -> {_sql_trim('x')}), t -> t <> '')"
    split = (f"transform({frags}, t -> named_struct('frag', t, 'p', CASE WHEN TRIM(TRAILING ':' FROM t) = '' AND t <> '' "
             f"THEN array() ELSE split(TRIM(TRAILING ':' FROM t), ':') END))")
    fields = (f"transform({split}, s -> named_struct('frag', s.frag, 'n', size(s.p), "
              f"'sku', {_sql_trim('get(s.p, 0)')}, 'q', {_sql_trim('get(s.p, 1)')}, "
              f"'pr', {_sql_trim('get(s.p, 2)')}))")
    row = (f"named_struct('sku_id', s.sku, 'qty', {_sql_int('s.q', 'qty', 's.frag')}, "
           f"'price', {_sql_int('s.pr', 'price', 's.frag')})")
    return (f"transform({fields}, s -> CASE WHEN s.n = 3 THEN {row} "
            f"ELSE raise_error(concat('{ITEM_FRAGMENT_ERROR}', s.frag)) END)")


SQL_FUNCTIONS = {
    "int_to_percent": (
        "CREATE OR REPLACE TEMPORARY FUNCTION int_to_percent(num INT, denom INT) RETURNS STRING "
        "RETURN concat(cast(cast(bround(cast(num AS DOUBLE) / cast(nullif(denom, 0) AS DOUBLE) * 100.0, 0) "
        "AS DECIMAL(38, 0)) AS STRING), '%')"),
    "udf_increment": "CREATE OR REPLACE TEMPORARY FUNCTION udf_increment(i INT) RETURNS INT RETURN i + 1",
    "filter_gt": "CREATE OR REPLACE TEMPORARY FUNCTION filter_gt(x BIGINT) RETURNS BOOLEAN RETURN x > 100",
    "udf_random": "CREATE OR REPLACE TEMPORARY FUNCTION udf_random() RETURNS DOUBLE NOT DETERMINISTIC RETURN rand()",
}


# SQL names of the original functions, registered as aliases so that
# existing queries run unchanged.  ("random" is a Spark built-in and keeps its own
# meaning; aggregate names cannot be SQL functions, see event_rate_sql.)
COMPAT_NAMES = {"int_to_precent": "int_to_percent", "random1": "udf_increment", "filterGt": "filter_gt"}


def _alias_statements() -> list[str]:
    out = []
    for alias, name in COMPAT_NAMES.items():
        stmt = SQL_FUNCTIONS[name]
        out.append(stmt.replace(f"TEMPORARY FUNCTION {name}(", f"TEMPORARY FUNCTION {alias}(", 1))
    return out


def _item_list_table_function() -> str:
    return ("CREATE OR REPLACE TEMPORARY FUNCTION item_list_explode(item_list STRING) "
            "RETURNS TABLE (sku_id STRING, qty INT, price INT) "
            f"RETURN SELECT r.sku_id, r.qty, r.price FROM (SELECT explode({item_list_sql()}) AS r)")


def event_rate_sql(event: str, numerator: str, denominator: str) -> str:
    """SQL text of ``event_rate`` for use inside ``spark.sql`` (arguments are SQL
    expressions, e.g. ``"event_type", "'purchase'", "'view'"``).

    A SQL function cannot hold an aggregate, and a registered grouped-aggregate
    Python UDF would pull each whole group into one worker with no partial step,
    so the SQL surface is this expression text: built-in aggregates, combined
    map-side like the DataFrame form.
    """
    return (f"try_divide(count_if(({event}) = ({numerator}) AND ({denominator}) IS NOT NULL), "
            f"count_if(({event}) = ({denominator}) AND ({numerator}) IS NOT NULL))")


def int_average_sql(value: str) -> str:
    """SQL text of ``int_average``: ``cast(sum(v) div count(v) as double)``, summed in decimal(38,0) as the DataFrame form."""
    return f"CAST(sum(CAST({value} AS DECIMAL(38, 0))) DIV count({value}) AS DOUBLE)"


def register_python(spark: SparkSession, name: str, fn, return_type, deterministic: bool = True):
    """Register a vectorised Python function (pandas Series in, Series out) under ``name``.

    For logic SQL cannot express.  Batches move through Arrow; non-deterministic
    functions are flagged so the optimizer never duplicates or reorders them.
    Returns the registered UDF object (``.deterministic`` reports the flag).
    """
    f = F.pandas_udf(fn, return_type)
    if not deterministic:
        f = f.asNondeterministic()
    return spark.udf.register(name, f)


# Sessions whose temporary functions are registered; entries go away with the session.
_REGISTERED: "weakref.WeakSet[SparkSession]" = weakref.WeakSet()


def register_all(spark: SparkSession, force: bool = False) -> list[str]:
    """Register every SQL name in ``spark``'s session; returns the names.

    Temporary functions live as long as the session, so the statements run once
    per session object (``force=True`` runs them again, e.g. after a drop).
    """
    names = [*SQL_FUNCTIONS, *COMPAT_NAMES, "item_list_explode"]
    if force or spark not in _REGISTERED:
        for stmt in [*SQL_FUNCTIONS.values(), *_alias_statements(), _item_list_table_function()]:
            spark.sql(stmt)
        _REGISTERED.add(spark)
    return names
