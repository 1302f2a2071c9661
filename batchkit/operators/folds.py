"""User-defined folds: aggregates with a state of their own, combined before the shuffle.

A :class:`Fold` is what ``aggregateByKey`` and a typed aggregator take: a zero state,
a step over input values, a merge of two states and a finish, with the types of the inputs,
the state and the result.  :func:`fold_by_key` runs one over a DataFrame:

1. each task folds its rows, an Arrow batch at a time, into one state per key;
2. only states are shuffled, sorted by key in each partition, and merged one after the
   other as they stream by, so no key's states are ever held together;
3. that happens twice: first the states of every FAN_IN neighbouring tasks, then
   those sums, so that a key that occurs in every task isn't merged by one task alone.

A key that holds any share of the rows moves one state a task.  :func:`register_fold`
gives a fold SQL names with the same plan.
"""

from __future__ import annotations

import sys
from typing import Any, Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf, arrow_udtf
from pyspark.sql.pandas.types import to_arrow_type

from batchkit._util import as_col
from batchkit.operators.partitions import map_partitions

#: Keys whose states a task holds; beyond, they are passed on and a key may have several states a task.
MAX_KEYS = 100_000
#: Tasks whose states are merged by one task in the first round.
FAN_IN = 64
#: States in an output batch.
OUT_ROWS = 10_000


def _type(ddl: str) -> T.DataType:
    return T.DataType.fromDDL(ddl)


def _fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields if ddl.strip() else []


class Fold:
    """An aggregate by its parts.

    ``zero()`` makes an empty state; ``update(state, *columns)`` adds rows, given as one
    Arrow array per input, and returns the state; ``merge(a, b)`` joins two states (``a`` may be
    changed and returned); ``finish(state)`` gives the result.  ``inputs`` (``"event
    string, n bigint"``), ``state`` and ``result`` are Spark types; states and results are
    Python values of these types.  Merging must not depend on the order of the states.
    """

    def __init__(self, zero: Callable[[], Any], update: Callable[..., Any], merge: Callable[[Any, Any], Any], finish: Callable[[Any], Any],
                 inputs: str, state: str, result: str):
        self.zero, self.update, self.merge, self.finish = zero, update, merge, finish
        self.inputs, self.state, self.result = inputs, state, result

    @classmethod
    def by_row(cls, zero: Callable[[], Any], reduce: Callable[..., Any], merge: Callable[[Any, Any], Any], finish: Callable[[Any], Any] = lambda s: s, *,
               inputs: str, state: str, result: str | None = None) -> Fold:
        """A fold whose step takes one row's values: ``reduce(state, *values)``."""
        def update(state, *columns):
            for values in zip(*(c.to_pylist() for c in columns), strict=True):
                state = reduce(state, *values)
            return state

        return cls(zero, update, merge, finish, inputs, state, result or state)

    def check(self, what: str, given: Sequence[T.DataType]) -> None:
        """Raise ``TypeError`` unless the arguments fit the inputs in number and type; char and varchar are strings."""
        wanted = _fields(self.inputs)
        if len(given) != len(wanted):
            raise TypeError(f"{what} requires {len(wanted)} argument(s) ({self.inputs}), got {len(given)}")
        for i, (field, kind) in enumerate(zip(wanted, given, strict=True)):
            if not isinstance(kind, T.StringType if isinstance(field.dataType, T.StringType) else type(field.dataType)) and \
                    not (isinstance(field.dataType, T.StringType) and isinstance(kind, (T.CharType, T.VarcharType))):
                raise TypeError(f"{what}: argument {i + 1} ({field.name}) must be {field.dataType.simpleString()}, got {kind.simpleString()}")


def _codes(keys: list[pa.Array], rows: int) -> np.ndarray:
    """Equal numbers for rows with equal keys (nulls and NaNs are equal to themselves)."""
    total = np.zeros(rows, np.int64)
    for k in keys:
        d = k.dictionary_encode(null_encoding="encode")
        total = total * max(1, len(d.dictionary)) + d.indices.to_numpy(zero_copy_only=False)
        total = np.unique(total, return_inverse=True)[1]
    return total


def _key(keys: list[pa.Array], row: int) -> tuple:
    """A row's key for a dictionary: NaN, which equals nothing, as a value that equals itself."""
    return tuple("\0NaN" if isinstance(v, float) and v != v else v for v in (k[row].as_py() for k in keys))


class _States:
    """The states of a task's keys."""

    def __init__(self, fold: Fold, key_types: list[pa.DataType]):
        self.fold, self.key_types, self.held = fold, key_types, {}

    def add(self, keys: list[pa.Array], values: list[pa.Array], rows: int) -> None:
        if not rows:
            return
        codes = _codes(keys, rows)
        order = np.argsort(codes, kind="stable")
        starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
        one = len(starts) == 1
        if not one:
            at = pa.array(order)
            values = [v.take(at) for v in values]
        for a, z in zip(starts.tolist(), [*starts[1:].tolist(), rows], strict=True):
            key = _key(keys, int(order[a]))
            state = self.held.get(key)
            self.held[key] = self.fold.update(self.fold.zero() if state is None else state, *(values if one else [v.slice(a, z - a) for v in values]))

    def full(self) -> bool:
        return len(self.held) > MAX_KEYS

    def take(self) -> Iterator[tuple[list[tuple], list]]:
        """The states so far, some keys at a time, and none are held any more."""
        items = list(self.held.items())
        self.held = {}
        for i in range(0, len(items), OUT_ROWS):
            part = items[i:i + OUT_ROWS]
            yield [tuple(float("nan") if v == "\0NaN" else v for v in k) for k, _ in part], [s for _, s in part]

    def columns(self, keys: list[tuple], states: list, kind: pa.DataType) -> list[pa.Array]:
        return [*(pa.array([k[i] for k in keys], t) for i, t in enumerate(self.key_types)), pa.array(states, kind)]


def _partial(fold: Fold, keys: int, key_types: list[pa.DataType], state: pa.DataType):
    """A kernel: rows (keys, inputs) to (keys, state, task group), a key once unless there are very many."""
    names = [*(f"k{i}" for i in range(keys)), "state", "salt"]

    def run(batches):
        held, salt = _States(fold, key_types), TaskContext.get().partitionId() // FAN_IN

        def out():
            for ks, states in held.take():
                yield pa.RecordBatch.from_arrays([*held.columns(ks, states, state), pa.array([salt] * len(states), pa.int32())], names=names)

        for b in batches:
            columns = b.columns
            held.add(columns[:keys], columns[keys:], b.num_rows)
            if held.full():
                yield from out()
        yield from out()

    return run


def _merge(fold: Fold, keys: int, key_types: list[pa.DataType], out_type: pa.DataType, last: bool):
    """A kernel: states sorted by key, merged as they stream by; the last round gives results."""
    names = [*(f"k{i}" for i in range(keys)), "value" if last else "state"]

    def run(batches):
        done_keys, done, key, row, state = [], [], None, None, None

        def out():
            rows = [fold.finish(s) for s in done] if last else done
            batch = pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in done_keys], t) for i, t in enumerate(key_types)), pa.array(rows, out_type)], names=names)
            done_keys.clear()
            done.clear()
            return batch

        for b in batches:
            if not b.num_rows:
                continue
            held = b.columns[:keys]
            codes = _codes(held, b.num_rows)
            states = b.column("state").to_pylist()
            starts = np.flatnonzero(np.diff(codes, prepend=-1))
            for a, z in zip(starts.tolist(), [*starts[1:].tolist(), b.num_rows], strict=True):
                this = _key(held, a)
                if state is None or this != key:
                    if state is not None:
                        done_keys.append(row)
                        done.append(state)
                    key, row, state = this, tuple(k[a].as_py() for k in held), fold.zero()
                for s in states[a:z]:
                    state = fold.merge(state, s)
            if len(done) >= OUT_ROWS:
                yield out()
        if state is not None:
            done_keys.append(row)
            done.append(state)
        if done:
            yield out()

    return run


def _zero(fold: Fold, state: pa.DataType):
    """A kernel: a zero state for each row."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([fold.zero() for _ in range(b.num_rows)], state)], names=["state"])

    return run


def _plain_key(c: Column, kind: T.DataType) -> Column:
    """Keys as grouping sees them: one NaN, one zero."""
    return F.when(F.isnan(c), F.lit(float("nan")).cast(kind)).otherwise(c + F.lit(0.0).cast(kind)) if isinstance(kind, (T.DoubleType, T.FloatType)) else c


def fold_by_key(df: DataFrame, by: Sequence, values: Sequence, fold: Fold, name: str = "value") -> DataFrame:
    """``aggregateByKey``: one row per key (names or Columns in ``by``) with the fold of ``values`` in ``name``.

    Keys must be atomic (no arrays, maps or structs); a null key is a key.  With no key the
    result is one row, also of no rows.  Argument types are checked before anything runs.
    """
    by = [by] if isinstance(by, (str, Column)) else list(by)
    values = [values] if isinstance(values, (str, Column)) else list(values)
    rows = df.select(*[as_col(c) for c in by], *[as_col(v) for v in values])
    kinds = [f.dataType for f in rows.schema.fields]
    out_names = rows.columns[:len(by)]
    n = len(by)
    for kind in kinds[:n]:
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"fold_by_key: a key must be atomic, got {kind.simpleString()}")
    fold.check("fold_by_key", kinds[n:])
    rows = rows.toDF(*[f"k{i}" for i in range(n)], *[f"v{i}" for i in range(len(values))])
    rows = rows.select(*[_plain_key(F.col(f"k{i}"), kinds[i]).alias(f"k{i}") for i in range(n)], *[f"v{i}" for i in range(len(values))])
    arrow = [to_arrow_type(k) for k in kinds[:n]]
    state, result = _type(fold.state), _type(fold.result)
    keys = [f"k{i}" for i in range(n)]
    schema = T.StructType([T.StructField(k, kinds[i]) for i, k in enumerate(keys)])
    with_state = T.StructType([*schema.fields, T.StructField("state", state)])
    partial = map_partitions(rows, _partial(fold, n, arrow, to_arrow_type(state)), T.StructType([*with_state.fields, T.StructField("salt", T.IntegerType())]))
    sort = lambda d: d.sortWithinPartitions(*keys) if n else d
    first = map_partitions(sort(partial.repartition(*keys, "salt")), _merge(fold, n, arrow, to_arrow_type(state), False), with_state)
    if n:
        last = sort(first.repartition(*keys))
    else:
        empty = map_partitions(df.sparkSession.range(0, 1, 1, 1), _zero(fold, to_arrow_type(state)), with_state)
        last = first.unionAll(empty).repartition(1)  # a state for each FAN_IN tasks
    done = map_partitions(last, _merge(fold, n, arrow, to_arrow_type(result), True), T.StructType([*schema.fields, T.StructField("value", result)]))
    return done.toDF(*out_names, name)


def register_fold(spark: SparkSession, name: str, fold: Fold, keys: str = "") -> tuple[str, str]:
    """SQL names for a fold: the table function ``{name}_states`` and the aggregate ``{name}`` over its states.

    ``SELECT dept, my_mean(state) FROM my_mean_states(TABLE(SELECT dept, salary FROM staff)) GROUP BY dept``

    The table function folds the rows of each task into one state per key (its leading
    columns, declared in ``keys`` as ``"dept string"``), the aggregate merges states and finishes: a
    hot key moves one state a task, as in :func:`fold_by_key`.  Wrong numbers or types
    of arguments raise an error that names the function.
    """
    key_fields, inputs = _fields(keys), _fields(fold.inputs)
    arrow = [to_arrow_type(f.dataType) for f in key_fields]
    wanted = [to_arrow_type(f.dataType) for f in inputs]
    state, n = to_arrow_type(_type(fold.state)), len(key_fields)
    names = [*(f.name for f in key_fields), "state"]
    given = f"{keys + ', ' if keys else ''}{fold.inputs}"

    class States:
        def __init__(self):
            self.held = _States(fold, arrow)

        def _out(self):
            for ks, states in self.held.take():
                yield pa.Table.from_arrays(self.held.columns(ks, states, state), names=names)

        def eval(self, batch):
            if batch.num_columns != n + len(wanted):
                raise TypeError(f"{name}_states requires {n + len(wanted)} column(s) ({given}), got {batch.num_columns}")
            for i, (c, t) in enumerate(zip(batch.columns, [*arrow, *wanted], strict=True)):
                if c.type != t:
                    raise TypeError(f"{name}_states: column {i + 1} must be {t}, got {c.type}")
            self.held.add(batch.columns[:n], batch.columns[n:], batch.num_rows)
            if self.held.full():
                yield from self._out()

        def terminate(self):
            yield from self._out()

    def finish(states):
        total = fold.zero()
        for s in states.to_pylist():
            if s is not None:
                total = fold.merge(total, s)
        return fold.finish(total)

    spark.udtf.register(f"{name}_states", arrow_udtf(States, returnType=T.StructType([*key_fields, T.StructField("state", _type(fold.state))])))
    finish.__annotations__ = {"states": pa.Array, "return": object}  # what makes it an aggregate
    spark.udf.register(name, arrow_udf(finish, _type(fold.result)))
    return f"{name}_states", name


# ------------------------------------------------------------------ folds of the library
def histogram(edges: Sequence[float], kind: str = "double") -> Fold:
    """Counts between ascending ``edges``: below the first, from each edge to the next, from the last on; nulls and NaNs aren't counted."""
    cuts = np.array(edges, np.float64)

    def update(state, values):
        x = pc.drop_null(values).to_numpy(zero_copy_only=False).astype(np.float64)
        at = np.searchsorted(cuts, x[~np.isnan(x)], side="right")
        return np.asarray(state) + np.bincount(at, minlength=len(cuts) + 1)

    def listed(state):
        return np.asarray(state).tolist()

    return Fold(lambda: [0] * (len(cuts) + 1), update, lambda a, b: (np.asarray(a) + np.asarray(b)), listed, f"value {kind}", "array<bigint>", "array<bigint>")


def event_rate_fold() -> Fold:
    """``event_rate`` as a fold: two counts, merged by addition; null where the denominator's is 0, and rows with a null argument don't count."""
    def update(state, event, numerator, denominator):
        there = pc.and_(pc.and_(pc.is_valid(event), pc.is_valid(numerator)), pc.is_valid(denominator))
        hits = [pc.sum(pc.fill_null(pc.and_(there, pc.equal(event, name)), False)).as_py() or 0 for name in (numerator, denominator)]
        return {"numerator_count": state["numerator_count"] + hits[0], "denominator_count": state["denominator_count"] + hits[1]}

    def merge(a, b):
        return {k: (a[k] or 0) + (b[k] or 0) for k in ("numerator_count", "denominator_count")}

    return Fold(lambda: {"numerator_count": 0, "denominator_count": 0}, update, merge,
                lambda s: s["numerator_count"] / s["denominator_count"] if s["denominator_count"] else None,
                "event string, numerator string, denominator string", "struct<numerator_count bigint, denominator_count bigint>", "double")


def int_mean_fold(kind: str = "bigint") -> Fold:
    """``int_average`` as a fold: an exact sum and a count; the division truncates toward zero, and no rows give null."""
    def update(state, values):
        x = pc.drop_null(values)
        if len(x) and len(x) * max(abs(pc.min(x).as_py()), abs(pc.max(x).as_py())) >= 1 << 63:
            total = sum(x.to_pylist())  # beyond 64 bits
        else:
            total = pc.sum(x).as_py() or 0
        return {"total": int(state["total"]) + total, "n": state["n"] + len(x)}

    def merge(a, b):
        return {"total": int(a["total"]) + int(b["total"]), "n": a["n"] + b["n"]}

    def finish(s):
        if not s["n"]:
            return None
        whole = abs(int(s["total"])) // s["n"]
        return float(whole if s["total"] >= 0 else -whole)

    return Fold(lambda: {"total": 0, "n": 0}, update, merge, finish, f"value {kind}", "struct<total decimal(38,0), n bigint>", "double")


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need the libraries only
