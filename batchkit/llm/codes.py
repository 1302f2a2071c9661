"""Vector codes: product quantisation trained by Lloyd rounds with Drake-Hamerly adaptive bounds.

Vectors of integers floor(scale * x) are cut into parts; each part position has a
codebook of ``entries``.  A round assigns every part to its nearest entry and moves
the entries to the floored mean of their parts.  Distances are integers and decide
exactly; what saves them is a state kept for each part between the rounds:

* its entry and an upper bound of the distance to it,
* the b entries that come next, ordered by lower bounds of their distances,
* one outer bound, below the distance to any entry that is not among these.

When entries move, the bounds loosen by as much.  A part whose upper bound lies
below all lower bounds keeps its entry without a distance.  Else the distance to
its own entry is computed; if that doesn't settle it, so are those of the listed
entries that the bound doesn't exclude, and if even the outer bound is reached, all.
Ties go to the lower index, which only integers decide; every float bound is
widened by more than its rounding error.  b is adapted for each part position
after each round, from how deep the lists were read.

The state is a table in the shared scratch folder, written each round and dropped
after the next, so a lost executor repeats its tasks only.  To the driver come the
sums of the entries and the depths: their number is that of the codebooks.

Edge cases: vectors that are null or hold null or non-finite components are dropped,
and so are those whose length is not that of the vector with the smallest id; a
length that isn't divisible by the number of parts gives parts that differ by one;
with fewer vectors than entries the codebooks are as much smaller; components
of any magnitude are exact (Python integers where 64 bits don't hold the squares), but a
sum of errors beyond a long is null; null labels are one label; null ids come last;
repeated ids are rows of their own, in the order of their vectors; other columns are
ignored, so clashing names do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchkit.llm.common import mapped, slices
from batchkit.session import shared_dir

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Entries listed at first, of the 15 that a part isn't assigned to.
FIRST_B = 4
#: b grows by one where more than this share of a position's parts needed all entries.
MANY = 0.05
#: b shrinks to the depth that all but this share of a position's parts did with.
FEW = 0.005
#: Labels with more than this share of the rows; there are at most 1,000.
HOT_LABEL = 1000
#: No entry.
NONE = 255
#: Bounds are widened by this share, far beyond the error of their arithmetic.
WIDER = 1e-12
#: Integers up to here (2**26) have sums of squared differences within 64 bits for parts of up to 512 components.
SMALL = 1 << 26
#: Sums travel as limbs of this many bits.
LIMB = 30


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null, NaN or infinite component."""
    x = F.transform(vector, lambda v: v.cast("double"))
    return vector.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), as 64-bit integers or as Python integers where these are too small."""
    f = np.floor(scale * x.astype(np.float64))
    if np.abs(f).max(initial=0) <= SMALL:
        return f.astype(np.int64)
    return np.array([int(v) for v in f.ravel()], object).reshape(f.shape)


def _alike(x: np.ndarray, book: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Parts and codebook in a type that holds the sums of their squared differences."""
    wide = x.dtype == object or x.shape[1] > 512 or any(abs(v) > SMALL for e in book for v in e)
    kind = object if wide else np.int64
    return x.astype(kind), np.array(book, kind).reshape(len(book), x.shape[1])


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    total = (d * d).sum(axis=-1)
    return total if total.dtype == object else total.astype(np.int64)


def _root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64))


class Bounds:
    """The state of one part position for some rows: arrays over the rows."""

    def __init__(self, own, upper, near, low, outer):
        self.own, self.upper, self.near, self.low, self.outer = own, upper, near, low, outer

    @classmethod
    def fresh(cls, x: np.ndarray, c: np.ndarray, b: int) -> Bounds:
        """From all distances: the nearest entry, ties to the lower index, the next b and the one after."""
        d = squared(x[:, None, :], c[None])
        order = np.argsort(d, axis=1, kind="stable")
        r = np.take_along_axis(_root(d), order, axis=1)
        b = min(b, len(c) - 1)
        outer = r[:, b + 1] * (1 - WIDER) if len(c) > b + 1 else np.full(len(x), np.inf)
        return cls(order[:, 0].astype(np.uint8), r[:, 0] * (1 + WIDER), order[:, 1:b + 1].astype(np.uint8), r[:, 1:b + 1] * (1 - WIDER), outer)

    def at(self, rows: np.ndarray) -> Bounds:
        return Bounds(self.own[rows], self.upper[rows], self.near[rows], self.low[rows], self.outer[rows])

    def put(self, rows: np.ndarray, other: Bounds) -> None:
        for name in ("own", "upper", "near", "low", "outer"):
            getattr(self, name)[rows] = getattr(other, name)

    def fit(self, b: int) -> None:
        """Lists of b entries: longer ones end in the outer bound, shorter ones are filled with no entries."""
        have = self.near.shape[1]
        if have > b:
            self.outer = np.minimum(self.outer, self.low[:, b])
            self.near, self.low = self.near[:, :b], self.low[:, :b]
        elif have < b:
            n = len(self.own)
            self.near = np.concatenate([self.near, np.full((n, b - have), NONE, np.uint8)], axis=1)
            self.low = np.concatenate([self.low, np.full((n, b - have), np.inf)], axis=1)

    def loosen(self, moved: np.ndarray) -> None:
        """After each entry has moved by at most ``moved``: bounds hold again."""
        by = np.append(moved, 0.0)  # no entry doesn't move
        self.upper = (self.upper + by[self.own]) * (1 + WIDER)
        self.low = self.low * (1 - WIDER) - by[np.where(self.near == NONE, len(moved), self.near)] * (1 + WIDER)
        self.outer = self.outer * (1 - WIDER) - moved.max(initial=0.0) * (1 + WIDER)
        order = np.argsort(self.low, axis=1, kind="stable")
        self.near, self.low = np.take_along_axis(self.near, order, axis=1), np.take_along_axis(self.low, order, axis=1)

    def open(self) -> np.ndarray:
        """Rows whose entry the bounds don't settle; equality is open, as ties go by index."""
        least = np.minimum(self.low[:, 0], self.outer) if self.low.shape[1] else self.outer
        return np.flatnonzero(~(self.upper < least))

    def settle(self, x: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Makes every row's entry the nearest; returns how many listed entries each row needed (one more than b: all entries)."""
        b = self.near.shape[1]
        depth = np.zeros(len(self.own), np.uint8)
        rows = self.open()
        if not len(rows):
            return depth
        own = squared(x[rows], c[self.own[rows]])
        self.upper[rows] = _root(own) * (1 + WIDER)
        still = self.at(rows)
        keep = still.open()
        rows, own, still = rows[keep], own[keep], still.at(keep)
        beyond = still.outer <= still.upper
        depth[rows[beyond]] = b + 1
        if beyond.any():
            anew = Bounds.fresh(x[rows[beyond]], c, b)
            anew.fit(b)
            self.put(rows[beyond], anew)
        rows, own, still = rows[~beyond], own[~beyond], still.at(np.flatnonzero(~beyond))
        if not len(rows):
            return depth
        # listed entries that the upper bound doesn't exclude, by integer distances
        ask = still.low <= still.upper[:, None]
        depth[rows] = ask.sum(axis=1)
        r, k = np.nonzero(ask)
        names = np.concatenate([still.own[:, None], still.near], axis=1)
        exact = np.full(names.shape, None, object) if x.dtype == object else np.full(names.shape, np.iinfo(np.int64).max)
        if x.dtype == object:
            exact[:] = 1 << 1024  # beyond any distance of doubles
        exact[:, 0] = own
        exact[r, k + 1] = squared(x[rows[r]], c[still.near[r, k]])
        bounds = np.concatenate([still.upper[:, None], still.low], axis=1)
        bounds[:, 0] = _root(own) * (1 - WIDER)
        bounds[r, k + 1] = _root(exact[r, k + 1]) * (1 - WIDER)
        least = exact.min(axis=1)
        winner = np.where(exact == least[:, None], names, NONE).min(axis=1).astype(np.uint8)
        upper = _root(least) * (1 + WIDER)
        bounds[names == winner[:, None]] = -np.inf  # first, and so off the list
        order = np.argsort(bounds, axis=1, kind="stable")[:, 1:]
        self.put(rows, Bounds(winner, upper, np.take_along_axis(names, order, axis=1), np.take_along_axis(bounds, order, axis=1), still.outer))
        return depth

    def pack(self) -> np.ndarray:
        """Rows of bytes."""
        n = len(self.own)
        floats = np.concatenate([self.upper[:, None], self.outer[:, None], self.low], axis=1)
        return np.concatenate([self.own[:, None], self.near, np.ascontiguousarray(floats).view(np.uint8).reshape(n, -1)], axis=1)

    @classmethod
    def unpack(cls, rows: np.ndarray, b: int) -> Bounds:
        floats = np.ascontiguousarray(rows[:, 1 + b:]).view(np.float64)
        return cls(rows[:, 0].copy(), floats[:, 0].copy(), rows[:, 1:1 + b].copy(), floats[:, 2:].copy(), floats[:, 1].copy())


def state_width(b: int) -> int:
    return 1 + b + 8 * (2 + b)


def edges(dim: int, parts: int) -> list[tuple[int, int]]:
    """The parts of a vector: equal, or as near as its length allows."""
    return [(dim * p // parts, dim * (p + 1) // parts) for p in range(parts)]


def movement(old: list[list[int]], new: list[list[int]]) -> np.ndarray:
    """How far each entry has moved, widened."""
    return np.array([float(sum((a - b) ** 2 for a, b in zip(x, y, strict=True))) ** 0.5 * (1 + WIDER) for x, y in zip(old, new, strict=True)])


def _vectors(column) -> np.ndarray:
    """A list column whose rows have one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(flat) else np.zeros((len(column), 0))


class Model:
    """Codebooks as they stand, and the lists' lengths by part position."""

    def __init__(self, books: list[list[list[int]]], dim: int, scale: int):
        self.books, self.dim, self.scale = books, dim, scale
        self.edges = edges(dim, len(books))
        self.old_b = self.b = [min(FIRST_B, max(0, len(book) - 1)) for book in books]
        self.moved: list[np.ndarray] | None = None

    def adapted(self, depths: dict[tuple[int, int], int]) -> list[int]:
        """b of each position: one more if many parts needed all entries, else the depth that all but few did with."""
        out = []
        for p, book in enumerate(self.books):
            seen = {d: n for (q, d), n in depths.items() if q == p}
            total, b = sum(seen.values()), self.b[p]
            if seen.get(b + 1, 0) > MANY * total:
                b += 1
            else:
                rest = total - seen.get(b + 1, 0)
                deep = b
                while deep > 1 and sum(n for d, n in seen.items() if deep <= d <= b) <= FEW * rest:
                    deep -= 1
                b = deep
            out.append(max(0, min(b, len(book) - 1)))
        return out


def _assign(model: Model):
    """A kernel: rows with their state, if they have one, to rows whose entries are nearest in the model's codebooks."""
    def run(batches):
        for b in slices(batches, 2048):
            x = integers(_vectors(b.column("x")), model.scale)
            old = None
            if model.moved is not None:
                old = np.frombuffer(b"".join(b.column("state").to_pylist()), np.uint8).reshape(b.num_rows, -1)
            packed, codes, depths, at = [], [], [], 0
            for p, (lo, hi) in enumerate(model.edges):
                part, c = _alike(x[:, lo:hi], model.books[p])
                if old is None:
                    state, depth = Bounds.fresh(part, c, model.b[p]), np.zeros(b.num_rows, np.uint8)
                    state.fit(model.b[p])
                else:
                    width = state_width(model.old_b[p])
                    state, at = Bounds.unpack(old[:, at:at + width], model.old_b[p]), at + width
                    state.loosen(model.moved[p])
                    state.fit(model.b[p])
                    depth = state.settle(part, c)
                packed.append(state.pack())
                codes.append(state.own)
                depths.append(depth)
            rows = [np.ascontiguousarray(np.concatenate(packed, axis=1)), np.stack(codes, axis=1), np.stack(depths, axis=1)]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), b.column("x"), *(pa.array([r.tobytes() for r in m], pa.binary()) for m in rows)],
                                             names=["vec_id", "label", "x", "state", "codes", "depths"])

    return run


def _codes(column, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), parts)


def _tally(model: Model):
    """A kernel: what a task adds to the entries, as rows (kind, part, entry, place, limb, value); one set a task."""
    def run(batches):
        parts = len(model.books)
        sums: dict[tuple[int, int], tuple[int, list]] = {}
        depths = np.zeros((parts, 256), np.int64)
        for b in slices(batches, 4096):
            x, codes = integers(_vectors(b.column("x")), model.scale), _codes(b.column("codes"), parts)
            seen = _codes(b.column("depths"), parts)
            for p, (lo, hi) in enumerate(model.edges):
                depths[p] += np.bincount(seen[:, p], minlength=256)
                for e in np.unique(codes[:, p]).tolist():
                    own = x[codes[:, p] == e, lo:hi]
                    n, total = sums.get((p, e), (0, [0] * (hi - lo)))
                    sums[p, e] = (n + len(own), [a + int(v) for a, v in zip(total, own.sum(axis=0).tolist() if len(own) else [], strict=True)])
        rows = [("depth", p, int(d), 0, 0, int(depths[p, d])) for p in range(parts) for d in np.flatnonzero(depths[p])]
        for (p, e), (n, total) in sums.items():
            rows.append(("count", p, e, 0, 0, n))
            for i, v in enumerate(total):
                sign, v, limb = (-1 if v < 0 else 1), abs(v), 0
                while v:
                    rows.append(("sum", p, e, i, limb, sign * (v & ((1 << LIMB) - 1))))
                    v, limb = v >> LIMB, limb + 1
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, [pa.string(), *[pa.int32()] * 4, pa.int64()], strict=True)],
                                         names=["kind", "part", "entry", "place", "limb", "value"])

    return run


STATE = "vec_id {id}, label {label}, x {x}, state binary, codes binary, depths binary"


def _drop(spark, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Trained:
    """Coded rows (vec_id, label, code, error), a scratch table, and the final codebooks [part][entry][component]."""

    def __init__(self, rows: DataFrame, codebooks: list[list[list[int]]], list_lengths: list[list[int]]):
        self.rows, self.codebooks, self.list_lengths = rows, codebooks, list_lengths

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(v) for book in self.codebooks for entry in book for v in entry).encode()).hexdigest()


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
          vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> Trained:
    """Codebooks after ``rounds`` rounds from the parts of the ``entries`` smallest ids, and every vector's code by them."""
    spark = vectors.sparkSession
    base = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("x")).where(usable(F.col("x")))
    order = [F.asc_nulls_last("vec_id"), F.asc("x")]
    first = base.orderBy(*order).limit(1).select(F.size("x").alias("n")).collect()
    dim = first[0]["n"] if first else 0
    base = base.where(F.size("x") == dim)
    kinds = {"id": base.schema["vec_id"].dataType.simpleString(), "label": base.schema["label"].dataType.simpleString(), "x": base.schema["x"].dataType.simpleString()}
    starts = [integers(np.array(r["x"], np.float64), scale).tolist() for r in base.orderBy(*order).limit(entries).collect()]
    model = Model([[s[lo:hi] for s in starts] for lo, hi in edges(dim, parts)], dim, scale)
    state, path, lengths = base, None, []
    for k in range(rounds + 1):
        before, path = path, shared_dir(spark, f"codes-{k}")
        state.transform(mapped, _assign(model), STATE.format(**kinds)).write.parquet(path)
        state = spark.read.parquet(path)
        if before:
            _drop(spark, before)  # this round's table holds all of it
        lengths.append(model.b)
        if k == rounds:
            break
        got = state.select("x", "codes", "depths").transform(mapped, _tally(model), "kind string, part int, entry int, place int, limb int, value long") \
                   .groupBy("kind", "part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect()  # as many as the codebooks have components
        totals: dict[tuple[str, int, int, int], int] = {}
        for r in got:
            at = (r["kind"], r["part"], r["entry"], r["place"])
            totals[at] = totals.get(at, 0) + (r["value"] << LIMB * r["limb"])
        books = [[[totals.get(("sum", p, e, i), 0) // n for i in range(len(entry))] if (n := totals.get(("count", p, e, 0))) else entry
                  for e, entry in enumerate(book)] for p, book in enumerate(model.books)]
        b = model.adapted({(p, e): n for (kind, p, e, _), n in totals.items() if kind == "depth"}) if k else model.b
        model.moved = [movement(x, y) for x, y in zip(model.books, books, strict=True)]
        model.old_b, model.b, model.books = model.b, b, books

    def finish(batches):
        for b in slices(batches, 2048):
            x, codes = integers(_vectors(b.column("x")), scale), _codes(b.column("codes"), parts)
            error = np.zeros(b.num_rows, object)
            for p, (lo, hi) in enumerate(model.edges):
                part, c = _alike(x[:, lo:hi], model.books[p])
                error = error + squared(part, c[codes[:, p]]).astype(object)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array([r.tobytes().hex() for r in codes], pa.string()),
                                              pa.array([e if e < 1 << 63 else None for e in error.tolist()], pa.int64())], names=["vec_id", "label", "code", "error"])

    coded = shared_dir(spark, "codes")
    state.select("vec_id", "label", "x", "codes").transform(mapped, finish, "vec_id {id}, label {label}, code string, error long".format(**kinds)).write.parquet(coded)
    _drop(spark, path)
    return Trained(spark.read.parquet(coded), model.books, lengths)


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` (label, error, ...) with ``label_error``, the sum of the errors of its label.

    Sums are made by label before anything meets them.  Labels of more than a 1,000th of the
    rows, at most 1,000, are broadcast; the rows of all others, no label of
    which is hot, are joined by label.
    """
    n = rows.count()
    sums = rows.groupBy("label").agg(F.expr("try_cast(sum(cast(error as decimal(20, 0))) as bigint)").alias("label_error"), F.max(F.col("error").isNull()).alias("lost"), F.count("*").alias("n")) \
               .select(F.col("label").alias("of"), F.when(~F.col("lost"), F.col("label_error")).alias("label_error"), "n")
    hot = sums.where(F.col("n") * HOT_LABEL > n).select("of", "label_error")
    cold = sums.where(F.col("n") * HOT_LABEL <= n).select("of", "label_error")
    same = F.col("label").eqNullSafe(F.col("of"))
    return rows.join(F.broadcast(hot), same).drop("of").unionByName(rows.join(F.broadcast(hot), same, "left_anti").join(cold, same).drop("of"))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per vector that takes part."""
    trained = train(vectors, parts, entries, rounds, scale, vec_id, vector, label)
    return with_label_error(trained.rows).select("vec_id", "code", "error", "label_error", F.lit(trained.sha256()).alias("codebooks_sha256"))


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in SQL: a common table expression for each assignment and each codebook."""
    steps = [f"""
with kept as (
  select row_number() over (order by vec_id) as r, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
cut as materialized (select r, p, list_slice(v, (len(v) * p // {parts} + 1)::bigint, (len(v) * (p + 1) // {parts})::bigint) as x from kept, range({parts}) t(p)),
book0 as materialized (select p, (r - 1)::bigint as e, x as c from cut where r <= {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""
near{k} as materialized (
  select r, p, x, e, d from (
    select r, cut.p, x, e, d, row_number() over (partition by r, cut.p order by d, e) as nth
    from (select r, cut.p, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d from cut join book{k} using (p)) cut)
  where nth = 1)""")
        if k < rounds:
            steps.append(f"""
mean{k} as (
  select p, e, list(m order by i) as c from (
    select p, e, i, floor(sum(w)::double / count(*))::bigint as m from (select p, e, unnest(x) as w, generate_subscripts(x, 1) as i from near{k}) group by 1, 2, 3) group by 1, 2),
book{k + 1} as materialized (select p, e, coalesce(m.c, b.c) as c from book{k} b left join mean{k} m using (p, e))""")
    return ",".join(steps) + f""",
coded as (select r, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error from near{rounds} group by 1)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
       (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) from book{rounds}) as codebooks_sha256
from coded join kept using (r)
"""


ORACLE = _oracle()
