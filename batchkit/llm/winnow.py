"""Document fingerprints by winnowing.

Every run of K code points gets a rolling hash; from each window of W hashes the
smallest is chosen, the rightmost one if several tie, and its position is kept.
Two texts that share a run of ``W + K - 1`` code points therefore share a chosen
hash, and no match shorter than K is ever reported.

A fingerprint is a string: per chosen gram the step from the position before and
the hash, as ``step.hash`` in base 16, comma-joined.  Likeness is the share of
common hashes among all distinct hashes of two fingerprints.

Edge cases: null and empty texts have an empty fingerprint, two of which are alike
(1.0) while an empty and a filled one are not (0.0); a text of fewer than K code
points is hashed as one gram; equal texts have equal fingerprints; very long
texts are hashed in overlapping pieces of bounded size, with the same result.

:func:`edited_neighbours` puts each document beside the next one in descending
order of doc_id (nulls last, rows of one id by their text) without sorting
everything in one task: ids are cut into ranges, and the first document of each
range is also sent to the range before it.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchkit.llm.common import mapped, mix, slices

K = 20
W = 80
#: Grams hashed at a time.
PIECE = 1 << 16
#: Bits of a gram's place within a piece, below its hash.
_PLACE = np.uint64(PIECE * 2 - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.cumprod(out)


_POWERS = _powers(_BASE, PIECE * 2 + K + W)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), PIECE * 2 + K + W)


def gram_hashes(codes: np.ndarray, k: int = K) -> np.ndarray:
    """Rolling hash of every run of k codes: differences of a running polynomial, brought to the same power."""
    n = len(codes)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum((codes.astype(_U) + _U(1)) * _POWERS[:n])])
    return mix((sums[k:] - sums[:-k]) * _INVERSE[:n - k + 1])


def _window_minima(keys: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of w keys, from running minima inside blocks of w."""
    n = len(keys)
    blocks = -(-n // w)
    full = np.full(blocks * w, np.iinfo(np.uint64).max, _U)
    full[:n] = keys
    grid = full.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def winnow(text: str | None, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes): the chosen grams of a text, hashes of 40 bits."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) == 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    k = min(k, len(codes))
    places, chosen, grams = [], [], len(codes) - k + 1
    width = min(w, grams)
    for at in range(0, grams - width + 1, PIECE):
        part = gram_hashes(codes[at:min(len(codes), at + PIECE + width - 1 + k - 1)], k) >> _U(24)
        # the place counts down in the low bits, so that the smallest key is the smallest hash at its rightmost place
        keys = (part << _U(24)) | (_PLACE - np.arange(len(part), dtype=_U))
        low = _window_minima(keys, width)
        low = low[np.concatenate([[True], low[1:] != low[:-1]])]
        places.append(at + (_PLACE - (low & _U((1 << 24) - 1))).astype(np.int64))
        chosen.append(low >> _U(24))
    position, first = np.unique(np.concatenate(places), return_index=True)
    return position, np.concatenate(chosen)[first]


def as_text(print_: tuple[np.ndarray, np.ndarray]) -> str:
    position, hashes = print_
    steps = np.diff(position, prepend=0).tolist()
    return ",".join([f"{a:x}.{b:x}" for a, b in zip(steps, hashes.tolist(), strict=True)])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Common hashes over all distinct hashes; 1.0 for two empty fingerprints."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    common = len(a) + len(b) - len(np.union1d(a, b))
    return common / (len(a) + len(b) - common)


def fingerprints(docs: DataFrame, text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """``docs`` with columns positions array<long> and hashes array<long>; no shuffle."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", positions array<bigint>, hashes array<bigint>"

    def run(batches):
        for b in slices(batches):
            found = [winnow(x, k, w) for x in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([p for p, _ in found], pa.list_(pa.int64())), pa.array([h.astype(np.int64) for _, h in found], pa.list_(pa.int64()))],
                                             names=[*b.schema.names, "positions", "hashes"])

    return docs.transform(mapped, run, schema)


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as many (or all) of ``following``."""
    m = len(text) // 2
    return text[:len(text) - m] + following[:m]


def neighbour_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """(range, own, id, text): every document in its range of ids, and as a row with own = false the document that follows the range.

    The first of each range is found by a grouped maximum; what reaches the
    driver is one id per range.
    """
    spark = docs.sparkSession
    ranges = ranges or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    base = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cuts = base.select(F.percentile_approx("id", [i / ranges for i in range(1, ranges)] or [0.5], 10_000).alias("c")).first()["c"] or []
    # range 0 holds the nulls, then ids up to the first cut, and so on
    above = F.size(F.filter(_longs(sorted(set(cuts))), lambda c: c < F.col("id")))
    rows = base.withColumn("range", F.when(F.col("id").isNull(), 0).otherwise(above + 1)).withColumn("own", F.lit(True))
    heads = {r["range"]: r["top"] for r in rows.groupBy("range").agg(F.max("id").alias("top")).collect()}
    used = sorted(heads)
    if not used:
        return rows.select("range", "own", "id", "text")
    # descending order: after a range comes the next used one below, and after the lowest the highest
    before = {b: used[(i + 1) % len(used)] for i, b in enumerate(used)}
    top = _longs([heads.get(b) for b in range(used[-1] + 1)])
    to = _longs([before.get(b) for b in range(used[-1] + 1)])
    first = F.col("id").isNull() | (F.col("id") == F.get(top, F.col("range")))
    extra = rows.where(first).withColumn("range", F.get(to, F.col("range")).cast("int")).withColumn("own", F.lit(False))
    return rows.unionByName(extra).select("range", "own", "id", "text")


def _longs(values: list[int | None]):
    """An array of numbers that the plan holds as one literal."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def edited_neighbours(docs: DataFrame, kernel, schema: str, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Runs ``kernel(id, text, next_text)`` for each document and the one that follows it in descending doc_id (after the last: the first).

    ``kernel`` is made once per task by calling it without arguments and returns a tuple of the columns in ``schema``.
    """
    names = [x.split()[0] for x in schema.split(",")]
    rows = neighbour_rows(docs, doc_id, text, ranges)
    n = ranges or max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartition(n, "range").sortWithinPartitions("range", F.desc("own"), F.desc_nulls_last("id"), "text")
    arrow = pa.schema([pa.field(x, t) for x, t in zip(names, _arrow_types(schema), strict=True)])

    def run(batches):
        work, out = kernel(), []
        held = None  # (range, id, text) waiting for its successor
        for b in slices(batches):
            for r, own, i, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and held[0] == r:
                    out.append(work(held[1], held[2], t))
                # of the rows that follow the range only the first counts
                held = (r, i, t) if own else None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)
                out = []

    return dealt.transform(mapped, run, schema)


def _arrow_types(schema: str) -> list[pa.DataType]:
    kinds = {"long": pa.int64(), "bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
    return [kinds[x.split()[1]] for x in schema.split(",")]


DIGEST = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _digest_kernel():
    cache: list = []  # the next document's fingerprint is used again as its own

    def work(i, text, following):
        a = next((f for t, f in cache if t == text), None)
        a = a if a is not None else winnow(text)
        b = winnow(following)
        cache[:] = [(following, b)]
        e = edited(text, following)
        c = winnow(e)
        return (i, len(text), hashlib.sha256(e.encode()).hexdigest(), as_text(a), as_text(c), likeness(a[1], c[1]), likeness(a[1], b[1]))

    return work


def digest(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and their likeness to one another and to the next document's."""
    return edited_neighbours(docs, _digest_kernel, DIGEST)
