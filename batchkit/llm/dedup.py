"""Suffix-array deduplication: removes each byte covered by a WIDTH-byte string that also starts earlier.

A suffix array of the whole corpus by difference cover sorts every suffix several
times over; its shuffles are many times the text.  Here the same algorithm sorts
only the suffixes that can have a partner, dealt to tasks by content:

1. Each window of WIDTH bytes has an anchor, the smallest hash of its runs of GRAM
   bytes (the rightmost, if several tie).  Equal windows have equal anchors at equal
   offsets.  An anchor's context is the union of the windows that it stands for.
2. Contexts that recur are settled as a whole: all windows of any but the earliest
   are removed.  A task settles what recurs within it before the shuffle, so a text or
   passage with very many copies sends one row a task.  Anchors that occur with one
   context only have no other partner.
3. The contexts left, one of each kind, are dealt to buckets by anchor, and each
   bucket's suffixes are sorted by difference cover (:mod:`batchkit.llm.suffixes`):
   sampled triples, recursion on their names, a merge with the remaining suffixes.
   Neighbours in that order are compared over WIDTH bytes; of each run of equals all
   but the earliest start are removed.  The windows of an anchor with more than HEAVY
   contexts go to no bucket: they are settled one by one by a digest of 128 bits, as
   contexts are, first within a task and then over all, so that what very many documents
   share between different texts is one row a task.
4. Spans go back to the texts.  A document without any is digested where it is read;
   which ones may have some is told by a filter of as many bits as there are such ids.

Documents are ordered by doc_id.  Edge cases: a null text is empty; nothing is
removed from texts shorter than WIDTH; rows that share a doc_id but not their text are
documents of their own, in the order of a hash of the text, and so are rows with a null
doc_id, after all others; rows with equal id and text are one document (neither
counts as earlier, what goes from one goes from the other); very long texts are read
whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchkit.llm.common import IdFilter, Powers, mapped, mix, slices, written
from batchkit.llm.suffixes import equal_prefixes, suffix_order

WIDTH = 100
GRAM = 36
#: Contexts, or windows of heavy anchors, settled in a task at a time.
SETTLED = 1 << 20
#: Bytes of context in a bucket, about.
BUCKET_BYTES = 1 << 18
#: Buckets in a task, about.
BUCKETS_PER_TASK = 8
HEAVY = 4096
_LAST = (1 << 63) - 1
_U = np.uint64


def anchors(raw: bytes, powers: Powers, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...] | None:
    """(anchor hash, context hash, anchor place, first window, last window) of the anchors of a text; None if it has no window."""
    n = len(raw)
    if n < width:
        return None
    sums = powers.sums(np.frombuffer(raw, np.uint8))
    down = powers.down
    grams = mix((sums[gram:] - sums[:-gram]) * down[:n - gram + 1])
    w = width - gram + 1
    places, starts = _rightmost_minima(grams, w)
    ends = np.append(starts[1:], n - width + 1) - 1
    length = ends - starts + width
    context = mix((sums[ends + width] - sums[starts]) * down[starts] + (length * 1000003 + (places - starts)).astype(_U))
    return grams[places], context, places, starts, ends


def _rightmost_minima(x: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of the smallest of each window of w (the rightmost of ties), without repeats, and the first window of each."""
    n = len(x)
    step = 1 << 20
    places, first = [], []
    for at in range(0, n - w + 1, step):
        part = x[at:at + step + w - 1]
        m = len(part)
        bits = _U((1 << 21) - 1)
        keys = (part & ~bits) | (bits - np.arange(m, dtype=_U))
        blocks = -(-m // w)
        full = np.full(blocks * w, np.iinfo(np.uint64).max, _U)
        full[:m] = keys
        grid = full.reshape(blocks, w)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        low = np.minimum(behind[:m - w + 1], ahead[w - 1:m])
        where = at + (bits - (low & bits)).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        places.append(where[new])
        first.append(at + new)
    p, f = np.concatenate(places), np.concatenate(first)
    keep = np.concatenate([[True], p[1:] != p[:-1]])
    return p[keep], f[keep]


ROWS = "anchor long, context long, d long, v long, place long, first long, last long, settled boolean"


def _contexts(batches):
    """Anchors of a partition's texts; of contexts that recur within SETTLED rows all but the earliest are marked as settled."""
    powers, held, size = Powers(), [], 0

    def out():
        a, c, p, s, e, d, v = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((p, v, d, c, a))
        a, c, p, s, e, d, v = (x[order] for x in (a, c, p, s, e, d, v))
        same = np.concatenate([[False], (a[1:] == a[:-1]) & (c[1:] == c[:-1])])
        run = np.cumsum(~same) - 1
        lead = np.flatnonzero(~same)[run]
        settled = (d != d[lead]) | (v != v[lead]) | (p != p[lead])
        # what is settled needs no hashes, only the spans: those of one text that touch are one
        yield from _batches(a[~settled], c[~settled], d[~settled], v[~settled], p[~settled], s[~settled], e[~settled], np.zeros(int((~settled).sum()), bool))
        d, v, s, e = merged(d[settled], v[settled], s[settled], e[settled])
        z = np.zeros(len(d), np.int64)
        yield from _batches(z.view(_U), z.view(_U), d, v, z, s, e, np.ones(len(d), bool))

    for b in slices(batches):
        for d, v, text in zip(b.column("d").to_pylist(), b.column("v").to_pylist(), b.column("text").to_pylist(), strict=True):
            got = anchors((text or "").encode("utf-8", "surrogatepass"), powers)
            if got:
                held.append((*got, np.full(len(got[0]), d, np.int64), np.full(len(got[0]), v, np.int64)))
                size += len(got[0])
                if size > SETTLED:
                    yield from out()
                    held, size = [], 0
    if held:
        yield from out()


def _batches(a, c, d, v, p, s, e, settled, rows: int = 1 << 16):
    for i in range(0, len(d), rows):
        k = slice(i, i + rows)
        yield pa.RecordBatch.from_arrays([pa.array(a[k].view(np.int64)), pa.array(c[k].view(np.int64)), *(pa.array(x[k]) for x in (d, v, p, s, e, settled))],
                                         names=["anchor", "context", "d", "v", "place", "first", "last", "settled"])


def merged(d: np.ndarray, v: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of starts, per document (d, v) in order, those that touch or overlap as one."""
    if not len(d):
        return d, v, first, last
    order = np.lexsort((first, v, d))
    d, v, first, last = d[order], v[order], first[order], last[order]
    other = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    # the farthest end so far within the document: ends are lifted by document, so that a running maximum can't cross
    lift = np.cumsum(np.concatenate([[0], other])) * (int(last.max()) + 2)
    far = np.maximum.accumulate(last + lift) - lift
    new = np.concatenate([[True], other | (first[1:] > far[:-1] + 1)])
    starts = np.flatnonzero(new)
    return d[starts], v[starts], first[starts], np.append(far[starts[1:] - 1], far[-1])


WINDOWS = "high long, low long, d long, v long, first long, last long, settled boolean"


def _windows(batches):
    """The windows of a partition's texts in the ranges ``at``, by digest; of those that recur within about SETTLED all but the earliest are marked as settled."""
    digests, docs, versions, firsts = [], [], [], []

    def out():
        h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        d, v, start = (np.array(x, np.int64) for x in (docs, versions, firsts))
        order = np.lexsort((start, v, d, h[:, 1], h[:, 0]))
        h, d, v, start = h[order], d[order], v[order], start[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]).any(axis=1)])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        settled = (d != d[lead]) | (v != v[lead]) | (start != start[lead])
        # as in _contexts, what is settled needs no digests, only the spans
        gone = merged(d[settled], v[settled], start[settled], start[settled])
        none = np.zeros(len(gone[0]), np.int64)
        for columns, flag in (((h[~settled, 0], h[~settled, 1], d[~settled], v[~settled], start[~settled], start[~settled]), False), ((none, none, *gone), True)):
            for i in range(0, len(columns[0]), 1 << 16):
                part = [pa.array(c[i:i + (1 << 16)]) for c in columns]
                yield pa.RecordBatch.from_arrays([*part, pa.array(np.full(len(part[0]), flag))], names=["high", "low", "d", "v", "first", "last", "settled"])

    for b in slices(batches):
        for d, v, text, at in zip(*(b.column(c).to_pylist() for c in ("d", "v", "text", "at")), strict=True):
            raw = (text or "").encode("utf-8", "surrogatepass")
            for x in at:
                for s in range(x["first"], x["last"] + 1):
                    digests.append(hashlib.blake2b(raw[s:s + WIDTH], digest_size=16).digest())
                    docs.append(d)
                    versions.append(v)
                    firsts.append(s)
                if len(docs) > SETTLED:
                    yield from out()
                    digests, docs, versions, firsts = [], [], [], []
    if docs:
        yield from out()


def repeated_starts(d: np.ndarray, v: np.ndarray, first: np.ndarray, count: np.ndarray, contexts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """Ranges of starts of windows that also start earlier, among ``contexts``.

    Context i begins at byte ``first[i]`` of document (``d[i]``, ``v[i]``); its first ``count[i]`` places are the windows to judge.
    """
    sizes = np.array([len(c) + 1 for c in contexts])
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    data = np.frombuffer(b"\0".join(contexts) + b"\0" * (width + 1), np.uint8)
    n = int(sizes.sum())
    text = data[:n].astype(np.int64) + 2
    text[base + sizes - 1] = 1  # an end of a context sorts before every byte
    order = suffix_order(text, width)
    owner = np.repeat(np.arange(len(contexts)), sizes)
    offset = np.arange(n) - base[owner]
    order = order[offset[order] < count[owner[order]]]
    run = np.cumsum(np.concatenate([[True], ~equal_prefixes(data, order, width)])) - 1 if len(order) else np.zeros(0, np.int64)
    doc, version, start = d[owner[order]], v[owner[order]], first[owner[order]] + offset[order]
    by = np.lexsort((start, version, doc, run))
    run, doc, version, start = run[by], doc[by], version[by], start[by]
    lead = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))[run] if len(run) else run
    later = (doc != doc[lead]) | (version != version[lead]) | (start != start[lead])
    return merged(doc[later], version[later], start[later], start[later])


def _sorted_bucket(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    col = lambda c: np.asarray(table.column(c))
    found = repeated_starts(col("d"), col("v"), col("first"), col("count"), table.column("bytes").to_pylist())
    return pa.table({name: pa.array(x, pa.int64()) for name, x in zip(("d", "v", "first", "last"), found, strict=True)})


def _identity() -> Column:
    """Hash of a document's identity."""
    return F.xxhash64("d", "v")


def spans(docs: DataFrame) -> DataFrame:
    """(d, v, first, last): ranges of starts of windows to remove, for ``docs`` (d, v, text)."""
    rows = docs.transform(mapped, _contexts, ROWS)
    rows = written(rows, "dedup-contexts")
    settled = rows.where("settled").select("d", "v", "first", "last")
    dealt = rows.where("not settled").select("anchor", "context", "d", "v", "place", "first", "last").repartition("anchor")
    rank = F.rank().over(Window.partitionBy("anchor", "context").orderBy("d", "v", "place"))
    of_anchor = Window.partitionBy("anchor")
    dealt = dealt.withColumn("rank", rank).withColumn("kinds", F.max("context").over(of_anchor) != F.min("context").over(of_anchor))
    dealt = written(dealt.where("rank > 1 or kinds"), "dedup-recurring")
    settled = settled.unionByName(dealt.where("rank > 1").select("d", "v", "first", "last"))
    open_ = dealt.where("rank = 1 and kinds")
    total = open_.agg(F.sum(F.col("last") - F.col("first") + WIDTH)).first()[0] or 0
    buckets = max(1, total // BUCKET_BYTES)
    heavy = open_.groupBy("anchor").count().where(F.col("count") > HEAVY).select("anchor")

    def texts(contexts, name):
        """(d, v, text, at) of the documents with ``contexts``, at being those of one text."""
        at = F.struct(F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket"), "first", "last")
        wanted = written(contexts.groupBy("d", "v").agg(F.collect_list(at).alias("at")), name)
        return IdFilter(wanted.select(_identity())).maybe(docs, _identity()).join(wanted, ["d", "v"]).select("d", "v", "text", "at")

    windows = written(texts(open_.join(heavy, "anchor", "left_semi"), "dedup-heavy").transform(mapped, _windows, WINDOWS), "dedup-windows")
    rank = F.rank().over(Window.partitionBy("high", "low").orderBy("d", "v", "first"))
    again = windows.where("not settled").withColumn("rank", rank).where("rank > 1")
    settled = settled.unionByName(windows.where("settled").unionByName(again.drop("rank")).select("d", "v", "first", "last"))

    def cut(batches):
        names, kinds = ["bucket", "d", "v", "first", "count", "bytes"], [*[pa.int64()] * 5, pa.binary()]
        for b in slices(batches):
            out = []
            for d, v, text, at in zip(*(b.column(c).to_pylist() for c in ("d", "v", "text", "at")), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                out += [(x["bucket"], d, v, x["first"], x["last"] - x["first"] + 1, raw[x["first"]:x["last"] + WIDTH]) for x in at]
            for i in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i:i + 20_000], strict=True), kinds, strict=True)], names=names)

    sorted_ = texts(open_.join(heavy, "anchor", "left_anti"), "dedup-wanted").transform(mapped, cut, "bucket long, d long, v long, first long, count long, bytes binary") \
                   .repartition(int(max(1, buckets // BUCKETS_PER_TASK)), "bucket").groupBy("bucket").applyInArrow(_sorted_bucket, "d long, v long, first long, last long")
    return written(settled.unionByName(sorted_), "dedup-spans")


def removed_runs(ranges: list[tuple[int, int]], n: int, width: int = WIDTH) -> list[tuple[int, int]]:
    """Runs of bytes (start, end) covered by the windows that start in ``ranges``, within a text of n bytes."""
    out: list[list[int]] = []
    for a, z in sorted(ranges):
        a, z = min(a, n), min(z + width, n)
        if a >= z:
            continue
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def identified(base: DataFrame) -> DataFrame:
    """``base`` (d, text, ...) with v, so that (d, v) names a document: 0 where d has one text only, else a hash of the text.

    Ids with several texts are found by one aggregate of hashes; a filter of them tells
    which rows need theirs, and a row that passes it for no reason does no harm.
    """
    own = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    several = written(base.groupBy("d").agg(F.min(own).alias("low"), F.max(own).alias("high")).where("low <> high").select("d"), "dedup-repeated")
    repeated = IdFilter(several.select(F.xxhash64("d")))
    return repeated.without(base, F.xxhash64("d")).withColumn("v", F.lit(0).cast("long")).unionByName(repeated.maybe(base, F.xxhash64("d")).withColumn("v", own))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``."""
    kind = docs.schema[doc_id].dataType.simpleString()
    base = identified(docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("d"), F.col(text).alias("text")))
    found = spans(base.select("d", "v", "text"))
    ranges = written(found.groupBy("d", "v").agg(F.collect_list(F.struct("first", "last")).alias("ranges")), "dedup-ranges")  # of one text
    concerned = IdFilter(ranges.select(_identity()))
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    zero = F.lit(0).cast("long")
    clean = concerned.without(base, _identity()).select("id", F.octet_length(raw).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(raw, 256).alias("kept_sha256"))
    rest = concerned.maybe(base, _identity()).join(ranges, ["d", "v"], "left").select("id", "text", "ranges")

    def cut(batches):
        for b in slices(batches):
            out = []
            for i, t, ranges in zip(b.column("id"), b.column("text").to_pylist(), b.column("ranges").to_pylist(), strict=True):
                data = (t or "").encode("utf-8", "surrogatepass")
                runs = removed_runs([(x["first"], x["last"]) for x in ranges or []], len(data))
                out.append((i.as_py(), len(data), sum(z - a for a, z in runs), len(runs), hashlib.sha256(kept_bytes(data, runs)).hexdigest()))
            if out:
                c = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c[0], b.column("id").type), *(pa.array(x, pa.int64()) for x in c[1:4]), pa.array(c[4])], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    cut_ = rest.transform(mapped, cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return clean.unionByName(cut_).withColumnRenamed("id", doc_id)


def kept_bytes(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    """``data`` without the runs."""
    at, out = 0, []
    for a, z in runs:
        out.append(data[at:a])
        at = z
    return b"".join([*out, data[at:]])
