"""N-gram Jaccard join with several global token orders.

A document's set holds the hashes of its distinct runs of five words; two documents
link when their sets' Jaccard likeness reaches a threshold.  Under any global order
of tokens, two such sets share a token among the first ``n - ceil(t n) + 1`` of each,
so a pair is a candidate only if it does so under each of ORDERS orders.  All orders
put rare tokens first (by a sketch of fixed size that counts every set of the corpus)
and break ties by different hashes.

More than that: with a prefix longer by k - 1 tokens, two such sets share k prefix
tokens; k grows with the set (:func:`shared`).

1. Equal sets fall together first: a set is known by a 64-bit hash of its tokens
   (two different sets of a corpus of 10**10 meet with a chance of a few, and then only as
   a false equality), and all that follows concerns distinct sets.
2. For each prefix token of the first order that several sets have, the smallest of
   them is the pivot; a set with enough such tokens is a member of the clusters of
   their pivots.  Two sets that share a token share a cluster, so the
   clusters replace the pairs: their size is linear in the prefixes.  Postings of heavy
   tokens, as the sketch tells, are salted.
3. Sets without such company are done.  The others give memberships under the further
   orders too; a set without company under any of them is done.  Until then only
   prefixes and ids have moved; now the sets that are left are dealt to their clusters.
4. In each cluster a central set is compared with all others, and every set that isn't
   linked to it with all sets that it isn't yet connected to, if the pair also shares a
   cluster under each further order (the intersected filters) and by length may link.
   Only links that join parts leave the task, fewer than it has sets.
   Clusters beyond CLUSTER_TOKENS are cut into blocks.  A central set of one block goes
   to all of them, and each block is compared like a cluster.  What that connects to the
   central set is connected from then on; the sets that it leaves open are compared with
   each other and with the connected ones by pairs of blocks, and no two blocks of
   connected sets meet.  So the data moved grow with the cluster and, beyond that, only
   with the share of it that is left open.
5. Connected components over the links, then the smallest id of each.

Every pair of different sets that links is compared or already connected, so no link
between classes is lost; copies are never expanded.

Edge cases: a text of fewer than five words is one token, its whole sequence; a null,
empty or blank text has an empty set and is alone; repeated rows and equal texts are
one class; a null id links as any other, but isn't a component's smallest id (a
component of null ids only has a null id); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchkit.llm.common import SKETCH, IdFilter, WordHashes, as_long, component_min, mapped, mix, shingle_hashes, sketch_levels, sketch_rows, slices, written

WORDS = 5
#: Least likeness, in hundredths.
THRESHOLD = 80
ORDERS = 3
#: Prefix tokens that linked sets share under each order: this many, and one more for every SHARED_STEP tokens beyond.
#: (Sets that must have fewer in common, those of 3 and less, link with sets of their own size only.)
SHARED, SHARED_STEP = 4, 10
SKETCH_BITS = 22
#: Tokens in a cluster, or in a block of a larger one.
CLUSTER_TOKENS = 1_000_000
#: Rows of a heavy token's postings in one salt, about.
SALT_ROWS = 1 << 15
_U = np.uint64


def shared(n: int, threshold: int = THRESHOLD) -> int:
    """How many tokens of their prefixes two linked sets share, the smaller of which has n."""
    return max(min(SHARED, -(-threshold * n // 100)), n // SHARED_STEP)


def needed(n: Column, threshold: int = THRESHOLD) -> Column:
    """:func:`shared` of the smallest set that one of n can link to, as a Column."""
    part = lambda x: F.call_function("div", threshold * x + 99, F.lit(100))
    least = part(n)
    return F.greatest(F.least(F.lit(SHARED), part(least)), F.call_function("div", least, F.lit(SHARED_STEP)))


def prefix_length(n: int, threshold: int = THRESHOLD) -> int:
    return n - -(-threshold * n // 100) + shared(n, threshold)


def _sid(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes())).astype(np.int64))


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> _U(64 - SKETCH_BITS)).astype(np.int64)


def prefix(tokens: np.ndarray, levels: np.ndarray, order: int, threshold: int = THRESHOLD) -> np.ndarray:
    """The first tokens of a set under an order: rare before common, ties by a hash of the order's own.

    Further orders see coarser classes of rarity, and so differ more than by their ties.
    """
    rarity = (levels[_bucket(tokens)] >> (2 * order)).astype(_U)
    key = (rarity << _U(56)) | (mix(tokens + _U(0x9E3779B97F4A7C15 * (order + 1) % (1 << 64))) >> _U(8))
    return tokens[np.argsort(key, kind="stable")[:prefix_length(len(tokens), threshold)]]


def _shingled(texts: list[str | None], hashes: WordHashes, words: int):
    return (shingle_hashes(h, words) for h, _ in hashes.many(texts))


def sets(docs: DataFrame, kind: str, words: int = WORDS) -> DataFrame:
    """(id, n, sid) per row, and in rows of their own (chunk, counts) the sketch of token frequencies over each task's distinct sets."""
    def run(batches):
        hashes, seen = WordHashes(), set()
        counts, pending = np.zeros(1 << SKETCH_BITS, np.uint32), []
        id_type = None

        def add():
            if pending:
                np.add(counts, np.bincount(np.concatenate(pending), minlength=len(counts)).astype(np.uint32), out=counts)
                pending.clear()

        for b in slices(batches):
            id_type = b.column("id").type
            n, sid = [], []
            for t in _shingled(b.column("text").to_pylist(), hashes, words):
                n.append(len(t))
                sid.append(_sid(t) if len(t) else None)
                if len(t) and sid[-1] not in seen:
                    seen.add(sid[-1])
                    pending.append(_bucket(t))
            if sum(map(len, pending)) > 1 << 20:
                add()
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names=["id", "n", "sid", "chunk", "counts"])
        add()
        if id_type is not None:
            s = sketch_rows(counts)
            m = s.num_rows
            yield pa.RecordBatch.from_arrays([pa.nulls(m, id_type), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), s.column(0), s.column(1)], names=["id", "n", "sid", "chunk", "counts"])

    return docs.transform(mapped, run, f"id {kind}, n long, sid long, {SKETCH}")


def _salts(levels: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """How many salts each token's postings are dealt to: 1 but for heavy tokens."""
    return np.maximum(1, np.exp2(levels[_bucket(tokens)] / 4.0) / SALT_ROWS).astype(np.int64)


def _emit(found: list[tuple[int, int, np.ndarray]], levels: np.ndarray):
    """Postings of (sid, size of the set, prefix): salts count from 0 for heavy tokens; below 0 they keep the smallest sets apart by size."""
    if not found:
        return
    tokens = np.concatenate([p for _, _, p in found])
    lengths = [len(p) for _, _, p in found]
    sid = np.repeat(np.array([s for s, _, _ in found], np.int64), lengths)
    kind = np.repeat(np.array([-min(n, SHARED) for _, n, _ in found]), lengths)
    salts = _salts(levels, tokens)
    salt = np.where((salts > 1) & (kind == -SHARED), (mix(sid.view(_U)) % salts.astype(_U)).astype(np.int64), kind)
    yield pa.RecordBatch.from_arrays([pa.array(as_long(tokens)), pa.array(salt.astype(np.int32)), pa.array(sid)], names=["token", "salt", "sid"])


POSTINGS = "token long, salt int, sid long"


def members(postings: DataFrame, sizes: DataFrame, name: str) -> DataFrame:
    """(sid, pivots): each set that shares enough prefix tokens with others, with those tokens' pivots.

    One shuffle of the postings; what only one set has is dropped after it.  ``sizes`` is (sid, n).
    """
    group = Window.partitionBy("token", "salt")
    held = postings.withColumn("repeat", F.lag("sid").over(group.orderBy("sid")) == F.col("sid")) \
                   .withColumn("low", F.min("sid").over(group)).withColumn("high", F.max("sid").over(group)) \
                   .where("not coalesce(repeat, false) and (salt >= 0 or low <> high)")
    held = written(held.select(F.when(F.col("salt") >= 0, F.col("token")).alias("token"), "salt", "sid", "low"), f"{name}-shared")
    heavy = held.where("salt >= 0")
    of_token = heavy.groupBy("token").agg(F.min("low").alias("pivot"), F.max("sid").alias("high")).where("pivot <> high")
    both = held.where("salt < 0").select("sid", F.col("low").alias("pivot")).unionByName(heavy.join(of_token, "token").select("sid", "pivot"))
    per = both.groupBy("sid", "pivot").agg(F.count("*").alias("tokens"))
    per = per.groupBy("sid").agg(F.collect_list("pivot").alias("pivots"), F.sum("tokens").alias("tokens"))  # fewer pivots than the set has prefix tokens
    return written(per.join(sizes, "sid").where(F.col("tokens") >= needed(F.col("n"))).select("sid", "pivots"), name)


def _overlaps(tokens: np.ndarray, index: tuple[np.ndarray, np.ndarray], rows: int) -> np.ndarray:
    """How many of ``tokens`` each row of the index holds."""
    keys, owner = index
    low, high = np.searchsorted(keys, tokens, "left"), np.searchsorted(keys, tokens, "right")
    sizes = high - low
    if not sizes.sum():
        return np.zeros(rows, np.int64)
    at = np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    return np.bincount(owner[at], minlength=rows)


def _index(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    order = np.argsort(keys, kind="stable")
    return keys[order], owner[order]


def forest(sids: np.ndarray, tokens: list[np.ndarray], side: np.ndarray | None, further: list[list[np.ndarray]], centre: int | None = None, threshold: int = THRESHOLD) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that connect the sets as all their links would, and a label per set, equal where these connect; with ``side``, only links between rows of side 0 and 1.

    ``centre`` is the row that is compared first, else a central one.
    """
    m = len(sids)
    if m < 2:
        return [], np.zeros(m, np.int64)
    n = np.array([len(t) for t in tokens])
    index, filters = _index(tokens), [_index(f) for f in further]
    label, out = np.arange(m), []

    def link(u: int) -> None:
        ok = (label != label[u]) & (100 * np.minimum(n, n[u]) >= threshold * np.maximum(n, n[u]))
        if side is not None:
            ok &= side != side[u]
        for lists, f in zip(further, filters, strict=True):
            if not ok.any():
                return
            ok &= _overlaps(lists[u], f, m) > 0
        if not ok.any():
            return
        common = _overlaps(tokens[u], index, m)
        ok &= 100 * common >= threshold * (n + n[u] - common)
        at = np.flatnonzero(ok)
        for c, first in zip(*np.unique(label[at], return_index=True), strict=True):
            out.append((int(sids[u]), int(sids[at[first]])))
            label[label == c] = label[u]

    if centre is None:
        centre = central(index, n)
    link(centre)
    rest = np.flatnonzero(label != label[centre])
    if side is not None:  # no link within a side was looked for, so rows linked to the centre may lack others still
        rest = np.flatnonzero(side == (2 * side.sum() < m))  # the side of fewer rows: each meets all of the other
    for u in rest:
        if (label == label[u]).all():
            break
        link(int(u))
    return out, label


def central(index: tuple[np.ndarray, np.ndarray], n: np.ndarray) -> int:
    """The set whose tokens are the most common ones in the cluster, which links to the most others."""
    starts = np.flatnonzero(np.diff(index[0], prepend=index[0][0] - 1))
    df = np.repeat(np.diff(np.append(starts, len(index[0]))), np.diff(np.append(starts, len(index[0]))))
    return int(np.argmax(np.bincount(index[1], weights=df, minlength=len(n)) / n))


def _centre(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    tokens = [np.asarray(x.values) for x in table.column("tokens")]
    k = central(_index(tokens), np.array([len(t) for t in tokens]))
    return pa.table({"pivot": table.column("pivot")[k:k + 1], "centre": table.column("sid")[k:k + 1]})


EDGES = "pivot long, a long, b long"


def _cluster(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    lists = lambda name: [np.asarray(x.values) for x in table.column(name)]
    further = [lists(c) for c in table.column_names if c.startswith("pivots")]
    side = None if i == j else (np.asarray(table.column("block")) == j).astype(np.int8)
    sids, centre = np.asarray(table.column("sid")), table.column("centre")[0].as_py()
    at = None if centre is None else int(np.flatnonzero(sids == centre)[0])
    edges, label = forest(sids, lists("tokens"), side, further, at)
    left = [] if at is None else sids[label != label[at]].tolist()  # with no b
    return pa.table({"pivot": pa.array([table.column("pivot")[0].as_py()] * (len(edges) + len(left)), pa.int64()),
                     "a": pa.array([a for a, _ in edges] + left, pa.int64()), "b": pa.array([b for _, b in edges] + [None] * len(left), pa.int64())})


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, cluster_tokens: int = CLUSTER_TOKENS) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``."""
    sc = docs.sparkSession.sparkContext
    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    both = written(sets(source, kind, words), "jaccard-sets")
    rows = both.where("chunk is null").select("id", "n", "sid")
    shared_levels = sc.broadcast(sketch_levels(both.where("chunk is not null").select("chunk", "counts"), SKETCH_BITS))

    def first_order(batches):
        hashes, seen, levels = WordHashes(), set(), shared_levels.value
        for b in slices(batches):
            found = []
            for tokens in _shingled(b.column("text").to_pylist(), hashes, words):
                if len(tokens) and (sid := _sid(tokens)) not in seen:
                    seen.add(sid)
                    found.append((sid, len(tokens), prefix(tokens, levels, 0)))
            yield from _emit(found, levels)

    sizes = rows.where("sid is not null").groupBy("sid").agg(F.first("n").alias("n"))
    first = members(source.select("text").transform(mapped, first_order, POSTINGS), sizes, "jaccard-first")
    company = first.select("sid")

    # one document of each set with company; a filter of their ids spares the others' texts
    chosen = rows.where("sid is not null").groupBy("sid").agg(F.min("id").alias("id")).join(company, "sid", "left_semi")

    hashed = F.xxhash64("id")  # of a null id, which many rows may have, as well
    chosen = written(chosen.select(hashed.alias("h")), "jaccard-chosen")

    def full_sets(batches):
        hashes, seen = WordHashes(), set()
        for b in slices(batches):
            found = []
            for tokens in _shingled(b.column("text").to_pylist(), hashes, words):
                if len(tokens) and (sid := _sid(tokens)) not in seen:
                    seen.add(sid)
                    found.append((sid, as_long(tokens)))
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in found], pa.int64()), pa.array([len(t) for _, t in found], pa.int64()), pa.array([t for _, t in found], pa.list_(pa.int64()))], names=["sid", "n", "tokens"])

    # a set may come twice, by an id that repeats or whose hash meets another's; the steps that follow allow for it
    candidates = IdFilter(chosen).maybe(source.select("id", "text"), hashed).select("text").transform(mapped, full_sets, "sid long, n long, tokens array<bigint>")
    candidates = written(candidates, "jaccard-candidates")

    kept = first.withColumnRenamed("pivots", "pivots0")
    for order in range(1, ORDERS):
        def postings(batches, order=order):
            levels = shared_levels.value
            for b in batches:
                yield from _emit([(s, len(t.values), prefix(np.asarray(t.values).view(_U), levels, order)) for s, t in zip(b.column("sid").to_pylist(), b.column("tokens"), strict=True)], levels)

        more = members(candidates.select("sid", "tokens").transform(mapped, postings, POSTINGS), sizes, f"jaccard-order{order}")
        kept = kept.join(more.withColumnRenamed("pivots", f"pivots{order}"), "sid")
    kept = written(kept.join(sizes, "sid"), "jaccard-kept")

    # clusters of two and more, cut into blocks by the number of their tokens
    clusters = kept.select(F.explode("pivots0").alias("pivot"), "sid", "n")
    blocks = clusters.groupBy("pivot").agg(F.count("*").alias("m"), F.ceil(F.sum("n") / cluster_tokens).cast("int").alias("blocks")).where("m > 1").drop("m")
    dealt = lambda c, k: F.pmod(F.xxhash64(c), k).cast("int")
    placed = clusters.join(blocks, "pivot").withColumn("block", dealt("sid", F.col("blocks")))
    placed = written(placed.select("pivot", "sid", "n", "block", "blocks"), "jaccard-clusters")
    # only the sets that a cluster needs move; again a filter tells which these may be
    needed_sets = IdFilter(placed.select(F.xxhash64("sid").alias("h")).distinct()).maybe(candidates.select("sid", "tokens"), F.xxhash64("sid"))

    def compared(cells: DataFrame) -> DataFrame:
        full = cells.select("pivot", "sid", "block", "i", "j", "centre").join(kept.drop("pivots0", "n"), "sid").join(needed_sets, "sid")
        return full.groupBy("pivot", "i", "j").applyInArrow(_cluster, EDGES)

    no_centre = F.lit(None).cast("long")
    wide = placed.where("blocks > 1")
    if wide.isEmpty():
        edges = compared(placed.withColumns({"i": F.col("block"), "j": F.col("block"), "centre": no_centre}))
    else:
        least = wide.groupBy("pivot").agg(F.min("block").alias("block"))
        one = wide.join(least, ["pivot", "block"]).join(needed_sets, "sid").select("pivot", "sid", "tokens")
        centres = written(one.groupBy("pivot").applyInArrow(_centre, "pivot long, centre long"), "jaccard-centres")  # a row for every wide cluster
        copies = wide.join(centres, "pivot").where("sid = centre").withColumn("home", F.col("block")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("block <> home")
        cells = placed.select("pivot", "sid", "block").join(centres, "pivot", "left").unionByName(copies.select("pivot", "sid", "block", "centre"))
        found = written(compared(cells.withColumns({"i": F.col("block"), "j": F.col("block")})), "jaccard-found")
        # what a block leaves open may link to a set of any other block
        left = found.where("b is null").select("pivot", F.col("a").alias("sid"), F.lit(True).alias("open")).distinct()
        again = written(wide.join(left.select("pivot").distinct(), "pivot", "left_semi").join(left, ["pivot", "sid"], "left").select("pivot", "sid", "n", F.coalesce("open", F.lit(False)).alias("open")), "jaccard-open")
        parts = lambda c: F.coalesce(F.ceil(F.sum(F.when(c, F.col("n"))) / cluster_tokens), F.lit(0)).cast("int")
        again = again.join(again.groupBy("pivot").agg(parts(F.col("open")).alias("r"), parts(~F.col("open")).alias("c")), "pivot")
        again = again.withColumn("block", F.when(F.col("open"), dealt("sid", F.col("r"))).otherwise(F.col("r") + dealt("sid", F.col("c")))) \
                     .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("r") - 1 + F.when(F.col("open"), F.col("c")).otherwise(0))))
        again = again.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other"), "centre": no_centre})
        edges = found.where("b is not null").unionByName(compared(again))
    edges = edges.select("a", "b")
    roots = component_min(edges, "jaccard-components")

    # the smallest id of each class, then of each component
    smallest = rows.where("sid is not null").groupBy("sid").agg(F.min("id").alias("low"))
    rooted = smallest.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    named = written(rooted.select("sid", "root", "low"), "jaccard-classes")
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    of_class = named.join(lowest, "root").select("sid", "component_id")
    out = rows.join(of_class, "sid", "left")
    return out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.when(F.col("sid").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that are the smallest id of their component.

    Of repeated rows (id and text) one stays; rows with a null id, which no decision can name, all stay.
    Most texts don't move: a filter tells which ids may be concerned.
    """
    found = written(join(docs, doc_id, text).select(F.col(doc_id).alias("id"), "component_id"), "jaccard-decisions")
    gone = found.where("id <> component_id").select("id").distinct()
    repeated = found.where("id is not null").groupBy("id").count().where("count > 1").select("id")
    concerned = IdFilter(written(gone.union(repeated).select(F.xxhash64("id").alias("h")), "jaccard-concerned"))
    # rows travel as one column, so that no name of theirs can clash
    marked = docs.select(F.col(doc_id).alias("id"), F.struct("*").alias("row"))
    hashed = F.when(F.col("id").isNotNull(), F.xxhash64("id"))
    still = concerned.without(marked, hashed)
    rest = concerned.maybe(marked, hashed).join(gone, "id", "left_anti").withColumn("t", F.md5(F.col(f"row.`{text}`"))).dropDuplicates(["id", "t"]).drop("t")
    return still.select("row.*").unionByName(rest.select("row.*"))
