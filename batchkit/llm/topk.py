"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

A vector is a sparse row of (term, weight): its dimensions whose integer weight
isn't 0.  Queries go to the candidates, a round of them at a time: a round has a stated
number of components, so it may be broadcast, and its number of rounds grows with
the query set.  In a round every task packs its candidates, as it reads them, into blocks
of postings (for each term the slots and weights); each query scatters ``query
weight x posting weight`` into a dense array of scores over the block's slots, and the K
best of the block are selected by partition and merged with the task's best so
far.  Only these lists, K rows a query and task, are shuffled and merged.

Nothing but blocks of bounded size is ever held and no candidate moves: the work is the
stated query set against all rows.

Edge cases: vectors that are null or hold a null or non-finite component take no
part; empty vectors have no terms and score 0; vectors of different length meet in
their common dimensions; ties go to the smaller id; rows with one id are separate
candidates of each other's queries only under another id; a null id takes no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchkit.llm.common import mapped, written

K = 5
#: Vectors in a block of candidates.
BLOCK_ROWS = 4096
#: Components of the queries of a round, about (32 MB).
ROUND_COMPONENTS = 1 << 22


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as a long; null where a vector takes no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def _blocks(batches, rows: int):
    """Vectors of a partition as blocks (ids, vectors)."""
    ids, vectors = [], []
    for b in batches:
        for i, v in zip(b.column("id").to_pylist(), b.column("v"), strict=True):
            ids.append(i)
            vectors.append(np.asarray(v.values, np.int64))
            if len(ids) >= rows:
                yield np.array(ids, np.int64), vectors
                ids, vectors = [], []
    if ids:
        yield np.array(ids, np.int64), vectors


def postings(vectors: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each term the slots that hold it and their weights."""
    sizes = [len(v) for v in vectors]
    slot = np.repeat(np.arange(len(vectors)), sizes)
    term = np.concatenate([np.arange(n) for n in sizes]) if sizes else np.zeros(0, np.int64)
    weight = np.concatenate(vectors) if vectors else np.zeros(0, np.int64)
    order = np.argsort(term, kind="stable")
    order = order[weight[order] != 0]
    cut = np.flatnonzero(np.diff(term[order], prepend=-1))
    return {int(term[order[a]]): (slot[order[a:b]], weight[order[a:b]]) for a, b in zip(cut, [*cut[1:], len(order)], strict=True)}


def accumulate(query: np.ndarray, lists: dict, slots: int) -> np.ndarray:
    """Scores of one query over all slots, a term at a time."""
    scores = np.zeros(slots, np.int64)
    for term in np.flatnonzero(query):
        if (held := lists.get(int(term))) is not None:
            at, weight = held
            scores[at] += query[term] * weight  # a slot holds a term once
    return scores


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id: a partition, then a sort of what reaches the k-th score."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def search(vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", vector: str = "embedding",
           block_rows: int = BLOCK_ROWS, round_components: int = ROUND_COMPONENTS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best among all other ids."""
    spark = vectors.sparkSession
    base = vectors.select(F.col(vec_id).cast("long").alias("id"), quantised(F.col(vector)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where("id is not null and v is not null")
    wanted = base.where("q").agg(F.sum(F.size("v") + 1).alias("n")).first()["n"] or 0
    rounds = max(1, -(-wanted // round_components))
    queries = base.where("q").select("id", "v").withColumn("round", F.pmod(F.monotonically_increasing_id(), F.lit(rounds)))
    if rounds > 1:
        queries = written(queries, "topk-queries")  # a row keeps its round
    found = None
    for r in range(rounds):
        got = queries.where(F.col("round") == r).select("id", "v").toArrow()  # a round's components
        shared = spark.sparkContext.broadcast((got.column("id").to_numpy(), [np.asarray(v.values, np.int64) for v in got.column("v")]))
        part = base.select("id", "v").transform(mapped, _scored(shared, k, block_rows), "query_id long, vec_id long, score long")
        if rounds > 1:
            part = written(part.withColumn("_r", F.row_number().over(_order())).where(F.col("_r") <= k).drop("_r"), "topk-round")
        found = part if found is None else found.unionByName(part)
    return found.withColumn("rank", F.row_number().over(_order())).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _order():
    return Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")


def _scored(shared, k: int, block_rows: int):
    """A kernel: a task's candidates to the k best of each query among them."""
    def run(batches):
        qids, rows = shared.value
        tops = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(qids)  # (ids, scores) so far
        for ids, vectors in _blocks(batches, block_rows):
            lists = postings(vectors)
            for i, (qid, own) in enumerate(zip(qids.tolist(), rows, strict=True)):
                scores = accumulate(own, lists, len(ids))
                others = np.flatnonzero(ids != qid)
                top = others[best(scores[others], ids[others], k)]
                held, seen = np.concatenate([tops[i][0], ids[top]]), np.concatenate([tops[i][1], scores[top]])
                at = best(seen, held, k)
                tops[i] = held[at], seen[at]
        if len(qids):
            sizes = [len(t[0]) for t in tops]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qids, sizes).astype(np.int64)), *(pa.array(np.concatenate([t[j] for t in tops])) for j in (0, 1))],
                                             names=["query_id", "vec_id", "score"])

    return run


ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
t as (select vec_id, generate_subscripts(v, 1) as d, unnest(v) as w from v),
s as (
  select q.vec_id as query_id, c.vec_id, sum(q.w * c.w)::bigint as score
  from t q join t c on q.d = c.d and q.vec_id <> c.vec_id where q.vec_id % 50 = 0 group by 1, 2)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 5
"""
