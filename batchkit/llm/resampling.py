"""Target-distribution importance resampling with bit-sliced weights.

Features are runs of words, hashed to buckets.  All documents and all target texts
are counted by bucket, which gives a bucket's gain: the logarithm of how much
likelier it is in the target, as an integer.  A document's weight is the mean gain of
its features.  It is computed on bit slices: the document's bucket counts become
planes of one bit a bucket, each is ANDed with each plane of the gains (two's
complement, so the top plane counts negatively), and the bits that are set, times
the powers of two of both planes, add up to the exact sum.

Documents are drawn without replacement by Gumbel keys: weight plus noise made of
the id, the highest scores first.

Edge cases: null and empty texts have no features and weight 0; a null id counts as an
empty text where the noise is made and comes after all ids in ties; rows of one id
and score are ranked in an arbitrary order; other columns are ignored, so clashing
names do no harm; with no target texts or no documents all gains are defined (the
counts are smoothed); an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchkit.llm.common import mapped, slices, written
from batchkit.operators.sorting import with_position

BUCKETS = 10_000
#: Longest run of words that is a feature.
LONGEST = 1
SCALE = 1000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
#: Documents whose planes are made at a time.
PLANE_ROWS = 128

#: A-Z to a-z; digits, letters and all bytes beyond ASCII stay; any other byte ends a word.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def features(words: list[bytes], longest: int = LONGEST) -> list[bytes]:
    """All runs of 1 to ``longest`` consecutive words, joined by one space."""
    out = list(words)
    for k in range(2, longest + 1):
        out += map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
    return out


def buckets_of(found: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, found), np.int64, len(found)) % buckets


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n) over all rows: added up in each task, then by Spark."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in slices(batches):
            for t in b.column(0).to_pylist():
                total += np.bincount(buckets_of(features(words_of(t), longest), buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    return texts.select(F.col(text).alias("text")).transform(mapped, run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS, scale: int = SCALE) -> np.ndarray:
    """floor(scale * ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket, from two tables of at most ``buckets`` rows."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, into in ((source, s), (target, t)):
        for r in counts.collect():  # one row a bucket
            into[r["bucket"]] = r["n"]
    of_s, of_t = s.sum() + buckets, t.sum() + buckets
    return np.array([math.floor(scale * math.log((b + 1) * of_s / ((a + 1) * of_t))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words."""
    packed = np.packbits(bits, axis=-1)
    short = -packed.shape[-1] % 8
    return np.ascontiguousarray(np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, short)])).view(np.uint64)


def gain_planes(gain: np.ndarray) -> np.ndarray:
    """Bit planes of the gains in two's complement, lowest first; the last is the sign."""
    width = int(np.abs(gain).max(initial=0)).bit_length() + 1
    return np.stack([_packed((gain >> j & 1).astype(bool)) for j in range(width)])


def weighted_sums(counts: np.ndarray, planes: np.ndarray) -> list[int]:
    """Sum of count times gain over the buckets, for each row of ``counts``, by AND and popcount of planes."""
    total = [0] * len(counts)
    top = len(planes) - 1
    for i in range(int(counts.max(initial=0)).bit_length()):
        plane = _packed((counts >> i & 1).astype(bool))
        for j, signed in enumerate(planes):
            ones = np.bitwise_count(plane & signed).sum(axis=1, dtype=np.int64).tolist()
            factor = -(1 << (i + j)) if j == top else 1 << (i + j)
            total = [a + factor * b for a, b in zip(total, ones, strict=True)]
    return total


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of each document's features, 0 without any."""
    shared = docs.sparkSession.sparkContext.broadcast((gain_planes(gain), len(gain)))
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        planes, buckets = shared.value
        for b in slices(batches, PLANE_ROWS):
            listed = [words_of(t) for t in b.column("text").to_pylist()]
            found = [buckets_of(features(w, longest), buckets) for w in listed]
            sizes = np.array([len(x) for x in found], np.int64)
            at = np.repeat(np.arange(len(found)) * buckets, sizes) + np.concatenate([np.zeros(0, np.int64), *found])
            counts = np.bincount(at, minlength=len(found) * buckets).reshape(len(found), buckets)
            weights = [s // n if n else 0 for s, n in zip(weighted_sums(counts, planes), sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([len(w) for w in listed], pa.int64()), pa.array(sizes), pa.array(weights, pa.int64())],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")) \
               .transform(mapped, run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column | str, seed: int = SEED, scale: int = SCALE) -> Column:
    """floor(-scale * ln(-ln(u))) with u of the first 32 bits of sha256("seed:id")."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0)))


def draw(scored: DataFrame, eligible: Column, percent: int = PERCENT) -> DataFrame:
    """``scored`` (doc_id, score, row and more) with ``rank``: 1, 2, 3... for the floor(percent * N / 100) highest scores of the N eligible rows.

    The histogram of the scores, which are integers within some ten thousands, gives
    the lowest score drawn; only rows from that score on are sorted, by range.
    ``row`` tells rows of one id and score apart, so that none of them forms a hot range.
    """
    able = scored.where(eligible)
    levels = sorted(((r["score"], r["n"]) for r in able.groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted = percent * sum(n for _, n in levels) // 100
    least, held = None, 0
    for score, n in levels:
        if held >= wanted:
            break
        least, held = score, held + n
    if least is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    near = eligible & (F.col("score") >= least)
    ranked = with_position(scored.where(near), [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")], "rank") \
        .withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return ranked.unionByName(scored.where(~near).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS, longest: int = LONGEST,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) per document; rank is null for documents that aren't drawn."""
    gain = gains(bucket_counts(docs, text, buckets, longest), bucket_counts(target, text, buckets, longest), buckets)
    weighed = weigh(docs, gain, longest, doc_id, text).withColumn("score", F.col("weight") + noise("doc_id", seed)).withColumn("row", F.monotonically_increasing_id())
    return draw(written(weighed, "resampling-scored"), F.col("n_words") >= min_words, percent).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = r"""
with recursive bits(i, k, c) as (
  select i, 0, i from range(256) t(i)
  union all
  select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from bits where k < 8),
steps as (select i, c from bits where k = 8),
found as (
  select 0 as part, doc_id as id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from documents
  union all
  select 1, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) from benchmark),
tally as (select part, id, w, count(*) as n from found group by 1, 2, 3),
crc(w, h, pos, c) as (
  select w, hex(encode(w)), 0, 4294967295::bigint from (select distinct w from tally)
  union all
  select w, h, pos + 1, xor(crc.c >> 8, steps.c)
  from crc join steps on steps.i = xor(crc.c & 255, ('0x' || substr(h, 2 * pos + 1, 2))::bigint) where 2 * pos < length(h)),
hashed as (select w, xor(c, 4294967295) % 10000 as bucket from crc where 2 * pos = length(h)),
spread as (select part, id, bucket, sum(n)::bigint as n from tally join hashed using (w) group by 1, 2, 3),
totals as (
  select b as bucket, coalesce(sum(n) filter (part = 0), 0)::bigint as s, coalesce(sum(n) filter (part = 1), 0)::bigint as t
  from range(10000) r(b) left join spread on bucket = b group by 1),
gain as (
  select bucket, floor(1000 * ln((t + 1)::double * ((sum(s) over ())::double + 10000) / ((s + 1)::double * ((sum(t) over ())::double + 10000))))::bigint as g from totals),
sums as (select id, sum(n)::bigint as n_features, sum(n * g)::bigint as total from spread join gain using (bucket) where part = 0 group by 1),
scored as (
  select d.doc_id, coalesce(n_features, 0)::bigint as n_features, coalesce(floor(total::double / n_features), 0)::bigint as weight,
         coalesce(floor(total::double / n_features), 0)::bigint
         + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id::varchar), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from documents d left join sums on id = d.doc_id),
ranked as (select doc_id, row_number() over (order by score desc, doc_id) as rank from scored where n_features >= 20)
select s.doc_id, s.n_features, s.weight, s.score,
       case when r.rank <= (select count(*) * 10 // 100 from ranked) then r.rank end::bigint as rank
from scored s left join ranked r on r.doc_id = s.doc_id
"""
