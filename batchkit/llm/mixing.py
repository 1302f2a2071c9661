"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

A document's key is an exponential variate divided by its quality weight,
``-ln(u) / weight``; the smallest keys of a source are a weighted sample without
replacement.  Within a source documents are sorted by key and their sizes summed
up to the source's budget.  A budget beyond the source's size first takes whole
epochs (every document once each), then the rest by key; the document at which the
budget ends is counted in part, so a source's words sum to its target, rounded down.

No source is sorted in one task: keys fall into BINS ranges, the sizes of the ranges
are summed first, and the running sum inside a range starts from the sum before it.

Edge cases: a null text has size 0; null sources form one source, the last; sources
of size 0 have target 0; repeated rows are separate rows that tie, in any order, with
the same total; an empty table gives an empty result; ``u`` comes from a digest of
the id, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchkit.llm.common import WORD, written

WEIGHTS = (1, 2, 3)
#: No source gives more than this many times its size.
MAX_EPOCHS = 3
BINS = 4096
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 for plain text, less the more of its characters are neither letters, digits nor white space; at least 0.1."""
    signs = F.length(F.regexp_replace(text, r"[\p{L}\p{N}\x20\x09-\x0D]+", ""))
    return F.coalesce(F.greatest(F.lit(0.1), F.lit(1.0) - F.try_divide(F.lit(2.0) * signs, F.length(text))), F.lit(0.1))


def sampling_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """-ln(u) / weight with u in (0, 1) from 48 bits of a digest of the id."""
    bits = F.conv(F.substring(F.md5(F.encode(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))), "UTF-8")), 1, 12), 16, 10)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 48)) / weight


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size) with target: shares of the sum of all sizes by weight, none above ``cap`` sizes.

    Sources are few beside documents, so the order by code point and the shares
    are windows over that small table.  With sources in order of cap / weight, the
    common level is the largest of what would be left per unit of weight if all
    sources before were at their cap.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * cap)
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) \
         .withColumn("shares", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    level = F.max(F.col("left").cast("double") / F.col("shares").cast("double")).over(everything)
    return s.select("source", "source_size", F.least(F.col("weight") * level, F.col("cap").cast("double")).alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", carry: tuple[str, ...] = (),
        weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_EPOCHS, bins: int = BINS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, epochs) and the columns in ``carry`` (as one struct), per row of ``docs``."""
    weight = quality_weight(F.col(text))
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                       sampling_key(F.col(doc_id), weight, seed).alias("key"), F.struct(F.lit(0).alias("_"), *carry).alias("carried"))
    # a null source as a key of its own; a range of keys of a source, which expects
    # 6 even shares of the documents at most, also if all have the least weight
    base = base.withColumn("sk", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source")))) \
               .withColumn("bin", F.least(F.lit(bins - 1), F.floor(F.col("key") / (1 + F.col("key")) * bins)).cast("int"))
    base = written(base, "mix")
    ranges = written(base.groupBy("sk", "bin").agg(F.sum("size").alias("bin_size"), F.first("source").alias("source")), "mix-ranges")
    sizes = ranges.groupBy("sk").agg(F.sum("bin_size").alias("source_size"), F.first("source").alias("source"))
    goal = targets(sizes.select("source", "source_size"), weights, cap)
    goal = goal.withColumn("sk", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source")))).drop("source")
    earlier = Window.partitionBy("sk").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("start", F.coalesce(F.sum("bin_size").over(earlier), F.lit(0))).select("sk", "bin", "start").join(goal, "sk")
    within = Window.partitionBy("sk", "bin").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    out = base.join(starts, ["sk", "bin"]).withColumn("before", F.col("start") + F.sum("size").over(within) - F.col("size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.try_divide(F.col("target"), F.col("source_size")))).otherwise(0).cast("long")
    out = out.withColumn("epochs", epochs).withColumn("budget", F.floor("target") - F.col("epochs") * F.col("source_size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("before")))
    return out.withColumn("taken", (F.col("epochs") * F.col("size") + part).cast("long")) \
              .select("doc_id", "source", "size", "source_size", "target", "taken", "epochs", *(["carried"] if carry else []))


ORACLE = r"""
with base as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '')), 1, 12))::ubigint::double + 0.5) / 281474976710656.0)
         / coalesce(greatest(0.1::double, 1.0::double - 2.0::double * length(regexp_replace(text, '[\p{L}\p{N}\x20\x09-\x0D]+', '', 'g'))::double / nullif(length(text), 0)), 0.1::double) as key
  from documents),
sizes as (select source, sum(size)::bigint as source_size from base group by source),
weighted as (select *, 1 + (row_number() over (order by source nulls last) - 1) % 3 as weight, 3 * source_size as cap from sizes),
filling as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over earlier, 0))::double / (sum(weight) over () - coalesce(sum(weight) over earlier, 0))::double as level
  from weighted window earlier as (order by cap::double / weight::double, source nulls last rows between unbounded preceding and 1 preceding)),
goals as (select source, source_size, least(weight * max(level) over (), cap::double) as target from filling),
ordered as (
  select b.doc_id, b.size, g.source_size, g.target, case when g.source_size > 0 then floor(g.target / g.source_size)::bigint else 0 end as epochs,
         (sum(b.size) over (partition by b.source order by b.key, b.doc_id, b.size rows between unbounded preceding and current row) - b.size)::bigint as before
  from base b join goals g on b.source is not distinct from g.source)
select doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target)::bigint - epochs * source_size - before)))::bigint as taken
from ordered
"""
