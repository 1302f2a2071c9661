"""The corpus pipeline: quality, near-duplicates, secrets, mixture, tokens.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns the columns of ``documents``; the last returns token ids.

1. quality: documents that the classifier rejects go.
2. near_duplicates: of each component of the n-gram Jaccard join the document with
   the smallest id stays.
3. secrets: every span that the scan finds is replaced by a mark; n_chars follows.
4. mixture: a document appears once for each time that the mixture takes it, whole
   also where the budget ends within it; one that isn't taken goes.
5. tokens: (doc_id, n_tokens, ids, decoded_sha256) of the whole text.

SQL can't express the classifier, the components or the encoding, so ORACLE_SQL is
None and tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchkit.llm import bpe, jaccard, mixing, quality, secrets
from batchkit.llm.common import read, written
from batchkit.llm.toxicity import sample_for


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels")
    return quality.accepted(docs, quality.train(sample_for(docs, labels, "quality", rows=quality.TRAIN_ROWS)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = secrets.redact(docs, secrets.train(secrets.samples(docs)))
    return done.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, carry=tuple(docs.columns)).where("taken > 0")
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), times))).select(*[F.col(f"carried.`{c}`").alias(c) for c in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.tokens(docs)


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("secrets", redact_secrets),
          ("mixture", mix_sources), ("tokens", encode_tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each one's result written and read again."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
