"""The operators on the driver's tables: one query opN_<name> each, over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchkit.llm import bpe, codes, dedup, html, jaccard, mixing, packing, quality, resampling, secrets, topk, toxicity, winnow
from batchkit.llm.common import read


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(read(spark, sf_dir, "documents"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.digest(read(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup(read(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(read(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(read(spark, sf_dir, "embeddings"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secrets, op2_jaccard, op3_toxicity, op4_winnowing, op5_mixing, op6_dedup, op7_quality, op8_topk, op9_bpe, op10_html,
                               op11_codes, op12_resampling, op13_packing)
}

ORACLE_SQL: dict[str, str] = {"op5_mixing": mixing.ORACLE, "op8_topk": topk.ORACLE, "op11_codes": codes.ORACLE, "op12_resampling": resampling.ORACLE}
