"""Queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumenweb.llm import ann, bpe, packing, quality, qualityrules, sharding, simhash, suffixdedup, toxicity, urlfilter
from lumenweb.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digests(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_suffixdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.digests(table(spark, sf_dir, "documents"))


def op7_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_qualityrules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualityrules.verdicts(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_sharding, op2_simhash, op3_packing, op4_bpe, op5_quality, op6_suffixdedup, op7_urlfilter, op8_ann, op9_toxicity, op10_qualityrules)}

#: None of these has an equivalent in SQL that runs on whole tables; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {}
