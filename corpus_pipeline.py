"""A training corpus in five stages: toxic documents go, then junk, then near-duplicates, then repeated passages; what is left is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame: all but the last one documents' columns, the last one the
pieces' places. A stage keeps every row that it doesn't reject, with all its columns; nulls, repeated rows and empty
tables follow the operators' own rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenweb.llm import packing, qualityrules, simhash, suffixdedup, toxicity
from lumenweb.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"), out="_toxicity")
    return scored.where(F.col("_toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def drop_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return qualityrules.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffixdedup.dedup(docs, removed="_removed", spans="_spans")
    return cut.withColumn("n_chars", F.when(F.col("_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_junk), ("simhash_near_dedup", drop_near_duplicates), ("suffix_array_dedup", cut_repeats), ("best_fit_packing", pack)]

#: Fingerprints, suffix arrays and tokenizers aren't SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
