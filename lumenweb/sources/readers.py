"""Reading domain lists, crawl rows, samples, registrars, taxonomies. Schemas are given, so nothing is read to infer them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenweb import schemas
from lumenweb.operators import labels, registrars
from lumenweb.operators.domains import normalize


def sniff_separator(spark: SparkSession, path: str) -> str:
    """A bar if the first line has one, else a comma."""
    first = spark.read.text(path).limit(1).collect()
    return "|" if first and "|" in first[0]["value"] else ","


def domain_list(spark: SparkSession, path: str, extra: str = "", separator: str = ",", chunks: bool = False) -> DataFrame:
    """Domains of one CSV file or a folder of them, normalized; extra: further columns as DDL. Files of chunks are left out unless asked for."""
    schema = schemas.DOMAIN_LIST + (f", {extra}" if extra else "")
    df = spark.read.option("header", True).option("sep", separator).option("enforceSchema", False).schema(schema).csv(path).withColumn("file", F.col("_metadata.file_name"))
    return normalize(df if chunks else df.where(~F.col("file").rlike(r"chunk\.\d+\.csv$")))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Crawl rows of JSON files; rows that can't be read are dropped, unknown keys too."""
    return spark.read.schema(schemas.CRAWL).option("mode", "DROPMALFORMED").json(path)


def documents_multiline(spark: SparkSession, path: str) -> DataFrame:
    """The same, where a file is one JSON array or object."""
    return spark.read.schema(schemas.CRAWL).option("multiLine", True).json(path)


def samples(spark: SparkSession, path: str) -> DataFrame:
    """Labelled samples: a file is a list, or an object with ``results`` whose categorisation is flattened."""
    envelope = f"{schemas.SAMPLES}, results array<struct<{schemas.SAMPLES}>>"
    raw = spark.read.schema(envelope).option("multiLine", True).json(path)
    plain = raw.where("results is null").drop("results")
    wrapped = raw.where("results is not null").select(F.inline("results"))
    return shape_samples(plain.unionByName(wrapped))


def shape_samples(raw: DataFrame) -> DataFrame:
    """Pairs of label and user split, categorisation flattened, screenshots by their file names."""
    part = lambda c, i: F.transform(c, lambda x: F.get(x, F.lit(i)))
    out = raw.withColumns({"user_name": part("user_choices", 1), "user_comments_name": part("user_comments", 1), "ss_filename": F.substring_index("ss_filename", "/", -1)})
    out = out.withColumns({"user_choices": part("user_choices", 0), "user_comments": part("user_comments", 0)})
    return out.select("*", "categorisation.*").drop("categorisation")


def legacy_samples(raw: DataFrame) -> DataFrame:
    """Samples of the first set: their text under its later name, trivial texts dropped."""
    out = raw.withColumnRenamed("clean_text", "html_text")
    return out.where(~F.coalesce(labels.is_trivial_text(F.col("html_text")), F.lit(False)))


def all_samples(current: DataFrame, legacy: DataFrame) -> DataFrame:
    return current.unionByName(legacy_samples(legacy), allowMissingColumns=True)


def registrar_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("encoding", "ISO-8859-1").schema(schemas.REGISTRARS).csv(path)


def registrar_lines(spark: SparkSession, path: str) -> DataFrame:
    """(domain, file) of text files with a domain in a line."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    return lines.select(registrars.domain_of_line(F.col("value")).alias("domain"), "file").where("domain is not null")


def taxonomy(spark: SparkSession, path: str) -> DataFrame:
    from lumenweb.operators.taxonomy import SCHEMA

    return spark.read.option("header", True).schema(SCHEMA).csv(path)


def translations_tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("sep", "\t").csv(path)


def output_files(spark: SparkSession, path: str) -> DataFrame:
    """The final tables of a folder: not the debugging ones, not the temporary ones."""
    df = spark.read.option("header", True).csv(path).withColumn("filename", F.col("_metadata.file_name"))
    return df.where(is_final(F.col("filename")))


def is_final(name):
    return F.contains(name, F.lit("final_")) & ~F.contains(name, F.lit("_DEBUG")) & ~F.contains(name, F.lit("_tempo"))


def stored(spark: SparkSession, source: str, date: str | None = None, jdbc: dict | None = None) -> DataFrame:
    """The warehouse table: Parquet partitioned by date, or a database. The date prunes partitions, or goes into the database's query."""
    df = spark.read.format("jdbc").options(dbtable=source, **jdbc).load() if jdbc else spark.read.parquet(source)
    return df.where(F.col("date") == F.lit(date).cast("date")) if date else df
