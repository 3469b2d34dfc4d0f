"""Defaults, column orders and final formatting; what goes to the warehouse, and how it gets there once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenweb.functions import urls
from lumenweb.functions.fixed import BOOLEAN_DEFAULTS, FINAL_ORDER, INTERMEDIATE_ORDER, WAREHOUSE_COLUMNS, WAREHOUSE_VERSIONS
from lumenweb.operators.category import with_categories
from lumenweb.operators.common import true

SAMPLE_FILES = ("ss_filename", "raw_filename", "clean_filename", "json_filename")


def is_digits(value: Column) -> Column:
    return F.coalesce(value.cast("string").rlike(r"^[0-9]+\z"), F.lit(False))


def fill_defaults(df: DataFrame) -> DataFrame:
    """Truth values and word counts of columns that are there, where they are null."""
    have = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in BOOLEAN_DEFAULTS.items() if c in df.columns}
    return df.withColumns(have | {c: F.coalesce(F.col(c), F.lit(0)) for c in df.columns if c.startswith("ml_feat_")})


def read_flag(value: Column) -> Column:
    """True, False and null from the spellings that a CSV round trip leaves."""
    text = value.cast("string")
    return F.when(text.isin("true", "True", "TRUE"), True).when(text.isin("false", "False", "FALSE"), False)


def interpret_flags(df: DataFrame) -> DataFrame:
    """All truth values typed and defaulted, those that are missing too; word counts as numbers."""
    flags = {c: F.coalesce(read_flag(F.col(c)), F.lit(v)) if c in df.columns else F.lit(v) for c, v in BOOLEAN_DEFAULTS.items()}
    counts = {c: F.coalesce(F.when(is_digits(F.col(c)), F.col(c).cast("string")).try_cast("int"), F.lit(0)) for c in df.columns if c.startswith("ml_feat_")}
    return df.withColumns(flags | counts)


def order_columns(df: DataFrame, first: list[str] = INTERMEDIATE_ORDER) -> DataFrame:
    """The expected columns first, null where they are missing, then the rest."""
    have = {c.lower(): c for c in df.columns}
    known = [F.col(have[c.lower()]).alias(c) if c.lower() in have else F.lit(None).cast("string").alias(c) for c in first]
    taken = {c.lower() for c in first}
    return df.select(*known, *[c for c in df.columns if c.lower() not in taken])


def final_format(df: DataFrame, delimiter: str = ",") -> DataFrame:
    """Categories, tld, input and final url, and the final column order."""
    out = with_categories(df).withColumns({"tld": urls.tld(F.col("url")), "input_url": F.col("url"), "final_url": urls.final_url(F.col("url"), F.col("target_url"), delimiter), "target_url": urls.final_url(F.col("target_url"), F.col("target_url"), delimiter)})
    return order_columns(out, FINAL_ORDER)


def empty_to_null(value: Column) -> Column:
    return F.nullif(value.cast("string"), F.lit(""))


def sample_files(url: Column, date: Column, folder: str = "output/sampling") -> dict[str, Column]:
    day = F.date_format(date, "yyyy-MM-dd")
    kinds = {"ss_filename": ("ss", "png"), "raw_filename": ("raw", "txt"), "clean_filename": ("clean", "txt"), "json_filename": ("resu", "json")}
    return {c: F.concat(F.lit(folder + "/"), urls.file_name(url), F.lit(f".{k}."), day, F.lit("." + ext)) for c, (k, ext) in kinds.items()}


def warehouse_rows(final: DataFrame, filename: str | Column, date: Column) -> DataFrame:
    """The columns that the warehouse takes, one row for each input_url of a file; no sample files for what isn't sampled."""
    name = filename if isinstance(filename, Column) else F.lit(filename)
    have = {c.lower() for c in final.columns}
    sampled = true(read_flag(F.col("to_sample"))) if "to_sample" in have else F.lit(False)
    columns = {c: empty_to_null(F.col(c)) if c.lower() in have else F.lit(None).cast("string") for c in WAREHOUSE_COLUMNS}
    columns |= {c: F.when(sampled, columns[c]) for c in SAMPLE_FILES} | {"to_sample": sampled}
    rows = final.select(date.cast("date").alias("date"), name.alias("filename"), *[v.alias(c) for c, v in columns.items()])
    return rows.dropDuplicates(["date", "filename", "input_url"])


def new_rows(rows: DataFrame, stored: DataFrame, keys: tuple[str, ...] = ("date", "filename", "input_url")) -> DataFrame:
    """Rows whose key isn't stored: what an insert that leaves conflicts alone would add."""
    return rows.join(stored.select(*keys), list(keys), "left_anti").select(*rows.columns)


def update_rows(stored: DataFrame, changes: DataFrame, columns: tuple[str, ...] = ("all_status_codes", "comment"), keys: tuple[str, ...] = ("filename", "input_url")) -> DataFrame:
    """stored with the columns of changes where a key matches, null included; of several changes the largest."""
    latest = changes.groupBy(*keys).agg(F.max(F.struct(*columns)).alias("_new"))
    out = stored.join(latest, list(keys), "left")
    there = F.col("_new").isNotNull()
    return out.withColumns({c: F.when(there, F.col("_new")[c]).otherwise(F.col(c)) for c in columns}).select(*stored.columns)


def matching_file(stored: DataFrame, fingerprint: str) -> DataFrame:
    """The first file name, in the alphabet, that ends with the fingerprint."""
    return stored.where(F.col("filename").endswith(fingerprint)).agg(F.min("filename").alias("filename"))


def warehouse_schema(version: int = len(WAREHOUSE_VERSIONS)) -> T.StructType:
    """The table's columns after so many migrations."""
    names = [c for v in WAREHOUSE_VERSIONS[:version] for c in v]
    kinds = {"date": T.DateType(), "to_sample": T.BooleanType()}
    return T.StructType([T.StructField(c, kinds.get(c, T.StringType()), c not in ("filename", "input_url", "final_url")) for c in names])


def migrate(df: DataFrame, version: int = len(WAREHOUSE_VERSIONS)) -> DataFrame:
    """A table of an older version with the columns that later ones added."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in warehouse_schema(version)])


def sample(df: DataFrame, date: str, quantity: int, seed: int = 0) -> DataFrame:
    """quantity rows of a date, the same ones for the same seed: a top-k of hashes, not a sort of all rows."""
    return df.where(F.col("date") == F.lit(date).cast("date")).orderBy(F.xxhash64(F.lit(seed), "filename", "input_url"), "input_url").limit(quantity)


def sampled(url: Column, rate: float, seed: int = 0) -> Column:
    """Whether a url is in the sample: the same answer in every run and task."""
    return F.pmod(F.xxhash64(F.lit(seed), url), F.lit(1_000_000)) < int(rate * 1_000_000)
