"""Writing final tables, documents, registrars, samples and the warehouse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lumenweb.functions.fixed import LIMITS
from lumenweb.operators import output, registrars


def csv(df: DataFrame, path: str, separator: str = ",", rows_per_file: int = 0, mode: str = "overwrite") -> None:
    """rows_per_file: files of at most so many rows."""
    flat = df.select(*[F.to_json(c).alias(c) if kind.startswith(("array", "struct", "map")) else F.col(c) for c, kind in df.dtypes])
    flat.write.mode(mode).option("header", True).option("sep", separator).option("maxRecordsPerFile", rows_per_file).csv(path)


def final_table(df: DataFrame, path: str, separator: str = ",") -> None:
    csv(output.final_format(df, separator), path, separator)


def chunks(df: DataFrame, path: str, size: int = LIMITS["chunk"]) -> None:
    csv(df, path, rows_per_file=size)


def documents(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def sample_artefacts(df: DataFrame, path: str) -> None:
    """Pages, texts and results of what was sampled."""
    df.where(F.coalesce(F.col("to_sample"), F.lit(False))).write.mode("overwrite").json(path)


def registrar_table(rows: DataFrame, path: str) -> None:
    csv(registrars.collapse(rows), path)


def registrar_lines(domains: DataFrame, path: str) -> None:
    """A folder for each last label, with a domain in a line."""
    registrars.by_last_label(domains.select("domain").distinct()).write.mode("overwrite").partitionBy("last_label").text(path)


def append_new(rows: DataFrame, path: str) -> int:
    """Adds what isn't stored yet, partitioned by date; returns how many. Running it again adds nothing. Only the dates of rows are read back."""
    spark = rows.sparkSession
    rows = rows.persist()
    try:
        days = [r["date"] for r in rows.select("date").distinct().collect()]  # the days of one load
        new = output.new_rows(rows, spark.read.parquet(path).where(F.col("date").isin(days))).persist()
    except AnalysisException:  # nothing is stored yet
        new = rows
    n = new.count()
    if n:
        new.write.mode("append").partitionBy("date").parquet(path)
    new.unpersist()
    rows.unpersist()
    return n


def create_table(spark: SparkSession, name: str, version: int | None = None) -> None:
    """The warehouse table of a version, partitioned by date; an older one gets the columns that it lacks."""
    schema = output.warehouse_schema(version) if version else output.warehouse_schema()
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema if f.name != "date")
        spark.sql(f"CREATE TABLE {name} ({columns}, date date) USING parquet PARTITIONED BY (date)")
        return
    have = {c.lower() for c in spark.table(name).columns}
    missing = [f"{f.name} {f.dataType.simpleString()}" for f in schema if f.name.lower() not in have]
    if missing:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(missing)})")


def run_script(spark: SparkSession, script: str) -> int:
    """Each statement of a script; returns how many there were."""
    statements = [s.strip() for s in script.split(";") if s.strip()]
    for s in statements:
        spark.sql(s)
    return len(statements)


def load(final: DataFrame, path: str, filename: str | Column, date: Column) -> int:
    """A final table into the warehouse, once."""
    return append_new(output.warehouse_rows(final, filename, date), path)
