"""Bronze, Silver, Quarantine and Gold layers (P1-P3, P5, P6, F1, D1, A1) and their Parquet sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.functions import columns as C


def bronze(jobs: DataFrame) -> DataFrame:
    """All rows with their partition values."""
    return jobs.withColumns({"p_source": C.partition_source(F.col("source")), "p_week": C.iso_week(F.col("run_id"))})


def gate_reason() -> Column:
    """the first rule that a row fails, or null."""
    def blank(c: str) -> Column:
        return F.trim(C.text(F.col(c))) == ""

    key = C.company_key(F.col("company"))
    return (
        F.when(blank("url"), "missing_url").when(blank("company"), "missing_company").when(blank("title"), "missing_title")
        .when(key.isin(*C.PLACEHOLDERS), "placeholder_company").when(~F.col("url").rlike("^https?://"), "malformed_url").when(F.col("url").contains("google.com/search"), "search_fallback_url")
    )


def gated(rows: DataFrame) -> DataFrame:
    """Each row's quarantine reason; of valid rows with one company, title and source the first by id has none.

    The reason is computed before the window, and invalid rows take their id into the key: they neither take a first place
    nor meet in one task, however many there are.
    """
    reason = gate_reason()
    lower = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit("none"))))
    keyed = rows.withColumn("_reason", reason).withColumn("_spread", F.when(F.col("_reason").isNotNull(), F.col("id")))
    first = F.row_number().over(Window.partitionBy("_spread", C.company_key(F.col("company")), lower("title"), lower("source")).orderBy("id"))
    return keyed.withColumn("quarantine_reason", F.coalesce("_reason", F.when(first > 1, "duplicate_grain"))).drop("_reason", "_spread")


def silver(rows: DataFrame) -> DataFrame:
    return gated(rows).where("quarantine_reason IS NULL").drop("quarantine_reason")


def quarantine(rows: DataFrame) -> DataFrame:
    return gated(rows).where("quarantine_reason IS NOT NULL")


def gold(silver_rows: DataFrame) -> DataFrame:
    """A1: totals per company and track."""
    outcome = F.lower(C.text(F.col("outcome")))
    track = F.upper(F.coalesce(F.when(F.col("resume_type") != "", F.col("resume_type")), F.lit("UNKNOWN")))
    grouped = silver_rows.groupBy(C.company_key(F.col("company")).alias("company_key"), track.alias("resume_track")).agg(
        F.count(F.lit(1)).alias("total_postings"), F.count_if(outcome == "valid").alias("valid_postings"), F.count_if(outcome == "discarded").alias("discarded_postings"),
        F.count_if(C.is_sponsored(F.col("sponsorship")) == 1).alias("sponsorship_yes"), F.count_if(C.is_remote_lake(F.col("remote")) == 1).alias("remote_count"),
        F.array_sort(F.collect_set(F.when(F.col("source") != "", F.col("source")))).alias("_sources"),
    )
    return grouped.select("*", F.array_join("_sources", ",").alias("sources"), F.size("_sources").cast("long").alias("source_count"), C.valid_rate(F.col("valid_postings"), F.col("valid_postings") + F.col("discarded_postings")).alias("valid_rate")).drop("_sources")


def conformed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a declared schema by name; missing ones and failed casts are null, unknown ones are an error."""
    if unknown := set(rows.columns) - set(schema.names):
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    return rows.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def write_layer(rows: DataFrame, path: str, *partition_by: str) -> int:
    """K1, K2: writes a layer, replacing only the partitions at hand, so an empty input changes nothing. Gives the row count.

    The count comes with the write itself (an observation), not from a second pass.
    """
    from pyspark.sql import Observation

    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return seen.get["n"]


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A layer with its partition values as text columns; files of different age are merged by name."""
    rows = spark.read.option("mergeSchema", True).option("basePath", path).parquet(path)
    return rows.select(*[F.col(f.name).cast("string").alias(f.name) if f.name.startswith("p_") else F.col(f.name) for f in rows.schema])


def read_jobs(jobs: DataFrame, week: str | None = None) -> DataFrame:
    """The job fact, of one ISO week if asked."""
    rows = bronze(jobs)
    return rows if week is None else rows.where(F.col("p_week") == week)


def backfill_week(rows: DataFrame, other_weeks: DataFrame) -> DataFrame:
    """Silver of one week without rows whose grain another week already holds."""
    def grain(df: DataFrame) -> DataFrame:
        return df.select(C.company_key(F.col("company")).alias("_c"), F.lower(F.trim(C.text(F.col("title")))).alias("_t"), F.lower(F.trim(F.coalesce("source", F.lit("none")))).alias("_s"))

    return silver(rows).withColumns({"_c": C.company_key(F.col("company")), "_t": F.lower(F.trim(C.text(F.col("title")))), "_s": F.lower(F.trim(F.coalesce("source", F.lit("none"))))}).join(grain(other_weeks).distinct(), ["_c", "_t", "_s"], "left_anti").drop("_c", "_t", "_s")
