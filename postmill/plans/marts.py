"""Company, weekly, source and rejection marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postmill.functions import columns as C
from postmill.operators import layers
from postmill.plans.registry import query, sql_rate
from postmill.sources import tables


def staged_jobs(silver: DataFrame) -> DataFrame:
    """P11."""
    return silver.where("url IS NOT NULL").select(
        F.col("id").cast("long").alias("job_id_pk"), "url", F.col("company").alias("company_raw"), C.company_key_single(F.col("company")).alias("company_key"), "title", "location", "source", "outcome",
        F.coalesce(F.nullif("resume_type", F.lit("")), F.lit("UNKNOWN")).alias("resume_track"), "job_type", "remote", "sponsorship", "run_id", "p_source", "p_week",
        C.is_sponsored(F.col("sponsorship")).alias("is_sponsored"), C.is_remote_lake(F.col("remote")).alias("is_remote"),
    )


def staged_quarantine(quarantine: DataFrame) -> DataFrame:
    """P12."""
    return quarantine.select(F.col("id").cast("long").alias("job_id_pk"), "url", F.col("company").alias("company_raw"), "title", "source", "p_source", "run_id", "quarantine_reason", C.reason_family(F.col("quarantine_reason")).alias("reason_family"))


def dim_company(jobs: DataFrame, longest_name: bool = False) -> DataFrame:
    """A2. The display name is the largest by code point, or the longest if asked (T4)."""
    name = F.max_by("company_raw", F.struct(F.length("company_raw"), F.col("company_raw"))) if longest_name else F.max("company_raw")
    found = jobs.groupBy("company_key").agg(
        name.alias("company_display"), F.count(F.lit(1)).alias("total_postings"), F.count_distinct("source").alias("source_count"), F.count_distinct("resume_track").alias("track_count"),
        F.count_if(F.col("outcome") == "valid").alias("valid_postings"), F.count_if(F.col("outcome") == "discarded").alias("discarded_postings"),
        F.sum("is_sponsored").alias("sponsored_postings"), F.sum("is_remote").alias("remote_postings"),
    )
    rate = C.valid_rate(F.col("valid_postings"), F.col("valid_postings") + F.col("discarded_postings"))
    return found.select("*", rate.alias("valid_rate"), C.valid_rate(F.col("sponsored_postings"), F.col("total_postings")).alias("sponsorship_rate"), ((F.col("total_postings") >= 20) & (rate < 0.05)).alias("is_fetch_waste"))


def weekly_ingest(jobs: DataFrame, since: str | None = None) -> DataFrame:
    """A3; of the weeks from `since` on (K7)."""
    rows = jobs.where("p_week <> 'unknown'")
    rows = rows if since is None else rows.where(F.col("p_week") >= since)
    return rows.groupBy("p_week", "p_source").agg(
        F.count(F.lit(1)).alias("postings"), F.count_distinct("company_key").alias("companies"), F.count_if(F.col("outcome") == "valid").alias("valid_postings"), F.sum("is_sponsored").alias("sponsored_postings"),
    ).withColumn("valid_rate", C.valid_rate(F.col("valid_postings"), F.col("postings")))


def first_week_to_rebuild(mart: DataFrame, lookback_days: int) -> Column:
    """K7: the earliest of the latest ceil(lookback_days / 7) weeks of the mart, as a one-row table's value."""
    return mart.select("p_week").distinct().orderBy(F.desc("p_week")).limit(-(-lookback_days // 7)).agg(F.coalesce(F.min("p_week"), F.lit("0000-W00")).alias("since"))


def refresh_weekly(jobs: DataFrame, mart: DataFrame, lookback_days: int = 28) -> DataFrame:
    """K7: the mart with its trailing weeks computed anew and the older ones as they are."""
    since = first_week_to_rebuild(mart, lookback_days)
    fresh = weekly_ingest(jobs.join(F.broadcast(since), F.col("p_week") >= F.col("since")).drop("since"))
    return mart.join(F.broadcast(since), F.col("p_week") < F.col("since")).drop("since").unionByName(fresh)


def rejection_funnel(quarantine: DataFrame) -> DataFrame:
    """Rows per reason and their share; the sum is taken over the few grouped rows."""
    found = quarantine.groupBy("reason_family", "quarantine_reason").agg(F.count(F.lit(1)).alias("rejected_rows"))
    return found.withColumn("share_of_rejected", F.round(F.col("rejected_rows").cast("double") / F.sum("rejected_rows").over(Window.partitionBy()), 4))


def source_quality(jobs: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Accepted and rejected rows per source, with one normal form on both sides."""
    a = jobs.groupBy(F.col("p_source").alias("source")).agg(F.count(F.lit(1)).alias("a"))
    r = quarantine.groupBy(F.col("p_source").alias("source")).agg(F.count(F.lit(1)).alias("r"))
    a_n, r_n = F.coalesce("a", F.lit(0)), F.coalesce("r", F.lit(0))
    return a.join(r, "source", "full").select("source", a_n.alias("accepted_rows"), r_n.alias("rejected_rows"), (a_n + r_n).alias("total_rows"), C.valid_rate(a_n, a_n + r_n).alias("yield_rate"))


def fetch_waste(companies: DataFrame, n: int = 25) -> DataFrame:
    """A6."""
    return companies.where("is_fetch_waste").orderBy(F.desc("total_postings"), "company_display").limit(n).select("company_display", "total_postings", "valid_postings", "valid_rate", "source_count")


def stage(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = layers.bronze(tables.jobs(spark, sf_dir))
    return staged_jobs(layers.silver(rows)), staged_quarantine(layers.quarantine(rows))


@query("p1_p2_bronze", "SELECT id, p_source, p_week FROM bronze", "bronze")
def _bronze(spark, sf_dir):
    return layers.bronze(tables.jobs(spark, sf_dir)).select("id", "p_source", "p_week")


@query("f1_d1_quarantine", "SELECT id, quarantine_reason FROM quarantine", "quarantine")
def _quarantine(spark, sf_dir):
    return layers.quarantine(layers.bronze(tables.jobs(spark, sf_dir))).select("id", "quarantine_reason")


@query("f1_d1_silver", "SELECT id, company, title, p_source, p_week FROM silver", "silver")
def _silver(spark, sf_dir):
    return layers.silver(layers.bronze(tables.jobs(spark, sf_dir))).select("id", "company", "title", "p_source", "p_week")


GOLD = f"""WITH k AS (SELECT *, %s AS company_key, upper(coalesce(nullif(resume_type, ''), 'UNKNOWN')) AS resume_track FROM silver)
SELECT company_key, resume_track, count(*) AS total_postings, count(*) FILTER (outcome = 'valid') AS valid_postings, count(*) FILTER (outcome = 'discarded') AS discarded_postings,
count(*) FILTER (lower(sponsorship) IN ('yes', 'true', '1')) AS sponsorship_yes, count(*) FILTER (lower(remote) LIKE '%%remote%%') AS remote_count,
coalesce(string_agg(DISTINCT source, ',' ORDER BY source), '') AS sources, count(DISTINCT source) AS source_count,
{sql_rate("count(*) FILTER (outcome = 'valid')", "count(*) FILTER (outcome IN ('valid', 'discarded'))")} AS valid_rate FROM k GROUP BY 1, 2"""


def _gold_sql() -> str:
    from postmill.plans.registry import sql_company_key

    return GOLD % sql_company_key("company")


@query("a1_gold", _gold_sql(), "silver")
def _gold(spark, sf_dir):
    return layers.gold(layers.silver(layers.bronze(tables.jobs(spark, sf_dir))))


@query("p11_staged_jobs", "SELECT job_id_pk, company_key, resume_track, p_source, p_week, is_sponsored, is_remote FROM stg_jobs", "stg_jobs")
def _stg(spark, sf_dir):
    return stage(spark, sf_dir)[0].select("job_id_pk", "company_key", "resume_track", "p_source", "p_week", "is_sponsored", "is_remote")


@query("p12_staged_quarantine", "SELECT job_id_pk, quarantine_reason, reason_family FROM stg_quarantine", "stg_quarantine")
def _stg_q(spark, sf_dir):
    return stage(spark, sf_dir)[1].select("job_id_pk", "quarantine_reason", "reason_family")


@query("a2_dim_company", "SELECT * FROM dim_company", "dim_company")
def _dim(spark, sf_dir):
    return dim_company(stage(spark, sf_dir)[0])


@query("a3_weekly_ingest", "SELECT * FROM fct_weekly_ingest", "fct_weekly_ingest")
def _weekly(spark, sf_dir):
    return weekly_ingest(stage(spark, sf_dir)[0])


@query("a4_rejection_funnel", "SELECT * FROM fct_rejection_funnel", "fct_rejection_funnel")
def _funnel(spark, sf_dir):
    return rejection_funnel(stage(spark, sf_dir)[1])


@query("a5_j1_source_quality", "SELECT * FROM fct_source_quality", "fct_source_quality")
def _sources(spark, sf_dir):
    return source_quality(*stage(spark, sf_dir))


WASTED = "company LIKE 'Acme %' AND CAST(regexp_extract(company, '([0-9]+)', 1) AS INT) % 8 = 0 AND id % 50 > 0"


def _waste_sql() -> str:
    """The mart's SQL over jobs of which every eighth company hardly has a valid posting."""
    from postmill.plans.registry import with_ctes

    text = with_ctes("SELECT company_display, total_postings, valid_postings, valid_rate, source_count FROM dim_company WHERE is_fetch_waste ORDER BY total_postings DESC, company_display LIMIT 25", "dim_company")
    return text.replace("jobs AS (", "base AS (", 1).replace(", bronze AS (", f", jobs AS (SELECT * REPLACE (CASE WHEN {WASTED} THEN 'discarded' ELSE outcome END AS outcome) FROM base), bronze AS (", 1)


def _waste(spark, sf_dir):
    jobs = tables.jobs(spark, sf_dir).withColumn("outcome", F.when(F.expr(WASTED), "discarded").otherwise(F.col("outcome")))
    return fetch_waste(dim_company(staged_jobs(layers.silver(layers.bronze(jobs)))))


query("a6_fetch_waste", _waste_sql())(_waste)


@query("k7_incremental_weekly", "SELECT * FROM fct_weekly_ingest", "fct_weekly_ingest")
def _refresh(spark, sf_dir):
    jobs = stage(spark, sf_dir)[0]
    return refresh_weekly(jobs, weekly_ingest(jobs))
