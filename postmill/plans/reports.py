"""Reports over the job fact, the run history and the marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.functions import columns as C
from postmill.plans import marts
from postmill.plans.registry import query
from postmill.sources import tables
from postmill.sources.tables import JOBS_AS_OF, RUNS_AS_OF

#: fixed values: counters of a run and their labels, in order of the stages
FUNNEL_STAGES = (
    ("duplicate_url", "Duplicate URL"), ("duplicate_job", "Duplicate job"), ("skipped_non_tech", "Not a tech role"), ("skipped_old", "Too old"), ("skipped_international", "Outside the US"),
    ("skipped_clearance", "Needs clearance"), ("skipped_blacklisted", "Blacklisted company"), ("failed_http", "Page failed to load"), ("discarded", "Failed validation"), ("valid", "Valid, written to tracker"),
)
TRACKS = {"SDE": "Software engineering", "ML": "Machine learning", "DA": "Data and analytics"}


def fact(jobs: DataFrame) -> DataFrame:
    """K3: the job fact with its derived columns."""
    return jobs.withColumns({"location_state": C.state_code(F.col("location")), "is_remote": C.is_remote_store(F.col("remote")), "is_sponsored": C.is_sponsored(F.col("sponsorship"))})


def since(as_of: str, days: int) -> Column:
    """Texts of dates from `days` before as_of on compare as text."""
    return F.date_format(F.date_sub(F.lit(as_of).cast("date"), days), "yyyy-MM-dd")


def _valid() -> Column:
    return F.col("outcome") == "valid"


def percent(part: Column, whole: Column) -> Column:
    return F.round(100.0 * part / whole, 1)


def total_jobs(jobs: DataFrame) -> DataFrame:
    """One row per outcome and one for all."""
    return jobs.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).unionByName(jobs.agg(F.count(F.lit(1)).alias("n")).select(F.lit("(all)").alias("outcome"), "n"))


def source_quality_report(jobs: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """A8."""
    return jobs.where(F.col("processed_at") >= since(as_of, days)).groupBy("source").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(_valid()).alias("valid"), F.count_if(F.col("outcome") == "discarded").alias("discarded"),
        F.round(F.avg("processing_time_ms"), 1).alias("avg_ms"), percent(F.count_if(_valid()), F.count(F.lit(1))).alias("valid_pct"),
    )


def rejection_reasons(jobs: DataFrame, as_of: str, days: int = 7, n: int = 20) -> DataFrame:
    """The share is of all discarded rows of the window, also those without a reason."""
    rows = jobs.where((F.col("outcome") == "discarded") & (F.col("processed_at") >= since(as_of, days)))
    grouped = rows.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("count"))
    return grouped.withColumn("pct", percent(F.col("count"), F.sum("count").over(Window.partitionBy()))).where("rejection_reason <> ''").orderBy(F.desc("count"), "rejection_reason").limit(n)


def company_stats(jobs: DataFrame, min_seen: int = 2, n: int = 50) -> DataFrame:
    """A10."""
    found = jobs.groupBy("company").agg(F.count(F.lit(1)).alias("total_seen"), F.count_if(_valid()).alias("valid"), F.count_if(F.col("outcome") == "discarded").alias("discarded"))
    return found.where(F.col("total_seen") >= min_seen).orderBy(F.desc("valid"), "company").limit(n)


def distribution(jobs: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Valid rows by a column, as a share of all valid rows."""
    grouped = jobs.where(_valid()).groupBy(column).agg(F.count(F.lit(1)).alias("count")).withColumn("pct", percent(F.col("count"), F.sum("count").over(Window.partitionBy())))
    return grouped if n is None else grouped.where(F.col(column) != "").orderBy(F.desc("count"), column).limit(n)


def daily_trend(jobs: DataFrame, as_of: str, days: int = 14) -> DataFrame:
    """A13."""
    day = F.substring("processed_at", 1, 10).alias("date")
    return jobs.where(F.col("processed_at") >= since(as_of, days)).groupBy(day).agg(F.count_if(_valid()).alias("valid"), F.count_if(F.col("outcome") == "discarded").alias("discarded"), F.count(F.lit(1)).alias("total"))


def latency(jobs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """A14 (T6): the element at floor(n * p) of the sorted times; p99 is the largest up to 100 rows.

    Approximate percentiles bound where the element lies (their rank is off by a 10,000th of the rows at most); only the rows
    between the bounds, about four 10,000ths, are counted by value and summed up.
    """
    slack = 2e-4
    times = jobs.where((F.col("processed_at") >= since(as_of, days)) & (F.col("processing_time_ms") > 0)).select(F.col("processing_time_ms").alias("t"))
    shares = (0.5, 0.9, 0.99)
    bounds = times.agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("most"), *[F.percentile_approx("t", [max(p - slack, 0.0), min(p + slack, 1.0)], 10_000).alias(f"q{i}") for i, p in enumerate(shares)])
    of = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col("n") * p).alias("rank"), F.col(f"q{i}")[0].alias("low"), F.col(f"q{i}")[1].alias("high")) for i, p in enumerate(shares)])).alias("w")
    wanted = bounds.select(of).select("w.*")
    near = times.crossJoin(F.broadcast(wanted)).where("t <= high").groupBy("i", "rank", F.when(F.col("t") >= F.col("low"), F.col("t")).alias("t")).agg(F.count(F.lit(1)).alias("c"))
    upto = near.withColumn("upto", F.sum("c").over(Window.partitionBy("i").orderBy(F.col("t").asc_nulls_first())))
    found = upto.where((F.col("upto") > F.col("rank")) & F.col("t").isNotNull()).agg(*[F.coalesce(F.min(F.when(F.col("i") == i, F.col("t"))), F.lit(0.0)).alias(f"p{i}") for i in range(3)])
    return found.crossJoin(F.broadcast(bounds.select("n", "most"))).select(F.col("p0").alias("p50"), F.col("p1").alias("p90"), F.coalesce(F.when(F.col("n") > 100, F.col("p2")).otherwise(F.col("most")), F.lit(0.0)).alias("p99"), F.col("n").alias("count"))


def combined_summary(jobs: DataFrame, as_of: str) -> DataFrame:
    """Section, label and number of the reports above, as one long table."""
    parts = {"total": total_jobs(jobs).select(F.col("outcome").alias("label"), "n"), "source": source_quality_report(jobs, as_of).select(F.col("source").alias("label"), F.col("total").alias("n")),
             "reason": rejection_reasons(jobs, as_of).select(F.col("rejection_reason").alias("label"), F.col("count").alias("n")), "state": distribution(jobs, "location_state", 15).select(F.col("location_state").alias("label"), F.col("count").alias("n")),
             "track": distribution(jobs, "resume_type").select(F.col("resume_type").alias("label"), F.col("count").alias("n")), "day": daily_trend(jobs, as_of).select(F.col("date").alias("label"), F.col("total").alias("n"))}
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("section"), "label", "n") for name, df in parts.items()])


def report_lines(jobs: DataFrame, as_of: str) -> DataFrame:
    """Text lines of A8."""
    r = source_quality_report(jobs, as_of)
    return r.select(F.format_string("%s: %d jobs, %d valid (%s%%)", F.coalesce("source", F.lit("Unknown")), "total", "valid", F.col("valid_pct").cast("string")).alias("line"))


def quality_by_source(jobs: DataFrame, least: int = 5) -> DataFrame:
    """A17."""
    has = {"location": ("Unknown", "location"), "job_id": ("N/A", "job_id"), "sponsorship": ("Unknown", "sponsorship"), "remote": ("Unknown", "remote")}
    counts = {k: F.count_if((F.col(c) != none) & (F.col(c) != "")) for k, (none, c) in has.items()} | {"salary": F.count_if(F.col("salary_low").isNotNull())}
    found = jobs.where("source NOT IN ('Unknown', '')").groupBy("source").agg(F.count(F.lit(1)).alias("total"), *[v.alias(k) for k, v in counts.items()]).where(F.col("total") >= least)
    return found.select("source", "total", *[percent(F.col(k), F.col("total")).alias(f"{k}_pct") for k in counts], F.round(sum((F.col(k) for k in counts), F.lit(0)) / (5 * F.col("total")) * 100, 1).alias("avg_completeness"))


def score_batch(jobs: DataFrame) -> DataFrame:
    """One row per measure: count, average, least and largest score, grades, missing fields."""
    score, _, missing = C.completeness()
    rows = jobs.select(score.alias("score"), missing.alias("missing"))
    whole = rows.agg(F.count(F.lit(1)).cast("double").alias("count"), F.round(F.avg("score"), 1).alias("avg_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score")).unpivot([], ["count", "avg_score", "min_score", "max_score"], "measure", "value")
    grades = rows.groupBy(F.concat(F.lit("grade_"), C.grade(F.col("score"))).alias("measure")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    fields = rows.select(F.explode("missing").alias("f")).groupBy(F.concat(F.lit("missing_"), F.col("f")).alias("measure")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return whole.unionByName(grades).unionByName(fields)


def headline(runs: DataFrame, jobs: DataFrame, companies: DataFrame, sources: DataFrame) -> DataFrame:
    """One row of single numbers; each table is reduced to one row before they meet."""
    evaluated = sum((F.sum(c) for c, _ in FUNNEL_STAGES), F.lit(0))
    r = runs.agg(F.count(F.lit(1)).alias("runs"), evaluated.alias("jobs_evaluated"), F.round(evaluated / F.count(F.lit(1))).cast("long").alias("jobs_evaluated_per_run"), F.round(F.avg("elapsed_seconds") / 60, 1).alias("avg_run_minutes"), F.round(F.median("elapsed_seconds") / 60, 1).alias("median_run_minutes"))
    j = jobs.where(_valid()).agg(F.count(F.lit(1)).alias("valid_jobs"), C.valid_rate(F.sum("is_sponsored"), F.count(F.lit(1))).alias("sponsored_share"), F.sum("is_remote").alias("remote_jobs"))
    c = companies.where(C.displayable(F.col("company_display"))).agg(F.count(F.lit(1)).alias("companies"))
    return r.crossJoin(j).crossJoin(c).crossJoin(sources.agg(F.count_distinct("source").alias("sources")))


def weekly(mart: DataFrame) -> DataFrame:
    """A21."""
    return mart.groupBy(F.col("p_week").alias("week")).agg(F.sum("postings").alias("postings"), F.sum("valid_postings").alias("valid"), F.sum("sponsored_postings").alias("sponsored"), F.count_distinct("p_source").alias("sources"))


def funnel(rejections: DataFrame, as_of: str, days: int = 30, n: int = 12) -> DataFrame:
    """A23."""
    return rejections.where(F.col("date") >= since(as_of, days)).groupBy("stage", F.col("reason_category").alias("reason")).agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "stage", "reason").limit(n)


def pipeline_funnel(runs: DataFrame) -> DataFrame:
    """The counters of all runs as rows."""
    sums = runs.agg(*[F.sum(c).cast("long").alias(c) for c, _ in FUNNEL_STAGES])
    label = F.coalesce(*[F.when(F.col("key") == c, name) for c, name in FUNNEL_STAGES])
    return sums.unpivot([], [c for c, _ in FUNNEL_STAGES], "key", "count").select("key", label.alias("stage"), "count")


def insights(jobs: DataFrame) -> DataFrame:
    """Kind, label, count of the valid postings' views."""
    valid = jobs.where(_valid())
    track = F.coalesce(*[F.when(F.col("resume_type") == k, v) for k, v in TRACKS.items()], F.lit("Other"))
    views = {"role": C.job_type(F.col("job_type")), "track": track, "state": C.state_bucket(F.col("location"))}
    parts = []
    for kind, label in views.items():
        grouped = valid.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("count")).where("label IS NOT NULL")
        parts.append((grouped.orderBy(F.desc("count"), "label").limit(12) if kind == "state" else grouped).select(F.lit(kind).alias("kind"), "label", "count"))
    by_company = valid.where(C.displayable(F.col("company"))).groupBy(F.col("company").alias("label")).agg(F.count(F.lit(1)).alias("valid"), F.sum("is_sponsored").alias("sponsored"))
    parts.append(by_company.orderBy(F.desc("valid"), "label").limit(10).select(F.lit("hiring").alias("kind"), "label", F.col("valid").alias("count")))
    parts.append(by_company.where("sponsored > 0").orderBy(F.desc("sponsored"), "label").limit(10).select(F.lit("sponsor").alias("kind"), "label", F.col("sponsored").alias("count")))
    return reduce(DataFrame.unionByName, parts)


def search(jobs: DataFrame, q: str = "", source: str = "", job_type: str = "", sponsored_only: bool = False, remote_only: bool = False) -> DataFrame:
    """valid postings with a web URL that meet the given conditions; the text is plain, not a pattern."""
    rows = jobs.where(_valid() & F.col("url").startswith("http"))
    if q.strip():
        word = q.strip().lower()
        rows = rows.where(F.lower("company").contains(word) | F.lower("title").contains(word))
    rows = rows.where(F.col("source") == source) if source else rows
    rows = rows.where(F.col("job_type") == job_type) if job_type in C.JOB_TYPES else rows
    rows = rows.where("is_sponsored = 1") if sponsored_only else rows
    rows = rows.where("is_remote = 1") if remote_only else rows
    return rows.select("id", "company", "title", F.coalesce("location", F.lit("Unknown")).alias("location"), "source", "url", C.job_type(F.col("job_type")).alias("job_type"), (F.col("is_remote") == 1).alias("remote"), (F.col("is_sponsored") == 1).alias("sponsored"), F.col("resume_type").alias("track"))


def page(rows: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    """O3: one page by descending id."""
    return rows.orderBy(F.desc("id")).offset(offset).limit(limit)


def company_search(companies: DataFrame, q: str = "", sponsored_only: bool = False, n: int = 50) -> DataFrame:
    """F22."""
    rows = companies.where(C.displayable(F.col("company_display")) & F.lower("company_display").contains(q.strip().lower()))
    rows = rows.where("sponsored_postings > 0") if sponsored_only else rows
    return rows.orderBy(F.desc("valid_postings"), F.desc("total_postings"), "company_display", "company_key").limit(n).select(F.col("company_display").alias("company"), F.col("total_postings").alias("total"), F.col("valid_postings").alias("valid"), "sponsorship_rate", "valid_rate", F.col("source_count").alias("sources"))


def week_totals(weeks: DataFrame, as_of: str) -> DataFrame:
    """Weekly totals, the busiest week, and the last four complete weeks against the four before."""
    marked = weeks.withColumn("partial", F.date_add(C.week_start(F.col("week")), 7) > F.lit(as_of).cast("date"))
    ranked = marked.withColumn("rank", F.row_number().over(Window.partitionBy("partial").orderBy(F.desc("week"))))
    last, before = (F.sum(F.when(~F.col("partial") & F.col("rank").between(a, b), F.col("postings"))) for a, b in ((1, 4), (5, 8)))
    return ranked.agg(F.sum("postings").alias("postings"), F.sum("valid").alias("valid"), F.max_by("week", F.struct("postings", "week")).alias("busiest"), F.coalesce(last, F.lit(0)).alias("last_four"), F.coalesce(before, F.lit(0)).alias("four_before"))


def _fact(spark, sf_dir):
    return fact(tables.jobs(spark, sf_dir))


query("s1_k3_job_fact", "SELECT id, location_state, is_remote, is_sponsored FROM fact", "fact")(lambda s, d: _fact(s, d).select("id", "location_state", "is_remote", "is_sponsored"))
query("a7_total_jobs", "SELECT outcome, count(*) AS n FROM fact GROUP BY 1 UNION ALL SELECT '(all)', count(*) FROM fact", "fact")(lambda s, d: total_jobs(_fact(s, d)))
query("a8_source_quality_report", f"""SELECT source, count(*) AS total, count(*) FILTER (outcome = 'valid') AS valid, count(*) FILTER (outcome = 'discarded') AS discarded, round(avg(processing_time_ms), 1) AS avg_ms,
    round(100.0 * count(*) FILTER (outcome = 'valid') / count(*), 1) AS valid_pct FROM fact WHERE processed_at >= strftime(DATE '{JOBS_AS_OF}' - 30, '%Y-%m-%d') GROUP BY 1""", "fact")(lambda s, d: source_quality_report(_fact(s, d), JOBS_AS_OF))  # fmt: skip
query("a9_j3_rejection_reasons", f"""WITH r AS (SELECT rejection_reason, count(*) AS count FROM fact WHERE outcome = 'discarded' AND processed_at >= strftime(DATE '{JOBS_AS_OF}' - 7, '%Y-%m-%d') GROUP BY 1)
    SELECT rejection_reason, count, pct FROM (SELECT *, round(100.0 * count / sum(count) OVER (), 1) AS pct FROM r) WHERE rejection_reason <> '' ORDER BY count DESC, rejection_reason LIMIT 20""", "fact")(lambda s, d: rejection_reasons(_fact(s, d), JOBS_AS_OF))  # fmt: skip
query("a10_company_stats", "SELECT company, count(*) AS total_seen, count(*) FILTER (outcome = 'valid') AS valid, count(*) FILTER (outcome = 'discarded') AS discarded FROM fact GROUP BY 1 HAVING count(*) >= 2 ORDER BY valid DESC, company LIMIT 50", "fact")(lambda s, d: company_stats(_fact(s, d)))
query("a11_location_distribution", "SELECT * FROM (SELECT location_state, count(*) AS count, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM fact WHERE outcome = 'valid' GROUP BY 1) WHERE location_state <> '' ORDER BY count DESC, location_state LIMIT 15", "fact")(lambda s, d: distribution(_fact(s, d), "location_state", 15))
query("a12_resume_types", "SELECT resume_type, count(*) AS count, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM fact WHERE outcome = 'valid' GROUP BY 1", "fact")(lambda s, d: distribution(_fact(s, d), "resume_type"))
query("a13_daily_trend", f"SELECT substr(processed_at, 1, 10) AS date, count(*) FILTER (outcome = 'valid') AS valid, count(*) FILTER (outcome = 'discarded') AS discarded, count(*) AS total FROM fact WHERE processed_at >= strftime(DATE '{JOBS_AS_OF}' - 14, '%Y-%m-%d') GROUP BY 1", "fact")(lambda s, d: daily_trend(_fact(s, d), JOBS_AS_OF))
query("a14_latency", f"""WITH t AS (SELECT processing_time_ms AS t, row_number() OVER (ORDER BY processing_time_ms) - 1 AS i, count(*) OVER () AS n FROM fact WHERE processed_at >= strftime(DATE '{JOBS_AS_OF}' - 7, '%Y-%m-%d') AND processing_time_ms > 0)
    SELECT coalesce(max(t) FILTER (i = floor(n * 0.5)), 0) AS p50, coalesce(max(t) FILTER (i = floor(n * 0.9)), 0) AS p90, coalesce(CASE WHEN max(n) > 100 THEN max(t) FILTER (i = floor(n * 0.99)) ELSE max(t) END, 0) AS p99, count(*) AS count FROM t""", "fact")(lambda s, d: latency(_fact(s, d), JOBS_AS_OF))  # fmt: skip
query("a15_summary")(lambda s, d: combined_summary(_fact(s, d), JOBS_AS_OF))
query("a16_report_lines")(lambda s, d: report_lines(_fact(s, d), JOBS_AS_OF))
query("a17_quality_by_source", """WITH q AS (SELECT source, count(*) AS total, count(*) FILTER (location NOT IN ('Unknown', '')) AS a, count(*) FILTER (job_id NOT IN ('N/A', '')) AS b, count(*) FILTER (sponsorship NOT IN ('Unknown', '')) AS c,
    count(*) FILTER (remote NOT IN ('Unknown', '')) AS d, count(salary_low) AS e FROM fact WHERE source NOT IN ('Unknown', '') GROUP BY 1 HAVING count(*) >= 5)
    SELECT source, total, round(100.0 * a / total, 1) AS location_pct, round(100.0 * b / total, 1) AS job_id_pct, round(100.0 * c / total, 1) AS sponsorship_pct, round(100.0 * d / total, 1) AS remote_pct, round(100.0 * e / total, 1) AS salary_pct,
    round((a + b + c + d + e) / (5 * total)::DOUBLE * 100, 1) AS avg_completeness FROM q""", "fact")(lambda s, d: quality_by_source(_fact(s, d)))  # fmt: skip
SCORE = """round((CASE WHEN coalesce(company, '') NOT IN ('', 'Unknown') THEN 2.0 ELSE 0 END + CASE WHEN coalesce(title, '') NOT IN ('', 'Unknown') THEN 2.0 ELSE 0 END + CASE WHEN coalesce(location, '') NOT IN ('', 'Unknown') THEN 1.5 ELSE 0 END
    + CASE WHEN coalesce(url, '') LIKE 'http%' THEN 2.0 ELSE 0 END + CASE WHEN coalesce(job_id, '') NOT IN ('', 'N/A') THEN 1.0 ELSE 0 END + CASE WHEN coalesce(salary_low, 0) <> 0 OR coalesce(salary_high, 0) <> 0 THEN 0.5 ELSE 0 END
    + CASE WHEN coalesce(sponsorship, '') NOT IN ('', 'Unknown') THEN 1.0 ELSE 0 END + CASE WHEN coalesce(remote, '') NOT IN ('', 'Unknown') THEN 0.5 ELSE 0 END)::DOUBLE / 10.5 * 100, 1)"""
query("p24_p25_completeness", f"SELECT id, score, CASE WHEN score >= 90 THEN 'A' WHEN score >= 75 THEN 'B' WHEN score >= 50 THEN 'C' WHEN score >= 25 THEN 'D' ELSE 'F' END AS grade FROM (SELECT id, {SCORE} AS score FROM fact)", "fact")(
    lambda s, d: _fact(s, d).select("id", C.completeness()[0].alias("score")).withColumn("grade", C.grade(F.col("score")))
)
query("a18_score_batch")(lambda s, d: score_batch(_fact(s, d)))
query("a19_a20_headline", """WITH r AS (SELECT count(*) AS runs, sum(duplicate_url + duplicate_job + skipped_old + failed_http + discarded + valid)::BIGINT AS jobs_evaluated, round(avg(elapsed_seconds) / 60, 1) AS avg_run_minutes, round(median(elapsed_seconds) / 60, 1) AS median_run_minutes FROM runs),
    j AS (SELECT count(*) AS valid_jobs, round(sum(is_sponsored)::DOUBLE / count(*), 4) AS sponsored_share, sum(is_remote)::BIGINT AS remote_jobs FROM fact WHERE outcome = 'valid')
    SELECT runs, jobs_evaluated, round(jobs_evaluated / runs::DOUBLE)::BIGINT AS jobs_evaluated_per_run, avg_run_minutes, median_run_minutes, valid_jobs, sponsored_share, remote_jobs,
    (SELECT count(*) FROM dim_company WHERE regexp_matches(company_display, '[A-Za-z]')) AS companies, (SELECT count(DISTINCT source) FROM fct_source_quality) AS sources FROM r, j""", "fact", "runs", "dim_company", "fct_source_quality")(
    lambda s, d: headline(tables.runs(s, d), _fact(s, d), marts.dim_company(marts.stage(s, d)[0]), marts.source_quality(*marts.stage(s, d)))
)
query("a21_weekly", "SELECT p_week AS week, sum(postings)::BIGINT AS postings, sum(valid_postings)::BIGINT AS valid, sum(sponsored_postings)::BIGINT AS sponsored, count(DISTINCT p_source) AS sources FROM fct_weekly_ingest GROUP BY 1", "fct_weekly_ingest")(lambda s, d: weekly(marts.weekly_ingest(marts.stage(s, d)[0])))
query("a22_sources_quarantine", "SELECT source AS name, total_rows AS n, yield_rate AS share FROM fct_source_quality UNION ALL SELECT quarantine_reason, rejected_rows, share_of_rejected FROM fct_rejection_funnel", "fct_source_quality", "fct_rejection_funnel")(
    lambda s, d: marts.source_quality(*marts.stage(s, d)).select(F.col("source").alias("name"), F.col("total_rows").alias("n"), F.col("yield_rate").alias("share")).unionByName(marts.rejection_funnel(marts.stage(s, d)[1]).select(F.col("quarantine_reason").alias("name"), F.col("rejected_rows").alias("n"), F.col("share_of_rejected").alias("share")))
)
query("a23_funnel", f"SELECT stage, reason_category AS reason, sum(count)::BIGINT AS count FROM rejection_funnel WHERE date >= strftime(DATE '{RUNS_AS_OF}' - 30, '%Y-%m-%d') GROUP BY 1, 2 ORDER BY count DESC, stage, reason LIMIT 12", "rejection_funnel")(lambda s, d: funnel(tables.rejection_funnel(s, d), RUNS_AS_OF))
query("a24_job_sources", "SELECT source, count(*) AS count FROM fact WHERE outcome = 'valid' AND url LIKE 'http%' GROUP BY 1", "fact")(lambda s, d: search(_fact(s, d)).groupBy("source").agg(F.count(F.lit(1)).alias("count")))
query("a25_pipeline_funnel", "WITH u AS (UNPIVOT (SELECT " + ", ".join(f"sum({c})::BIGINT AS {c}" for c, _ in FUNNEL_STAGES) + " FROM runs) ON COLUMNS(*) INTO NAME key VALUE count) SELECT key, CASE key " + " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in FUNNEL_STAGES) + " END AS stage, count FROM u", "runs")(lambda s, d: pipeline_funnel(tables.runs(s, d)))
query("a26_o2_insights", """WITH v AS (SELECT * FROM fact WHERE outcome = 'valid'), c AS (SELECT company AS label, count(*) AS valid, sum(is_sponsored)::BIGINT AS sponsored FROM v WHERE regexp_matches(company, '[A-Za-z]') GROUP BY 1)
    SELECT 'role' AS kind, CASE WHEN job_type IN ('Internship', 'Full Time', 'Co-op', 'New Grad') THEN job_type ELSE 'Other' END AS label, count(*) AS count FROM v GROUP BY 2
    UNION ALL SELECT 'track', CASE resume_type WHEN 'SDE' THEN 'Software engineering' WHEN 'ML' THEN 'Machine learning' WHEN 'DA' THEN 'Data and analytics' ELSE 'Other' END, count(*) FROM v GROUP BY 2
    UNION ALL (SELECT 'state', CASE WHEN lower(location) LIKE '%remote%' THEN 'Remote' ELSE location_state END, count(*) FROM v WHERE lower(location) LIKE '%remote%' OR location_state <> '' GROUP BY 2)
    UNION ALL (SELECT 'hiring', label, valid FROM c ORDER BY valid DESC, label LIMIT 10) UNION ALL (SELECT 'sponsor', label, sponsored FROM c WHERE sponsored > 0 ORDER BY sponsored DESC, label LIMIT 10)""", "fact")(lambda s, d: insights(_fact(s, d)))  # fmt: skip
query("f21_search", "SELECT id, company, title, coalesce(location, 'Unknown') AS location, source, url, CASE WHEN job_type IN ('Internship', 'Full Time', 'Co-op', 'New Grad') THEN job_type ELSE 'Other' END AS job_type, is_remote = 1 AS remote, is_sponsored = 1 AS sponsored, resume_type AS track FROM fact WHERE outcome = 'valid' AND url LIKE 'http%' AND contains(lower(title), 'engineer') AND is_sponsored = 1", "fact")(lambda s, d: search(_fact(s, d), "Engineer", sponsored_only=True))
query("o3_page", "SELECT id, company FROM fact WHERE outcome = 'valid' AND url LIKE 'http%' ORDER BY id DESC LIMIT 50 OFFSET 100", "fact")(lambda s, d: page(search(_fact(s, d)), 50, 100).select("id", "company"))
query("f22_company_search", "SELECT company_display AS company, total_postings AS total, valid_postings AS valid, sponsorship_rate, valid_rate, source_count AS sources FROM dim_company WHERE contains(lower(company_display), 'acme 1') AND sponsored_postings > 0 ORDER BY valid_postings DESC, total_postings DESC, company_display, company_key LIMIT 50", "dim_company")(lambda s, d: company_search(marts.dim_company(marts.stage(s, d)[0]), "acme 1", True))
query("a46_p49_week_totals", f"""WITH w AS (SELECT p_week AS week, sum(postings)::BIGINT AS postings, sum(valid_postings)::BIGINT AS valid FROM fct_weekly_ingest GROUP BY 1),
    m AS (SELECT *, strptime(week || '-1', '%G-W%V-%u')::DATE + 7 > DATE '{JOBS_AS_OF}' AS partial FROM w), k AS (SELECT *, row_number() OVER (PARTITION BY partial ORDER BY week DESC) AS r FROM m)
    SELECT sum(postings)::BIGINT AS postings, sum(valid)::BIGINT AS valid, arg_max(week, (postings, week)) AS busiest, coalesce(sum(postings) FILTER (NOT partial AND r BETWEEN 1 AND 4), 0)::BIGINT AS last_four, coalesce(sum(postings) FILTER (NOT partial AND r BETWEEN 5 AND 8), 0)::BIGINT AS four_before FROM k""", "fct_weekly_ingest")(
    lambda s, d: week_totals(weekly(marts.weekly_ingest(marts.stage(s, d)[0])), JOBS_AS_OF)
)
query("s19_run_timeline", "SELECT ts, round(elapsed_seconds / 60, 1) AS minutes, valid, discarded, failed_http FROM runs", "runs")(lambda s, d: tables.runs(s, d).select("ts", F.round(F.col("elapsed_seconds") / 60, 1).alias("minutes"), "valid", "discarded", "failed_http"))
query("a45_latest_run", "SELECT run_id, count(*) AS rows, count(*) FILTER (outcome = 'valid') AS valid FROM jobs WHERE run_id = (SELECT max(run_id) FROM jobs) GROUP BY 1", "jobs")(
    lambda s, d: tables.jobs(s, d).groupBy("run_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(_valid()).alias("valid")).orderBy(F.desc("run_id")).limit(1)
)
