"""Data tests and audits (Q1-Q10, Q12, Q14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions import columns as C
from postmill.operators import gates, layers
from postmill.plans import marts, reports
from postmill.plans.registry import query, sql_company_key
from postmill.sources import tables


class GateError(ValueError):
    """A layer that must not be built on."""


def column_tests(df: DataFrame, not_null: tuple[str, ...] = (), accepted: dict[str, tuple] | None = None, ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Q1, Q3, Q4: test, column, failures; all tests of a table in one pass."""
    tests = [("not_null", c, F.col(c).isNull()) for c in not_null]
    tests += [("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(*v)) for c, v in (accepted or {}).items()]
    tests += [("accepted_range", c, F.col(c).isNotNull() & ~F.col(c).between(a, b)) for c, (a, b) in (ranges or {}).items()]
    counted = df.agg(*[F.count_if(t).alias(f"_{i}") for i, (_, _, t) in enumerate(tests)])
    return counted.select(F.explode(F.array(*[F.struct(F.lit(n).alias("test"), F.lit(c).alias("column"), F.col(f"_{i}").alias("failures")) for i, (n, c, _) in enumerate(tests)])).alias("t")).select("t.*")


def unique_test(df: DataFrame, *keys: str) -> DataFrame:
    """Q2, Q5: the number of keys that occur more than once."""
    return df.groupBy(*keys).count().where("count > 1").agg(F.count(F.lit(1)).alias("failures")).select(F.lit("unique").alias("test"), F.lit(",".join(keys)).alias("column"), "failures")


def silver_gate(rows: DataFrame, least: float = 0.20) -> float:
    """Q6-Q8: the pass rate; an error for an empty table or a rate below the least."""
    found = layers.gated(rows).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("quarantine_reason").isNull()).alias("ok")).first()
    if not found["n"]:
        raise GateError("the table is empty")
    rate = found["ok"] / found["n"]
    if rate < least:
        raise GateError(f"only {rate:.0%} of the rows pass")
    return rate


def week_gate(extracted: DataFrame, landed: DataFrame, weeks: DataFrame, least: float = 0.20) -> DataFrame:
    """Q6-Q8: week, extracted, landed, silver, rate, verdict of each week to build: skip, lost, stop or pass.

    A week without rows is skipped, but an empty table is an error; a week whose landed rows are not as many as its extracted ones is lost;
    one with a share of Silver rows below the least is stopped. Silver rows of a week are its valid grains, so they are
    counted and no row is ranked.
    """
    if extracted.isEmpty():
        raise GateError("the table is empty")
    grain = F.struct(C.company_key(F.col("company")), *[F.lower(F.trim(F.coalesce(F.col(c), F.lit("none")))) for c in ("title", "source")])
    n = extracted.groupBy("p_week").agg(F.count(F.lit(1)).alias("extracted"))
    found = landed.groupBy("p_week").agg(F.count(F.lit(1)).alias("landed"), F.count_distinct(F.when(layers.gate_reason().isNull(), grain)).alias("silver"))
    both = weeks.select("p_week").distinct().join(n, "p_week", "left").join(found, "p_week", "left").fillna(0, ["extracted", "landed", "silver"])
    rate = F.when(F.col("landed") > 0, F.col("silver") / F.col("landed")).otherwise(0.0)
    verdict = F.when(F.col("extracted") == 0, "skip").when(F.col("extracted") != F.col("landed"), "lost").when(rate < least, "stop").otherwise("pass")
    return both.select("p_week", "extracted", "landed", "silver", F.round(rate, 6).alias("rate"), verdict.alias("verdict"))


def require_weeks(verdicts: DataFrame) -> list[str]:
    """The weeks to build; an error if any is lost or stopped."""
    bad = [f"{r.p_week} {r.verdict}" for r in verdicts.where("verdict IN ('lost', 'stop')").orderBy("p_week").limit(5).collect()]
    if bad:
        raise GateError(f"weeks that may not be published: {', '.join(bad)}")
    return [r.p_week for r in verdicts.where("verdict = 'pass'").orderBy("p_week").collect()]


def run_summary(rows: DataFrame) -> DataFrame:
    """Q9: one line on a run."""
    r = layers.gated(rows).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("quarantine_reason").isNull()).alias("ok"))
    return r.select(F.format_string("%d extracted, %d silver, %d quarantined", "n", "ok", F.col("n") - F.col("ok")).alias("line"))


def audit(jobs: DataFrame) -> DataFrame:
    """Q10, Q11, Q14: check, id of postings that break a rule of consistency; one pass, then the flags become rows."""
    url_title = C.squash(C.slug_title(F.col("url")))
    checks: dict[str, Column] = {
        "type_vs_title": (F.col("job_type") == "Full Time") & F.lower("title").rlike(gates.INTERN), "live_gate": gates.title_reason(F.col("title")).isNotNull(), "junk_title": F.lower("title").rlike(gates.JUNK),
        "missing_id_in_url": (F.col("job_id") == "N/A") & C.board_job_id(F.col("url")).isNotNull(), "bad_type": ~F.col("job_type").isin(*C.JOB_TYPES), "suspect_location": ~gates.is_us_location(F.col("location")), "title_vs_url": (F.length(url_title) > 10) & ~C.squash(F.col("title")).contains(url_title),
    }
    flags = F.filter(F.array(*[F.when(F.coalesce(v, F.lit(False)), k) for k, v in checks.items()]), lambda x: x.isNotNull())
    return jobs.select("id", F.explode(flags).alias("check"))


#: what is wrong with a place, in order: (reason, pattern)
PLACE_FAULTS = (
    ("requisition id", "^(?:[A-Z]{1,3}[0-9]{3,}|R?[0-9]{4,})$"), ("job title", "(?i)\\b(?:analyst|developer|engineer|intern|scientist)\\b"), ("web address", "https?://"), ("no separator", "^[A-Za-z]{3,}[a-z][A-Z]{2}$"), ("stray comma", "^ *,|, *$"), ("run together", "[A-Za-z]{3,}[0-9]"), ("too long", "^.{45,}$"),
)


def place_fault(location: Column) -> Column:
    """The first fault of a place; null for none, and for unknown and remote places."""
    v = F.trim(C.text(location))
    return F.when(~F.lower(v).isin("", "unknown", "n/a", "remote"), F.coalesce(*[F.when(v.rlike(p), why) for why, p in PLACE_FAULTS]))


def open_audit(rows: DataFrame, as_of: str) -> DataFrame:
    """Q14: panel, label, n of postings that are still open: the gates of today that they fail, their age in weeks, faults of their places
    and the sources of these, and titles, companies and ids that stand twice (Q10). Titles are judged once each."""
    from postmill.operators import chain, dedup

    judged = chain.looked_up(rows, chain.title_verdicts(rows), "title")
    weeks = F.floor(F.datediff(F.lit(as_of).cast("date"), F.to_date(F.substring("processed_at", 1, 10))) / 7)
    fault = place_fault(F.col("location"))
    cell = lambda panel, label, when: F.when(when, F.struct(F.lit(panel).alias("panel"), label.cast("string").alias("label")))
    gate = F.coalesce("gate", F.when(~F.col("technical"), "tech"))
    cells = F.array(cell("gate", gate, gate.isNotNull()), cell("age_weeks", weeks, weeks.isNotNull()), cell("place", fault, fault.isNotNull()), cell("place_source", F.coalesce("source", F.lit("Unknown")), fault.isNotNull()))
    counts = judged.select(F.explode(F.filter(cells, lambda c: c.isNotNull())).alias("c")).groupBy("c.panel", "c.label").agg(F.count(F.lit(1)).alias("n"))
    keys = F.array(F.struct(F.lit("title").alias("label"), dedup.dedup_key(F.col("company"), F.col("title")).alias("key")), F.when((C.text(F.col("job_id")) != "") & (F.col("job_id") != "N/A"), F.struct(F.lit("job_id").alias("label"), F.concat_ws("|", "company", "job_id").alias("key"))))
    twice = rows.select(F.explode(F.filter(keys, lambda k: k.isNotNull())).alias("k")).groupBy("k.label", "k.key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").groupBy("label").agg(F.sum("n").alias("n"))
    return counts.unionByName(twice.select(F.lit("twice").alias("panel"), "label", "n"))


def rescued(jobs: DataFrame, as_of: str, days: int = 60) -> DataFrame:
    """Q12: rejected postings of the last days that today's gates pass, with the ground for a second look."""
    trusted = jobs.where("outcome = 'valid'").select("company").distinct().withColumn("_t", F.lit(True))
    rows = jobs.where((F.col("outcome") == "discarded") & (F.col("processed_at") >= reports.since(as_of, days)) & gates.is_tech_role(F.col("title")))
    reason = F.lower("rejection_reason")
    return rows.join(trusted, "company", "left").select("id", F.when(reason.contains("clearance"), "clearance").when(reason.contains("location") & gates.is_us_location(F.col("location")), "location").when(reason.contains("tech"), "non_tech").when(F.col("_t"), "trusted_company").otherwise("fetch").alias("ground"))


query("q1_q3_q4_column_tests", """SELECT 'not_null' AS test, 'company_key' AS "column", count(*) FILTER (company_key IS NULL) AS failures FROM dim_company UNION ALL SELECT 'accepted_values', 'reason_family', count(*) FILTER (reason_family NOT IN ('url', 'entity')) FROM stg_quarantine
    UNION ALL SELECT 'accepted_range', 'valid_rate', count(*) FILTER (valid_rate NOT BETWEEN 0 AND 0.5) FROM dim_company""", "dim_company", "stg_quarantine")(
    lambda s, d: column_tests(marts.dim_company(marts.stage(s, d)[0]), ("company_key",)).unionByName(column_tests(marts.stage(s, d)[1], accepted={"reason_family": ("url", "entity")})).unionByName(column_tests(marts.dim_company(marts.stage(s, d)[0]), ranges={"valid_rate": (0, 0.5)}))
)
query("q2_q5_unique", "SELECT 'unique' AS test, 'company,title' AS \"column\", count(*) AS failures FROM (SELECT company, title FROM jobs GROUP BY 1, 2 HAVING count(*) > 1)", "jobs")(lambda s, d: unique_test(tables.jobs(s, d), "company", "title"))
query("q9_run_summary", "SELECT (SELECT count(*) FROM jobs) || ' extracted, ' || (SELECT count(*) FROM silver) || ' silver, ' || (SELECT count(*) FROM quarantine) || ' quarantined' AS line", "silver", "quarantine")(lambda s, d: run_summary(layers.bronze(tables.jobs(s, d))))
query("q10_q11_q14_audit")(lambda s, d: audit(tables.jobs(s, d)))
_OPEN = "CASE id % 12 WHEN 0 THEN 'JR12345' WHEN 1 THEN 'Boston,' WHEN 2 THEN 'Data Engineer Intern' WHEN 3 THEN 'BostonMA' WHEN 4 THEN 'Suite400' WHEN 5 THEN 'https://x.com/place' WHEN 6 THEN ', Boston' WHEN 7 THEN repeat('Some place ', 5) WHEN 8 THEN 'Unknown' ELSE location END"


def _open(spark, sf_dir):
    ids = F.when(F.col("job_id") == "N/A", "N/A").otherwise(F.concat(F.lit("JR-"), (F.col("id") % 90).cast("string")))
    return tables.jobs(spark, sf_dir).where("outcome = 'reviewed'").withColumn("location", F.expr(_OPEN)).withColumn("job_id", ids)


query("q14_open_audit", f"""WITH r AS (SELECT * REPLACE ({_OPEN} AS location, CASE WHEN job_id = 'N/A' THEN job_id ELSE 'JR-' || id % 90 END AS job_id) FROM jobs WHERE outcome = 'reviewed'),
    f AS (SELECT *, CASE id % 12 WHEN 0 THEN 'requisition id' WHEN 1 THEN 'stray comma' WHEN 2 THEN 'job title' WHEN 3 THEN 'no separator' WHEN 4 THEN 'run together' WHEN 5 THEN 'web address' WHEN 6 THEN 'stray comma' WHEN 7 THEN 'too long' END AS fault FROM r),
    g AS (SELECT CASE WHEN title = 'Solutions Engineer' THEN 'business_role' WHEN title = 'Software Engineer III' THEN 'too_senior' WHEN title LIKE 'Summer 2027%' THEN 'wrong_term' END AS gate FROM r), k AS (SELECT 'title' AS label, {sql_company_key("company")} || '|' || lower(title) AS key FROM r UNION ALL SELECT 'job_id', company || '|' || job_id FROM r WHERE job_id NOT IN ('', 'N/A'))
    SELECT 'gate' AS panel, gate AS label, count(*) AS n FROM g WHERE gate IS NOT NULL GROUP BY 2 UNION ALL SELECT 'age_weeks', (date_diff('day', substr(processed_at, 1, 10)::DATE, DATE '{tables.JOBS_AS_OF}') // 7)::VARCHAR, count(*) FROM r GROUP BY 2 UNION ALL SELECT 'place', fault, count(*) FROM f WHERE fault IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'place_source', coalesce(source, 'Unknown'), count(*) FROM f WHERE fault IS NOT NULL GROUP BY 2 UNION ALL SELECT 'twice', label, sum(n)::BIGINT FROM (SELECT label, key, count(*) AS n FROM k GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 2""", "jobs")(lambda s, d: open_audit(_open(s, d), tables.JOBS_AS_OF))  # fmt: skip
query("q12_rescued")(lambda s, d: rescued(tables.jobs(s, d), tables.JOBS_AS_OF))
query("u1_u2_source_union", "SELECT DISTINCT coalesce(source, 'none') AS source FROM (SELECT source FROM jobs UNION SELECT source FROM source_runs)", "jobs", "source_runs")(
    lambda s, d: tables.jobs(s, d).select("source").unionByName(tables.source_runs(s, d).select("source")).select(F.coalesce("source", F.lit("none")).alias("source")).distinct()
)
