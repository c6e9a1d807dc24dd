"""Posting tables derived by Spark from the star-schema Parquet tables, so that every query has data that grows with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

JOBS_AS_OF, RUNS_AS_OF = "2001-08-01", "2024-01-31"

#: {orders} and {customer} are tables; the same text runs in Spark and DuckDB
JOBS = """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL
       WHEN o_orderkey % 13 = 0 THEN 'ftp://files.example/' || CAST(o_orderkey AS STRING)
       WHEN o_orderkey % 17 = 0 THEN 'https://www.google.com/search?q=' || CAST(o_orderkey AS STRING)
       ELSE 'https://boards.greenhouse.io/c' || CAST(o_custkey % 40 AS STRING) || '/jobs/' || CAST(1000000 + o_orderkey AS STRING) || '?utm=x' END AS url,
  CASE WHEN o_orderkey % 23 = 0 THEN '' WHEN o_orderkey % 29 = 0 THEN 'Unknown'
       ELSE 'Acme ' || CAST(o_custkey % 40 AS STRING) ||
            CASE o_orderkey % 5 WHEN 0 THEN ' Inc.' WHEN 1 THEN ', LLC' WHEN 2 THEN ' Technologies' WHEN 3 THEN ' Group, Inc.' ELSE '' END END AS company,
  CASE o_orderkey % 7 WHEN 0 THEN 'Software Engineer Intern' WHEN 1 THEN 'Software Engineer II' WHEN 2 THEN 'Data Analyst Co-op'
       WHEN 3 THEN 'Machine Learning Engineer' WHEN 4 THEN 'Solutions Engineer' WHEN 5 THEN 'Software Engineer III' ELSE 'Summer 2027 Intern - Data' END AS title,
  CASE o_orderkey % 4 WHEN 0 THEN 'Boston, MA' WHEN 1 THEN 'New York, NY' WHEN 2 THEN 'Remote' ELSE 'Unknown' END AS location,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE c_mktsegment END AS source,
  CASE o_orderstatus WHEN 'F' THEN 'valid' WHEN 'O' THEN 'discarded' ELSE 'reviewed' END AS outcome,
  CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE '' END AS rejection_reason,
  CASE o_orderkey % 3 WHEN 0 THEN 'SDE' WHEN 1 THEN 'ML' ELSE 'DA' END AS resume_type,
  CASE o_orderkey % 4 WHEN 0 THEN 'Internship' WHEN 1 THEN 'Full Time' WHEN 2 THEN 'Co-op' ELSE 'Plano, TX' END AS job_type,
  CASE WHEN o_orderkey % 3 = 0 THEN 'N/A' ELSE 'JR-' || CAST(o_orderkey AS STRING) END AS job_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'Remote' WHEN 1 THEN 'On Site' WHEN 2 THEN 'Hybrid' ELSE 'Unknown' END AS remote,
  CASE o_orderkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END AS sponsorship,
  CAST(NULL AS DOUBLE) AS salary_low, CAST(NULL AS DOUBLE) AS salary_high, CAST(NULL AS BIGINT) AS page_age_days,
  o_totalprice AS processing_time_ms, '' AS entry_date,
  substr(CAST(o_orderdate AS STRING), 1, 10) || 'T00:00:00' AS processed_at,
  'run_' || replace(substr(CAST(o_orderdate AS STRING), 1, 10), '-', '') || '_000000' AS run_id
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

RUNS = """
SELECT min(ts) AS ts, count(CASE WHEN event_type = 'purchase' THEN 1 END) AS valid, count(CASE WHEN event_type = 'error' THEN 1 END) AS discarded,
  count(CASE WHEN event_type = 'view' THEN 1 END) AS duplicate_url, count(CASE WHEN event_type = 'click' THEN 1 END) AS duplicate_job,
  count(CASE WHEN event_type = 'signup' THEN 1 END) AS skipped_old, 0 AS skipped_non_tech, 0 AS skipped_international, 0 AS skipped_clearance,
  0 AS skipped_blacklisted, count(CASE WHEN value < 1 THEN 1 END) AS failed_http, round(sum(value), 3) AS elapsed_seconds
FROM {events} GROUP BY CAST(ts AS DATE)
"""

REJECTION_FUNNEL = """
SELECT CAST(CAST(ts AS DATE) AS STRING) AS date, event_type AS stage, event_type || '-' || CAST(user_id % 5 AS STRING) AS reason_category, count(*) AS count
FROM {events} GROUP BY 1, 2, 3
"""

SOURCE_RUNS = """
SELECT event_type AS source, CAST(ts AS DATE) AS run, count(*) AS fetched, count(CASE WHEN value >= 50 THEN 1 END) AS valid
FROM {events} GROUP BY 1, 2
"""

TITLES = "SELECT page_id AS id, regexp_extract(url, '^https?://[^/]*[.]([a-z]+)', 1) AS company, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM {pages}"

EMPLOYERS = """
SELECT 'ACME ' || CAST(c_custkey % 60 AS STRING) || ' LLC' AS name, CAST(floor(c_acctbal) AS INT) AS approvals FROM {customer} WHERE c_acctbal > 0
"""

#: postings with a wide range of texts, dealt to the orders in turn
SAMPLE_TITLES = (
    "Software Engineer Intern", "US Citizens Only - Software Engineer Intern", "Security Clearance Required Developer", "2025 New Grad Software Engineer", "New Grad Software Engineer 2027", "Summer 2027 Software Intern", "Spring 2027 Software Intern",
    "Software Intern (Fall 2028)", "Software Engineer Summer 2027 Start", "Summer Data Intern", "Sales Analytics Intern", "Salesforce Developer", "Technical Recruiter", "Customer Solutions AI Intern", "Hardware Engineer", "Hardware Software Engineer",
    "Silicon Validation AI Intern", "Senior Software Engineer", "Software Engineer III", "Software Engineer II", "Software Engineer 4", "Staff Engineer New Grad Program", "Registered Nurse", "Nurse Software Developer", "Data Engineer", "Engineering Manager",
)
SAMPLE_TEXTS = (
    "We will consider all. Open to everyone.", "An active secret clearance is needed.", "Must be a U.S. citizen.", "Visa: no visa sponsorship.", "You graduate by December 2026.", "Permanent work authorization needed.", "For high school students only.",
    "A currently enrolled undergraduate student.", "A currently enrolled undergraduate or master student.", "Undergraduate students only." + " filler" * 100 + " a master student", "A degree in nursing.", "A degree in biology or computer science.",
    "Preferred degree: mechanical engineering.", "PhD students only.", "PhD students or master students.", "Enrolled at a university in Texas.", "We do not accept CPT.", "We do not accept OPT extensions, but are CPT eligible.", "US person status.",
    "US person under export compliance rules.", "For bachelor''s students only.", "For the class of 2029.", "Graduating between 2026 and 2029.", "Class of 2028 or later.", "Pay is $18 - $22 per hour.", "Pay is $30 per hour.", "Needs 5+ years of work.", "Needs 2 to 6 years, or 4 years.",
)
SAMPLE_PLACES = ("Boston, MA", "Toronto, ON", "London", "London, KY", "Bangalore, India", "Remote", "", "San Francisco", "Vancouver, WA", "Cambridge, Ontario, Canada", "Munich, Germany", "Somewhere")


def _dealt(values: tuple[str, ...]) -> str:
    return f"CASE o_orderkey % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


SAMPLES = f"""
SELECT o_orderkey AS id, {_dealt(SAMPLE_TITLES)} AS title, {_dealt(SAMPLE_TEXTS)} AS body, {_dealt(SAMPLE_PLACES)} AS location, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 9 AS INT) END AS age,
  'Acme ' || CAST(o_custkey % 40 AS STRING) AS company, CASE o_orderkey % 5 WHEN 0 THEN 'https://jobs.acme.ca/1' WHEN 1 THEN 'https://acme.co.uk/jobs/2' ELSE 'https://acme.example.com/jobs/3' END AS url
FROM {{orders}}
"""

#: statements of restrictions, and sentences that may save them, at distances that grow with the order's number
STATEMENTS = (
    "Currently pursuing a bachelor''s degree in Computer Science.", "Must be a rising junior or senior in an accredited university.", "Must be at least advancing to their junior year of study.", "Requires sophomore standing or higher.", "Pursuing a BS/MS in Computer Engineering.",
    "Currently pursuing a bachelor''s or master''s degree in CS.", "Must be currently pursuing a Ph.D. in computer science.", "PhD Internship - Machine Learning Research.", "This is a Summer 2027 internship program.", "Currently pursuing a degree in Computer Science or related field.", "Join our team as a software engineering intern!",
    "In process of obtaining a Bachelors degree.", "Enrolled in an accredited four-year college.", "We will not provide documentation for CPT.", "Sponsorship is not available, which includes F-1 (OPT).", "U.S. Person status; a DoD contract.", "Degrees preferred: mechanical engineering, physics.", "Preferred majors: mechanical or computer science.",
    "Bachelor''s in electrical engineering.", "Graduation date of December 2026.", "Bachelor''s students only.", "Requires a PhD.", "Candidates enrolled in a PhD program.",
)
SAVERS = ("Master''s students are welcome.", "We support CPT.", "Subject to export control rules.", "Computer science or software.", "Nothing else.", "Graduate students may apply.", "Line one.")
#: pages with headings: rules on doctoral studies and places look at their sections
SAMPLE_PAGES = (
    "<h2>About us</h2><p>Our founders enrolled at a university in Texas.</p><h2>Requirements</h2><p>Python.</p>", "<h2>Requirements</h2><p>Enrolled at a university in Texas.</p>", "<h2>Requirements</h2><p>You attend a college within the greater Chicago area.</p>", "<h2>Requirements</h2><p>Enrolled at a university in Massachusetts.</p>",
    "<h2>Requirements</h2><p>Enrolled at a college or university in the United States.</p>", "<h3>Benefits</h3><p>Students at our partner college in Ohio get a discount.</p>", "<h3>Who you are</h3><ul><li>A PhD student</li></ul>", "<h3>Who we are</h3><p>Half of us have a PhD degree.</p><h3>Qualifications</h3><p>Python.</p>",
    "<p>PhD candidates.</p>{filler}<h2>Minimum qualifications</h2><p>Pursuing an MS degree or a PhD.</p>", "<p>PhD candidates.</p>{filler}<h2>About the team</h2><p>We advise master students.</p>", "<h2>Nice to have</h2><p>Current PhD.</p>{filler}<p>Or a Masters.</p>", "<h2>Responsibilities</h2><p>Work with a PhD intern.</p>",
    "<b>Requirements:</b><br>You must live in California.<br>", "<b>Our story</b><br>Our staff must live in California.<br>", "<script>PhD students only</script><p>Open to all.</p>", "<p>PhD&nbsp;students&nbsp;only</p>", "<div>Doctoral candidates</div><div>only</div>", "<p>Pursuing a Ph.D. or M.S. degree in statistics.</p>",
    "<h2>Qualifications</h2><p>Study at a university located in Ontario.</p>", "<h1>PhD</h1><h2>Internship</h2><p>Open.</p>",
)


RESTRICTED = f"""
SELECT o_orderkey AS id, {{statements}} || CASE WHEN o_orderkey % 3 = 0 THEN chr(10) ELSE ' ' END || repeat('Some words here. ', CAST(o_custkey % 3 * (o_custkey % 3 + 1) * 6 AS INT)) || {{savers}} AS body, {{pages}} AS html FROM {{{{orders}}}}
"""

RESTRICTED = RESTRICTED.format(statements=_dealt(STATEMENTS), savers=_dealt(SAVERS), pages=_dealt(tuple(p.replace("{filler}", "<p>" + "words " * 120 + "</p>") for p in SAMPLE_PAGES)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derived(text: str, *names: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})

    return run


jobs = _derived(JOBS, "orders", "customer")
runs = _derived(RUNS, "events")
rejection_funnel = _derived(REJECTION_FUNNEL, "events")
source_runs = _derived(SOURCE_RUNS, "events")
samples = _derived(SAMPLES, "orders")
restricted = _derived(RESTRICTED, "orders")
titles = _derived(TITLES, "pages")
employers = _derived(EMPLOYERS, "customer")
