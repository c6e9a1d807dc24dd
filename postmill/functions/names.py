"""Titles, companies and places in their clean forms, and classes read from them (P9, P15, P21-P23, P31, P39, P42b, P44-P46, P55, F15b-F15d, J11, J12, J14)."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.functions import columns as C
from postmill.operators import enrich, gates
from postmill.plans import reports
from postmill.plans.registry import query
from postmill.sources import tables

#: fixed values: names of states and provinces and their codes, two-word names first
STATE_NAMES = {
    "New York": "NY", "New Jersey": "NJ", "North Carolina": "NC", "South Carolina": "SC", "New Hampshire": "NH", "West Virginia": "WV", "Rhode Island": "RI", "British Columbia": "BC", "California": "CA", "Massachusetts": "MA", "Texas": "TX",
    "Washington": "WA", "Illinois": "IL", "Florida": "FL", "Georgia": "GA", "Colorado": "CO", "Virginia": "VA", "Pennsylvania": "PA", "Ohio": "OH", "Michigan": "MI", "Oregon": "OR", "Arizona": "AZ", "Utah": "UT", "Ontario": "ON", "Quebec": "QC", "Alberta": "AB",
}
PROVINCES = ("ON", "BC", "QC", "AB", "MB", "SK", "NS", "NB")
COUNTRIES = r"\b(canada|united kingdom|england|india|germany|france|spain|ireland|singapore|mexico|australia|poland|brazil|netherlands|japan|china)\b"
AMBIGUOUS = r"^(london|vancouver|cambridge|waterloo|windsor|hamilton)\b"


def state_from_words(location: Column) -> Column:
    """The state's code, Remote, Hybrid, or the code of a state's name in the text."""
    t = C.text(location)
    named = F.coalesce(*[F.when(t.contains(name), code) for name, code in STATE_NAMES.items()], F.lit("Unknown"))
    return F.when(F.lower(t).contains("remote"), "Remote").when(F.lower(t).contains("hybrid"), "Hybrid").when(C.state_code(t) != "", C.state_code(t)).otherwise(named)


def with_state_codes(location: Column) -> Column:
    """State names after a comma become codes."""
    found = location
    for name, code in STATE_NAMES.items():
        found = F.regexp_replace(found, rf",\s*{name}\b", f", {code}")
    return found


def job_type_of(title: Column, source: Column) -> Column:
    """From the title, then from the source's name, else full time, which first jobs after a degree are too."""
    t, s = F.lower(C.text(title)), F.lower(C.text(source))
    return F.when(t.rlike(r"co[\s-]?op\b"), "Co-op").when(t.rlike(r"\bintern(ship)?s?\b"), "Internship").when(t.rlike(r"new grad|entry[ -]level"), "Full Time").when(s.contains("intern"), "Internship").otherwise("Full Time")


def track(title: Column) -> Column:
    """ML, then DA, else SDE."""
    t = F.lower(C.text(title))
    return F.when(t.rlike(r"machine learning|deep learning|\bai\b|\bml\b|computer vision|nlp"), "ML").when(t.rlike(r"\bdata\b|analyst|analytics|business intelligence"), "DA").otherwise("SDE")


def role_category(title: Column) -> Column:
    """The first category whose words the title has, and none of its excluded words."""
    t = F.lower(C.text(title))
    rules = (("Machine Learning", r"machine learning|\bai\b", ""), ("Data", r"\bdata\b|analyst", "data center"), ("Security", r"security|cyber", "security guard"), ("Infrastructure", r"devops|cloud|\bsre\b", ""), ("Software", r"software|developer|engineer", "solutions engineer"))
    return F.coalesce(*[F.when(t.rlike(p) & ~(t.rlike(no) if no else F.lit(False)), name) for name, p, no in rules], F.lit("Other"))


def job_id_votes(url: Column) -> Column:
    """(id, confidence) of the first pattern that a URL matches; null if none."""
    u = C.text(url)
    rules = ((r"[?&](?:gh_jid|job_?id|jid)=([A-Za-z0-9-]+)", 0.95), (r"/jobs?/(\d{4,})", 0.9), (r"_((?:JR|R|REQ)-?\d+)", 0.9), (r"/([0-9a-f]{8}-[0-9a-f-]{27})", 0.85), (r"/(\d{5,})(?:/|$|\?)", 0.6))
    return F.coalesce(*[F.when(F.regexp_extract(u, p, 1) != "", F.struct(F.regexp_extract(u, p, 1).alias("job_id"), F.lit(c).alias("confidence"))) for p, c in rules])


def page_age(text: Column) -> Column:
    """Days since posting that a page states, without start dates and copyright lines."""
    t = F.regexp_replace(F.lower(C.text(text)), r"(start date|copyright|©)[^.\n]{0,40}", " ")
    return C.days_ago(F.regexp_extract(t, r"(?:posted|published|updated)\s*:?\s*((?:\d+\+?\s*(?:minute|hour|day|week|month|year)s?\s*ago)|today|yesterday)", 1))


def company_name(c: Column) -> Column:
    """Board codes and legal suffixes off, slugs in words, all-capital words of five letters or more in title case; placeholders are null."""
    t = F.trim(F.regexp_replace(F.regexp_replace(C.text(c), r"^\d{3,}\s+|\s*\([^)]*\)$", ""), r"(?i),?\s+(inc|llc|ltd|corp|co|plc|gmbh)\.?$", ""))
    words = F.when(t.rlike(r"^[a-z0-9]+(-[a-z0-9]+)+$"), F.initcap(F.replace(t, F.lit("-"), F.lit(" ")))).when((t == F.upper(t)) & (F.length(t) > 4), F.initcap(t)).otherwise(t)
    return F.when(~F.lower(words).isin(*C.PLACEHOLDERS), words)


def is_company(c: Column) -> Column:
    """A name of 2 to 70 characters with a letter, no placeholder, no address and no sentence."""
    t = F.trim(C.text(c))
    return F.length(t).between(2, 70) & t.rlike(r"\p{L}") & ~F.lower(t).isin(*C.PLACEHOLDERS) & ~t.rlike(r"https?://|@|\. [A-Z]") & ~F.lower(t).rlike(r"^(apply|careers?|jobs?|home|login)$")


def clean_title(c: Column) -> Column:
    """In order: leading junk, spaced hyphens, segments after bars that name a team or month, 'X is hiring for', brackets, seasons (unless an internship), repeated halves; under five letters the original stays."""
    t = F.regexp_replace(F.regexp_replace(C.text(c), r"^[^\p{L}\p{N}]+", ""), r"(?i)^[a-z0-9-]+\.(ai|com|io|co|org|net)\s+(?=\p{L})", "")
    # a dash that touches the word before it only is spaced; one at the end goes
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"(?<=[\p{L})])-\s+(?=\p{L})", " - "), r"\s+[-–—]\s+", " - "), r"\s*[-–—,:]+\s*$", "")
    t = F.array_join(F.filter(F.split(t, r"\s*\|\s*"), lambda s: ~F.lower(s).rlike(r"\bteam$|^(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*( \d{4})?$")), " | ")
    t = F.regexp_replace(t, r"(?i)^.{2,40} is hiring (for )?(an? )?", "")
    t = F.regexp_replace(t, r"\s*[\[(][^\])]*[\])]", "")
    t = F.when(~F.lower(t).rlike(gates.INTERN), F.regexp_replace(t, r"(?i)\s*[-,]?\s*\b(spring|summer|fall|winter)\s*20\d\d\b|\s*[-,]\s*20\d\d$", "")).otherwise(t)
    t = F.trim(F.regexp_replace(F.regexp_replace(t, r"^(.{5,}?)\s*[-|,]?\s*\1$", "$1"), r"\s+", " "))
    return F.when(F.lower(t).rlike(gates.JUNK), "").when(F.length(t) < 5, c).otherwise(t)


def page_title_role(raw: Column, company: Column) -> Column:
    """The role in a page's title: before the first separator, without 'at Company'; site furniture is empty."""
    t = F.trim(F.split(C.text(raw), r"\s+[|–—-]\s+", 2)[0])
    t = F.regexp_replace(t, r"(?i)\s+at\s+\S.*$", "")
    t = F.when((C.text(company) != "") & F.endswith(F.lower(t), F.lower(company)), F.trim(F.substr(t, F.lit(1), F.length(t) - F.length(company)))).otherwise(t)
    return F.when(F.lower(t).rlike(gates.JUNK), "").otherwise(t)


def place_in_url(url: Column) -> Column:
    """P55: 'City-ST' in a URL's path as 'City, ST'."""
    u = C.text(url)
    city, state = (F.regexp_extract(u, r"/([A-Z][a-z]+(?:-[A-Z][a-z]+)?)-([A-Z]{2})(?:[/_?-]|$)", i) for i in (1, 2))
    return F.when(state.isin(*C.STATES), F.concat(F.replace(city, F.lit("-"), F.lit(" ")), F.lit(", "), state))


def international(location: Column, url: Column, title: Column, company: Column) -> Column:
    """F15b-F15d: why a posting lies abroad, in order: country in the title, URL, province, country or city in the place, company; null if it doesn't.

    Cities that exist on both sides count for the US unless Canadian signs outweigh American ones.
    """
    place, code = F.lower(C.text(location)), C.state_code(location)
    canada = F.when(place.rlike("canada"), 3).otherwise(0) + F.when(C.text(url).rlike(r"\.ca(/|$)"), 3).otherwise(0) + F.when(code.isin(*PROVINCES), 2).otherwise(0)
    us = F.when(place.rlike(r"\b(us|usa|united states)\b"), 3).otherwise(0) + F.when(code.isin(*C.STATES), 2).otherwise(0)
    return (
        F.when(F.lower(C.text(title)).rlike(COUNTRIES), "title").when(C.text(url).rlike(r"^https?://[^/]+\.(ca|co\.uk|de|in|fr)(/|$)"), "url").when(place.rlike(AMBIGUOUS), F.when(canada > us, "ambiguous_city"))
        .when(code.isin(*PROVINCES), "province").when(place.rlike(gates.FOREIGN) & ~code.isin(*C.STATES), "place").when(F.lower(C.text(company)).rlike(r"\b(canada|uk|india|gmbh|pty|s\.?a\.? de c\.?v)\b"), "company")
    )


def public_posting(jobs: DataFrame) -> DataFrame:
    """The allowed fields of a posting, with normalised classes; private columns don't appear."""
    return jobs.select("id", company_name(F.col("company")).alias("company"), "title", F.coalesce("location", F.lit("Unknown")).alias("location"), "source", F.when(C.text(F.col("url")).startswith("http"), F.col("url")).alias("url"), C.job_type(F.col("job_type")).alias("job_type"), C.is_remote_sheet(F.col("remote")).alias("remote"), (C.is_sponsored(F.col("sponsorship")) == 1).alias("sponsored"))


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """1 for equal names, 0.9 if one holds the other, else the share of common substrings."""
    def one(x: str | None, y: str | None) -> float:
        x, y = ("".join(ch for ch in (t or "").lower() if ch.isalnum()) for t in (x, y))
        if not x or not y:
            return 0.0
        return 1.0 if x == y else 0.9 if x in y or y in x else difflib.SequenceMatcher(None, x, y, autojunk=False).ratio()

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)])


def revised_company(jobs: DataFrame, least: float = 0.4) -> DataFrame:
    """Id, score and company: below the least similarity the URL's company wins over the stated one."""
    slug = C.company_slug(F.col("url"))
    scored = jobs.select("id", "company", slug.alias("slug"), similarity(F.col("company"), slug).alias("score"))
    return scored.select("id", F.round("score", 4).alias("score"), F.when(F.col("slug").isNotNull() & (F.col("score") < least), F.initcap(F.replace("slug", F.lit("-"), F.lit(" ")))).otherwise(F.col("company")).alias("company"))


def run_counters(runs: DataFrame) -> DataFrame:
    """A run's counters as rejection rows (stage, reason, count) through the outcome table."""
    stages = {"duplicate_url": "dedup", "duplicate_job": "dedup", "skipped_old": "age", "skipped_non_tech": "title", "skipped_international": "location", "skipped_clearance": "page", "skipped_blacklisted": "company", "failed_http": "fetch", "discarded": "validation"}
    rows = runs.unpivot(["ts"], list(stages), "reason", "count").where("count > 0")
    return rows.select("ts", F.coalesce(*[F.when(F.col("reason") == k, v) for k, v in stages.items()]).alias("stage"), "reason", "count")


def sheet_yield(valid: DataFrame, discarded: DataFrame) -> DataFrame:
    """Per source of two sheets: valid and discarded rows and the yield; sources of either appear."""
    v, d = (df.groupBy(F.coalesce("source", F.lit("Unknown")).alias("source")).agg(F.count(F.lit(1)).alias(n)) for df, n in ((valid, "valid"), (discarded, "discarded")))
    n = lambda c: F.coalesce(c, F.lit(0))
    return v.join(d, "source", "full").select("source", n("valid").alias("valid"), n("discarded").alias("discarded"), C.valid_rate(n("valid"), n("valid") + n("discarded")).alias("yield"))


def _jobs(spark, sf_dir):
    return tables.jobs(spark, sf_dir)


query("p9_state", "SELECT id, CASE location WHEN 'Boston, MA' THEN 'MA' WHEN 'New York, NY' THEN 'NY' WHEN 'Remote' THEN 'Remote' ELSE 'Unknown' END AS state FROM jobs", "jobs")(lambda s, d: _jobs(s, d).select("id", state_from_words(F.col("location")).alias("state")))
query("p15_public_postings", "SELECT id, location, CASE WHEN url LIKE 'http%' THEN url END AS url, lower(trim(remote)) = 'remote' AS remote, lower(sponsorship) IN ('yes', 'true', '1') AS sponsored FROM jobs", "jobs")(lambda s, d: public_posting(_jobs(s, d)).select("id", "location", "url", "remote", "sponsored"))
query("p21_p22_p23_classes", """SELECT id, CASE WHEN title LIKE '%Co-op%' THEN 'Co-op' WHEN title LIKE '%Intern%' THEN 'Internship' ELSE 'Full Time' END AS job_type, CASE WHEN title LIKE '%Machine Learning%' THEN 'ML' WHEN title LIKE '%Data%' THEN 'DA' ELSE 'SDE' END AS track,
    CASE WHEN title LIKE '%Machine Learning%' THEN 'Machine Learning' WHEN title LIKE '%Data%' THEN 'Data' WHEN title LIKE 'Solutions%' THEN 'Other' ELSE 'Software' END AS category FROM jobs""", "jobs")(
    lambda s, d: _jobs(s, d).select("id", job_type_of(F.col("title"), F.col("source")).alias("job_type"), track(F.col("title")).alias("track"), role_category(F.col("title")).alias("category"))
)
query("p31_job_id_votes", "SELECT id, CASE WHEN url LIKE 'https://boards%' THEN regexp_extract(url, '/jobs/(\\d+)', 1) WHEN regexp_matches(url, '^ftp.*/\\d{5,}$') THEN regexp_extract(url, '(\\d{5,})$', 1) END AS job_id, CASE WHEN url LIKE 'https://boards%' THEN 0.9::DOUBLE WHEN regexp_matches(url, '^ftp.*/\\d{5,}$') THEN 0.6::DOUBLE END AS confidence FROM jobs", "jobs")(
    lambda s, d: _jobs(s, d).select("id", job_id_votes(F.col("url")).alias("v")).select("id", "v.*")
)
query("p39_page_age", "SELECT id, CASE WHEN id % 3 = 0 THEN NULL ELSE (id % 30)::INT END AS age FROM samples", "samples")(
    lambda s, d: tables.samples(s, d).select("id", page_age(F.concat(F.lit("Start date: posted 9 days ago. "), "body", F.when(F.col("id") % 3 == 0, " Copyright: posted ").otherwise(" Posted: "), (F.col("id") % 30).cast("string"), F.lit(" days ago"))).alias("age"))
)
query("p42_p44_p45_names", "SELECT id, CASE WHEN company IN ('', 'Unknown') THEN NULL ELSE regexp_replace(company, ',? (Inc|LLC)[.]?$', '') END AS name, company NOT IN ('', 'Unknown') AS ok, location FROM jobs", "jobs")(
    lambda s, d: _jobs(s, d).select("id", company_name(F.col("company")).alias("name"), is_company(F.col("company")).alias("ok"), with_state_codes(F.col("location")).alias("location"))
)
query("p46_p55_titles", """SELECT id, CASE id % 26 WHEN 1 THEN 'US Citizens Only' ELSE title END AS role, CASE id % 26 WHEN 7 THEN 'Software Intern' WHEN 8 THEN 'Software Engineer Start' ELSE title END AS title, CASE WHEN id % 2 = 0 THEN 'San Jose, CA' END AS place FROM samples""", "samples")(
    lambda s, d: tables.samples(s, d).select("id", page_title_role(F.concat("title", F.lit(" at Acme - Careers")), F.lit("")).alias("role"), clean_title(F.concat(F.lit("-- "), "title", F.lit(" [Remote] | Platform Team"))).alias("title"), place_in_url(F.concat(F.lit("https://x.example.com/job/San-Jose-"), F.when(F.col("id") % 2 == 0, "CA").otherwise("ZZ"), F.lit("/1"))).alias("place"))
)
query("f15_international", """SELECT id, CASE WHEN id % 5 < 2 THEN 'url' ELSE CASE id % 12 WHEN 1 THEN 'province' WHEN 4 THEN 'place' WHEN 9 THEN 'ambiguous_city' WHEN 10 THEN 'place' END END AS reason FROM samples""", "samples")(
    lambda s, d: tables.samples(s, d).select("id", international(F.col("location"), F.col("url"), F.col("title"), F.col("company")).alias("reason"))
)
query("f15d_company", "SELECT id, CASE WHEN id % 4 = 0 THEN 'company' END AS reason FROM samples WHERE id % 12 = 0", "samples")(
    lambda s, d: tables.samples(s, d).where("location = 'Boston, MA'").select("id", international(F.col("location"), F.lit(""), F.col("title"), F.concat("company", F.lit(" GmbH"))).alias("reason"))
)
query("j11_revised_company")(lambda s, d: revised_company(_jobs(s, d)))
query("j12_same_employer", "SELECT id, company LIKE 'Acme%' AS same FROM jobs", "jobs")(
    lambda s, d: _jobs(s, d).select("id", enrich.same_employer(F.col("company"), F.concat(F.lit("Acme "), (F.col("id") % 7).cast("string"), F.lit(" Holdings"))).alias("same"))
)
query("j14_reconciled", "SELECT id, title || ' Remote' AS title FROM jobs", "jobs")(lambda s, d: _jobs(s, d).select("id", enrich.reconciled(F.col("title"), F.concat("title", F.lit(" Remote")))[0].alias("title")))
query("j10_a37_run_counters", "SELECT ts, 'dedup' AS stage, 'duplicate_url' AS reason, duplicate_url AS count FROM runs WHERE duplicate_url > 0 UNION ALL SELECT ts, 'dedup', 'duplicate_job', duplicate_job FROM runs WHERE duplicate_job > 0 UNION ALL SELECT ts, 'age', 'skipped_old', skipped_old FROM runs WHERE skipped_old > 0 UNION ALL SELECT ts, 'fetch', 'failed_http', failed_http FROM runs WHERE failed_http > 0 UNION ALL SELECT ts, 'validation', 'discarded', discarded FROM runs WHERE discarded > 0", "runs")(
    lambda s, d: run_counters(tables.runs(s, d).withColumns({c: F.col(c).cast("long") for c in ("skipped_non_tech", "skipped_international", "skipped_clearance", "skipped_blacklisted")}))
)
query("a27_u2_sheet_yield", "SELECT coalesce(source, 'Unknown') AS source, count(*) FILTER (outcome = 'valid') AS valid, count(*) FILTER (outcome = 'discarded') AS discarded, round(count(*) FILTER (outcome = 'valid')::DOUBLE / count(*), 4) AS yield FROM jobs WHERE outcome IN ('valid', 'discarded') GROUP BY 1", "jobs")(
    lambda s, d: sheet_yield(_jobs(s, d).where("outcome = 'valid'"), _jobs(s, d).where("outcome = 'discarded'"))
)
query("s5_incremental", "SELECT id FROM jobs WHERE url IS NOT NULL AND url NOT IN (SELECT url FROM jobs WHERE outcome = 'valid' AND url IS NOT NULL)", "jobs")(
    lambda s, d: _jobs(s, d).where("url IS NOT NULL").join(_jobs(s, d).where("outcome = 'valid'").select("url"), "url", "left_anti").select("id")
)
query("a28_snapshot_views", "SELECT 'jobs' AS view, count(*) AS rows FROM fact WHERE outcome = 'valid' AND url LIKE 'http%' UNION ALL SELECT 'companies', count(*) FROM dim_company UNION ALL SELECT 'weekly', count(DISTINCT p_week) FROM fct_weekly_ingest", "fact", "dim_company", "fct_weekly_ingest")(lambda s, d: _snapshot(s, d))


def _snapshot(spark, sf_dir):
    """The row counts of the snapshot's views."""
    from functools import reduce

    from postmill.plans import marts

    staged = marts.stage(spark, sf_dir)[0]
    views = {"jobs": reports.search(reports.fact(_jobs(spark, sf_dir))), "companies": marts.dim_company(staged), "weekly": reports.weekly(marts.weekly_ingest(staged))}
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("view"), "rows") for n, df in views.items()])
