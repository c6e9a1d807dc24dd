"""Registered queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postmill.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PUNCTUATION = ",.'\"()&/"
SUFFIXES = ("inc", "llc", "ltd", "limited", "corp", "corporation", "co", "company", "plc", "gmbh", "sa", "ag", "holdings", "group", "technologies", "technology", "labs", "the")


def sql_company_key(c: str) -> str:
    spaced = f"translate(lower(coalesce({c}, '')), ',.''\"()&/', '        ')"
    return f"trim(regexp_replace(' ' || trim(regexp_replace({spaced}, '\\s+', ' ', 'g')), '( ({'|'.join(SUFFIXES)}))+$', ''))"


def sql_company_key_single(c: str) -> str:
    return f"trim(regexp_replace(lower(regexp_replace({c}, '[,.''\"()&/]', ' ', 'g')), '\\s+(inc|llc|ltd|limited|corp|corporation|co|company|plc|gmbh|holdings|group|technologies|technology|labs)$', '', 'g'))"


def sql_rate(num: str, den: str) -> str:
    return f"coalesce(round(({num})::DOUBLE / nullif(({den}), 0), 4), 0.0)"


STATE = r"regexp_extract(location, ',\s*([A-Z]{2})\b', 1)"
CTES = {
    "jobs": tables.JOBS.format(orders="orders", customer="customer"),
    "runs": tables.RUNS.format(events="events"),
    "rejection_funnel": tables.REJECTION_FUNNEL.format(events="events"),
    "source_runs": tables.SOURCE_RUNS.format(events="events"),
    "samples": tables.SAMPLES.format(orders="orders"),
    "restricted": tables.RESTRICTED.format(orders="orders"),
    "titles": tables.TITLES.format(pages="pages"),
    "employers": tables.EMPLOYERS.format(customer="customer"),
    "fact": f"SELECT *, coalesce({STATE}, '') AS location_state, CASE WHEN lower(remote) IN ('remote', 'yes') THEN 1 ELSE 0 END AS is_remote, CASE WHEN lower(sponsorship) IN ('yes', 'true', '1') THEN 1 ELSE 0 END AS is_sponsored FROM jobs",
    "bronze": """SELECT *, replace(lower(trim(coalesce(nullif(source, ''), 'unknown'))), ' ', '_') AS p_source,
        coalesce(strftime(try_strptime(substr(run_id, 5, 8), '%Y%m%d'), '%G-W%V'), 'unknown') AS p_week FROM jobs""",
    "gated": f"""SELECT *, {sql_company_key("company")} AS _key, CASE WHEN trim(coalesce(url, '')) = '' THEN 'missing_url' WHEN trim(coalesce(company, '')) = '' THEN 'missing_company'
        WHEN trim(coalesce(title, '')) = '' THEN 'missing_title' WHEN {sql_company_key("company")} IN ('', 'unknown', 'n/a', 'na', 'none', 'null', '-') THEN 'placeholder_company'
        WHEN NOT (url LIKE 'http://%' OR url LIKE 'https://%') THEN 'malformed_url' WHEN contains(url, 'google.com/search') THEN 'search_fallback_url' END AS reason FROM bronze""",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY reason IS NULL, _key, lower(trim(title)), lower(trim(coalesce(source, 'none'))) ORDER BY id) AS _rn FROM gated",
    "silver": "SELECT * EXCLUDE (reason, _rn, _key) FROM ranked WHERE reason IS NULL AND _rn = 1",
    "quarantine": "SELECT * EXCLUDE (reason, _rn, _key), coalesce(reason, 'duplicate_grain') AS quarantine_reason FROM ranked WHERE reason IS NOT NULL OR _rn > 1",
    "stg_jobs": f"""SELECT id AS job_id_pk, url, company AS company_raw, {sql_company_key_single("company")} AS company_key, title, location, source, outcome,
        coalesce(nullif(resume_type, ''), 'UNKNOWN') AS resume_track, job_type, remote, sponsorship, run_id, p_source, p_week,
        CASE WHEN lower(sponsorship) IN ('yes', 'true', '1') THEN 1 ELSE 0 END AS is_sponsored, CASE WHEN lower(remote) LIKE '%remote%' THEN 1 ELSE 0 END AS is_remote FROM silver WHERE url IS NOT NULL""",
    "stg_quarantine": """SELECT id AS job_id_pk, url, company AS company_raw, title, source, p_source, run_id, quarantine_reason,
        CASE WHEN quarantine_reason IN ('malformed_url', 'search_fallback_url') THEN 'url' WHEN quarantine_reason IN ('missing_company', 'placeholder_company') THEN 'entity'
        WHEN quarantine_reason = 'duplicate_grain' THEN 'dedup' ELSE 'other' END AS reason_family FROM quarantine""",
    "dim_base": """SELECT company_key, max(company_raw) AS company_display, count(*) AS total_postings, count(DISTINCT source) AS source_count, count(DISTINCT resume_track) AS track_count,
        count(*) FILTER (outcome = 'valid') AS valid_postings, count(*) FILTER (outcome = 'discarded') AS discarded_postings, sum(is_sponsored)::BIGINT AS sponsored_postings, sum(is_remote)::BIGINT AS remote_postings FROM stg_jobs GROUP BY 1""",
    "dim_company": f"""SELECT *, {sql_rate("valid_postings", "valid_postings + discarded_postings")} AS valid_rate, {sql_rate("sponsored_postings", "total_postings")} AS sponsorship_rate,
        total_postings >= 20 AND {sql_rate("valid_postings", "valid_postings + discarded_postings")} < 0.05 AS is_fetch_waste FROM dim_base""",
    "fct_weekly_ingest": f"""SELECT p_week, p_source, count(*) AS postings, count(DISTINCT company_key) AS companies, count(*) FILTER (outcome = 'valid') AS valid_postings, sum(is_sponsored)::BIGINT AS sponsored_postings,
        {sql_rate("count(*) FILTER (outcome = 'valid')", "count(*)")} AS valid_rate FROM stg_jobs WHERE p_week <> 'unknown' GROUP BY 1, 2""",
    "fct_rejection_funnel": """SELECT reason_family, quarantine_reason, count(*) AS rejected_rows, round(count(*)::DOUBLE / sum(count(*)) OVER (), 4) AS share_of_rejected FROM stg_quarantine GROUP BY 1, 2""",
    "fct_source_quality": f"""SELECT coalesce(a.source, r.source) AS source, coalesce(accepted_rows, 0) AS accepted_rows, coalesce(rejected_rows, 0) AS rejected_rows, coalesce(accepted_rows, 0) + coalesce(rejected_rows, 0) AS total_rows,
        {sql_rate("coalesce(accepted_rows, 0)", "coalesce(accepted_rows, 0) + coalesce(rejected_rows, 0)")} AS yield_rate
        FROM (SELECT p_source AS source, count(*) AS accepted_rows FROM stg_jobs GROUP BY 1) a FULL JOIN (SELECT p_source AS source, count(*) AS rejected_rows FROM stg_quarantine GROUP BY 1) r ON a.source = r.source""",
}
BASES = {"fact": ["jobs"], "bronze": ["jobs"], "gated": ["bronze"], "ranked": ["gated"], "silver": ["ranked"], "quarantine": ["ranked"], "stg_jobs": ["silver"], "stg_quarantine": ["quarantine"], "dim_base": ["stg_jobs"], "dim_company": ["dim_base"], "fct_weekly_ingest": ["stg_jobs"], "fct_rejection_funnel": ["stg_quarantine"], "fct_source_quality": ["stg_jobs", "stg_quarantine"]}


def with_ctes(text: str, *names: str) -> str:
    """The text with the named views, and those they rest on, in front."""
    found: list[str] = []

    def add(name: str) -> None:
        for base in BASES.get(name, ()):
            add(base)
        if name not in found:
            found.append(name)

    for name in names:
        add(name)
    if not found:
        return text
    views = ", ".join(f"{n} AS ({CTES[n]})" for n in found)
    return f"WITH {views} {', ' + text[5:] if text.startswith('WITH ') else text}"


def query(name: str, sql: str | None = None, *views: str):
    """Registers a query, with its SQL over the named views if it has one."""
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(sql, *views)
        return run

    return add
