"""DuckDB twins of queries whose rules are arithmetic and text work, stated anew in SQL."""

from __future__ import annotations

from postmill.plans.registry import ORACLES, QUERIES, with_ctes
from postmill.sources.tables import JOBS_AS_OF

DAY = f"DATE '{JOBS_AS_OF}'"
SINCE = lambda days: f"processed_at >= strftime({DAY} - {days}, '%Y-%m-%d')"
RATES = f"""WITH r AS (SELECT source, substr(processed_at, 1, 10)::DATE AS day, count(*) AS total, count(*) FILTER (outcome = 'valid') AS ok FROM jobs WHERE source NOT IN ('Unknown', '') AND {SINCE(30)} GROUP BY 1, 2),
    span AS (SELECT source, unnest(generate_series(min(day), {DAY}, INTERVAL 1 DAY))::DATE AS day FROM r GROUP BY 1),
    f AS (SELECT span.source, span.day, coalesce(total, 0) AS total, CASE WHEN coalesce(total, 0) = 0 THEN 0.0 ELSE round(100.0::DOUBLE * ok / total, 10) END AS rate FROM span LEFT JOIN r ON span.source = r.source AND span.day = r.day),
    k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY day DESC) AS b FROM f),
    s AS (SELECT source, avg(rate) AS mean, coalesce(stddev_samp(rate), 0) AS std, max(rate) FILTER (b = 1) AS current_rate, max(total) FILTER (b = 1) AS volume, max(rate) FILTER (b = 2) AS p1, max(rate) FILTER (b = 3) AS p2 FROM k GROUP BY 1 HAVING count(*) >= 3),
    z AS (SELECT *, CASE WHEN std > 0 THEN (current_rate - mean) / std ELSE 0 END AS z, greatest(0, mean - 2 * std) AS lcl FROM s) """
HAS = lambda c, *no: f"coalesce({c}, '') NOT IN ('', {', '.join(repr(x) for x in no)})"
CHECKS = {"company": (HAS("company", "Unknown"), 2.0), "title": (HAS("title", "Unknown"), 2.0), "location": (HAS("location", "Unknown"), 1.5), "url": ("coalesce(url, '') LIKE 'http%'", 2.0), "job_id": (HAS("job_id", "N/A"), 1.0), "salary": ("coalesce(salary_low, 0) <> 0 OR coalesce(salary_high, 0) <> 0", 0.5), "sponsorship": (HAS("sponsorship", "Unknown"), 1.0), "remote": (HAS("remote", "Unknown"), 0.5)}
SCORE = "round((" + " + ".join(f"CASE WHEN {c} THEN {w} ELSE 0 END" for c, w in CHECKS.values()) + ")::DOUBLE / 10.5 * 100, 1)"
SQUASH = lambda c: f"regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9]', '', 'g')"
AGE = f"date_diff('day', substr(processed_at, 1, 10)::DATE, {DAY})"
PAGE_TITLE = "regexp_extract(html, '(?is)<title>(.*?)</title>', 1)"
TWINS: dict[str, tuple[str, ...]] = {
    "a15_summary": (f"""SELECT 'total' AS section, outcome AS label, count(*) AS n FROM fact GROUP BY 2 UNION ALL SELECT 'total', '(all)', count(*) FROM fact UNION ALL SELECT 'source', source, count(*) FROM fact WHERE {SINCE(30)} GROUP BY 2
        UNION ALL (SELECT 'reason', rejection_reason, count(*) FROM fact WHERE outcome = 'discarded' AND {SINCE(7)} AND rejection_reason <> '' GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 20)
        UNION ALL (SELECT 'state', location_state, count(*) FROM fact WHERE outcome = 'valid' AND location_state <> '' GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 15) UNION ALL SELECT 'track', resume_type, count(*) FROM fact WHERE outcome = 'valid' GROUP BY 2
        UNION ALL SELECT 'day', substr(processed_at, 1, 10), count(*) FROM fact WHERE {SINCE(14)} GROUP BY 2""", "fact"),
    "a16_report_lines": (f"SELECT coalesce(source, 'Unknown') || ': ' || count(*) || ' jobs, ' || count(*) FILTER (outcome = 'valid') || ' valid (' || round(100.0::DOUBLE * count(*) FILTER (outcome = 'valid') / count(*), 1) || '%)' AS line FROM jobs WHERE {SINCE(30)} GROUP BY source", "jobs"),
    "a18_score_batch": (f"""WITH q AS (SELECT {SCORE} AS score, list_filter([{', '.join(f"CASE WHEN NOT ({c}) THEN '{k}' END" for k, (c, _) in CHECKS.items())}], lambda x: x IS NOT NULL) AS missing FROM jobs)
        SELECT 'count' AS measure, count(*)::DOUBLE AS value FROM q UNION ALL SELECT 'avg_score', round(avg(score), 1) FROM q UNION ALL SELECT 'min_score', min(score) FROM q UNION ALL SELECT 'max_score', max(score) FROM q
        UNION ALL SELECT 'grade_' || CASE WHEN score >= 90 THEN 'A' WHEN score >= 75 THEN 'B' WHEN score >= 50 THEN 'C' WHEN score >= 25 THEN 'D' ELSE 'F' END, count(*)::DOUBLE FROM q GROUP BY 1 UNION ALL SELECT 'missing_' || m, count(*)::DOUBLE FROM (SELECT unnest(missing) AS m FROM q) GROUP BY 1""", "jobs"),
    "a30_alerts": (RATES + """, a AS (SELECT source, current_rate, mean, CASE WHEN volume = 0 THEN 'outage' WHEN z < -2 THEN 'degradation' WHEN current_rate < lcl AND std > 0 THEN 'anomaly' END AS alert_type FROM z
        UNION ALL SELECT source, current_rate, mean, 'recovery' FROM z WHERE p1 < lcl AND p2 < lcl AND current_rate >= mean)
        SELECT source, alert_type, CASE alert_type WHEN 'outage' THEN 'critical' WHEN 'degradation' THEN 'warning' ELSE 'info' END AS severity, current_rate, mean FROM a WHERE alert_type IS NOT NULL""", "jobs"),
    "a41_moving_success": ("""WITH k AS (SELECT event_type || CAST(user_id % 50 AS VARCHAR) AS pattern, value >= 50 AS ok, ts, event_id FROM events), b AS (SELECT *, row_number() OVER (PARTITION BY pattern ORDER BY ts DESC, event_id DESC) - 1 AS back FROM k)
        SELECT pattern, round(sum(CASE WHEN ok THEN 0.05::DOUBLE * pow(0.95, back) ELSE 0 END) + 0.5 * pow(0.95, count(*)), 6) AS confidence, count(*) AS tries FROM b GROUP BY 1""",),
    "j15_tracker_sync": (f"""WITH t AS (SELECT id, job_id, company, title, CASE WHEN outcome = 'valid' THEN 'Applied' ELSE 'Not Applied' END AS status FROM jobs WHERE outcome <> 'discarded'),
        a AS (SELECT job_id AS j, arg_min(status, id) AS s FROM t WHERE coalesce(job_id, '') <> '' GROUP BY 1), b AS (SELECT {SQUASH('company')} AS c, {SQUASH('title')} AS t, arg_min(status, id) AS s FROM t GROUP BY 1, 2)
        SELECT * FROM (SELECT jobs.id, jobs.company, jobs.title, coalesce(a.s, b.s, '') AS status FROM jobs LEFT JOIN a ON jobs.job_id = a.j LEFT JOIN b ON {SQUASH('jobs.company')} = b.c AND {SQUASH('jobs.title')} = b.t) WHERE status <> 'Not Applied'""", "jobs"),
    "o4_by_sponsorship": ("""WITH m AS (SELECT id, source, row_number() OVER (PARTITION BY source ORDER BY id) AS slot, row_number() OVER (PARTITION BY source ORDER BY CASE sponsorship WHEN 'Yes' THEN 0 WHEN 'Unknown' THEN 1 ELSE 2 END, company, title, id) AS k FROM jobs WHERE outcome <> 'valid')
        SELECT a.id, b.id AS place FROM m a JOIN m b ON a.source IS NOT DISTINCT FROM b.source AND a.k = b.slot UNION ALL SELECT id, id FROM jobs WHERE outcome = 'valid'""", "jobs"),
    "p16_p35_p36_p37_dates": (f"""SELECT id, CASE WHEN TRY_CAST('2001-' || strftime(d, '%m-%d') AS DATE) <= {DAY} THEN TRY_CAST('2001-' || strftime(d, '%m-%d') AS DATE) ELSE TRY_CAST('2000-' || strftime(d, '%m-%d') AS DATE) END AS entry_date, CASE WHEN {AGE} BETWEEN 0 AND 3650 THEN {AGE} END AS age, (id % 30)::INT AS text_age, (id % 30 * 7)::INT AS feed_age, (id % 9 * 7)::INT AS days_ago
        FROM (SELECT *, substr(processed_at, 1, 10)::DATE AS d FROM jobs)""", "jobs"),
    "p29_p32_p34_p48_urls": (f"""SELECT id, coalesce(url LIKE 'https://boards%', false) AS identifying, regexp_replace({SQUASH('job_id')}, '^0+', '') AS job_id, CASE WHEN url LIKE 'http%google%' THEN 'Search' ELSE '' END AS slug_title,
        CASE WHEN url LIKE 'http%' THEN url ELSE 'https://www.google.com/search?q=' || replace(url_encode(company || ' ' || title || ' careers'), '%20', '+') END AS link FROM jobs""", "jobs"),
    "p40_plain_text": (f"""WITH t AS (SELECT page_id, {PAGE_TITLE} AS t FROM pages) SELECT page_id, trim(regexp_replace(strip_accents(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')), '\\s+', ' ', 'g')) AS title FROM t""",),
    "p41_p43_location_mode": ("SELECT id, location, CASE WHEN location = 'Remote' OR remote = 'Remote' THEN 'Remote' WHEN remote = 'Hybrid' THEN 'Hybrid' WHEN remote = 'On Site' THEN 'On Site' ELSE 'Unknown' END AS mode FROM jobs", "jobs"),
    "p51_send_at": ("""WITH d AS (SELECT id, location, substr(processed_at, 1, 10)::DATE + 1 AS d FROM jobs), n AS (SELECT id, d + CASE dayofweek(d) WHEN 6 THEN 2 WHEN 0 THEN 1 ELSE 0 END AS d FROM d)
        SELECT id, timezone('UTC', timezone('America/New_York', d::TIMESTAMP + INTERVAL 10 HOUR)) AS send_at FROM n""", "jobs"),
    "p53_a50_title_preference": ("""WITH w AS (SELECT id, outcome, list_distinct(list_filter(string_split_regex(lower(title), '[^a-z0-9]+'), lambda x: length(x) > 2)) AS w FROM jobs),
        l AS (SELECT list(x) AS liked FROM (SELECT x, count(*) AS n FROM (SELECT unnest(w) AS x FROM w WHERE outcome = 'valid') GROUP BY 1 HAVING count(*) >= 3 ORDER BY n DESC, x LIMIT 50))
        SELECT id, round(least(1.0, len(list_intersect(w, liked)) / 5.0::DOUBLE), 4) AS preference FROM w, l""", "jobs"),
    "q12_rescued": (f"""SELECT id, CASE WHEN company IN (SELECT company FROM jobs WHERE outcome = 'valid') THEN 'trusted_company' ELSE 'fetch' END AS ground FROM jobs WHERE outcome = 'discarded' AND {SINCE(60)} AND title IN ('Software Engineer Intern', 'Software Engineer II', 'Data Analyst Co-op', 'Machine Learning Engineer')""", "jobs"),
    "q10_q11_q14_audit": ("""SELECT id, unnest(list_filter([CASE WHEN job_type = 'Full Time' AND (title LIKE '%Intern%' OR title LIKE '%Co-op%') THEN 'type_vs_title' END, CASE WHEN title IN ('Solutions Engineer', 'Software Engineer III', 'Summer 2027 Intern - Data') THEN 'live_gate' END,
        CASE WHEN job_id = 'N/A' AND url LIKE 'https://boards%' THEN 'missing_id_in_url' END, CASE WHEN job_type = 'Plano, TX' THEN 'bad_type' END], lambda x: x IS NOT NULL)) AS "check" FROM jobs""", "jobs"),
    "s15_forum": ("SELECT company, location, title, coalesce(url, '') AS url, '0d' AS age FROM jobs", "jobs"),
    "w11_throttle": ("""WITH RECURSIVE k AS (SELECT CAST(user_id AS VARCHAR) AS module, ts, CASE event_type WHEN 'error' THEN 'down' WHEN 'click' THEN 'slow' ELSE 'ok' END AS kind, row_number() OVER (PARTITION BY user_id ORDER BY ts, CASE event_type WHEN 'error' THEN 'down' WHEN 'click' THEN 'slow' ELSE 'ok' END) AS n FROM events),
        s AS (SELECT module, ts, kind, n, kind <> 'ok' AS sent, CASE WHEN kind <> 'ok' THEN ts END AS at FROM k WHERE n = 1 UNION ALL
        SELECT k.module, k.ts, k.kind, k.n, k.kind <> s.kind OR (k.kind <> 'ok' AND s.at IS NOT NULL AND k.ts - s.at >= INTERVAL 6 HOUR), CASE WHEN k.kind <> s.kind OR (k.kind <> 'ok' AND s.at IS NOT NULL AND k.ts - s.at >= INTERVAL 6 HOUR) THEN k.ts ELSE s.at END FROM s JOIN k ON k.module = s.module AND k.n = s.n + 1)
        SELECT module, ts, kind, sent FROM s""",),
    "o6_p52_relevance": ("""WITH w AS (SELECT id, lower(title || ' ' || job_type) AS b, lower(title) AS t, lower(company) AS c FROM jobs), m AS (SELECT *, CASE WHEN regexp_matches(b, '\\bmachine learning\\b') THEN 1 ELSE 0 END AS ml, CASE WHEN regexp_matches(b, '\\bdata\\b') THEN 1 ELSE 0 END AS da,
        CASE WHEN regexp_matches(b, '\\bsoftware\\b') THEN 1 ELSE 0 END AS so, CASE WHEN regexp_matches(b, '\\banalyst\\b') THEN 1 ELSE 0 END AS an, CASE WHEN regexp_matches(b, '\\bengineer\\b') THEN 1 ELSE 0 END AS en FROM w)
        SELECT id, least(100, CASE WHEN ml + da + so > 0 THEN least(60, floor(60 * (0.6 * (5 * ml + 2 * da + 2 * so) / greatest(1, 5 * ml + 2 * da + 2 * so + 2 * an + en) + 0.4 * least(1.0, (ml + da + so) / 4.0)))) ELSE 0 END
        + least(25, 5 * CASE WHEN t LIKE '%machine learning%' THEN 5 WHEN t LIKE '%data%' THEN 4 WHEN t LIKE '%software engineer%' THEN 4 WHEN t LIKE '%analyst%' THEN 3 WHEN t LIKE '%engineer%' THEN 2 ELSE 0 END) + least(15, 3 * CASE WHEN c LIKE '%acme 1%' THEN 5 WHEN c LIKE '%acme%' THEN 2 ELSE 0 END))::INT AS score FROM m""", "jobs"),
}
for _name, (_sql, *_views) in TWINS.items():
    if _name in QUERIES:
        ORACLES[_name] = with_ctes(_sql, *_views)
