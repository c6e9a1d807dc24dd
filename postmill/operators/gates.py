"""Posting gates: rules that give the first failing reason, or null.

Word lists that decide verdicts are fixed values; how they combine is written here. A rule fires on lower-case text; a chain stops at its first hit, so
cheap gates stand first.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions import columns as C
from postmill.operators.restrictions import page_reason, page_text, restriction  # noqa: F401
from postmill.plans.registry import query
from postmill.sources import tables


class Rule(NamedTuple):
    reason: str
    pattern: str
    rescue: str = ""


#: fixed values: names of student roles, each also in the plural; a space stands for up to three signs
ROLES = ("coop", "co op", "future talent", "intern", "internship", "summer analyst")
INTERN = "\\b(?:" + "|".join(w.replace(" ", r"\W{1,3}") for w in ROLES) + r")s?\b"
GRADUATION = 2027
#: fixed values: words of titles by class: Summer, other Late seasons, Early seasons, Roles, First and later Years of the early seasons
CLASSES = {
    "S": ("summer",), "L": ("autumn", "fall"), "E": ("january", "jan", "spring", "winter"), "R": ("coop", "coops", "intern", "interns", "internship", "internships"), "F": ("26", "2026"), "Y": ("27", "28", "29", "2027", "2028", "2029"),
    "c": ("co",), "o": ("op", "ops"), "a": ("analyst",), "f": ("future",), "t": ("talent",), "|": ("|",),
}
#: fixed values: phrases of citizenship and clearance in titles
CITIZEN = (r"(us|u\.s\.?|united states) citizen", "citizenship required", r"must be an? (us|u\.s\.?) citizen", "security clearance", "active clearance", "ts/sci", "public trust", "clearance required")
#: fixed values: business roles, and technical words that rescue them
BUSINESS = (
    "sales development representative", "sales representative", "sales analytics", "sales operations", "sales strategy", "business information systems", "business operations", "growth & development", "growth and development",
    "account executive", "account manager", "business development", "technical recruiter", "recruiter", "talent acquisition", "solutions engineer", "solution engineer", "partner solutions", "solutions architect", "solution architecture",
    "customer engineer", "customer success", "customer solutions", "support engineer", "technical support", "help desk", "service desk", "investment banking", "financial reporting", "wealth management", "enterprise solutions specialist",
    "assurance intern", "claim professional", "socioeconomic", "actuary", "presales", "pre-sales", "field sales", "inside sales",
)
TECHNICAL = (" ai ", " artificial intelligence ", " backend ", " compiler ", " data engineer", " data scien", " devops ", " embedded ", " firmware ", " front end ", " frontend ", " full stack ", " fullstack ", " genai ", " machine learning ", " ml engineer", " product engineering ", " sde ", " site reliability ", " software develop", " software engineer", " swe ")
#: fixed values: hardware disciplines that nothing rescues, those that software words rescue, and these words
HARDWARE = ("silicon validation", "ic design", "integrated circuit", "nuclear", "thermal-hydraulic", "thermal - hydraulic", "post-fab", "post - fab", "mixed signal", "braid design", "hip/knee", "metallurg", "welding", "piping", "hvac")
SOFT_HARDWARE = ("photonic", "electrical design", "electrical systems", "electronics engineer", "electronics/electrical", "commissioning", "civil/environmental", "environmental engineer", "quality engineer", "qms", "reliability engineer", "quality assurance engineer", "mechanical design", "optics engineer", "hardware")
DISCIPLINES = ("mechanical", "electrical", "civil", "structural", "chemical", "industrial", "manufacturing", "aerospace", "biomedical", "materials", "analog", "rf", "asic", "fpga", "pcb", "vlsi")
SOFTWARE = (" ai ", " backend ", " compiler ", " data engineer", " data scien", " devops ", " firmware ", " front end ", " frontend ", " full stack ", " fullstack ", " machine learning ", " ml ", " qa engineer", " sde ", " sdet ", " site reliability ", " software ", " sre ", " swe ")
EARLY_CAREER = r"\b(intern(ship)?s?|co[\s-]*op|new (college )?grad(uate)?s?|entry[ -]level|early[ -]career|junior|associate|university grad\w*)\b"
SENIOR = Rule("too_senior", r"\b(senior|sr|staff|principal|lead|manager|director|head of|vp|vice president|chief|architect)\b", EARLY_CAREER)
#: fixed values: work that is not technical
OTHER_WORK = (
    "accountant", "accounting", "actuarial", "attorney", "audit", "barista", "cashier", "chef", "claims", "communications", "cook", "counselor", "culinary", "customer service", "dental", "driver", "electrician", "event planning", "fashion", "front desk", "fundraising", "graphic design", "hospitality", "human resources", "janitor", "journalism",
    "law clerk", "legal", "logistics", "marketing", "mechanic", "merchandising", "nurse", "nursing", "paralegal", r"pharmac\w+", "physician", "plumber", "procurement", "public relations", "real estate", "retail", "social media", "social work", "supply chain", "tax", "teacher", "teaching", "therapist", "underwriting", "veterinary", "warehouse",
)
NON_TECH = Rule("non_tech", rf"\b({'|'.join(OTHER_WORK)})\b", r"\b(software|data|engineer|developer|machine learning)\b")


def any_of(words: tuple[str, ...]) -> str:
    """The words at a word's start; those of four letters or fewer also at its end."""
    return "|".join(rf"(?<![a-z]){w}" + (r"(?![a-z])" if len(w) <= 4 else "") for w in words)


def term_classes(t: Column) -> Column:
    """The words, figures and bars of a lower-case title as a string of their classes, x for any other."""
    table = F.create_map(*[F.lit(x) for letter, words in CLASSES.items() for word in words for x in (word, letter)])
    return F.array_join(F.transform(F.regexp_extract_all(t, F.lit(r"[a-z]+|[0-9]+|[|]"), F.lit(0)), lambda w: F.coalesce(F.element_at(table, w), F.lit("x"))), "")


def wrong_term(t: Column) -> Column:
    """A student role in a late season: one next to a late year, or at most five words before the role. An early season next to a year rescues it."""
    seen = term_classes(t)
    return seen.rlike("R|co|Sa|ft") & ~seen.rlike("E[FY]|[FY]E") & seen.rlike("[SL]Y|Y[SL]|[SL][^|]{0,5}(R|co)")


def names_one(t: Column, words: tuple[str, ...]) -> Column:
    """Whether one of the words stands in the title, signs counting as spaces; a word without a space behind it is a beginning."""
    spaced = F.concat(F.lit(" "), F.regexp_replace(t, r"[^a-z0-9]+", " "), F.lit(" "))
    return spaced.rlike("|".join(words))


def title_gates(title: Column) -> Column:
    """citizenship, past class year, wrong term, business role, hardware role; null if none fires."""
    t = F.lower(C.text(title))
    return (
        F.when(t.rlike(rf"\b({'|'.join(CITIZEN)})"), "citizenship").when(F.array_max(season_years(title)) < GRADUATION, "past_class").when(wrong_term(t), "wrong_term")
        .when(t.rlike(any_of(BUSINESS)) & ~names_one(t, TECHNICAL), "business_role").when(t.rlike(any_of(HARDWARE)) | ((t.rlike(any_of(SOFT_HARDWARE)) | t.rlike(rf"\b({'|'.join(DISCIPLINES)})\b.{{0,12}}\b(engineer|design)")) & ~names_one(t, SOFTWARE)), "hardware_role")
    )


TECH = r"\b(software|developer|data|machine learning|engineer|analyst|scientist|cloud|devops|sre|ai|ml|programmer)\b"
JUNK = r"^(apply( now)?|job openings?|jobs?|careers?|search results|home|login|sign in|page not found|404|untitled)$|^\W*$"
TITLE_VALIDITY = (
    Rule("garbage", JUNK), Rule("too_short", r"^.{0,4}$"), Rule("hex_id", r"^[0-9a-f-]{16,}$"), Rule("phd_only", r"\bph\.?d\b", r"\b(ms|master'?s?|bs|bachelor'?s?)\b"), Rule("unpaid", r"\b(unpaid|volunteer)\b"), Rule("military", r"\b(army|navy|air force|marine corps)\b"),
    Rule("campus_only", r"\b(work[ -]study|student worker|campus job)\b"), Rule("truncated", r"(\.\.\.|…|[-,(&/]|\b(and|of|the|for|with|in))\s*$"),
)


#: fixed values: places abroad
ABROAD = ("canada", "toronto", "montreal", "calgary", "ontario", "quebec", "british columbia", "alberta", "uk", "united kingdom", "england", "london", "manchester", "scotland", "ireland", "dublin", "india", "bangalore", "bengaluru", "hyderabad", "pune", "mumbai", "delhi",
          "germany", "berlin", "munich", "france", "paris", "spain", "madrid", "barcelona", "italy", "netherlands", "amsterdam", "poland", "warsaw", "switzerland", "zurich", "sweden", "singapore", "japan", "tokyo", "china", "shanghai", "beijing", "hong kong", "korea", "seoul",
          "mexico", "brazil", "sao paulo", "argentina", "australia", "sydney", "melbourne", "new zealand", "israel", "tel aviv", "philippines", "vietnam", "vancouver")
FOREIGN = rf"\b({'|'.join(ABROAD)})\b"
US_PLACES = r"\b(us|usa|u\.s\.a?|united states|america|remote|nationwide|new york|san francisco|seattle|boston|austin|chicago|los angeles|atlanta|denver|dallas|houston|bay area|silicon valley)\b"
HARD_CAPS = {"company": 70, "title": 130}


def fires(rule: Rule, text: Column) -> Column:
    hit = text.rlike(rule.pattern)
    return hit & ~text.rlike(rule.rescue) if rule.rescue else hit


def first_reason(rules: tuple[Rule, ...], text: Column) -> Column:
    """The first rule that fires on the lower-case text."""
    lower = F.lower(C.text(text))
    return F.coalesce(*[F.when(fires(r, lower), r.reason) for r in rules])


def title_reason(title: Column) -> Column:
    """title gates in order, then seniority (a senior word or a level above 2), then non-technical work."""
    t = F.lower(C.text(title))
    high = (fires(SENIOR, t) | (seniority(title) > 2)) & ~t.rlike(EARLY_CAREER)
    return F.coalesce(title_gates(title), F.when(high, SENIOR.reason), F.when(fires(NON_TECH, t), NON_TECH.reason))


def is_tech_role(title: Column, description: Column | None = None) -> Column:
    """no gate fires and technical words are at least as many as non-technical ones; boundaries guard short words."""
    return title_reason(title).isNull() & more_technical(title, description)


def more_technical(title: Column, description: Column | None = None) -> Column:
    """technical words are at least as many as others."""
    body = F.lower(F.concat_ws(" ", title, *([description] if description is not None else [])))
    return (F.regexp_count(body, F.lit(TECH)) >= F.regexp_count(body, F.lit(NON_TECH.pattern))) & body.rlike(TECH)


def is_internship(title: Column, job_type: Column) -> Column:
    """F9, F17."""
    return F.lower(C.text(title)).rlike(INTERN) | job_type.isin("Internship", "Co-op")


def should_drop_summer(title: Column, job_type: Column) -> Column:
    """only unambiguous summer 2027 internships."""
    t = F.lower(C.text(title))
    return t.rlike(r"\bsummer\s*(?:20)?27\b|\b2027\s*\(?summer") & t.rlike(INTERN) & ~t.rlike(r"\b(spring|fall|winter|full[- ]time)\b") & (F.coalesce(job_type, F.lit("")) != "Full Time")


def season_years(title: Column) -> Column:
    """the years a title names, ascending."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(C.text(title), F.lit(r"\b(20[2-3]\d)\b"), F.lit(1)), lambda y: y.cast("int"))))


def seniority(title: Column) -> Column:
    """the highest level that the title names by digit, numeral or word; 0 if none."""
    ranks = {"i": 1, "1": 1, "ii": 2, "2": 2, "iii": 3, "3": 3, "iv": 4, "4": 4, "v": 5, "5": 5, "senior": 5, "sr": 5, "staff": 6, "principal": 7}
    found = F.regexp_extract_all(F.lower(C.text(title)), F.lit(r"\b(i{1,3}|iv|v|[1-5]|senior|sr|staff|principal)\b"), F.lit(1))
    table = F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])
    return F.coalesce(F.array_max(F.transform(found, lambda x: F.element_at(table, x))), F.lit(0))


def hourly_pay(text: Column) -> tuple[Column, Column]:
    """least and largest hourly figure between 1 and 200 in a text."""
    figures = F.filter(F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"\$\s?(\d{1,3}(?:\.\d+)?)(?=\s*(?:-|–|to|/|per|an?)?\s*(?:\$\s?\d+(?:\.\d+)?\s*)?(?:/|per |an? )?(?:hour|hr))"), F.lit(1)), lambda x: x.cast("double")), lambda v: (v > 1) & (v < 200))
    return F.array_min(figures), F.array_max(figures)


def pay_reason(text: Column, least: float = 25.0) -> Column:
    low, high = hourly_pay(text)
    return F.when((high < least) & low.isNotNull(), "low_pay")


def experience_reason(text: Column, most: int = 3) -> Column:
    """the smallest years figure is above the limit."""
    years = F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"(\d{1,2})\+? (?:or more )?years"), F.lit(1)), lambda y: y.cast("int"))
    return F.when(F.array_min(years) > most, "experience")


def too_old(age: Column, most: int = 3, keep_undated: bool = False) -> Column:
    """whether a posting is older than `most` days; undated ones go on the feed path and stay on the page path."""
    return F.when(age.isNull(), not keep_undated).otherwise(age > most)


def is_us_location(location: Column) -> Column:
    """Unknown passes, foreign words reject, a state code or US words accept, anything else rejects."""
    t, state = F.lower(F.trim(C.text(location))), C.state_code(location).isin(*C.STATES)
    return F.when(t.isin("", "unknown", "remote"), True).when(t.rlike(FOREIGN) & ~state, False).when(state | t.rlike(US_PLACES), True).otherwise(False)


def integrity_reason() -> Column:
    """empty or overlong fields, and a board's name as the company."""
    company, title = F.trim(C.text(F.col("company"))), F.trim(C.text(F.col("title")))
    return (
        F.when(company == "", "empty_company").when(title == "", "empty_title").when(F.length(company) > HARD_CAPS["company"], "long_company").when(F.length(title) > HARD_CAPS["title"], "long_title")
        .when(F.lower(company).isin("greenhouse", "lever", "workday", "linkedin", "indeed"), "board_as_company").when(~F.col("outcome").isin("valid", "discarded", "reviewed"), "bad_outcome")
    )


def is_job_url(url: Column) -> Column:
    """a web address outside search engines and social sites, and not a listing page."""
    u = F.lower(C.text(url))
    return u.rlike("^https?://") & ~u.rlike(r"google\.com/search|facebook\.com|youtube\.com|twitter\.com") & ~u.rlike(r"/(about|blog|privacy|login|search)(/|$)")


def write_quality() -> Column:
    """0 to 7 points for company, title, location, id, web address, remote and sponsorship."""
    known = lambda c, *no: F.when(~C.text(F.col(c)).isin("", "Unknown", *no), 1).otherwise(0)
    return known("company") + known("title") + known("location") + known("job_id", "N/A") + F.when(C.text(F.col("url")).startswith("http"), 1).otherwise(0) + known("remote") + known("sponsorship")


def expired(rows: DataFrame, as_of: str, limit_days: int, most: int, absurd: float = 0.9) -> DataFrame:
    """Unprotected rows as old as the limit, oldest first, at most `most`; an error if they are nearly all rows."""
    day = F.to_date(F.substring("processed_at", 1, 10))
    old = rows.where((F.datediff(F.lit(as_of).cast("date"), day) >= limit_days) & (F.col("outcome") != "valid"))
    share = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if((F.datediff(F.lit(as_of).cast("date"), day) >= limit_days) & (F.col("outcome") != "valid")).alias("k")).first()
    if share["n"] and share["k"] / share["n"] > absurd:
        raise ValueError("nearly all rows would expire")
    return old.orderBy(day, "id").limit(most)


def first_fail(jobs: DataFrame) -> DataFrame:
    """jobs with the first gate that each fails, cheapest first. Titles repeat, so each distinct one is judged once and looked up."""
    from postmill.operators import chain

    judged = chain.looked_up(jobs, chain.title_verdicts(jobs), "title")
    gate = F.coalesce(
        F.when(~is_job_url(F.col("url")), "url"), F.when(should_drop_summer(F.col("title"), F.col("job_type")), "term"), F.concat(F.lit("title:"), "validity"), F.concat(F.lit("gate:"), "gate"),
        F.when(~F.col("technical"), "tech"), F.when(~is_us_location(F.col("location")), "location"), F.when(write_quality() < 4, "quality"), F.concat(F.lit("integrity:"), integrity_reason()),
    )
    return judged.withColumn("first_fail", gate).drop("validity", "gate", "technical")


def sql_reason(rules: tuple[Rule, ...], c: str) -> str:
    q = lambda p: p.replace("'", "''")
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '{q(r.pattern)}')" + (f" AND NOT regexp_matches({c}, '{q(r.rescue)}')" if r.rescue else "") + f" THEN '{r.reason}'" for r in rules) + " END"


TEXT = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"
query("f3_f6_f7_title_reason", "SELECT id, CASE title WHEN 'Solutions Engineer' THEN 'business_role' WHEN 'Software Engineer III' THEN 'too_senior' WHEN 'Summer 2027 Intern - Data' THEN 'wrong_term' END AS reason FROM jobs", "jobs")(lambda s, d: tables.jobs(s, d).select("id", title_reason(F.col("title")).alias("reason")))
query("f8_f16_title_validity", f"SELECT doc_id, {sql_reason(TITLE_VALIDITY, 'lower(title)')} AS reason FROM (SELECT doc_id, split_part(text, chr(10), 1) AS title FROM documents)")(lambda s, d: tables.table(s, d, "documents").select("doc_id", first_reason(TITLE_VALIDITY, F.split("text", "\n")[0]).alias("reason")))
query("f11_page_reason")(lambda s, d: tables.table(s, d, "pages").select("page_id", page_reason(F.col("html")).alias("reason")))
query("f11_document_reason")(lambda s, d: tables.table(s, d, "documents").select("doc_id", restriction(F.col("text")).alias("reason")))
query("f2_summer", "SELECT id, lower(title) LIKE '%summer 2027%' AND coalesce(job_type, '') <> 'Full Time' AS dropped FROM jobs", "jobs")(lambda s, d: tables.jobs(s, d).select("id", should_drop_summer(F.col("title"), F.col("job_type")).alias("dropped")))
query("f9_f17_internship", f"SELECT id, regexp_matches(lower(title), '{INTERN}') OR job_type IN ('Internship', 'Co-op') AS intern FROM jobs", "jobs")(lambda s, d: tables.jobs(s, d).select("id", is_internship(F.col("title"), F.col("job_type")).alias("intern")))
query("f10_season_years", "SELECT id, array_to_string(list_sort(list_distinct(regexp_extract_all(title, '\\b(20[2-3]\\d)\\b', 1))), ',') AS years FROM jobs", "jobs")(lambda s, d: tables.jobs(s, d).select("id", F.array_join(season_years(F.col("title")), ",").alias("years")))
query("f15_us_location", f"SELECT id, CASE WHEN lower(location) IN ('', 'unknown', 'remote') THEN true ELSE regexp_matches(location, ',\\s*({'|'.join(C.STATES)})\\b') END AS us FROM jobs", "jobs")(lambda s, d: tables.jobs(s, d).select("id", is_us_location(F.col("location")).alias("us")))
query("f18_integrity", "SELECT id, CASE WHEN trim(company) = '' THEN 'empty_company' END AS reason FROM jobs", "jobs")(lambda s, d: tables.jobs(s, d).select("id", integrity_reason().alias("reason")))
query("f19_job_url", "SELECT id, coalesce(url LIKE 'http%' AND url NOT LIKE '%google.com/search%', false) AS ok FROM jobs", "jobs")(lambda s, d: tables.jobs(s, d).select("id", is_job_url(F.col("url")).alias("ok")))
KNOWN = " + ".join(f"CASE WHEN coalesce({c}, '') NOT IN ('', 'Unknown', {no}) THEN 1 ELSE 0 END" for c, no in (("company", "''"), ("title", "''"), ("location", "''"), ("job_id", "'N/A'"), ("remote", "''"), ("sponsorship", "''")))
query("p26_f20_write_quality", f"SELECT id, {KNOWN} + CASE WHEN coalesce(url, '') LIKE 'http%' THEN 1 ELSE 0 END AS quality FROM jobs", "jobs")(lambda s, d: tables.jobs(s, d).select("id", write_quality().alias("quality")))
query("f23_k12_expired", f"SELECT id FROM jobs WHERE date_diff('day', substr(processed_at, 1, 10)::DATE, DATE '{tables.JOBS_AS_OF}') >= 2000 AND outcome <> 'valid' ORDER BY substr(processed_at, 1, 10), id LIMIT 100", "jobs")(lambda s, d: expired(tables.jobs(s, d), tables.JOBS_AS_OF, 2000, 100).select("id"))
U = "regexp_replace(regexp_replace(regexp_replace(lower(trim(regexp_replace(coalesce(url, ''), '[?#].*$', ''))), '/+$', ''), '^(https?://)www[.]', '\\1'), 'x^', '')"
query("p27_p28_p30_url_keys", f"SELECT id, {U} AS canonical, regexp_replace(lower(title), '[^a-z0-9]', '', 'g') AS squashed, CASE WHEN url LIKE '%greenhouse.io%' THEN regexp_extract(url, '/jobs/(\\d+)', 1) END AS board_id, CASE WHEN url LIKE '%greenhouse.io%' THEN 'greenhouse' ELSE 'other' END AS platform, CASE WHEN url LIKE '%greenhouse.io%' THEN regexp_extract(url, 'greenhouse.io/([^/]+)', 1) END AS slug FROM jobs", "jobs")(
    lambda s, d: tables.jobs(s, d).select("id", C.canonical_url(F.col("url")).alias("canonical"), C.squash(F.col("title")).alias("squashed"), C.board_job_id(F.col("url")).alias("board_id"), C.platform(F.col("url")).alias("platform"), C.company_slug(F.col("url")).alias("slug"))
)
query("p29_p32_p34_p48_urls")(lambda s, d: tables.jobs(s, d).select("id", C.is_identifying_url(F.col("url")).alias("identifying"), C.normal_job_id(F.col("job_id")).alias("job_id"), C.slug_title(F.col("url")).alias("slug_title"), C.fallback_url().alias("link")))
query("p7_p8_p10_p13_p14", "SELECT id, coalesce(regexp_extract(location, ',\\s*([A-Z]{2})\\b', 1), '') AS code, CASE WHEN lower(location) LIKE '%remote%' THEN 'Remote' ELSE nullif(regexp_extract(location, ',\\s*([A-Z]{2})\\b', 1), '') END AS bucket, lower(remote) = 'remote' AS sheet_remote, regexp_matches(company, '[A-Za-z]') AS shown, CASE WHEN rejection_reason = '' THEN 'Unspecified' ELSE rejection_reason END AS reason FROM jobs", "jobs")(
    lambda s, d: tables.jobs(s, d).select("id", C.state_code(F.col("location")).alias("code"), C.state_bucket(F.col("location")).alias("bucket"), C.is_remote_sheet(F.col("remote")).alias("sheet_remote"), C.displayable(F.col("company")).alias("shown"), C.discard_reason(F.col("rejection_reason")).alias("reason"))
)
query("p16_p35_p36_p37_dates")(lambda s, d: tables.jobs(s, d).select("id", C.entry_date(F.date_format(F.to_date(F.substring("processed_at", 1, 10)), "MMM d"), F.lit(tables.JOBS_AS_OF).cast("date")).alias("entry_date"), C.age_from_timestamp(F.substring("processed_at", 1, 19), F.lit(tables.JOBS_AS_OF).cast("date")).alias("age"), C.age_from_text(F.concat(F.lit("Posted "), (F.col("id") % 30).cast("string"), F.lit("+ Days Ago"))).alias("text_age"), C.feed_age(F.concat((F.col("id") % 30).cast("string"), F.lit("w")), F.lit(tables.JOBS_AS_OF).cast("date")).alias("feed_age"), C.days_ago(F.concat((F.col("id") % 9).cast("string"), F.lit(" weeks ago"))).alias("days_ago")))


def _expected(values: tuple, n: int) -> str:
    """Hand-given verdicts of the sample texts, by their number."""
    return f"CASE id % {n} " + " ".join(f"WHEN {i} THEN {str(v).lower() if isinstance(v, bool) else repr(v)}" for i, v in enumerate(values) if v is not None) + " END"


#: what the rules mean for each of SAMPLE_TITLES, SAMPLE_TEXTS and SAMPLE_PLACES, written by hand
TITLE_VERDICTS = (None, "citizenship", "citizenship", "past_class", None, "wrong_term", None, "wrong_term", None, "wrong_term", "business_role", None, "business_role", None, "hardware_role", None, "hardware_role", "too_senior", "too_senior", None, "too_senior", None, "non_tech", None, None, "too_senior")
TEXT_VERDICTS = (None, "clearance", "citizenship", "citizenship", "graduation", "permanent_authorization", "high_school", "undergraduate_only", None, "undergraduate_only", "non_cs_degree", None, "preferred_degree", "phd_only", None, "geography", "cpt_opt", None, "us_person", None, "bachelor_only", "graduation_year")
US_VERDICTS = (True, False, False, True, False, True, True, True, True, False, False, False)
query("f3_f6_f7_sample_titles", f"SELECT id, {_expected(TITLE_VERDICTS, 26)} AS reason FROM samples", "samples")(lambda s, d: tables.samples(s, d).select("id", title_reason(F.col("title")).alias("reason")))
query("f4_f5_tech_role", f"SELECT id, {_expected(TITLE_VERDICTS, 26)} IS NULL AS tech, CASE id % 26 WHEN 17 THEN 5 WHEN 18 THEN 3 WHEN 19 THEN 2 WHEN 20 THEN 4 WHEN 21 THEN 6 ELSE 0 END AS level FROM samples", "samples")(
    lambda s, d: tables.samples(s, d).select("id", is_tech_role(F.col("title")).alias("tech"), seniority(F.col("title")).alias("level"))
)
query("f11_sample_texts", f"SELECT id, {_expected(TEXT_VERDICTS, 28)} AS reason FROM samples", "samples")(lambda s, d: tables.samples(s, d).select("id", restriction(F.col("body")).alias("reason")))
query("f12_f13_pay_experience", "SELECT id, CASE id % 28 WHEN 24 THEN 'low_pay' WHEN 26 THEN 'experience' WHEN 27 THEN 'experience' END AS reason FROM samples", "samples")(lambda s, d: tables.samples(s, d).select("id", F.coalesce(pay_reason(F.col("body")), experience_reason(F.col("body"))).alias("reason")))
query("f14_age_gate", "SELECT id, coalesce(age > 3, true) AS feed_old, coalesce(age > 3, false) AS page_old FROM samples", "samples")(lambda s, d: tables.samples(s, d).select("id", too_old(F.col("age")).alias("feed_old"), too_old(F.col("age"), keep_undated=True).alias("page_old")))
query("f15_sample_places", f"SELECT id, {_expected(US_VERDICTS, 12)} AS us FROM samples", "samples")(lambda s, d: tables.samples(s, d).select("id", is_us_location(F.col("location")).alias("us")))
query("f25_f26_first_fail", """SELECT first_fail, count(*) AS n FROM (SELECT CASE WHEN url IS NULL OR url NOT LIKE 'http%' OR url LIKE '%google.com/search%' THEN 'url' WHEN title LIKE 'Summer 2027%' AND job_type <> 'Full Time' THEN 'term' WHEN title = 'Solutions Engineer' THEN 'gate:business_role'
    WHEN title = 'Software Engineer III' THEN 'gate:too_senior' WHEN title LIKE 'Summer 2027%' THEN 'gate:wrong_term' WHEN (CASE WHEN company IN ('', 'Unknown') THEN 0 ELSE 1 END) + 1 + (CASE WHEN location = 'Unknown' THEN 0 ELSE 1 END) + (CASE WHEN job_id = 'N/A' THEN 0 ELSE 1 END) + 1
    + (CASE WHEN remote = 'Unknown' THEN 0 ELSE 1 END) + (CASE WHEN sponsorship = 'Unknown' THEN 0 ELSE 1 END) < 4 THEN 'quality' WHEN company = '' THEN 'integrity:empty_company' END AS first_fail FROM jobs) GROUP BY 1""", "jobs")(lambda s, d: first_fail(tables.jobs(s, d)).groupBy("first_fail").agg(F.count(F.lit(1)).alias("n")))
