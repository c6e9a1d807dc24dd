"""Derived columns of postings. Each function takes and gives columns; nulls count as empty unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed values: legal suffixes of company names
SUFFIXES = ("inc", "llc", "ltd", "limited", "corp", "corporation", "co", "company", "plc", "gmbh", "sa", "ag", "holdings", "group", "technologies", "technology", "labs", "the")
SINGLE_SUFFIXES = ("inc", "llc", "ltd", "limited", "corp", "corporation", "co", "company", "plc", "gmbh", "holdings", "group", "technologies", "technology", "labs")
PLACEHOLDERS = ("", "unknown", "n/a", "na", "none", "null", "-")
#: fixed values: postal codes of US states
STATES = ("AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY").split()
JOB_TYPES = ("Internship", "Full Time", "Co-op", "New Grad")


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def company_key(c: Column) -> Column:
    """Lower case, punctuation to spaces, all trailing legal suffixes off (a name of suffixes only is empty)."""
    spaced = F.translate(F.lower(text(c)), ",.'\"()&/", " " * 8)
    return F.trim(F.regexp_replace(F.concat(F.lit(" "), F.trim(F.regexp_replace(spaced, r"\s+", " "))), f"( ({'|'.join(SUFFIXES)}))+$", ""))


def company_key_single(c: Column) -> Column:
    """The marts' key, which takes one suffix off and leaves inner spaces."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(c, "[,.'\"()&/]", " ")), rf"\s+({'|'.join(SINGLE_SUFFIXES)})$", ""))


def valid_rate(num: Column, den: Column, digits: int = 4) -> Column:
    """P5: a rate that is 0 where the denominator is 0 or null."""
    return F.coalesce(F.round(F.try_divide(num.cast("double"), den), digits), F.lit(0.0))


def iso_week(run_id: Column) -> Column:
    """YYYY-Www of run_YYYYMMDD_..., else 'unknown'."""
    day = F.try_to_date(F.substring(run_id, 5, 8), "yyyyMMdd")
    week = F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), day).cast("int"), F.weekofyear(day))
    return F.when(run_id.startswith("run_") & day.isNotNull(), week).otherwise("unknown")


def partition_source(c: Column) -> Column:
    """Source as a partition value."""
    return F.replace(F.lower(F.trim(F.coalesce(F.when(c != "", c), F.lit("unknown")))), F.lit(" "), F.lit("_"))


def state_code(location: Column) -> Column:
    """The state code after a comma, else empty."""
    return F.regexp_extract(text(location), r",\s*([A-Z]{2})\b", 1)


def state_bucket(location: Column) -> Column:
    """Remote, a valid state code, or null."""
    code = state_code(location)
    return F.when(F.lower(text(location)).contains("remote"), "Remote").when(code.isin(*STATES), code)


def is_remote_store(c: Column) -> Column:
    """P10, the store's rule."""
    return F.when(F.lower(text(c)).isin("remote", "yes"), 1).otherwise(0)


def is_remote_lake(c: Column) -> Column:
    """P10, the lake's rule."""
    return F.when(F.lower(text(c)).contains("remote"), 1).otherwise(0)


def is_remote_sheet(c: Column) -> Column:
    """P10, the sheet's rule."""
    return F.lower(F.trim(text(c))) == "remote"


def is_sponsored(c: Column) -> Column:
    return F.when(F.lower(text(c)).isin("yes", "true", "1"), 1).otherwise(0)


def reason_family(c: Column) -> Column:
    """P12."""
    return F.when(c.isin("malformed_url", "search_fallback_url"), "url").when(c.isin("missing_company", "placeholder_company"), "entity").when(c == "duplicate_grain", "dedup").otherwise("other")


def displayable(c: Column) -> Column:
    """A name with a letter and without encoding debris."""
    return text(c).rlike("[A-Za-z]") & ~text(c).rlike("Ã|Â|â€|�")


def discard_reason(c: Column) -> Column:
    """The reason before details, at most 60 characters."""
    cut = F.trim(F.substring(F.split(text(c), r"[:(\[]| - ", 2)[0], 1, 60))
    return F.when(cut == "", "Unspecified").otherwise(cut)


def job_type(c: Column) -> Column:
    """P20."""
    return F.when(c.isin(*JOB_TYPES), c).otherwise("Other")


def canonical_url(c: Column) -> Column:
    """Without scheme's www, query, fragment and last slash, in lower case."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.regexp_replace(text(c), r"[?#].*$", ""))), "/+$", ""), r"^(https?://)www\.", "$1")


def squash(c: Column) -> Column:
    """Letters and digits only."""
    return F.regexp_replace(F.lower(text(c)), "[^a-z0-9]", "")


def is_identifying_url(c: Column) -> Column:
    """Whether the path itself names one posting."""
    path = F.regexp_extract(text(c), r"^https?://[^/?#]+([^?#]*)", 1)
    return text(c).rlike("^https?://") & ~text(c).contains("google.com/search") & path.rlike(r"\d{4,}|[0-9a-f]{8}-[0-9a-f]{4}|/jobs?/[^/]{6,}")


def board_job_id(c: Column) -> Column:
    """The id in a board's URL, or null."""
    u = text(c)
    rules = (
        ("greenhouse.io", r"/jobs/(\d+)"), ("lever.co", r"lever\.co/[^/]+/([0-9a-f-]{36})"), ("ashbyhq.com", r"ashbyhq\.com/[^/]+/([0-9a-f-]{36})"),
        ("myworkdayjobs.com", r"_((?:JR|R|REQ)-?\d+)"), ("icims.com", r"/jobs/(\d+)"), ("smartrecruiters.com", r"/(\d{9,})"), ("workable.com", r"/j/([A-Z0-9]+)"),
        ("rippling.com", r"/jobs/([0-9a-f-]{36})"), ("linkedin.com", r"/view/(\d+)"),
    )
    found = F.lit(None).cast("string")
    for host, pattern in reversed(rules):
        found = F.when(u.contains(host), F.regexp_extract(u, pattern, 1)).otherwise(found)
    return F.when(found != "", found)


def normal_job_id(c: Column) -> Column:
    """Lower-case letters and digits without leading zeros; zeros alone stay."""
    plain = squash(c)
    return F.when(plain.rlike("^0+$"), plain).otherwise(F.regexp_replace(plain, "^0+", ""))


def platform(c: Column) -> Column:
    """The board behind a URL."""
    u, found = F.lower(text(c)), F.lit("other")
    for name in ("linkedin", "rippling", "workable", "smartrecruiters", "icims", "myworkdayjobs", "ashbyhq", "lever", "greenhouse"):
        found = F.when(u.contains(name), "workday" if name == "myworkdayjobs" else "ashby" if name == "ashbyhq" else name).otherwise(found)
    return found


def company_slug(c: Column) -> Column:
    """The employer's slug in a board URL, or null."""
    found = F.regexp_extract(text(c), r"^https?://(?:boards\.greenhouse\.io|jobs\.lever\.co|jobs\.ashbyhq\.com|apply\.workable\.com)/([^/?#]+)", 1)
    tenant = F.regexp_extract(text(c), r"^https?://([a-z0-9-]+)\.(?:wd\d+\.)?myworkdayjobs\.com", 1)
    return F.when(found != "", found).when(tenant != "", tenant)


def slug_title(c: Column) -> Column:
    """Words of the last path part, without ids."""
    last = F.regexp_extract(text(c), r"/([^/?#]+)/?(?:[?#].*)?$", 1)
    return F.initcap(F.trim(F.regexp_replace(F.regexp_replace(last, r"[-_]+", " "), r"\b\d+\b", "")))


def age_from_timestamp(v: Column, as_of: Column) -> Column:
    """Days since an epoch in seconds or milliseconds, or an ISO text; null outside 0..3650."""
    number = F.when(v.rlike(r"^\d{9,14}$"), v).cast("double")
    day = F.coalesce(F.to_date(F.timestamp_seconds(F.when(number > 1e11, number / 1000).otherwise(number))), F.try_to_date(F.substring(v, 1, 10), "yyyy-MM-dd"))
    age = F.datediff(as_of, day)
    return F.when(age.between(0, 3650), age)


def age_from_text(c: Column) -> Column:
    """Days in 'Posted 3 Days Ago', 'today', 'yesterday', '30+ days ago'."""
    t = F.lower(text(c))
    days = F.regexp_extract(t, r"(\d+)\+?\s*day", 1)
    return F.when(t.contains("today") | t.contains("just posted"), 0).when(t.contains("yesterday"), 1).when(days != "", days.cast("int"))


def feed_age(c: Column, as_of: Column) -> Column:
    """Days in '3d', '20h', '11m', '2w', '1mo', ISO dates and 'Aug 21' (of this year, or the last if that lies ahead)."""
    t = F.lower(F.trim(text(c)))
    n = F.regexp_extract(t, r"^(\d+)", 1).cast("int")
    year = F.year(as_of)
    this, last = (F.try_to_date(F.concat_ws(" ", F.initcap(t), (year - k).cast("string")), "MMM d yyyy") for k in (0, 1))
    named = F.datediff(as_of, F.when(this <= as_of, this).otherwise(last))
    return (
        F.when(t.rlike(r"^\d+mo$"), n * 30).when(t.rlike(r"^\d+w$"), n * 7).when(t.rlike(r"^\d+d$"), n).when(t.rlike(r"^\d+[hm]$"), 0)
        .when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.datediff(as_of, F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd"))).when(t.rlike(r"^[a-z]{3} \d{1,2}$"), named)
    )


def days_ago(c: Column) -> Column:
    """Days in free text such as '2 weeks ago', '1 month ago', '5+ hours ago'."""
    t = F.lower(text(c))
    n = F.regexp_extract(t, r"(\d+)\+?\s*(minute|hour|day|week|month|year)", 1)
    unit = F.regexp_extract(t, r"(\d+)\+?\s*(minute|hour|day|week|month|year)", 2)
    factor = F.when(unit == "day", 1).when(unit == "week", 7).when(unit == "month", 30).when(unit == "year", 365).otherwise(0)
    return F.when(t.contains("today"), 0).when(t.contains("yesterday"), 1).when(n != "", n.cast("int") * factor)


#: Formats of entry dates with a year, and without
DATED, YEARLESS = ("yyyy-MM-dd", "MM/dd/yyyy", "M/d/yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "yyyy/MM/dd"), ("MMM d", "MMMM d", "M/d", "d MMM")


def entry_date(c: Column, as_of: Column) -> Column:
    """A date in one of eleven formats; without a year it is the latest such day not after as_of."""
    t = F.trim(F.regexp_replace(text(c), r"(?i)^rescued\s*", ""))
    whole = F.coalesce(*[F.try_to_date(t, f) for f in DATED])
    year = F.year(as_of)
    def of(k: int) -> Column:
        return F.coalesce(*[F.try_to_date(F.concat_ws(" ", t, (year - k).cast("string")), f"{f} yyyy") for f in YEARLESS])

    return F.coalesce(whole, F.when(of(0) <= as_of, of(0)).otherwise(of(1)))


def week_start(week: Column) -> Column:
    """The Monday of YYYY-Www."""
    january = F.make_date(F.substring(week, 1, 4).cast("int"), F.lit(1), F.lit(4))
    return F.date_add(F.to_date(F.date_trunc("week", january)), 7 * (F.substring(week, 7, 2).cast("int") - 1))


CHECKS = (("company", 2.0), ("title", 2.0), ("location", 1.5), ("url", 2.0), ("job_id", 1.0), ("salary", 0.5), ("sponsorship", 1.0), ("remote", 0.5))


def completeness() -> tuple[Column, Column, Column]:
    """Score 0-100, share of checks met, and the array of missing fields."""
    known = {c: text(F.col(c)) != "" for c in ("company", "title", "location", "job_id", "sponsorship", "remote")}
    met = {c: known[c] & (F.col(c) != ("N/A" if c == "job_id" else "Unknown")) for c in known}
    met["url"] = text(F.col("url")).startswith("http")
    met["salary"] = (F.coalesce("salary_low", F.lit(0.0)) != 0) | (F.coalesce("salary_high", F.lit(0.0)) != 0)
    total = sum(w for _, w in CHECKS)
    score = F.round(sum((F.when(met[c], w).otherwise(0.0) for c, w in CHECKS), F.lit(0.0)) / total * 100, 1)
    share = F.round(sum((F.when(met[c], 1).otherwise(0) for c, _ in CHECKS), F.lit(0)) / len(CHECKS) * 100, 1)
    missing = F.filter(F.array(*[F.when(~met[c], c) for c, _ in CHECKS]), lambda x: x.isNotNull())
    return score, share, missing


def grade(score: Column) -> Column:
    """P25."""
    return F.when(score >= 90, "A").when(score >= 75, "B").when(score >= 50, "C").when(score >= 25, "D").otherwise("F")


def fallback_url() -> Column:
    """The posting's URL, or a web search for it."""
    return F.when(text(F.col("url")).startswith("http"), F.col("url")).otherwise(F.concat(F.lit("https://www.google.com/search?q="), F.url_encode(F.concat_ws(" ", "company", "title", F.lit("careers")))))
