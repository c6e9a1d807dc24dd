"""the restrictions that a posting's page states, as phrases with windows, captures and sections; the first that nothing saves wins.

The phrases are fixed values, in the notation of phrases.py; how they combine is written there.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.functions import columns as C
from postmill.operators.phrases import Rule, all_hits, first_reason, page_words, plain_words, sql_hits, sql_words
from postmill.plans.registry import query
from postmill.sources import tables

#: fixed values: states by name, with the home of the one who applies left out, and lands abroad where universities are named
HOME = ("massachusetts", "boston", "new england", "the united states", "united states", "the us", "usa", "the usa")
STATES = (
    "alabama", "alaska", "arizona", "arkansas", "california", "colorado", "connecticut", "delaware", "florida", "georgia", "hawaii", "idaho", "illinois", "indiana", "iowa", "kansas", "kentucky", "louisiana", "maine", "maryland", "michigan", "minnesota",
    "mississippi", "missouri", "montana", "nebraska", "nevada", "new hampshire", "new jersey", "new mexico", "new york", "north carolina", "north dakota", "ohio", "oklahoma", "oregon", "pennsylvania", "rhode island", "south carolina", "south dakota", "tennessee",
    "texas", "utah", "vermont", "virginia", "washington", "west virginia", "wisconsin", "wyoming",
)
LANDS = ("canada", "ontario", "quebec", "british columbia", "alberta", "toronto", "vancouver", "montreal", "europe", "germany", "france", "ireland", "india", "china", "japan", "singapore", "australia", "mexico", "brazil", "israel", "the uk", "the united kingdom", "england", "london")
CITIES = ("chicago", "seattle", "houston", "dallas", "austin", "atlanta", "denver", "philadelphia", "pittsburgh", "los angeles", "san francisco", "san diego", "bay area", "san francisco bay area", "new york city", "detroit", "phoenix", "minneapolis", "baltimore", "cleveland", "columbus")
#: fixed values: words that open a posting to master's students
MASTER = (
    "master*", "graduate", "graduate student|students|program|degree", "grad student|students", "ms degree|students", "ms phd", "bs ms", "or|and ms", "msc", "meng", "advanced degree", "advanced degree students", "bachelor|bachelors ... or higher degree",
)
COMPUTING = ("computer science", "software engineering", "computer engineering", "information technology", "data science", "information systems", "software", "cs")
OTHER_FIELDS = ("mechanical", "electrical", "civil", "chemical", "industrial", "aerospace", "biomedical", "materials", "nuclear", "petroleum", "environmental", "biology", "chemistry", "physics", "finance", "accounting", "marketing", "economics", "nursing", "law", "psychology")

CLEARANCE = (
    "export administration regulations", "ear eligible", "eligible under ... export", "us export control", "ear itar", "itar", "itar compliance|eligible|required", "export controlled information|technology|data", "access to export controlled", "export control ... required|compliance|restriction",
    "security clearance", "clearance ... required|preferred", "clearance eligibility|required|preferred", "obtain|get|acquire ... clearance", "eligible|eligibility for ... clearance", "secret clearance", "top secret", "dod secret", "ts sci", "polygraph", "public trust clearance",
    "citizen|citizenship ... clearance",
)
CITIZENSHIP = (
    "us citizenship [is] required", "citizenship requirement", "citizenship [is] required", "require|requires|required us citizenship", "us citizenship", "must be [a|an] us|american citizen|citizens", "must be [a] united states citizen|citizens", "us citizen|citizens", "united states citizen|citizens only",
    "only us citizens", "candidate|candidates must be us citizen|citizens", "authorized to work ... without|no [employer] sponsor|sponsorship", "without requiring sponsorship now or in the future", "legal right to work ... without [requiring] sponsor|sponsorship", "us citizen or have the legal right to work",
    "no|not|without|unable [to] [offer|provide|require] [visa] sponsor|sponsorship", "no visa sponsorship", "not eligible for employer sponsored work visa", "not eligible for ... sponsor|sponsorship", "sponsorship is not available|offered", "employment sponsorship [is] not required|available", "no employment sponsorship",
)
GRADUATION = (
    "graduate|graduates|graduating|graduation|graduated by|in|before [the] fall|december|dec|summer [of] 2020|2021|2022|2023|2024|2025|2026", "graduate|graduating|graduation no later than fall|december|dec 2026", "fall|december|dec 2026 graduation|graduate|graduates", "graduation date of|by december|fall [of] 2024|2025|2026",
    "juniors seniors or masters students in [the] fall [of] 2026", "complete ms|master|masters|degree by|in fall|december|dec 2026", "intern ... graduating by december 2026",
)
PERMANENT = (
    "permanent ... work|employment authorization", "permanent|unrestricted|indefinite [work] authorization|authorisation", "permanently authorized to work", "permanent ... right|ability to work", "must have|possess ... permanent ... authorization", "authorized|authorised to work ... permanently|indefinitely",
    "permanent|permanently authorized|authorised", "green card holder|holders|required", "not [currently] hiring|sponsoring foreign national|nationals",
)
HIGH_SCHOOL = ("high school student|students|senior|seniors|junior|juniors only", "high school student|senior|graduate", "graduating [from] high school", "current|currently [in] high school", "enrolled in high school", "rising high school senior", "must be [in|a] high school", "high school ... plans to attain")
UNDERGRADUATE = (
    "pursuing|obtaining [a|an|their] bachelor|bachelors", "working toward|towards [a|an] bachelor|bachelors [degree]", "scheduled to obtain ... bachelor|bachelors", "pursuing ... bachelor|bachelors ... computer", "student obtaining [a] bs|ba", "pursuing [a] bs|ba degree|in", "must be pursuing [a] bs|ba", "current bs|ba student",
    "enrolled bs|ba program", "pursuing bsee", "pursuing [a|an] undergraduate degree", "pursuing [a] 4|four year degree", "bachelor|bachelors student enrolled", "bachelor|bachelors candidate|candidates only", "bachelor|bachelors program enrollment", "bachelor|bachelors level student",
    "enrolled in [a|an] bachelor|bachelors", "enrolled ... associate|associates or bachelor|bachelors", "enrolled in [a] 4|four year bachelor|bachelors|undergraduate", "must be [actively|currently] enrolled ... bachelor|bachelors", "enrolled in [a|an] undergraduate program", "enrolled undergraduate",
    "undergraduate student|students only", "undergraduate student|students pursuing|status", "undergraduate only", "current undergraduate status", "undergraduate enrollment required", "undergraduate program student", "undergraduate intern|interns|internship", "intern undergraduate", "must be [a|an] undergraduate [student]",
    "open to undergraduate student|students", "undergraduate junior|senior|sophomore status",
    "rising sophomore|sophomores|junior|juniors|senior|seniors", "entering|completed [their|the] sophomore|junior|senior year", "entering third|fourth year", "advancing to [their|the] sophomore|junior|senior [year]", "going into [their|the] junior|senior year", "going into junior or senior year",
    "freshman|sophomore|junior|senior standing", "freshman|sophomore|junior|senior year standing", "sophomore|junior|senior status", "junior or senior year|standing|status", "class standing junior|senior|sophomore", "junior|senior pursuing [a] bachelor|bachelors", "current|rising sophomore|junior|senior student|year",
    "must be [a] junior|senior [or] [senior] year|student", "for junior|senior [year] students only", "must have completed sophomore|junior|senior year", "completed 2|3|two|three years by start",
    "currently [a|enrolled] college student", "enrolled [as] [a] college student", "enrolled [as] [a] [full] [time] student at [a|an] accredited four|4 year", "accredited four|4 year college|university", "must be [a] current|active student ... college|university", "must be [a] full time student ... college|university",
    "enrolled [as] [a] [full] [time] student ... four|4 year", "enrolled ... full time ... undergraduate", "associate|associates|aa or|and bachelor|bachelors", "associate|associates|aa degree ... only", "target|targeted major|majors ... bachelor|bachelors", "graduating ... with [a] ba|bs", "with [a] ba bs majoring",
    "receive [a] ba|bs by|before|prior", "high school diploma ... currently attending [a] college", "student|students must be continuing ... degree during", "experience ... bachelor|bachelors program",
    "summer|fall 2027", "2027 start", "start ... 2027",
)
PHD = (
    "phd intern|interns|internship|student|students|candidate|candidates|applicant|applicants|only|required|preferred", "phd is required", "doctoral intern|student|students|candidate|candidates|only", "doctoral degree ... required", "pursuing|obtaining|toward|towards [a|an|their] phd [in]", "pursuing|enrolled|candidate|candidates ... phd degree|program",
    "requires|require [a|an] phd", "must|should have [a|an] phd", "must have ... phd degree|student|candidate", "has ... phd degree", "phd degree in the field of", "phd level degree|student", "current|ongoing|active phd", "3rd year phd", "current 3rd year ... phd", "criteria ... pursuing ... phd", "one of ... following ... phd", "2026|2027 start phd",
)
DEGREE_LISTS = ("bs|ba|bachelor|bachelors|bsc ms|ma|master|masters|msc [or|and] phd", "bs|ba|bachelor|bachelors or|and ms|ma|master|masters", "ms|ma|master|masters [or|and] phd", "ms phd", "bs ms", "ba ms")
ENROLLED = ("enrolled", "enroll", "attend", "attending", "study", "studying", "student", "students")
SCHOOL = "university|universities|college|colleges|school|schools|institution|institutions"
CPT = (
    "no|not|cannot|unable|without [to] [accept|support|provide|offer|sponsor|sign|hire|use] [on|for|any|either] cpt|opt", "no cpt|opt", "will not provide|offer|support|sign|accept ... cpt|opt", "will not ... curricular|optional practical", "does|do not support|provide|sponsor|accept ... cpt|opt", "doesnt|dont|cannot support|provide|sponsor|accept ... cpt|opt",
    "cpt|opt not|ineligible|excluded", "cpt|opt [is|are] not|cannot [be] available|supported|provided|offered|accepted", "cpt|opt ... not available|supported|provided|offered|accepted", "not eligible ... cpt|opt", "not open to candidates on opt|cpt", "no ... assistance|support|documentation ... cpt|opt", "sponsorship is available ... opt|cpt",
    "no sponsorship is available ... opt|cpt", "sponsorship ... not available ... cpt|opt", "not available ... f 1 ... cpt|opt|ead", "authorization to work ... indefinitely is required", "work permit sponsorship is not available", "authorized to work ... without the need for ... sponsor|sponsorship",
)
CPT_OPEN = ("support|supports|supporting|welcome|welcomes|provide|provides|offer|offers cpt|opt", "cpt|opt eligible|accepted|welcome")
EXPORT = (
    "export control|compliance|regulations|controls", "export controlled", "itar", "ear", "immigration nationality act", "defined by", "classified as", "eligible for any required authorizations", "eligible for authorizations from",
)


def _places(*heads: str) -> tuple[str, ...]:
    """The phrases with each place behind them; the places of several words are spelled out one by one."""
    named = (*STATES, *LANDS, *CITIES)
    single, several = "|".join(p for p in named if " " not in p), tuple(p for p in named if " " in p)
    return tuple(f"{head} {place}" for head in heads for place in (single, *several))


GEOGRAPHY = _places(f"{'|'.join(ENROLLED)} ... {SCHOOL} ... in|within|near [the] [greater]", f"{'|'.join(ENROLLED)} ... {SCHOOL} ... state of", "must reside|live|study|enroll in [the]", "must be enrolled in [the]", "must reside|live|study ... state of")

#: F11a to F11m, in order
RULES = (
    Rule("clearance", CLEARANCE), Rule("citizenship", CITIZENSHIP), Rule("graduation", GRADUATION), Rule("permanent_authorization", PERMANENT), Rule("high_school", HIGH_SCHOOL), Rule("undergraduate_only", UNDERGRADUATE, MASTER, 500),
    Rule("non_cs_degree", ("pursuing|enrolled ... bsee|bsme|bsce|bsae|bsie", "bachelor|bachelors ... electrical|mechanical|civil|aerospace engineering", "degree in nursing|law|education|biology|chemistry|marketing|accounting|finance|psychology|architecture", "degree in civil|mechanical|electrical|aerospace|chemical|industrial engineering"), COMPUTING, 200),
    Rule("preferred_degree", ("degree|degrees preferred", "preferred degree|degrees|major|majors", "majoring in", "preferred field|fields [of] [study]"), COMPUTING, fields=OTHER_FIELDS),
    Rule("phd_only", PHD, (*MASTER, *DEGREE_LISTS), 500, within=("requirements", "preferred"), outside=("about", "benefits")),
    Rule("geography", GEOGRAPHY, (*(f"{'university|college|school|enrolled'} ... {h}" for h in HOME), *(f"anywhere|across|within|in {h}" for h in HOME), "enrolled in an accredited"), outside=("about", "benefits")),
    Rule("cpt_opt", CPT, CPT_OPEN, 150), Rule("us_person", ("us person|persons", "united states person|persons", "department of defense", "dod", "dod contract|clearance|program", "defense contract|contracts"), EXPORT, 300),
    Rule("bachelor_only", ("bachelor|bachelors [degree] student|students|candidate|candidates only", "only [for|open] [to] bachelor|bachelors", "only open to undergraduate"), MASTER, 300),
)
LAST_YEAR = 2027


def graduation_year(words: Column) -> Column:
    """F11n: every graduation year that the normal form names lies after 2027; a span that holds 2027 and 'or later' pass."""
    said = F.regexp_extract_all(words, F.lit(r"(?:class of|graduat\w+(?: date)?(?: (?:in|by|between|from|of))?)(?: [a-z]+){0,3} (20[2-3]\d(?: (?:(?:to|and|or) )?(?:[a-z]+ )?20[2-3]\d)*)"), F.lit(1))
    years = F.flatten(F.transform(said, lambda s: F.regexp_extract_all(s, F.lit(r"(20\d\d)"), F.lit(1))))
    return (F.size(years) > 0) & (F.array_min(F.transform(years, lambda y: y.cast("int"))) > LAST_YEAR) & ~words.rlike(r"20\d\d or (later|after|beyond)")


def _reason(words: Column) -> Column:
    return F.coalesce(first_reason(words, RULES), F.when(graduation_year(words), "graduation_year"))


def restriction(text: Column) -> Column:
    """F11 on a plain text."""
    return _reason(plain_words(text))


def page_text(html: Column) -> Column:
    """The text of a page: without scripts, styles and tags, in single spaces."""
    bare = F.regexp_replace(F.regexp_replace(C.text(html), r"(?is)<(script|style)[^>]*>.*?</\1>", " "), "<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def page_reason(html: Column) -> Column:
    """F11 on a page: its headings bound the sections that the rules on doctoral studies and places use."""
    return _reason(page_words(html))


def hits(words: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    return all_hits(words, rules)


#: the rules without sections, for the twin that finds the same positions by joining words
FLAT = tuple(r._replace(within=(), outside=()) for r in RULES if r.reason in ("graduation", "undergraduate_only", "non_cs_degree", "preferred_degree", "phd_only", "cpt_opt", "us_person", "bachelor_only"))
FLAT = tuple(r._replace(phrases=tuple(p for p in r.phrases if p.count(" ... ") < 2), rescue=tuple(p for p in r.rescue if p.count(" ... ") < 2)) for r in FLAT)

NAMES = " ".join(f"WHEN {i} THEN '{r.reason}'" for i, r in enumerate(FLAT))
query("f11_phrase_verdicts", "WITH bodies AS (SELECT DISTINCT body FROM restricted), " + sql_hits(f"SELECT body AS id, {sql_words('body')} AS t FROM bodies", FLAT) + f""",
    verdict AS (SELECT id, min(rule) FILTER (NOT rescued) AS r, count(*) AS n FROM hit GROUP BY id) SELECT x.id, CASE r {NAMES} END AS reason, coalesce(n, 0) AS n_hits FROM restricted x LEFT JOIN verdict v ON x.body = v.id""", "restricted")(
    lambda s, d: tables.restricted(s, d).withColumn("h", hits(plain_words(F.col("body")), FLAT)).select("id", F.get(F.filter("h", lambda h: ~h["rescued"]), F.lit(0))["reason"].alias("reason"), F.size("h").cast("long").alias("n_hits"))
)
#: what the rules mean for each of SAMPLE_PAGES, judged by hand
PAGE_VERDICTS = (None, "geography", "geography", None, None, None, "phd_only", None, None, "phd_only", None, "phd_only", "geography", None, None, "phd_only", "phd_only", None, "geography", None)
query("f11_page_sections", f"SELECT id, CASE id % {len(PAGE_VERDICTS)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(PAGE_VERDICTS) if v) + " END AS reason FROM restricted", "restricted")(lambda s, d: tables.restricted(s, d).select("id", page_reason(F.col("html")).alias("reason")))
