"""Where a posting lies: longest matches of word runs with a place table, scores summed by country (F15b, F15c), and glued place names (P42d).

The place table is a bounded list of names with a country and a weight each; a name of several countries has a row for each. Only
the distinct values of a field are split into runs of words, joined with the table and scored; the scores come back by a join.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.functions import columns as C
from postmill.plans.registry import query
from postmill.sources import tables

LONGEST = 3
#: fixed values: states by code, provinces by code
STATES = dict(x.split("=") for x in (
    "AL=alabama,AK=alaska,AZ=arizona,AR=arkansas,CA=california,CO=colorado,CT=connecticut,DE=delaware,FL=florida,GA=georgia,HI=hawaii,ID=idaho,IL=illinois,IN=indiana,IA=iowa,KS=kansas,KY=kentucky,LA=louisiana,ME=maine,MD=maryland,MA=massachusetts,MI=michigan,MN=minnesota,"
    "MS=mississippi,MO=missouri,MT=montana,NE=nebraska,NV=nevada,NH=new hampshire,NJ=new jersey,NM=new mexico,NY=new york,NC=north carolina,ND=north dakota,OH=ohio,OK=oklahoma,OR=oregon,PA=pennsylvania,RI=rhode island,SC=south carolina,SD=south dakota,TN=tennessee,TX=texas,"
    "UT=utah,VT=vermont,VA=virginia,WA=washington,WV=west virginia,WI=wisconsin,WY=wyoming,DC=district of columbia"
).split(","))
PROVINCES = dict(x.split("=") for x in "ON=ontario,QC=quebec,BC=british columbia,AB=alberta,MB=manitoba,SK=saskatchewan,NS=nova scotia,NB=new brunswick,NL=newfoundland".split(","))
#: fixed values: cities with their state, and cities of other lands; those of several lands are in several rows, with the likelier one first
CITIES = dict(x.split("=") for x in (
    "new york=NY,san francisco=CA,los angeles=CA,san jose=CA,san diego=CA,palo alto=CA,mountain view=CA,sunnyvale=CA,santa clara=CA,fremont=CA,irvine=CA,seattle=WA,bellevue=WA,redmond=WA,boston=MA,chicago=IL,austin=TX,dallas=TX,houston=TX,plano=TX,san antonio=TX,atlanta=GA,"
    "denver=CO,boulder=CO,phoenix=AZ,scottsdale=AZ,portland=OR,hillsboro=OR,pittsburgh=PA,philadelphia=PA,detroit=MI,ann arbor=MI,minneapolis=MN,raleigh=NC,charlotte=NC,miami=FL,orlando=FL,tampa=FL,nashville=TN,salt lake city=UT,indianapolis=IN,columbus=OH,cleveland=OH,"
    "baltimore=MD,wilmington=DE,st louis=MO,kansas city=MO,las vegas=NV,sacramento=CA,jersey city=NJ,princeton=NJ,arlington=VA,reston=VA,mclean=VA"
).split(","))
ABROAD = {
    "Canada": "toronto,montreal,calgary,ottawa,edmonton,winnipeg,mississauga,markham,kitchener,quebec city", "UK": "manchester,edinburgh,glasgow,leeds,oxford", "India": "bangalore,bengaluru,hyderabad,pune,mumbai,chennai,delhi,new delhi,noida,gurgaon,gurugram,kolkata",
    "Germany": "munich,berlin,hamburg,frankfurt,stuttgart,cologne", "France": "lyon,toulouse", "Ireland": "cork,galway", "Poland": "warsaw,krakow,wroclaw", "Spain": "madrid,barcelona", "Netherlands": "amsterdam,eindhoven", "Switzerland": "zurich,geneva", "Israel": "tel aviv,haifa",
    "Japan": "tokyo,osaka", "China": "beijing,shanghai,shenzhen", "Singapore": "", "Australia": "sydney,brisbane", "Mexico": "mexico city,guadalajara,monterrey", "Brazil": "sao paulo",
}
SHARED = {"london": ("UK", "Canada", "US"), "vancouver": ("Canada", "US"), "cambridge": ("US", "UK", "Canada"), "waterloo": ("Canada", "US"), "windsor": ("Canada", "US", "UK"), "hamilton": ("Canada", "US"), "dublin": ("Ireland", "US"), "paris": ("France", "US"), "melbourne": ("Australia", "US"),
          "birmingham": ("US", "UK"), "manchester nh": ("US",), "richmond": ("US", "Canada"), "victoria": ("Canada", "US"), "milan": ("Italy", "US"), "rome": ("Italy", "US"), "athens": ("US", "Greece")}
COUNTRY_WORDS = {"US": "us,usa,united states,united states of america,america", "Canada": "canada", "UK": "uk,united kingdom,england,scotland,wales,great britain", "Italy": "italy", "Greece": "greece"} | {c: c.lower() for c in ("India", "Germany", "France", "Ireland", "Poland", "Spain", "Netherlands", "Switzerland", "Israel", "Japan", "China", "Singapore", "Australia", "Mexico", "Brazil")}
#: weights: a country's name, a code behind a comma, a city of one land, a region's name, the first and the other lands of a shared city
COUNTRY, CODE, CITY, REGION, LIKELY, OTHER = 5.0, 3.0, 4.0, 3.0, 2.0, 1.0
DOMAINS = {"ca": "Canada", "co.uk": "UK", "uk": "UK", "de": "Germany", "in": "India", "co.in": "India", "fr": "France", "ie": "Ireland", "com.au": "Australia"}
SIGNS = {"canada": "Canada", "uk": "UK", "india": "India", "gmbh": "Germany", "pty": "Australia", "sarl": "France"}


def place_rows() -> list[tuple[str, str, float]]:
    """(name, country, weight) of the place table. Codes stand behind a comma, written ', xx'."""
    rows = [(n, "US", REGION) for n in STATES.values()] + [(n, "Canada", REGION) for n in PROVINCES.values()] + [(n, "US", CITY) for n in CITIES] + [(n, c, CITY) for c, names in ABROAD.items() for n in names.split(",") if n]
    rows += [(n, c, LIKELY if i == 0 else OTHER) for n, lands in SHARED.items() for i, c in enumerate(lands)] + [(n, c, COUNTRY) for c, names in COUNTRY_WORDS.items() for n in names.split(",")]
    rows += [(f", {k.lower()}", "US", CODE) for k in STATES] + [(f", {k.lower()}", "Canada", CODE) for k in PROVINCES]
    most: dict[tuple[str, str], float] = {}
    for name, country, weight in rows:  # a name counts once for a land: New York is a city and a state
        most[name, country] = max(weight, most.get((name, country), 0.0))
    return [(name, country, weight) for (name, country), weight in most.items()]


def gazetteer(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(place_rows(), "name string, country string, weight double")


def place_tokens(text: Column) -> Column:
    """Lower-case words, and commas as words of their own."""
    return F.filter(F.split(F.regexp_replace(F.lower(C.text(text)), r"[^a-z,]+|(,)", " $1 "), " +"), lambda t: t != "")


def place_scores(values: DataFrame, places: DataFrame) -> DataFrame:
    """value, country, score: the places in each distinct text `value`, the longest match at each spot, by country."""
    tokens = values.select("value").distinct().select("value", place_tokens(F.col("value")).alias("t")).where(F.size("t") > 0)
    runs = tokens.select("value", "t", F.explode(F.sequence(F.lit(1), F.size("t"))).alias("at")).select("value", "at", F.posexplode(F.transform(F.array(*[F.lit(n) for n in range(1, LONGEST + 2)]), lambda n: F.array_join(F.slice("t", F.col("at"), n), " "))).alias("n", "name"))
    found = runs.join(F.broadcast(places), "name").select("value", "at", (F.col("at") + F.size(F.split("name", " "))).alias("end"), "country", "weight").distinct()
    listed = found.groupBy("value").agg(F.collect_list(F.struct("at", "end", "country", "weight")).alias("m"))  # as long as a text has words
    whole = F.filter("m", lambda x: ~F.exists("m", lambda y: (y["at"] <= x["at"]) & (y["end"] >= x["end"]) & (y["end"] - y["at"] > x["end"] - x["at"])))
    return listed.select("value", F.explode(whole).alias("x")).groupBy("value", "x.country").agg(F.sum("x.weight").alias("score"))


def countries(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Id, country, score, us_score, reason of rows (id, title, url, location, company) that lie abroad.

    A country in the title counts like one in the place; the address's domain and the company's name add to its score. A posting
    lies abroad if a country's sum is above that of the US; ties go to the US, and between other countries to the first by name.
    reason is the first of title, url, place, company that speaks for the country.
    """
    host = F.regexp_extract(F.lower(C.text(F.col("url"))), r"^https?://[^/]*?\.(co\.uk|co\.in|com\.au|[a-z]+)(?:[/:?]|$)", 1)
    domain = F.create_map(*[F.lit(x) for kv in DOMAINS.items() for x in kv])
    sign = F.create_map(*[F.lit(x) for kv in SIGNS.items() for x in kv])
    named = F.get(F.filter(F.transform(F.split(F.lower(C.text(F.col("company"))), "[^a-z]+"), lambda w: F.element_at(sign, w)), lambda c: c.isNotNull()), F.lit(0))
    texts = rows.select(F.explode(F.array(F.col("location"), F.col("title"))).alias("value")).where("value IS NOT NULL")
    scores = place_scores(texts, places)
    by_text = scores.groupBy("value").agg(F.map_from_entries(F.collect_list(F.struct("country", "score"))).alias("s"))
    # of titles only the names of countries count: cities and states in them are often words of teams
    titles = place_scores(rows.select(F.col("title").alias("value")).where("value IS NOT NULL"), places.where(F.col("weight") == COUNTRY)).groupBy("value").agg(F.map_from_entries(F.collect_list(F.struct("country", "score"))).alias("s"))
    joined = rows.join(by_text.select(F.col("value").alias("location"), F.col("s").alias("_place")), "location", "left").join(titles.select(F.col("value").alias("title"), F.col("s").alias("_title")), "title", "left")
    empty = F.create_map().cast("map<string,double>")
    parts = {"title": F.coalesce("_title", empty), "url": F.when(F.element_at(domain, host).isNotNull(), F.create_map(F.element_at(domain, host), F.lit(3.0))).otherwise(empty), "place": F.coalesce("_place", empty), "company": F.when(named.isNotNull(), F.create_map(named, F.lit(2.0))).otherwise(empty)}
    held = joined.select("id", *[v.alias(k) for k, v in parts.items()])
    value = lambda part, country: F.coalesce(F.try_element_at(F.col(part), country), F.lit(0.0))
    total = lambda country: sum((value(p, country) for p in parts), F.lit(0.0))
    lands = F.filter(F.array_distinct(F.concat(*[F.map_keys(F.col(p)) for p in parts])), lambda c: c != "US")
    best = F.get(F.array_sort(F.transform(lands, lambda c: F.struct((-total(c)).alias("minus"), c.alias("country")))), F.lit(0))
    judged = held.withColumn("best", best).withColumn("us_score", total(F.lit("US")))
    reason = F.coalesce(*[F.when(value(p, F.col("best.country")) > 0, p) for p in parts])
    return judged.where(-F.col("best.minus") > F.col("us_score")).select("id", F.col("best.country").alias("country"), (-F.col("best.minus")).alias("score"), "us_score", reason.alias("reason"))


#: words of place names, from the place table and a few more
WORDS = sorted({w for name, _, _ in place_rows() if not name.startswith(",") for w in name.split()} | {"area", "bay", "beach", "city", "county", "downtown", "east", "fort", "greater", "heights", "hill", "hills", "lake", "metro", "north", "park", "saint", "south", "springs", "valley", "west"})


def segment(text: str, words: frozenset[str], longest: int) -> str | None:
    """The fewest dictionary words that make up the text, longer ones first; None if it isn't made of them. One pass over the letters."""
    best: list[tuple[int, int] | None] = [(0, 0)]  # of each length: words needed, where the last one begins
    for end in range(1, len(text) + 1):
        ways = [(best[a][0] + 1, a) for a in range(max(0, end - longest), end) if best[a] is not None and text[a:end] in words]
        best.append(min(ways) if ways else None)
    if best[-1] is None or not text:
        return None
    parts, end = [], len(text)
    while end:
        parts.append(text[best[end][1] : end])
        end = best[end][1]
    return " ".join(reversed(parts))


def unglued(rows: DataFrame, column: str) -> DataFrame:
    """P42d: rows with `column` freed of glued words: a state's code before a city goes behind it, 'SanFranciscoCA' and 'sanfrancisco' are cut
    into words of the place table. Only distinct values are cut; null stays null, and values that no dictionary words make up stay."""
    known, longest = frozenset(WORDS), max(map(len, WORDS))

    @F.pandas_udf("string")
    def cut(texts: pd.Series) -> pd.Series:
        def one(text: str) -> str:
            found = segment(text.lower(), known, longest)
            return text if found is None else found.title()

        return texts.map(one, na_action="ignore")

    t, codes = F.trim(F.col("_v")), "|".join(STATES)
    code, rest = F.regexp_extract(t, rf"^({codes})(?=[A-Z][a-z])(.+)$", 1), F.regexp_extract(t, rf"^({codes})(?=[A-Z][a-z])(.+)$", 2)
    moved = F.when(code != "", F.concat(F.regexp_replace(rest, rf",? *({codes})$", ""), F.lit(", "), F.coalesce(F.nullif(F.regexp_extract(rest, rf",? *\b({codes})$", 1), F.lit("")), code))).otherwise(t)
    tail = F.regexp_replace(moved, rf"([a-z])({codes})$", "$1, $2")
    head, state = F.regexp_extract(tail, r"^([^,]*)(,.*)?$", 1), F.regexp_extract(tail, r"^([^,]*)(,.*)?$", 2)
    values = rows.select(F.col(column).alias("_v")).where("_v IS NOT NULL").distinct().select("_v", head.alias("_h"), state.alias("_s"))
    done = values.select("_v", F.concat(F.when(F.col("_h").contains(" "), F.col("_h")).otherwise(cut("_h")), "_s").alias("_new"))
    return rows.join(done, F.col(column) == F.col("_v"), "left").withColumn(column, F.col("_new")).drop("_v", "_new")


#: postings in many places
LOCATIONS = (
    "Toronto, ON, Canada", "London", "London, KY", "London, ON", "Boston, MA", "Munich, DE", "Wilmington, DE", "Hyderabad, IN", "Indianapolis, IN", "Dublin, CA", "Dublin, OH", "Dublin", "Paris, TX", "Paris, France", "Vancouver, WA", "Vancouver, BC", "Vancouver", "Cambridge", "Cambridge, UK",
    "Cambridge, Ontario", "Mexico City", "New Mexico", "New York City, New York", "New Delhi", "Remote", "Remote - US or Canada", "San Jose; Toronto; Montreal", "Bangalore, India", "Waterloo", "Waterloo, IA", "Birmingham, AL", "", "United Kingdom", "Salt Lake City", "Georgia", "Berlin, CT", "Quebec City, QC", "Melbourne, FL",
)
POSTED = f"""SELECT o_orderkey AS id, CASE o_orderkey % {len(LOCATIONS)} {' '.join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(LOCATIONS))} END AS location, CASE WHEN o_custkey % 11 = 0 THEN 'Software Intern - Germany' WHEN o_custkey % 11 = 1 THEN 'US Data Intern' WHEN o_custkey % 11 = 2 THEN NULL ELSE 'Boston Team Developer' END AS title,
    CASE o_custkey % 7 WHEN 0 THEN 'https://jobs.acme.ca/1' WHEN 1 THEN 'https://acme.co.uk/jobs/2' WHEN 2 THEN 'https://acme.de' WHEN 3 THEN NULL ELSE 'https://acme.example.com/jobs/3' END AS url, CASE o_custkey % 5 WHEN 0 THEN 'Acme GmbH' WHEN 1 THEN 'Acme Canada Inc' ELSE 'Acme' END AS company FROM {{orders}}"""


def _posted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(POSTED, orders=tables.table(spark, sf_dir, "orders"))


_VALUES = ", ".join(f"('{n}', '{c}', {w})" for n, c, w in place_rows())
_MATCHES = """SELECT value, country, sum(weight) AS score FROM {0} a WHERE NOT EXISTS (SELECT 1 FROM {0} b WHERE b.value = a.value AND b.k <= a.k AND b.e >= a.e AND b.e - b.k > a.e - a.k) GROUP BY 1, 2"""
query("f15_countries", f"""WITH posted AS ({POSTED.format(orders='orders')}), place(name, country, weight) AS (VALUES {_VALUES}),
    words AS (SELECT value, list_filter(string_split_regex(regexp_replace(regexp_replace(lower(value), '[^a-z,]+', ' ', 'g'), ',', ' , ', 'g'), ' +'), lambda x: x <> '') AS t FROM (SELECT location AS value FROM posted UNION SELECT title FROM posted) WHERE value IS NOT NULL),
    runs AS (SELECT value, k, k + n AS e, array_to_string(t[k : k + n - 1], ' ') AS name FROM (SELECT value, t, unnest(range(1, len(t) + 1)) AS k FROM words), range(1, 5) r(n) WHERE k + n <= len(t) + 1),
    m AS (SELECT DISTINCT value, k, e, country, weight FROM runs JOIN place USING (name)), mt AS (SELECT * FROM m WHERE weight = {COUNTRY}), s AS ({_MATCHES.format('m')}), st AS ({_MATCHES.format('mt')}),
    d AS (SELECT id, regexp_extract(lower(coalesce(url, '')), '^https?://[^/]*?\\.(co\\.uk|co\\.in|com\\.au|[a-z]+)(?:[/:?]|$)', 1) AS host, lower(company) AS c FROM posted),
    sign AS (SELECT id, country, score, 1 AS k FROM posted JOIN st ON title = value UNION ALL SELECT id, CASE host WHEN 'ca' THEN 'Canada' WHEN 'co.uk' THEN 'UK' WHEN 'de' THEN 'Germany' END, 3, 2 FROM d WHERE host IN ('ca', 'co.uk', 'de') UNION ALL SELECT id, country, score, 3 FROM posted JOIN s ON location = value
      UNION ALL SELECT id, CASE WHEN contains(c, 'gmbh') THEN 'Germany' ELSE 'Canada' END, 2, 5 FROM d WHERE contains(c, 'gmbh') OR contains(c, 'canada')),
    t AS (SELECT id, country, sum(score)::DOUBLE AS score, min(k) AS k FROM sign GROUP BY 1, 2), b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, country) AS r FROM t WHERE country <> 'US')
    SELECT b.id, b.country, b.score, coalesce(u.score, 0.0)::DOUBLE AS us_score, CASE b.k WHEN 1 THEN 'title' WHEN 2 THEN 'url' WHEN 3 THEN 'place' ELSE 'company' END AS reason FROM b LEFT JOIN t u ON b.id = u.id AND u.country = 'US' WHERE r = 1 AND b.score > coalesce(u.score, 0)""")(lambda s, d: countries(_posted(s, d), gazetteer(s)))  # fmt: skip
#: names to glue: cities of two words and more, behind or before the code of their state, and as they are
GLUED = [(name, state) for name, state in CITIES.items()]
_CITY = f"CASE o_orderkey % {len(GLUED)} " + " ".join(f"WHEN {i} THEN '{n}|{st}'" for i, (n, st) in enumerate(GLUED)) + " END"
GLUE = f"SELECT id, name, state, CASE id % 4 WHEN 0 THEN replace(name, ' ', '') WHEN 1 THEN state || replace(initcap(name), ' ', '') || ', ' || state WHEN 2 THEN replace(initcap(name), ' ', '') || state ELSE state || replace(initcap(name), ' ', '') END AS location FROM (SELECT o_orderkey AS id, substring_index({_CITY}, '|', 1) AS name, substring_index({_CITY}, '|', -1) AS state FROM {{orders}})"
query("p42d_glued_places", f"SELECT id, array_to_string(list_transform(string_split(string_split(p, '|')[1], ' '), lambda w: upper(w[1]) || w[2:]), ' ') || CASE WHEN id % 4 = 0 THEN '' ELSE ', ' || string_split(p, '|')[2] END AS location FROM (SELECT o_orderkey AS id, {_CITY} AS p FROM orders)")(lambda s, d: unglued(s.sql(GLUE, orders=tables.table(s, d, "orders")), "location").select("id", "location"))
