"""What a page says about its posting (P54): JSON-LD of any shape, elements found by selectors, labelled text and the address.

Structured data is parsed to VARIANT and walked through lists, @graph, mainEntity and lists of items, some levels deep, until nodes
of type JobPosting are found; their values may be texts, objects or lists. Elements come from one stream of tags per page, made by
one pattern; selectors are conditions on its entries.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions import columns as C
from postmill.operators.restrictions import page_text
from postmill.plans.registry import query
from postmill.sources import tables

DEPTH = 3
SCRIPT = r"(?is)<script[^>]+type\s*=\s*[\"']?application/ld\+json[^>]*>(.*?)</script>"
#: groups: what stands inside a tag, its name, and the text up to the next tag (behind its last '>')
TAG = r"<(\s*+(/?[a-zA-Z][\w-]*+)?+(?:\"[^\"]*+\"|'[^']*+'|[^>\"']++)*+)>(?:[^<>]*+>)*+([^<>]*+)"
NAME = r"([a-zA-Z_:][\w:.-]*)\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
VALUE = r"[a-zA-Z_:][\w:.-]*\s*=\s*[\"']?+((?<=\")[^\"]*(?=\")|(?<=')[^']*(?=')|(?<![\"'])[^\s\"'>]+)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body of a value that is worked out once, however often the body names it; nested columns are worked out anew at each place."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def listed(v: Column) -> Column:
    """The elements of a variant that is a list, else the variant alone; nothing for null."""
    return F.filter(F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v)), lambda x: x.isNotNull() & ~F.is_variant_null(x))


def at(v: Column, *names: str) -> Column:
    """The variant under the names, or null."""
    return F.try_variant_get(v, "$" + "".join(f'["{n}"]' for n in names), "variant")


def first_text(v: Column) -> Column:
    """The text of a value: itself, or the name or value of its object, of the first in a list that has one."""
    said = lambda x: F.coalesce(*[F.nullif(F.trim(F.try_variant_get(x, path, "string")), F.lit("")) for path in ("$.name", "$.value", "$.legalName")], F.when(~F.schema_of_variant(x).startswith("OBJECT") & ~F.schema_of_variant(x).startswith("ARRAY"), F.nullif(F.trim(F.try_variant_get(x, "$", "string")), F.lit(""))))
    deep = lambda x: F.coalesce(said(x), F.get(F.filter(F.transform(listed(at(x, "parentOrganization")), said), lambda t: t.isNotNull()), F.lit(0)))
    return F.get(F.filter(F.transform(listed(v), deep), lambda t: t.isNotNull()), F.lit(0))


def postings_in(html: Column) -> Column:
    """array<variant>: every JobPosting node of a page's JSON-LD blocks, in their order; blocks that are no JSON are passed over.

    A node without a type counts if it names a hiring organization."""
    def deeper(level: Column) -> Column:
        return F.flatten(F.transform(level, lambda x: F.concat(listed(at(x, "@graph")), listed(at(x, "mainEntity")), F.transform(listed(at(x, "itemListElement")), lambda e: F.coalesce(at(e, "item"), e)))))

    def wanted(x: Column) -> Column:
        return let(F.transform(listed(at(x, "@type")), lambda t: F.try_variant_get(t, "$", "string")), lambda kinds: F.array_contains(kinds, "JobPosting") | ((F.size(kinds) == 0) & at(x, "hiringOrganization").isNotNull()))

    def walked(levels: list[Column]) -> Column:
        if len(levels) > DEPTH:
            return F.filter(F.concat(*levels), wanted)
        return let(deeper(levels[-1]), lambda level: walked([*levels, level]))

    blocks = F.transform(F.regexp_extract_all(C.text(html), F.lit(SCRIPT), F.lit(1)), lambda b: F.try_parse_json(F.trim(b)))
    return let(F.flatten(F.transform(F.filter(blocks, lambda b: b.isNotNull()), listed)), lambda level: walked([level]))


def place_of(node: Column) -> Column:
    """The places of a posting, '; ' between them: 'City, Region', or what its address says; Remote for telecommuting without a place."""
    def said(address: Column) -> Column:
        spoken = F.nullif(F.concat_ws(", ", *[F.nullif(F.trim(F.try_variant_get(address, f"$.{n}", "string")), F.lit("")) for n in ("addressLocality", "addressRegion")]), F.lit(""))
        return F.coalesce(spoken, first_text(address), first_text(at(address, "addressCountry")))

    def one(p: Column) -> Column:
        return let(F.coalesce(F.get(listed(at(p, "address")), F.lit(0)), p), said)

    remote = F.exists(listed(at(node, "jobLocationType")), lambda t: F.try_variant_get(t, "$", "string") == "TELECOMMUTE")
    return let(F.filter(F.transform(listed(at(node, "jobLocation")), one), lambda t: t.isNotNull()), lambda places: F.when(F.size(places) > 0, F.array_join(F.array_distinct(places), "; ")).when(remote, "Remote"))


def without_scripts(html: Column) -> Column:
    return F.regexp_replace(C.text(html), r"(?is)<(?:(script|style)[^>]*>.*?</\1>|!--.*?-->)", " ")


def tags_in(bare: Column) -> Column:
    """struct<names, texts, marked>: the names of all tags in order, the text behind each up to the next one, and the tags that have
    attributes as structs of place (from 1), name, keys and values.

    A closing tag's name begins with a slash; names and keys are in lower case."""
    all_of = lambda t, pattern, i: F.regexp_extract_all(t, F.lit(pattern), F.lit(i))

    def entry(x: Column, i: Column) -> Column:
        keys = F.transform(all_of(x, NAME, 1), lambda k: F.lower(k))
        return F.when(x.contains("="), F.struct((i + 1).alias("place"), F.lower(F.regexp_extract(x, r"^\s*(/?[a-zA-Z][\w-]*)", 1)).alias("name"), keys.alias("keys"), all_of(x, VALUE, 1).alias("values")))

    return F.struct(F.transform(all_of(bare, TAG, 2), lambda n: F.lower(n)).alias("names"), all_of(bare, TAG, 3).alias("texts"), F.filter(F.transform(all_of(bare, TAG, 1), entry), lambda x: F.size(x["keys"]) > 0).alias("marked"))


def tag_stream(html: Column) -> Column:
    """The tags of a page (tags_in); scripts and styles are left out."""
    return let(without_scripts(html), tags_in)


class Selector(NamedTuple):
    """tag: a name, or '' for any. conditions: (attribute, sign, text), sign being '' (has it), = (equal), ~ (a word of it) or * (contains). take: an attribute, or '' for the text."""

    tag: str
    conditions: tuple[tuple[str, str, str], ...]
    take: str


def selector(text: str) -> Selector:
    """Reads `tag.class#id[attr=value][attr~=word][attr*=part]@attribute`."""
    body, _, take = text.partition("@")
    tag = re.match(r"[a-z0-9]*", body)[0]
    conditions = [("class", "~", c) if sign == "." else ("id", "=", c) for sign, c in re.findall(r"([.#])([\w-]+)", re.sub(r"\[[^]]*\]", "", body))]
    conditions += [(a, sign, v.strip("\"'")) for a, sign, v in re.findall(r"\[([\w:-]+)(?:([~*]?)=([^]]+))?\]", body) for sign in [sign or ("=" if v else "")]]
    return Selector(tag, tuple(conditions), take)


def value_of(x: Column, name: str) -> Column:
    """The first attribute of that name of a marked tag."""
    return F.get(x["values"], F.array_position(x["keys"], F.lit(name)).cast("int") - 1)


def fitting(stream: Column, s: Selector) -> Column:
    """The marked tags that a selector with conditions finds."""
    def fits(x: Column) -> Column:
        test = (x["name"] == s.tag) if s.tag else ~x["name"].startswith("/")
        for name, sign, text in s.conditions:
            v, text = F.lower(value_of(x, name)), text.lower()
            test = test & {"": v.isNotNull(), "=": v == text, "~": v.contains(text) & F.array_contains(F.split(v, r"\s+"), text), "*": v.contains(text)}[sign]
        return test

    return F.filter(stream["marked"], fits)


def place_in(stream: Column, s: Selector) -> Column:
    """The place of the first tag that a selector finds, or null."""
    if s.conditions:
        return F.get(fitting(stream, s), F.lit(0))["place"]
    place = F.array_position(stream["names"], F.lit(s.tag)) if s.tag else F.array_position(F.transform(stream["names"], lambda n: ~n.startswith("/")), F.lit(True))
    return F.when(place > 0, place.cast("int"))


def class_words(stream: Column) -> Column:
    """array<struct<word, place>>: the words of all classes of a page in order."""
    of = lambda x: F.transform(F.split(F.lower(value_of(x, "class")), r"\s+"), lambda w: F.struct(w.alias("word"), x["place"].alias("place")))
    return F.flatten(F.transform(F.filter(stream["marked"], lambda x: F.array_contains(x["keys"], "class") & ~x["name"].startswith("/")), of))


def text_at(stream: Column, place: Column) -> Column:
    """All text from a tag up to the element's end, or up to the next tag if it has no end."""
    end = F.array_position(F.slice(stream["names"], place, F.size(stream["names"])), F.concat(F.lit("/"), F.get(stream["names"], place - 1)))
    own = F.slice(stream["texts"], place, F.greatest(end.cast("int") - 1, F.lit(1)))
    return F.trim(F.regexp_replace(F.array_join(own, ""), r"\s+", " "))


def attribute_at(stream: Column, s: Selector) -> Column:
    """The first value of the attribute that a selector takes which is not empty."""
    return F.get(F.filter(F.transform(fitting(stream, s), lambda x: F.trim(value_of(x, s.take))), lambda t: t.isNotNull() & (t != "")), F.lit(0))


def selected(stream: Column, s: Selector) -> Column:
    """The first value that a selector finds in a tag stream: an attribute, or all text up to the element's end."""
    return attribute_at(stream, s) if s.take else let(place_in(stream, s), lambda place: let(text_at(stream, place), lambda t: F.when(t != "", t)))


#: field, selector, confidence
SELECTORS = (
    ("title", "title", 0.7), ("title", "h1", 0.9), ("title", "[itemprop=title]", 0.9), ("company", "meta[property=og:site_name]@content", 0.9), ("company", ".company", 0.85), ("company", ".company-name", 0.85), ("company", "[itemprop=hiringOrganization]", 0.85), ("company", "[data-company]@data-company", 0.85),
    ("location", ".location", 0.88), ("location", ".job-location", 0.88), ("location", "#job-location", 0.88), ("location", "[itemprop=jobLocation]", 0.88), ("location", "[data-location]@data-location", 0.85), ("location", "meta[property=og:locality]@content", 0.85),
    ("job_type", "meta[name=job-type]@content", 0.9), ("job_type", "[itemprop=employmentType]", 0.88), ("job_type", ".employment-type", 0.85), ("job_id", "meta[name=job-id]@content", 0.95), ("job_id", "meta[name=jobid]@content", 0.95), ("job_id", "meta[property=og:job:id]@content", 0.95),
    ("job_id", "[data-job-id]@data-job-id", 0.9), ("job_id", "[data-jobid]@data-jobid", 0.9), ("job_id", "[data-requisition-id]@data-requisition-id", 0.9), ("language", "html@lang", 0.95),
)


def place_in_path(url: Column) -> Column:
    """'City-ST' in a URL's path as 'City, ST'."""
    city, state = (F.regexp_extract(C.text(url), r"/([A-Z][a-z]+(?:-[A-Z][a-z]+)?)-([A-Z]{2})(?:[/_?-]|$)", i) for i in (1, 2))
    return F.when(state.isin(*C.STATES), F.concat(F.replace(city, F.lit("-"), F.lit(" ")), F.lit(", "), state))


def votes(pages: DataFrame) -> DataFrame:
    """page_id, field, value, confidence: what structured data, selected elements, labelled text and the address say.

    Each page is parsed once: its postings, its tag stream and its text are columns that all votes read. Values longer than 80
    characters are no votes; a page without any gives no rows.
    """
    bare = pages.select("page_id", "url", F.get(postings_in(F.col("html")), F.lit(0)).alias("_node"), without_scripts(F.col("html")).alias("_bare"), page_text(F.col("html")).alias("_text"))
    tags, texts = F.col("_tags"), [x for x in (selector(text) for _, text, _ in SELECTORS) if not x.take]
    # most selectors ask for an attribute that no tag of a page has
    asked = lambda x, found: F.when(F.array_contains("_keys", x.conditions[0][0]), found) if x.conditions else found

    def place(x: Selector) -> Column:
        if not x.tag and [c[:2] for c in x.conditions] == [("class", "~")]:
            return F.get(F.col("_words")["place"], F.array_position(F.col("_words")["word"], F.lit(x.conditions[0][2].lower())).cast("int") - 1)
        return asked(x, place_in(tags, x))

    def taken(x: Selector) -> Column:
        return asked(x, attribute_at(tags, x)) if x.take else text_at(tags, F.get("_places", F.lit(texts.index(x))))

    parsed = bare.withColumn("_tags", tags_in(F.col("_bare"))).withColumns({"_keys": F.array_distinct(F.flatten(tags["marked"]["keys"])), "_words": class_words(tags)})
    parsed = parsed.withColumn("_places", F.array(*[place(x) for x in texts]))
    label = lambda name: F.regexp_extract("_text", rf"(?i)\b(?:{name})\s*:\s*([^.|<]{{2,60}}?)(?=\s{{2}}|[.|<]|$)", 1)
    code = lambda name: F.regexp_extract("_text", rf"(?i)\b(?:{name})\s*:?\s*((?=[A-Z0-9-]*[0-9])[A-Z0-9-]{{4,20}})\b", 1)
    node = F.col("_node")
    said = [
        ("title", first_text(at(node, "title")), 0.95), ("company", first_text(at(node, "hiringOrganization")), 0.93), ("location", place_of(node), 0.95), ("job_type", first_text(at(node, "employmentType")), 0.95), ("job_id", first_text(at(node, "identifier")), 0.95),
        ("location", label("location"), 0.8), ("job_id", code("job id|job code|req(?:uisition)? id|requisition number|role id"), 0.85), ("job_type", label("job type|employment type"), 0.8), ("company", F.regexp_extract("url", r"^https?://(?:www\.|m\.)?([^./]+)", 1), 0.4),
        ("job_id", C.board_job_id(F.col("url")), 0.9), ("location", place_in_path(F.col("url")), 0.7), ("language", F.regexp_extract("url", r"/(en|de|fr|es)/", 1), 0.6),
    ]
    said += [(field, F.substring(taken(selector(text)), 1, 2) if field == "language" else taken(selector(text)), c) for field, text, c in SELECTORS]
    found = F.array(*[F.struct(F.lit(f).alias("field"), F.trim(v).alias("value"), F.lit(c).alias("confidence")) for f, v, c in said])
    # explode would put a filter on the array's size in front, with all of the above in it once more
    return parsed.select("page_id", found.alias("v")).select("page_id", F.explode_outer("v").alias("v")).select("page_id", "v.*").where("value IS NOT NULL AND value <> '' AND length(value) <= 80")


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """The rows that pages are made of, dealt over all shuffle partitions: reading a page takes far longer than moving such a row, and a small file is one task."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


#: shapes of structured data, with T, C and I for title, company and id
SHAPES = (
    '{"@type":"JobPosting","title":"T","hiringOrganization":{"@type":"Organization","name":"C"},"identifier":{"value":"I"},"jobLocation":{"address":{"addressLocality":"Boston","addressRegion":"MA"}},"employmentType":"INTERN"}',
    '{"@context":"x","@graph":[{"@type":"WebSite","name":"W"},{"@type":["JobPosting","Thing"],"title":"T","hiringOrganization":"C","identifier":"I","jobLocation":[{"address":{"addressLocality":"Boston","addressRegion":"MA"}}],"employmentType":["INTERN","PART_TIME"]}]}',
    '[{"@type":"BreadcrumbList","itemListElement":[]},{"@type":"JobPosting","title":"T","hiringOrganization":[{"name":" "},{"parentOrganization":{"name":"C"}}],"identifier":[{"@type":"PropertyValue","value":"I"}],"jobLocation":{"address":"Boston, MA"},"employmentType":{"name":"INTERN"}}]',
    '{"@type":"WebPage","mainEntity":{"@type":"ItemList","itemListElement":[{"position":1,"item":{"@type":"JobPosting","title":"T","hiringOrganization":{"legalName":"C"},"identifier":I,"jobLocation":{"@type":"Place","name":"Boston, MA"},"employmentType":"INTERN"}}]}}',
)


def _shaped() -> str:
    """A page with a broken block, then one of the shapes, and marked elements."""
    shapes = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SHAPES))
    filled = f"replace(replace(replace(replace(CASE id % 4 {shapes} END, '\"T\"', '\"' || title || '\"'), '\"C\"', '\"' || company || '\"'), '\"I\"', '\"' || id || '\"'), ':I,', ':' || id || ',')"
    return f"""'<html lang="en-US"><script type="application/ld+json">{{broken</script><script type=application/ld+json>' || {filled} || '</script><body><div class="x job-location"><span>Austin</span>, <b>TX</b></div><p data-job-id=' || id || '></p></body></html>'"""


query("p54_json_ld", """SELECT id AS page_id, field, value, c::DOUBLE AS confidence FROM (SELECT id, unnest(['title', 'company', 'job_id', 'location', 'job_type', 'location', 'job_id', 'language']) AS field, unnest([title, company, id::VARCHAR, 'Boston, MA', 'INTERN', 'Austin, TX', id::VARCHAR, 'en']) AS value,
    unnest([0.95, 0.93, 0.95, 0.95, 0.95, 0.88, 0.9, 0.95]) AS c FROM samples)""", "samples")(lambda s, d: votes(dealt(tables.samples(s, d), "id").selectExpr("id AS page_id", f"{_shaped()} AS html", "CAST(NULL AS STRING) AS url")))  # fmt: skip
