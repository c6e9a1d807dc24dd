"""Golden cases and brute force for places, page data, the gate chain, change sets and learned confidences."""

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from postmill.operators import chain, changes, gates, learned, places, restrictions
from postmill.plans.catalog import ORACLES, QUERIES
from postmill.sources import feeds, pages


def abroad(spark, rows):
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, location string, url string, title string, company string")
    found = {r.id: (r.country, r.reason) for r in places.countries(table, places.gazetteer(spark)).collect()}
    return [found.get(i) for i in range(len(rows))]


def test_places_here_and_abroad(spark):
    here = ["Dublin, CA", "Dublin, OH", "Paris, TX", "London, KY", "Vancouver, WA", "Wilmington, DE", "Indianapolis, IN", "Boston, MA", "New Mexico", "Cambridge", "Remote", "", None, "Georgia"]
    away = {"Munich, DE": "Germany", "Berlin, DE": "Germany", "Hyderabad, IN": "India", "Bangalore, IN": "India", "Toronto, ON": "Canada", "Vancouver, BC": "Canada", "Toronto, ON, Canada": "Canada", "Mexico City": "Mexico", "London": "UK", "Vancouver": "Canada", "Dublin": "Ireland"}
    assert abroad(spark, [(x, None, None, None) for x in here]) == [None] * len(here)
    assert abroad(spark, [(x, None, None, None) for x in away]) == [(c, "place") for c in away.values()]
    cases = [("London", "https://company.co.uk/jobs/123", None, None), ("Unknown", None, "Software Intern - Germany", None), ("London, KY", "https://a.co.uk/1", None, "Acme UK"), ("Vancouver", "https://a.ca", None, None), ("Boston, MA", "https://a.ca", None, "Acme Canada"), (None, None, None, "Acme GmbH")]
    assert abroad(spark, cases) == [("UK", "url"), ("Germany", "title"), ("UK", "url"), ("Canada", "url"), None, ("Germany", "company")]


def test_longest_places_win(spark):
    rows = spark.createDataFrame([("new york city, new york",), ("quebec city",), ("new delhi",)], "value string")
    found = {(r.value, r.country): r.score for r in places.place_scores(rows, places.gazetteer(spark)).collect()}
    assert found == {("new york city, new york", "US"): 8.0, ("quebec city", "Canada"): 4.0, ("new delhi", "India"): 4.0}


def test_segments_have_the_fewest_words():
    words = frozenset({"new", "york", "newyork", "city", "san", "sanf", "francisco", "a"})
    assert places.segment("newyorkcity", words, 9) == "newyork city" and places.segment("sanfrancisco", words, 9) == "san francisco"
    assert places.segment("", words, 9) is None and places.segment("xyz", words, 9) is None and places.segment("a" * 2000, words, 9).count(" ") == 1999
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice(sorted(words)) for _ in range(rng.randint(1, 4)))

        def fewest(t):
            return 0 if not t else min((1 + fewest(t[len(w) :]) for w in words if t.startswith(w)), default=99)

        found = places.segment(text, words, 9)
        assert found.replace(" ", "") == text and len(found.split()) == fewest(text)


def test_glued_places(spark):
    cases = {"CAFremont, CA": "Fremont, CA", "TXBellevue, WA": "Bellevue, WA", "SanFranciscoCA": "San Francisco, CA", "saltlakecity": "Salt Lake City", "New York, NY": "New York, NY", "HillsboroOR": "Hillsboro, OR", "Qwertyville": "Qwertyville", "": "", None: None, "Remote": "Remote"}
    table = spark.createDataFrame([(i, c, "x") for i, c in enumerate(cases)], "id long, location string, _v string")
    assert [r.location for r in places.unglued(table.drop("_v"), "location").orderBy("id").collect()] == list(cases.values())
    names = [(i, c.title().replace(" ", "") + s) for i, (c, s) in enumerate(places.CITIES.items())]
    found = [r.location for r in places.unglued(spark.createDataFrame(names, "id long, location string"), "location").orderBy("id").collect()]
    assert found == [f"{c.title()}, {s}" for c, s in places.CITIES.items()]


def test_json_ld_of_any_shape(spark):
    job = {"@type": "JobPosting", "title": "T", "hiringOrganization": {"name": "C"}}
    shapes = [job, [job], {"@graph": [{"@type": "WebSite"}, job]}, {"@graph": [[{"x": 1}], {"mainEntity": job}]}, {"itemListElement": [{"item": job}]}, [{"@graph": {"@type": ["Thing", "JobPosting"], "title": "T", "hiringOrganization": "C"}}], {"@type": "Person", "name": "x"}, "text", 5, None, {"title": "T", "hiringOrganization": [{"parentOrganization": {"name": "C"}}]}]
    pages_ = [(i, f"<script id=a type='application/ld+json' class=x>\n{json.dumps(s)}\n</script>") for i, s in enumerate(shapes)] + [(90, "<script type='application/ld+json'>{bad</script>"), (91, None), (92, "")]
    table = spark.createDataFrame(pages_, "page_id long, html string").withColumn("url", F.lit(None).cast("string"))
    found = {}
    for r in pages.votes(table).where("field IN ('title', 'company')").collect():
        found.setdefault(r.page_id, {})[r.field] = r.value
    assert {i: v for i, v in found.items() if v == {"title": "T", "company": "C"}}.keys() == {0, 1, 2, 3, 4, 5, 10} and len(found) == 7


def test_selectors_on_one_stream(spark):
    html = """<!-- <h1>no</h1> --><html lang=en-GB><head><title>A &gt; B</title><meta content="Co" property="og:site_name"><script>var x = "<h1>bad</h1>";</script></head>
      <body data-job-id='77'><h1 class="big  Title"><span>Data</span> <b>Engineer</b></h1><div id=job-location data-x="a>b">Here <i>and</i> there</div><p class="company-name-x">no</p><p CLASS="x Company-Name">Yes</p><br></body></html>"""
    table = spark.createDataFrame([(html,), (None,)], "html string")
    wanted = {"title": "A &gt; B", "meta[property=og:site_name]@content": "Co", "h1": "Data Engineer", ".title": "Data Engineer", "#job-location": "Here and there", "[data-job-id]@data-job-id": "77", ".company-name": "Yes", "html@lang": "en-GB", "p[class*=name-x]": "no", "em": None, "div[data-x=a>b]": "Here and there"}
    row = table.select(pages.tag_stream(F.col("html")).alias("s")).select(*[pages.selected(F.col("s"), pages.selector(k)).alias(f"c{i}") for i, k in enumerate(wanted)]).collect()
    assert list(row[0]) == list(wanted.values()) and list(row[1]) == [None] * len(wanted)
    assert pages.selector("a.b[c=d][e]@f") == pages.Selector("a", (("class", "~", "b"), ("c", "=", "d"), ("e", "", "")), "f")


def test_votes_read_each_page_once_and_in_many_tasks(spark, small):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in ("p54_json_ld", "p54_sample_votes"):
        df = QUERIES[name](spark, small)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("parseJson") == 1 and plan.count("regexp_extract_all") == 6 and plan.count("Exchange ") == 1
        assert parts > 1 and df.rdd.getNumPartitions() == parts


def test_tags_of_odd_pages(spark):
    cases = {
        "</p class=company><p class='x  COMPANY'>a > b</p>": {".company": "b"}, "<i class=a class=company>x</i>": {".company": None, ".a": "x"}, "<b data-company=x=y></b><b data-company='z'>": {"[data-company]@data-company": "x=y"},
        "<meta name='job-id' content=''><meta name=job-id content=' 7\"7 '>": {"meta[name=job-id]@content": '7"7'}, "<p id = Job-Location>one<p>two": {"#job-location": "one"}, "<h1>a<h1>b</h1>c</h1>": {"h1": "ab"}, "<a=\"b\" c=d>": {"[c=d]@a": "b"}, "<h1": {"h1": None}, "< H1 >x": {"h1": "x"}, "<div class=''>x</div>": {"div[class]": "x", ".x": None},
        "<p " + "long " * 20000 + "class=company>x</p>": {".company": "x"},
    }
    wanted = sorted({k for c in cases.values() for k in c})
    table = spark.createDataFrame(list(enumerate(cases)), "page_id long, html string")
    rows = table.select("page_id", pages.tag_stream(F.col("html")).alias("s")).select("page_id", *[pages.selected(F.col("s"), pages.selector(k)).alias(k) for k in wanted]).collect()
    assert {r.page_id: {k: r[k] for k in c} for r, c in ((r, list(cases.values())[r.page_id]) for r in rows)} == dict(enumerate(cases.values()))


def test_page_titles_equal_their_sql_on_odd_texts(spark):
    titles = ["cut&amp", "a&amp;b&amp", "&amp;lt;&lt;&LT;&#39;&quot;&gt", "&eacute;&copy;&nbsp;x", "\u00e9t\u00e9 \u0301e\u0308 \u0903\u20dd", "\ud55c\uad6d \u2126", "a \u2013 b \u2014\u2600\U0001f600", "\u00a0\u2003 a\x0bb\x1cc \t\n d\u3000", "a\u00a0 \r\n\u00a0b\x0b", "", " ", "<b>x</b>"]
    pages_ = [(i, f"<TITLE>{t}</Title><title>no</title>") for i, t in enumerate(titles)] + [(90, None), (91, "none"), (92, "<title>open"), (93, "<title>two\nlines</title>")]
    ours = {r.page_id: r.title for r in spark.createDataFrame(pages_, "page_id long, html string").select("page_id", feeds.page_title(F.col("html")).alias("title")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", pages_)
    assert ours == dict(con.execute(ORACLES["p40_plain_text"]).fetchall()) and ours[0] == "cut&amp"
    row = spark.createDataFrame([("caf\u00e9 &copy; a&amp b \u2013\u2003c \U0001f600",)], "t string").select(feeds.plain_text("t")).first()
    assert row[0] == "cafe a& b - c"


def test_chain_joins_only_rows_that_are_alive(spark):
    good = ("https://boards.greenhouse.io/a/jobs/123456", "Beta", "Software Engineer Intern", "Internship", "Boston, MA", "JR-1", "Remote", "Yes", "valid", 1)
    edit = lambda **kw: tuple(kw.get(k, v) for k, v in zip(names, good, strict=True))
    names = ("url", "company", "title", "job_type", "location", "job_id", "remote", "sponsorship", "outcome", "age")
    cases = [
        ("blacklist", 1, edit(company="Acme Labs", title="Summer 2027 Intern")), ("blacklist", 1, edit(title="Bad Word Intern")), ("term", 1, edit(title="Summer 2027 Intern", age=None)), ("age", 1, edit(age=9)), ("age", 1, edit(age=None)), ("title:too_short", 2, edit(title="SWE")), ("duplicate_url", 3, edit(url="https://boards.greenhouse.io/k/jobs/999999?a=1")),
        ("duplicate_key", 3, edit(company="Known Inc", title="Known Role (US)")), ("gate:too_senior", 4, edit(title="Senior Software Engineer")), ("tech", 4, edit(title="Garden Helper Person")), ("address", 4, edit(url="ftp://x")), ("location", 4, edit(location="Munich, Germany")), ("page:citizenship", 5, edit(title="Software Engineer A")), ("page_age", 5, edit(title="Software Engineer B")),
        ("low_pay", 5, edit(title="Software Engineer C")), ("experience", 5, edit(title="Software Engineer D")), ("quality", 5, edit(company="Unknown", location="Remote", job_id="N/A", remote="Unknown", sponsorship="Unknown", title="Software Engineer E", url="https://c.com/jobs/1")), (None, 5, good), (None, 5, edit(title="Software Engineer F")),
    ]
    rows = spark.createDataFrame([(i, *c[2]) for i, c in enumerate(cases)], "id long, url string, company string, title string, job_type string, location string, job_id string, remote string, sponsorship string, outcome string, age int")
    bodies = {"Software Engineer A": ("Must be a U.S. citizen.", 1), "Software Engineer B": ("ok", 9), "Software Engineer C": ("$18 per hour", None), "Software Engineer D": ("5+ years of work", 2)}
    pages_ = spark.createDataFrame([(i, *bodies.get(c[2][2], ("fine", None))) for i, c in enumerate(cases)], "id long, body string, page_age int")
    known = spark.createDataFrame([("url", "https://boards.greenhouse.io/k/jobs/999999"), ("key", "known|knownrole")], "kind string, key string")
    one = lambda v, name: spark.createDataFrame([(v,)], f"{name} string")
    found = {r.id: (r.first_fail, r.lookups) for r in chain.full_chain(rows, one("Acme", "name"), one("bad word", "term"), known, pages_).collect()}
    assert [found[i] for i in range(len(cases))] == [c[:2] for c in cases]
    assert chain.full_chain(rows.limit(0), one("Acme", "name"), one("bad word", "term"), known, pages_).count() == 0


def test_company_rules_reach_both_ways(spark):
    companies = spark.createDataFrame([("Acme Robotics",), ("Acm",), ("Acme",), ("Zeta Inc",), (None,), ("Zetaphone",)], "company string")
    rules = spark.createDataFrame([("Acme Robotics West",), ("Zeta",), ("Ac",), (None,)], "name string")
    assert {r.company: r.listed for r in chain.company_rules(companies, rules).collect()} == {"Acme Robotics": True, "Acm": False, "Acme": True, "Zeta Inc": True, None: False, "Zetaphone": True}


def test_merging_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, f"c{i}", "x", f"p{i % 4}") for i in range(12)], "id long, company string, location string, part string").write.partitionBy("part").parquet(path)
    files = lambda: sorted(str(f.relative_to(path)) for f in (tmp_path / "t").rglob("*.parquet"))
    before = files()
    edits = [(0, "b", "fix", "company", "Late"), (0, "a", "fix", "company", "New"), (0, "a", "fix", "location", "x"), (1, "a", "delete", "", None), (1, "a", "fix", "company", "y"), (3, "a", "delete", "", None), (7, "a", "delete", "", None), (11, "a", "delete", "", None), (99, "a", "delete", "", None), (2, "a", "flag", "", None)]
    table = spark.createDataFrame(edits, "id long, check string, action string, column string, value string")
    assert changes.merge(spark, path, ("part",), table) == 3
    after = files()
    assert [f for f in after if f in before and "part=p2" in f] == [f for f in before if "part=p2" in f] and not any("part=p3" in f for f in after)
    rows = {r.id: (r.company, r.location) for r in spark.read.parquet(path).collect()}
    assert rows[0] == ("New", "x") and set(rows) == {0, 2, 4, 5, 6, 8, 9, 10}
    assert changes.merge(spark, path, ("part",), table) == 0 and files() == after


def test_shifted_rows(spark):
    titles = ["a", "a", "a", "b", "b", "", "", "", "c", "c", "c", "c", None, None, None]
    table = spark.createDataFrame([(i * 3, t) for i, t in enumerate(titles)], "id long, title string")
    assert sorted(r.id // 3 for r in changes.shifted(table).collect()) == [1, 2, 9, 10, 11]


def test_confidences_after_two_runs(spark, tmp_path):
    folder = str(tmp_path / "versions")
    run = lambda rows: spark.createDataFrame(rows, "pattern string, at string, id long, ok boolean")
    first, second = [("uuid", "1", 1, True), ("uuid", "1", 2, False), ("new", "1", 3, True)], [("uuid", "2", 4, True)]
    assert learned.latest(spark, folder).count() == len(learned.PATTERNS)
    assert [learned.learn(spark, folder, "r1", run(first)), learned.learn(spark, folder, "r2", run(second)), learned.learn(spark, folder, "r1", run(second))] == [1, 2, 1]
    found = {r.pattern: (r.confidence, r.tries) for r in learned.latest(spark, folder).collect()}
    uuid = ((0.85 * 0.95 + 0.05) * 0.95) * 0.95 + 0.05
    assert found["uuid"] == (pytest.approx(uuid), 3) and found["new"] == (pytest.approx(0.05), 1) and found["query_id"] == (0.95, 0)
    rows = spark.createDataFrame([(1, "https://a/jobs/12345"), (2, "https://a/x"), (3, None)], "id long, url string")
    low = spark.createDataFrame([("jobs_path", 0.2, 1), ("number", 0.7, 1)], "pattern string, confidence double, tries long")
    assert [tuple(r) for r in learned.votes(rows, low).orderBy("id").collect()] == [(1, "number", "12345", 0.7), (2, None, None, None), (3, None, None, None)]


def test_pages_judged_by_section(spark):
    from postmill.sources import tables

    rows = spark.createDataFrame([(i, p.replace("{filler}", "<p>" + "words " * 120 + "</p>")) for i, p in enumerate(tables.SAMPLE_PAGES)], "id long, html string")
    assert tuple(r.r for r in rows.select("id", gates.page_reason(F.col("html")).alias("r")).orderBy("id").collect()) == restrictions.PAGE_VERDICTS
