"""Golden cases of columns, gates, layers, feeds, sinks and streams."""

import datetime

import pytest
from pyspark.sql import functions as F

from postmill.functions import columns as C
from postmill.operators import checks, dedup, enrich, gates, layers, monitor, sinks
from postmill.plans import marts, reports
from postmill.sources import feeds, tables
from postmill.streaming import streams


def values(spark, cases, make, kind="string"):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string")
    return [r[0] for r in rows.select(make(F.col("x")).alias("y"), "i").orderBy("i").collect()]


def test_company_key(spark):
    cases = {"Acme Group, Inc.": "acme", "Inc": "", "The Group, Inc.": "", "A & B Labs": "a b", "  Foo  Bar LLC": "foo bar", None: "", "N/A": "n a", "Incas": "incas"}
    assert values(spark, cases, C.company_key) == list(cases.values())


def test_iso_week(spark):
    cases = {"run_20251229_120000": "2026-W01", "run_20240101_0": "2024-W01", "run_2024": "unknown", None: "unknown", "x": "unknown"}
    assert [v or "unknown" for v in values(spark, cases, C.iso_week)] == list(cases.values())


def test_week_start_and_entry_date(spark):
    assert values(spark, ["2026-W01"], C.week_start) == [datetime.date(2025, 12, 29)]
    as_of = F.lit("2024-03-10").cast("date")
    cases = {"Mar 9": datetime.date(2024, 3, 9), "Mar 11": datetime.date(2023, 3, 11), "2024-01-02": datetime.date(2024, 1, 2), "Rescued Feb 29": datetime.date(2024, 2, 29), "": None, "soon": None}
    assert values(spark, cases, lambda c: C.entry_date(c, as_of)) == list(cases.values())


def test_ages(spark):
    as_of = F.lit("2024-08-25").cast("date")
    cases = {"3d": 3, "20h": 0, "2w": 14, "1mo": 30, "Aug 21": 4, "Sep 1": 359, "2024-08-20": 5, "x": None}
    assert values(spark, cases, lambda c: C.feed_age(c, as_of)) == list(cases.values())
    assert values(spark, ["Posted 3 Days Ago", "Posted Today", "30+ days ago", "?"], C.age_from_text) == [3, 0, 30, None]


def test_urls(spark):
    cases = {"https://www.A.com/x/?q=1#f": "https://a.com/x", "http://b.com///": "http://b.com", None: ""}
    assert values(spark, cases, C.canonical_url) == list(cases.values())
    assert values(spark, ["https://boards.greenhouse.io/a/jobs/123456", "https://x.com/careers"], C.is_identifying_url) == [True, False]
    assert values(spark, ["JR-0012", "000", "AB12"], C.normal_job_id) == ["jr0012", "000", "ab12"]


def test_discriminator(spark):
    pairs = [("SWE I", "SWE II", True), ("DeFi Algorithmic Trader", "Algorithmic Trader", True), ("Cloud Intern - Data", "Data Cloud Intern", False), ("Software Engineer", "Software Engineer", False)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(pairs)], "i int, a string, b string")
    assert [r[0] for r in rows.orderBy("i").select(dedup.differs(F.col("a"), F.col("b"))).collect()] == [p[2] for p in pairs]


def test_title_gates(spark):
    cases = {"Summer 2027 Software Intern": "wrong_term", "Spring 2027 Summer 2027 Intern": None, "Sales Representative": "business_role", "Software Engineer III": "too_senior", "Senior New Grad Engineer": None, "Registered Nurse": "non_tech", "Hardware Engineer": "hardware_role", "Data Analyst": None}
    assert values(spark, cases, gates.title_reason) == list(cases.values())


@pytest.mark.parametrize("word", ["sales representative", "mechanical engineer", "nurse"])
def test_gate_property(spark, word):
    seeds = [f"{a} {word} {b}" for a in ("", "Junior", "Remote") for b in ("", "- Boston", "II")]
    assert all(values(spark, [s.title() for s in seeds], gates.title_reason))


def test_pay_and_pages(spark):
    assert values(spark, ["Pay: $18/hr", "$20 - $35 per hour", "no pay"], gates.pay_reason) == ["low_pay", None, None]
    assert values(spark, ["<p>Must be a U.S. citizen</p>", "<p>class of 2029</p>", "<p>class of 2029 or 2027</p>", "<p>ok</p>"], gates.page_reason) == ["citizenship", "graduation_year", None, None]


def test_weekly_backfill_keeps_other_weeks(spark, small, tmp_path):
    rows = layers.quarantine(layers.bronze(tables.jobs(spark, small)))
    weeks = [r[0] for r in rows.select("p_week").distinct().orderBy("p_week").limit(2).collect()]
    path = str(tmp_path / "quarantine")
    n = [layers.write_layer(rows.where(F.col("p_week") == w), path, "quarantine_reason", "p_week") for w in weeks]
    assert layers.read_layer(spark, path).count() == sum(n) > 0
    assert layers.write_layer(rows.limit(0), path, "p_week") == 0


def test_silver_gate_and_schema(spark, small):
    rows = layers.bronze(tables.jobs(spark, small))
    with pytest.raises(checks.GateError):
        checks.silver_gate(rows, 0.99)
    with pytest.raises(checks.GateError):
        checks.silver_gate(rows.limit(0))
    with pytest.raises(ValueError):
        layers.conformed(rows, tables.employers(spark, small).schema)
    assert checks.silver_gate(rows, 0.01) > 0.01


def test_week_gate_passes_stops_and_skips(spark):
    row = lambda i, week, title: (i, "https://a.com/1", "Acme", title, "s", week)
    rows = spark.createDataFrame([row(i, "2024-W01", f"t{i}") for i in range(5)] + [row(i, "2024-W02", "same") for i in range(10, 16)] + [row(i, "2024-W03", "same") for i in range(20, 25)], "id long, url string, company string, title string, source string, p_week string")
    weeks = spark.createDataFrame([(f"2024-W0{i}",) for i in range(1, 6)], "p_week string")
    found = {r.p_week[-1]: r.verdict for r in checks.week_gate(rows, rows.where("id <> 4"), weeks).collect()}
    assert found == {"1": "lost", "2": "stop", "3": "pass", "4": "skip", "5": "skip"}
    with pytest.raises(checks.GateError, match="W02 stop"):
        checks.require_weeks(checks.week_gate(rows, rows, weeks))
    assert checks.require_weeks(checks.week_gate(rows.where("p_week <> '2024-W02'"), rows.where("p_week <> '2024-W02'"), weeks)) == ["2024-W01", "2024-W03"]
    with pytest.raises(checks.GateError, match="empty"):
        checks.week_gate(rows.limit(0), rows, weeks)


def test_display_name_variants(spark, small):
    jobs = marts.stage(spark, small)[0]
    assert marts.dim_company(jobs).count() == marts.dim_company(jobs, longest_name=True).count()


def test_latency_element(spark):
    rows = spark.createDataFrame([(float(i), "2024-01-01") for i in (1, 2, 3, 4)], "processing_time_ms double, processed_at string")
    assert reports.latency(rows, "2024-01-02").first()["p50"] == 3.0
    assert reports.latency(rows.limit(0), "2024-01-02").first()["count"] == 0


def test_outages_need_dense_days(spark):
    rows = spark.createDataFrame([("a", f"2024-01-{d:02d}", "valid") for d in range(1, 8) for _ in range(3)], "source string, processed_at string, outcome string")
    found = monitor.alerts(monitor.source_stats(monitor.daily_rates(rows, "2024-01-10", densify=True))).collect()
    assert [(r.source, r.alert_type) for r in found] == [("a", "outage")]


RESTRICTED = {
    "Now pursuing a bachelor's degree in computing": "undergraduate_only", "You are a rising senior at a college": "undergraduate_only", "advancing to their junior year": "undergraduate_only", "Needs sophomore standing": "undergraduate_only",
    "Pursuing a BS/MS in computing": None, "Pursuing a bachelor's or master's degree": None, "currently pursuing a PhD in statistics": "phd_only", "PhD internship": "phd_only", "pursuing a degree in computing": None, "Join as an intern!": None,
    "PhD students only. " + "x " * 400 + "master": "phd_only", "master " + "x " * 100 + " PhD students only": None, "No CPT here." + " y" * 200 + " We support OPT": "cpt_opt", "No CPT. We support OPT": None,
    "degree in finance " + "z " * 150 + "computer science": "non_cs_degree", "degree in finance or computer science": None, "US persons only": "us_person", "US persons only, export compliance": None, "graduating in 2028 or 2029": "graduation_year",
    "graduating between 2026 and 2028": None, "graduate in 2028 or later": None, "enrolled at a university in Texas": "geography", "enrolled at a university in Texas or anywhere in the United States": None, None: None, "": None,
}


def test_restrictions_look_around_each_hit(spark):
    assert dict(zip(RESTRICTED, values(spark, list(RESTRICTED), gates.restriction), strict=True)) == RESTRICTED


def test_golden_pages(spark):
    """Pages that offers for bachelor or doctoral students only must fail, and that offers open to master students must pass."""
    undergraduate = ["Currently pursuing a bachelor's degree in Computer Science", "Must be a rising junior or senior in an accredited university", "Must be at least advancing to their junior year of study", "Requires sophomore standing or higher", "This is a Summer 2027 internship program"]
    doctoral = ["must be currently pursuing a phd in computer science", "PhD Internship - Machine Learning Research", "Requires a Ph.D. in a related field", "PhD candidates only"]
    free = ["Pursuing a BS/MS in Computer Engineering, Computer Science", "Currently pursuing a bachelor's or master's degree in CS", "Currently pursuing a degree in Computer Science or related field", "Join our team as a software engineering intern!", "Pursuing a BS, MS or PhD in computing"]
    pages = [f"<html><body><p>{t}</p></body></html>" for t in (*undergraduate, *doctoral, *free)]
    assert values(spark, pages, gates.page_reason) == ["undergraduate_only"] * len(undergraduate) + ["phd_only"] * len(doctoral) + [None] * len(free)


def test_automaton_equals_search_for_each_form():
    import random
    import re

    from postmill.operators import phrases, restrictions

    rng, rules = random.Random(5), restrictions.RULES
    vocabulary = sorted({w for rule in rules for p in (*rule.phrases, *rule.rescue) for part in p.split(" ... ") for form in phrases.plain_forms(part)[:3] for w in form.replace("*", "s").split()}) + ["|", "."] * 40
    matcher, flat = phrases.Matcher(rules), [(r, role, p, part) for r, role, p, phrase in phrases._phrases(rules) if " ... " not in phrase for part in [phrase]]
    for _ in range(60):
        text = " " + " ".join(rng.choice(vocabulary) for _ in range(200)) + " "
        found = {(h.rule, h.start, h.end) for h in matcher.hits(text) if not rules[h.rule].fields and not rules[h.rule].outside}
        for r, role, _, part in flat:
            if role == "phrase" and not rules[r].fields and not rules[r].outside:
                for form in phrases.plain_forms(part):
                    pattern = rf"(?<= )(?={re.escape(form[:-1]) + '[^ ]*' if form.endswith('*') else re.escape(form)} )"
                    for m in re.finditer(pattern, text):
                        end = text.index(" ", m.start() + len(form) - form.endswith("*"))
                        assert (r, m.start(), end) in found


def test_hits_cost_a_linear_time():
    import time

    from postmill.operators import phrases, restrictions

    matcher, took = phrases.Matcher(restrictions.RULES), []
    for n in (2_000, 8_000):
        text = " " + "rising senior and no cpt with phd students here " * n
        began = time.process_time()
        assert len(matcher.hits(text)) >= 3 * n
        took.append(time.process_time() - began)
    assert took[1] < 12 * took[0]


def test_sections_and_captures():
    from postmill.operators import phrases

    text = " first §h about us §e we are §h minimum qualifications §e python §h nice to have §e go §h odd §e x "
    assert [(s.kind, text[s.start : s.end].split()[-1]) for s in phrases.sections(text)] == [("top", "first"), ("about", "are"), ("requirements", "python"), ("preferred", "go"), ("other", "x")]
    rule = (phrases.Rule("field", ("preferred majors",), ("cs",), fields=("law", "art")),)
    reason = phrases.Matcher(rule).reason
    assert [reason(f" {t} ") for t in ("preferred majors law . cs", "preferred majors law cs", "preferred majors . law", "preferred majors art | cs", "majors law")] == ["field", None, None, "field", None]
    assert phrases.plain_forms("a|b [x|y] c") == ["a x c", "a y c", "a c", "b x c", "b y c", "b c"]


def test_title_gates_and_age(spark):
    cases = {"Co - Op, Fall 2027": "wrong_term", "Spring 2027 Summer Analyst": None, "2027 (Summer) Intern": "wrong_term", "Mechanical Engineer": "hardware_role", "Electrical Software Engineer": None, "Photonics Data Engineer Intern": None, "Nuclear AI Intern": "hardware_role", "Summer IT AI Intern": "wrong_term", "NVIDIA 2027 Fall Internships": "wrong_term", "Fall 28 Coop": "wrong_term", "Software Engineer, Summer 2027 start": None, "January 2027 Summer Intern": None, "Front-End Recruiter": None, "Summer | one two | Intern": None, "Talent Acquisition AI Intern": None}
    assert values(spark, list(cases), gates.title_reason) == list(cases.values())
    ages = spark.createDataFrame([(0, None), (1, 3), (2, 4)], "i int, age int").orderBy("i").select(gates.too_old(F.col("age")), gates.too_old(F.col("age"), keep_undated=True)).collect()
    assert [tuple(r) for r in ages] == [(True, False), (False, False), (True, True)]


def test_company_similarity(spark):
    import difflib

    from postmill.functions import names

    pairs = [("Acme, Inc.", "acmeinc"), ("Acme Robotics", "acme"), ("Blue River", "bluriver"), ("", "x"), (None, "x"), ("Zeta", "omega")]
    found = [r[0] for r in spark.createDataFrame(pairs, "a string, b string").select(names.similarity("a", "b")).collect()]
    assert found[:2] == [1.0, 0.9] and found[3:5] == [0.0, 0.0]
    assert found[2] == pytest.approx(difflib.SequenceMatcher(None, "blueriver", "bluriver", autojunk=False).ratio()) and found[5] < 0.5


def test_numbers_without_one_task(spark):
    from postmill.operators import lineage

    rows = spark.range(500).select("id", F.pmod(F.xxhash64("id"), F.lit(97)).alias("x"), F.when(F.col("id") % 3 > 0, "a").alias("s"))
    found = lineage.ranked(rows, "n", F.col("x"), F.col("id"), by=("s",)).collect()
    for s in ("a", None):
        part = sorted((r for r in found if r.s == s), key=lambda r: (r.x, r.id))
        assert [r.n for r in part] == list(range(1, len(part) + 1))


def test_alert_cards_of_awkward_mails(spark):
    mails = [(1, "<a href='https://www.linkedin.com/jobs/view/7?x=1'>Title <b>A</b></a><p>Co · Boston, MA</p><p>more</p>"), (2, "<a href='https://www.linkedin.com/jobs/view/7'>again</a>"), (3, None), (4, "<a href='https://x.com/jobs/view/7'>no</a>"), (5, "<a href='https://jobright.ai/jobs/info/ab'></a>")]
    found = {r.url: tuple(r)[1:] for r in feeds.alert_cards(spark.createDataFrame(mails, "mail_id long, html string")).collect()}
    assert found == {"https://www.linkedin.com/jobs/view/7": ("Co", "TitleA", "Boston, MA", "7", "LinkedIn"), "https://jobright.ai/jobs/info/ab": ("Unknown", "Unknown", "Unknown", "ab", "Jobright")}


def test_throttle(spark):
    t = datetime.datetime(2024, 1, 1)
    rows = spark.createDataFrame([("m", t + datetime.timedelta(hours=h), k) for h, k in ((0, "ok"), (1, "down"), (2, "down"), (8, "down"), (9, "ok"))], "module string, ts timestamp, kind string")
    assert [r.sent for r in monitor.throttle(rows).orderBy("ts").collect()] == [False, True, False, True, True]


def test_duplicate_groups_chain(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "a long, b long")
    assert {(r.id, r.group) for r in dedup.duplicate_groups(pairs).collect()} == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7)}


def test_boards(spark):
    body = '{"content": [{"id": "1", "name": "Dev", "location": {"city": "Austin", "region": "TX", "country": "us"}}, {"id": "2", "name": "dev ", "location": {"country": "us"}}, {"id": "3", "name": "Dev", "location": {"country": "de"}}]}'
    rows = feeds.board_postings(spark.createDataFrame([("acme", body), ("bad", "{")], "company string, body string"), "smartrecruiters", "2024-01-01").collect()
    assert [(r.title, r.location, r.job_id) for r in rows] == [("Dev", "Austin, TX", "1")]
    muse = '{"results": [{"id": 5, "name": "Dev", "locations": [{"name": " "}, {"name": "Oslo"}], "refs": {"landing_page": "http://x"}, "publication_date": "2023-12-31T00:00:00Z"}]}'
    row = feeds.board_postings(spark.createDataFrame([("acme", muse)], "company string, body string"), "themuse", "2024-01-01").first()
    assert (row.location, row.job_id, row.age) == ("Oslo", "5", 1)
    good, bad = feeds.json_lines(spark.createDataFrame([('{"company":"a","title":"b","url":"http://c","source":"d"}',), ("{",), ('{"company":"a"}',)], "value string"))
    assert (good.count(), bad.count()) == (1, 2)


def test_employer_export(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_bytes("Fiscal Year\tEmployer (Petitioner) Name\tInitial Approval\tContinuing Approval\n2024\tACME LLC\t1,000\t5\n".encode("utf-16"))
    assert feeds.employer_export(spark, str(path)).first().approvals == 1005


def test_sinks(spark, tmp_path):
    old, new = (spark.createDataFrame(r, "k string, v long") for r in ([("a", 1), ("b", 2)], [("b", 3), ("c", 4)]))
    assert {(r.k, r.v) for r in sinks.upsert(old, new, "k").collect()} == {("a", 1), ("b", 3), ("c", 4)}
    path = str(tmp_path / "history")
    for night, rows in (("2024-01-01", old), ("2024-01-02", new), ("2024-01-02", new)):
        sinks.write_history(rows, path, night)
    assert spark.read.parquet(path).count() == 4
    sinks.write_snapshot(old, str(tmp_path / "snapshot"))
    assert sinks.read_corrections(spark.createDataFrame([('{"company":"a"}',), ("oops",)], "value string")).count() == 1


def test_lookup_needs_second_word(spark):
    employers = spark.createDataFrame([("ADVANCED TECHNOLOGY LABORATORIES", 5), ("META PLATFORMS INC", 9)], "name string, approvals long")
    rows = spark.createDataFrame([("Advanced Space",), ("Meta",), ("",)], "company string")
    found = {r.company: (r.verdict, r.approvals) for r in enrich.approvals_lookup(rows, enrich.employer_approvals(employers)).collect()}
    assert found == {"Advanced Space": ("Unknown", 0), "Meta": ("Yes", 9), "": ("Unknown", 0)}


def test_streams_equal_their_batches(spark, small, tmp_path):
    folder = str(tmp_path / "in")
    events = tables.table(spark, small, "events")
    events.repartition(3).write.parquet(folder)
    batch = events.withColumn("ts", F.col("ts").cast("timestamp"))

    def run(df, mode, name):
        q = df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name)

    source = streams.stream(spark, folder, events.schema)
    assert run(streams.first_seen(source, "user_id"), "append", "x2").count() == events.select("user_id").distinct().count()
    for name, make in (("x3", streams.weekly), ("x4", streams.daily)):
        found = run(make(source), "update", name)
        keys = found.columns[:2]
        last = found.groupBy(*keys).agg(*[F.max(c).alias(c) for c in found.columns[2:]])
        assert sorted(map(tuple, last.collect())) == sorted(map(tuple, make(batch).collect()))
    assert run(streams.last_runs(source), "update", "x5").groupBy("event_type").agg(F.max("n").alias("n")).where("n = 30").count() == events.select("event_type").distinct().count()
    q = streams.land(source, str(tmp_path / "bronze"), str(tmp_path / "x1"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == events.count()


def test_nearest_name_with_any_edit(spark):
    known = ["Acme 5", "Globex", "Initech Labs", "ab", "x"]
    names = ["Xcme 5", "cme 5", "AAcme 5", "acme 5", "Qlobexx", "obex", "itech Labs", "Initech Lab", "ba", "", "nothing"]
    found = {r.name: r.distance for r in enrich.nearest_name(spark.createDataFrame([(x,) for x in names], "name string"), spark.createDataFrame([(x,) for x in known], "name string")).collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    least = {a: min(distance(a.lower(), b.lower()) for b in known) for a in names}
    assert found == {a: d for a, d in least.items() if d <= 2}


def test_duplicate_groups_of_a_long_chain(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(120)] + [(200, 201)], "a long, b long")
    assert {(r.id, r.group) for r in dedup.duplicate_groups(pairs).collect()} == {(i, 0) for i in range(121)} | {(200, 200), (201, 200)}


def brute_registry(rows, days):
    """Rows (key, day, id) that are taken in, one after another by day and id."""
    last, taken = {}, []
    for key, day, i in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: (r[1], r[2])):
        if key not in last or day > last[key] + days:
            last[key] = day
            taken.append(i)
    return taken


def test_registry_equals_brute_force(spark):
    import random

    from postmill.operators import seen

    rng, base = random.Random(4), datetime.date(2024, 1, 1)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(500)]), i) for i in range(400)] + [("hot", d % 300, 1000 + d) for d in range(900)] + [("edge", 0, 5000), ("edge", 90, 5001), ("edge", 91, 5002)]
    table = spark.createDataFrame([(k, None if d is None else base + datetime.timedelta(days=d), i) for k, d, i in rows], "key string, day date, id long")
    found = {r.id: r for r in seen.known(table).collect()}
    taken = set(brute_registry(rows, 90))
    assert {i for i, r in found.items() if not r.known} == taken | {i for k, d, i in rows if k is None or d is None}
    assert found[5001].seen_at == base and not found[5002].known and found[5002].seen_at is None
    assert seen.known(table.limit(0)).count() == 0


def test_registry_stream_expires_and_takes_late_rows(spark, tmp_path):
    import time

    from postmill.operators import seen

    base = datetime.datetime(2024, 1, 1)
    batches = [[("a", 0, 1), ("a", 0, 2), ("b", 5, 3)], [("a", 90, 4), ("a", 91, 5), ("b", 4, 6)], [("a", 90, 7), ("b", 96, 8), ("c", 180, 9)], [("a", 300, 10), ("b", 297, 11), ("b", 100, 12)]]
    for batch in batches:
        spark.createDataFrame([(k, base + datetime.timedelta(days=d), i) for k, d, i in batch], "key string, ts timestamp, id long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(1.1)  # files are taken in the order of their times
    before = spark.conf.get(seen.STORE[0], None)
    spark.conf.set(*seen.STORE)
    try:
        source = spark.readStream.schema("key string, ts timestamp, id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        seen.taken_in(source).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(seen.STORE[0]) if before is None else spark.conf.set(seen.STORE[0], before)
    # 6 and 7 are late but covered, 12 is beyond the watermark, and ids seen 91 days ago are free again
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 3, 5, 8, 9, 10, 11]


@pytest.mark.parametrize(("most", "guard", "earlier"), [(1000, False, False), (7, False, False), (7, True, True)])
def test_top_matches_equal_brute_force(spark, most, guard, earlier):
    import math
    import random
    from collections import Counter

    rng = random.Random(8)
    words = ["software", "engineer", "intern", "data", "cloud", "remote", "ii", "senior", "rare", "nlp"]
    titles = sorted({(c, " ".join(["rare", *rng.sample(words, rng.randint(1, 5))])) for c in "ab" for _ in range(60)})
    rows = [(i, c, t) for i, (c, t) in enumerate(titles)]
    table = spark.createDataFrame([*rows, (999, "c", "")], "id long, company string, title string")
    count = {i: Counter(t.split()) for i, _, t in rows}
    df = Counter(w for c in count.values() for w in c)
    vector = {i: {w: n / sum(c.values()) * (math.log((len(rows) + 2) / (df[w] + 1)) + 1) for w, n in c.items()} for i, c in count.items()}
    norm = {i: math.sqrt(sum(x * x for x in v.values())) for i, v in vector.items()}
    by_pair = {(r.a, r.b): r.d for r in table.selectExpr("id AS a", "title AS ta").crossJoin(table.selectExpr("id AS b", "title AS tb")).select("a", "b", dedup.differs(F.col("ta"), F.col("tb")).alias("d")).collect()}
    expected = set()
    for i, c, _ in rows:
        near = []
        for j, e, _ in rows:
            score = round(sum(x * vector[j].get(w, 0) for w, x in vector[i].items()) / norm[i] / norm[j], 6)
            if i != j and c == e and score >= 0.7 and not (guard and by_pair[i, j]) and not (earlier and j > i):
                near.append((-score, j))
        expected |= {(i, j, -s) for s, j in sorted(near)[:3]}
    found = {(r.a, r.b, r.score) for r in dedup.top_matches(table, 0.7, 3, guard, earlier, most).collect()}
    assert found == expected and len(found) > 50


def test_tiers_in_order(spark):
    rows = [
        (1, "https://boards.greenhouse.io/a/jobs/123456", "Acme Inc", "Data Engineer", "JR-7", "2024-01-01", "r1"), (2, None, "Acme", "Other Role", "JR 7", "2024-03-31", "r2"), (3, None, "Acme", "Third Role", "JR-7", "2024-04-01", "r3"),
        (4, None, "Elsewhere", "Fourth Role", "jr7", "2024-04-01", "r3"), (5, "https://boards.greenhouse.io/a/jobs/123456?x=1", "Zeta", "Fifth Role", "N/A", "2024-05-01", "r4"), (6, None, "Acme LLC", "Data Engineer (US)", "N/A", "2024-05-01", "r4"),
        (7, None, "Acme", "Data Engineer Role", "N/A", "2024-05-01", "r4"), (8, None, "Acme", "Data Engineer II", "N/A", "2024-05-01", "r4"), (9, None, None, None, None, None, None), (10, None, "", "Data Engineer", "N/A", "2024-05-01", "r4"),
    ]
    table = spark.createDataFrame(rows, "id long, url string, company string, title string, job_id string, processed_at string, run_id string")
    assert {r.id: r.tier for r in dedup.tiers(table, fuzzy=0.6).collect()} == {1: None, 2: "job_id", 3: None, 4: "run", 5: "url", 6: "key", 7: "fuzzy", 8: None, 9: None, 10: None}
    assert dedup.tiers(table.limit(0)).count() == 0
    assert [r.id for r in dedup.run_repeats(table.unionByName(table.where("id = 7").withColumn("id", F.lit(70)))).collect()] == [70]


def test_golden_titles(spark):
    technical = ["Software Engineering Intern", "Machine Learning Intern", "Data Science Intern", "AI Engineering Intern", "Full Stack Developer Intern", "Backend Engineer Intern", "Cloud Infrastructure Intern"]
    other = ["Accounting Intern", "Marketing Intern", "Supply Chain Analyst Intern", "Nursing Intern", "Legal Intern", "Social Media Intern"]
    assert values(spark, technical + other, gates.is_tech_role) == [True] * len(technical) + [False] * len(other)
    types = {"Software Engineer, Backend": "Full Time", "Software Engineer Intern, Robotics": "Internship", "Neuroengineer Intern": "Internship", "Software Engineer Intern, Co-op": "Co-op", "Machine Learning Intern/Co-op": "Co-op", "New Grad: Software Engineer": "Full Time", "Entry Level Software Engineer": "Full Time", "Software Engineer I": "Full Time", "Co-op Software Developer": "Co-op"}
    from postmill.functions import names

    assert values(spark, list(types), lambda c: names.job_type_of(c, F.lit("greenhouse_direct"))) == list(types.values())
    assert values(spark, ["Software Engineer Intern", "ML Co-op", "Senior Software Engineer"], lambda c: gates.is_internship(c, F.lit(""))) == [True, True, False]
    cleaned = {"Software Engineer Intern —": "Software Engineer Intern", "Research Intern- AI Ethics": "Research Intern - AI Ethics", "company.ai Software Engineer Intern": "Software Engineer Intern", "Unknown": "Unknown", "Apply Now": "", "404": "", "careers": "", "Home": "", "login": "", "Backend Engineer, Payments": "Backend Engineer, Payments", "Co-op Developer": "Co-op Developer"}
    assert values(spark, list(cleaned), names.clean_title) == list(cleaned.values())
