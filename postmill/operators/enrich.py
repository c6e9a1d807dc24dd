"""Employer lookups, blacklists, feature vectors, relevance and outreach tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.functions import columns as C
from postmill.operators.lineage import ranked
from postmill.plans import reports
from postmill.plans.registry import query, sql_company_key
from postmill.sources import tables

STRONG, MODERATE = 100, 20


def employer_approvals(rows: DataFrame) -> DataFrame:
    """Approvals per employer key, with the longest name."""
    return rows.groupBy(C.company_key(F.col("name")).alias("employer_key")).agg(F.sum("approvals").alias("approvals"), F.max_by("name", F.struct(F.length("name"), F.col("name"))).alias("name"))


def approvals_lookup(companies: DataFrame, employers: DataFrame) -> DataFrame:
    """Each company's verdict, approvals and employer name: the largest of the exact key and of employers whose first
    word is the company's (of four letters or more) and that hold its second word, if it has one. Never 'No'.

    Both ways are equi-joins of distinct companies: on the key, and on the first word.
    """
    names = companies.select("company").where(F.length(C.company_key(F.col("company"))) >= 3).distinct().withColumn("q", C.company_key(F.col("company"))).withColumn("words", F.split("q", " "))
    e = employers.withColumn("e_words", F.split("employer_key", " "))
    exact = names.join(e, F.col("q") == F.col("employer_key"))
    word = names.where(F.length(F.col("words")[0]) >= 4).join(e, F.col("words")[0] == F.col("e_words")[0]).where((F.size("words") < 2) | F.array_contains("e_words", F.try_element_at("words", F.lit(2))))
    hits = exact.unionByName(word).groupBy("company").agg(F.max_by(F.struct("approvals", "name"), F.struct("approvals", "name")).alias("hit"))
    return companies.join(hits, "company", "left").select(*companies.columns, F.when(F.col("hit").isNotNull(), "Yes").otherwise("Unknown").alias("verdict"), F.coalesce("hit.approvals", F.lit(0)).alias("approvals"), F.coalesce("hit.name", F.lit("")).alias("employer"))


def starts(c: str, least: int) -> Column:
    """The beginnings of a text, from so many letters to the whole."""
    return F.transform(F.sequence(F.lit(least), F.length(c)), lambda n: F.left(F.col(c), n))


def company_rules(companies: DataFrame, rules: DataFrame) -> DataFrame:
    """company, listed: whether a rule's key is the company's, or the start of it, or begins with it (four letters or more).

    Every start of a rule's key, and every start of a company's key, is a join key: one side's whole key meets the other's starts."""
    key = lambda c: C.squash(C.company_key(F.col(c)))
    names = companies.select("company").distinct().withColumn("_k", key("company"))
    long = names.where(F.length("_k") >= 4)
    r = rules.select(key("name").alias("_r")).where(F.length("_r") >= 4).distinct()
    longer = long.select("company", F.explode(starts("_k", 4)).alias("_x")).join(r, F.col("_x") == F.col("_r"), "left_semi").select("company")
    shorter = long.join(r.select(F.explode(starts("_r", 4)).alias("_x")).distinct(), F.col("_k") == F.col("_x"), "left_semi").select("company")
    hit = longer.union(shorter).distinct().select(F.col("company").alias("_c"), F.lit(True).alias("listed"))
    return names.join(hit, F.col("company").eqNullSafe(F.col("_c")), "left").select("company", F.coalesce("listed", F.lit(False)).alias("listed"))


def filings_lookup(companies: DataFrame, employers: DataFrame, block: int = 5) -> DataFrame:
    """Tier, filings and name by exact squashed key, else by a prefix either way (of five letters or more), the largest.

    Each side's starts of five letters and more are join keys against the other side's whole keys, so no common start is a hot block.
    """
    key = lambda c: C.squash(C.company_key(F.col(c)))
    names = companies.select("company").distinct().withColumn("q", key("company"))
    e = employers.select(key("name").alias("k"), F.col("name").alias("employer"), F.col("approvals").alias("filings")).where("k <> ''")
    exact = names.join(e, F.col("q") == F.col("k")).withColumn("rank", F.lit(1))
    long, known = names.where(F.length("q") >= block), e.where(F.length("k") >= block)
    longer = long.withColumn("x", F.explode(starts("q", block))).join(known, F.col("x") == F.col("k"))
    shorter = long.join(known.withColumn("x", F.explode(starts("k", block))), F.col("q") == F.col("x"))
    near = longer.unionByName(shorter).drop("x").withColumn("rank", F.lit(0))
    hits = exact.unionByName(near).groupBy("company").agg(F.max_by(F.struct("filings", "employer"), F.struct("rank", "filings", "employer")).alias("hit"))
    n = F.col("hit.filings")
    tier = F.when(n >= STRONG, 1).when(n >= MODERATE, 2).when(n.isNotNull(), 3).otherwise(4)
    return companies.join(hits, "company", "left").select(*companies.columns, tier.alias("tier"), F.coalesce(n, F.lit(0)).alias("filings"))


def blacklisted(jobs: DataFrame, rules: DataFrame) -> DataFrame:
    """Postings whose company key equals a rule, or starts with it, or is its start (four letters or more)."""
    listed = company_rules(jobs, rules).where("listed").select(F.col("company").alias("_c"))
    return jobs.join(listed, F.col("company").eqNullSafe(F.col("_c")), "left_semi")


def whole_word_terms(jobs: DataFrame, terms: DataFrame) -> DataFrame:
    """ids of titles that hold a blacklisted term as whole words: title words are joined to the terms' first words."""
    words = lambda c: F.trim(F.regexp_replace(F.lower(C.text(F.col(c))), "[^a-z0-9]+", " "))
    t = terms.select(words("term").alias("_t")).where("_t <> ''").distinct().withColumn("_w", F.split("_t", " ")[0])
    j = jobs.select("id", words("title").alias("_x"))
    return j.select("id", "_x", F.explode(F.array_distinct(F.split("_x", " "))).alias("_w")).join(t, "_w").where(F.concat(F.lit(" "), "_x", F.lit(" ")).contains(F.concat(F.lit(" "), F.col("_t"), F.lit(" ")))).select("id").distinct()


def mapped(rows: DataFrame, table: DataFrame, key: str, value: str) -> DataFrame:
    """A dictionary lookup that keeps what it doesn't know."""
    t = table.select(F.col("key").alias("_key"), F.col("value").alias("_value"))
    return rows.join(t, F.col(key) == F.col("_key"), "left").withColumn(value, F.coalesce("_value", F.col(key))).drop("_key", "_value")


def same_employer(a: Column, b: Column) -> Column:
    """One squashed name holds the other, or their first words are equal."""
    ka, kb = C.squash(C.company_key(a)), C.squash(C.company_key(b))
    first = lambda c: F.split(C.company_key(c), " ")[0]
    return (ka != "") & (kb != "") & (ka.contains(kb) | kb.contains(ka) | ((F.length(first(a)) >= 3) & (first(a) == first(b))))


def nearest_name(rows: DataFrame, names: DataFrame, most: int = 2) -> DataFrame:
    """The nearest known name within an edit distance.

    Exact candidates: of most + 1 pieces of a name, one stands unchanged in any name within the distance, shifted by at most
    that distance. Names meet on (length, number of the piece, piece), then are compared.
    """
    r, n = rows.select("name").distinct(), names.select(F.col("name").alias("known")).distinct()
    k = most + 1
    cut = lambda l, i: f"CAST(floor({i} * {l} / {k}) AS INT)"
    own = F.expr(f"transform(sequence(0, {most}), i -> struct(length(lower(name)) AS l, i AS i, substr(lower(name), {cut('length(lower(name))', 'i')} + 1, {cut('length(lower(name))', '(i + 1)')} - {cut('length(lower(name))', 'i')}) AS piece))")
    places = f"flatten(transform(sequence(greatest(0, length(lower(known)) - {most}), length(lower(known)) + {most}), l -> flatten(transform(sequence(0, {most}), i -> transform(sequence(-{most}, {most}), s -> struct(l AS l, i AS i, {cut('l', 'i')} + 1 + s AS at, {cut('l', '(i + 1)')} - {cut('l', 'i')} AS n))))))"
    theirs = F.expr(f"array_distinct(transform(filter({places}, p -> p.at >= 1), p -> struct(p.l AS l, p.i AS i, substr(lower(known), p.at, p.n) AS piece)))")
    pairs = r.select("name", F.explode(own).alias("p")).select("name", "p.*").join(n.select("known", F.explode(theirs).alias("p")).select("known", "p.*"), ["l", "i", "piece"]).select("name", "known").distinct()
    near = pairs.withColumn("distance", F.levenshtein(F.lower("name"), F.lower("known"), most)).where("distance >= 0")
    return near.groupBy("name").agg(F.min_by("known", F.struct("distance", "known")).alias("known"), F.min("distance").alias("distance"))


def reconciled(feed: Column, page: Column) -> tuple[Column, Column]:
    """The page's title where it adds words, else the feed's; and the words that only one of them has."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(C.text(c)), "[^a-z0-9]+"), lambda w: F.length(w) > 2))
    added, lost = F.array_except(words(page), words(feed)), F.array_except(words(feed), words(page))
    return F.when((F.size(added) > 0) & (F.size(lost) == 0), page).otherwise(feed), F.array_sort(F.array_union(added, lost))


def feature_vectors(jobs: DataFrame) -> DataFrame:
    """Per posting: company and source history, valid postings in its state, title marks (T15: plain substrings)."""
    valid = F.count_if(F.col("outcome") == "valid")
    n = F.count(F.lit(1))
    company = jobs.groupBy("company").agg(n.alias("company_times_seen"), C.valid_rate(valid, n).alias("company_valid_rate"))
    source = jobs.groupBy(F.col("source").alias("_s")).agg(C.valid_rate(valid, n).alias("source_valid_rate"))
    state = jobs.groupBy(F.col("location_state").alias("_st")).agg(valid.alias("location_job_density"))
    has = lambda *words: F.when(F.lower("title").rlike("|".join(words)), 1).otherwise(0)
    joined = jobs.join(company, "company", "left").join(source, F.col("source") == F.col("_s"), "left").join(state, F.col("location_state") == F.col("_st"), "left")
    return joined.select("id", "company_times_seen", "company_valid_rate", F.coalesce("source_valid_rate", F.lit(0.0)).alias("source_valid_rate"), "location_state", F.coalesce("location_job_density", F.lit(0)).alias("location_job_density"), F.length("title").alias("title_length"), has("ai", "ml", "machine learning", "data science").alias("has_ai_ml"), has("software", "sde", "backend", "frontend", "full stack").alias("has_sde"))


#: Our own small table of skills and weights
SKILLS = {"python": 5, "sql": 4, "spark": 4, "java": 3, "machine learning": 5, "data": 2, "software": 2, "analyst": 2, "engineer": 1, "cloud": 3}
RESUME = ("python", "sql", "spark", "machine learning", "data", "software")
TITLES = {"machine learning": 5, "data": 4, "software engineer": 4, "analyst": 3, "engineer": 2}


def relevance(title: Column, company: Column, description: Column, tiers: dict[str, int] | None = None) -> Column:
    """0-100 of skills (60), title (25) and company (15)."""
    body = F.lower(F.concat_ws(" ", title, description))
    asked = {s: body.rlike(rf"\b{s}\b") for s in SKILLS}
    weight = lambda names: sum((F.when(asked[s], SKILLS[s]).otherwise(0) for s in names), F.lit(0))
    n = sum((F.when(asked[s], 1).otherwise(0) for s in RESUME), F.lit(0))
    skill = F.when(n > 0, F.least(F.lit(60), F.floor(60 * (0.6 * weight(RESUME) / F.greatest(F.lit(1), weight(SKILLS)) + 0.4 * F.least(F.lit(1.0), n / 4))))).otherwise(0)
    named = F.least(F.lit(25), 5 * F.greatest(F.lit(0), *[F.when(F.lower(title).contains(k), v).otherwise(0) for k, v in TITLES.items()]))
    tier = F.coalesce(*[F.when(F.lower(company).contains(k), v) for k, v in (tiers or {"acme 1": 5, "acme": 2}).items()], F.lit(0))
    return F.least(F.lit(100), skill + named + F.least(F.lit(15), 3 * tier)).cast("int")


def title_preference(jobs: DataFrame, applied: DataFrame, top: int = 50) -> DataFrame:
    """Of each title, its overlap with the commonest words of applied titles, by five, at most 1."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: F.length(w) > 2))
    liked = applied.select(F.explode(words(F.col("title"))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n >= 3").orderBy(F.desc("n"), "w").limit(top).agg(F.collect_list("w").alias("liked"))
    return jobs.crossJoin(F.broadcast(liked)).select("id", F.round(F.least(F.lit(1.0), F.size(F.array_intersect(words(F.col("title")), "liked")) / 5), 4).alias("preference"))


def sponsorship(posting: Column, employer: Column, job_type: Column) -> Column:
    """The posting's word before the employer's record; unknown for internships."""
    said = F.when(posting.isin("Yes", "No"), posting)
    return F.when(job_type.isin("Internship", "Co-op"), "Unknown").otherwise(F.coalesce(said, F.when(employer == "Yes", "Yes"), F.lit("Unknown")))


def sponsorship_from_text(c: Column) -> Column:
    """What a page says about sponsorship."""
    t = F.lower(C.text(c))
    return F.when(t.rlike("(no|not|unable to|without) (offer |provide )?(visa )?sponsor"), "No").when(t.rlike("(will|can|offers?|provides?) (visa )?sponsor"), "Yes").otherwise("Unknown")


def auto_blacklist(jobs: DataFrame, existing: DataFrame, pattern: str, least: int = 3) -> DataFrame:
    """Company, reason and count of qualifying rejections, without companies on the list."""
    reason = F.substring(F.trim(F.split("rejection_reason", r"\(")[0]), 1, 60)
    rows = jobs.where((F.col("outcome") == "discarded") & (F.trim(C.text(F.col("company"))) != "") & F.col("rejection_reason").rlike(pattern))
    return rows.groupBy("company", reason.alias("reason")).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") >= least).join(existing.select("company"), "company", "left_anti")


def blacklist_review(jobs: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Companies with repeated rejections in the window: their count, commonest reason, and whether reasons are mixed."""
    rows = jobs.where((F.col("outcome") == "discarded") & (F.col("processed_at") >= reports.since(as_of, days)) & (C.text(F.col("company")) != ""))
    by = rows.groupBy("company", "rejection_reason").agg(F.count(F.lit(1)).alias("n"))
    found = by.groupBy("company").agg(F.sum("n").alias("rejections"), F.max_by("rejection_reason", F.struct("n", "rejection_reason")).alias("top_reason"), (F.count(F.lit(1)) > 1).alias("mixed"))
    return found.where("rejections >= 3").withColumn("auto", F.col("rejections") >= 10)


def domain_reputation(bounces: DataFrame) -> DataFrame:
    """Per mail domain: bounces, score (100 less 30 each, not below 0), blocked from five on."""
    found = bounces.groupBy(F.lower(F.split("email", "@")[1]).alias("domain")).agg(F.count(F.lit(1)).alias("bounces"))
    return found.select("domain", "bounces", F.greatest(F.lit(0), 100 - 30 * F.col("bounces")).alias("score"), (F.col("bounces") >= 5).alias("blocked"))


def moving_success(tries: DataFrame, keep: float = 0.95) -> DataFrame:
    """Per pattern, the exponential mean of its successes in order, from 0.5.

    The mean is a weighted sum: a success that k tries follow weighs (1 - keep) * keep ** k. Tries are numbered within their
    day, and days by their counts, so no pattern is numbered in one task.
    """
    rows = tries.withColumn("_day", F.to_date("ts"))
    days = rows.groupBy("pattern", "_day").agg(F.count(F.lit(1)).alias("_n"))
    after = days.withColumn("_after", F.sum("_n").over(Window.partitionBy("pattern").orderBy(F.desc("_day"))) - F.col("_n")).drop("_n")
    back = rows.withColumn("_back", F.row_number().over(Window.partitionBy("pattern", "_day").orderBy(F.desc("ts"), F.desc("event_id"))) - 1).join(after, ["pattern", "_day"])
    weight = F.when(F.col("ok"), (1 - keep) * F.pow(F.lit(keep), F.col("_back") + F.col("_after"))).otherwise(0.0)
    n = F.count(F.lit(1))
    return back.groupBy("pattern").agg(F.round(F.sum(weight) + 0.5 * F.pow(F.lit(keep), n), 6).alias("confidence"), n.alias("tries"))


def burn_rate(usage: DataFrame, credits: float) -> DataFrame:
    """Per api and day, the mean of the last seven days' use and the days that the credits last at that rate."""
    daily = usage.groupBy("api", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("used"))
    mean = F.avg("used").over(Window.partitionBy("api").orderBy("day").rowsBetween(-6, 0))
    return daily.select("api", "day", "used", F.round(mean, 4).alias("mean_7"), F.round(credits / mean, 2).alias("days_left"))


def tracker_sync(postings: DataFrame, tracker: DataFrame) -> DataFrame:
    """Postings in order with the tracker's status, found by job id, else by company and title; renumbered from 1."""
    by_id = tracker.where(C.text(F.col("job_id")) != "").groupBy(F.col("job_id").alias("_j")).agg(F.min_by("status", "id").alias("_s1"))
    by_key = tracker.groupBy(C.squash(F.col("company")).alias("_c"), C.squash(F.col("title")).alias("_t")).agg(F.min_by("status", "id").alias("_s2"))
    rows = postings.join(by_id, F.col("job_id") == F.col("_j"), "left").join(by_key, (C.squash(F.col("company")) == F.col("_c")) & (C.squash(F.col("title")) == F.col("_t")), "left")
    return rows.select("id", "company", "title", F.coalesce("_s1", "_s2", F.lit("")).alias("status")).where("status <> 'Not Applied'")


def contact_priority(tracker: DataFrame, jobs: DataFrame) -> DataFrame:
    """Whom to write to: not where sponsorship is refused, at once where it is given in a tech hub or the status is Applied."""
    hub = F.col("location").rlike("Boston|New York|Seattle|San Francisco|Remote")
    return tracker.join(jobs.select("id", "location", "sponsorship"), "id").select("id", F.when(F.col("sponsorship") == "No", "Skip").when((F.col("sponsorship") == "Yes") & hub, "yes").when(F.col("status") == "Applied", "yes").otherwise("later").alias("priority"))


def contact_lookup(rows: DataFrame, contacts: DataFrame, most_bounces: int = 1) -> DataFrame:
    """Rows (company, title) with the address of a contact (company, role, email, bounces) of their company and role, unless it bounced twice."""
    good = contacts.where((C.text(F.col("email")) != "") & (F.coalesce("bounces", F.lit(0)) <= most_bounces)).groupBy(C.company_key(F.col("company")).alias("_c"), C.squash(F.col("role")).alias("_r")).agg(F.min("email").alias("email"))
    return rows.join(good, (C.company_key(F.col("company")) == F.col("_c")) & (C.squash(F.col("title")) == F.col("_r")), "left").drop("_c", "_r")


def learned_report(jobs: DataFrame, n: int = 10) -> DataFrame:
    """Section, label and number: sizes of what is learned, the commonest error patterns, and preferred roles (words of accepted titles)."""
    count = F.count(F.lit(1))
    sizes = jobs.agg(F.count_distinct("company").alias("companies"), F.count_distinct("source").alias("sources"), F.count_if(F.col("outcome") == "valid").alias("accepted")).unpivot([], ["companies", "sources", "accepted"], "label", "n").select(F.lit("size").alias("section"), "label", "n")
    errors = jobs.where("outcome = 'discarded' AND rejection_reason <> ''").groupBy(C.discard_reason(F.col("rejection_reason")).alias("label")).agg(count.alias("n")).orderBy(F.desc("n"), "label").limit(n).select(F.lit("error").alias("section"), "label", "n")
    roles = jobs.where("outcome = 'valid'").groupBy(F.col("title").alias("label")).agg(count.alias("n")).orderBy(F.desc("n"), "label").limit(n).select(F.lit("role").alias("section"), "label", "n")
    return sizes.unionByName(errors).unionByName(roles)


#: fixed values: states by time zone, for the send slot
ZONES = {"America/New_York": ("MA", "NY", "NJ", "PA", "FL", "GA"), "America/Chicago": ("TX", "IL"), "America/Denver": ("CO",), "America/Los_Angeles": ("CA", "WA", "OR")}


def send_at(location: Column, after: Column) -> Column:
    """Ten o'clock in the state's zone on the next weekday, as a UTC time."""
    code = C.state_code(location)
    zone = F.coalesce(*[F.when(code.isin(*states), z) for z, states in ZONES.items()], F.lit("America/New_York"))
    day = F.date_add(F.to_date(after), 1)
    shift = F.when(F.dayofweek(day) == 7, 2).when(F.dayofweek(day) == 1, 1).otherwise(0)
    return F.to_utc_timestamp(F.concat(F.date_add(day, shift).cast("string"), F.lit(" 10:00:00")), zone)


def status_counts(rows: DataFrame) -> DataFrame:
    """Applications by normalised status and source, with a running weekly total."""
    s = F.lower(C.text(F.col("status")))
    status = F.when(s.contains("interview"), "Interview").when(s.contains("reject"), "Rejected").when(s.contains("offer"), "Offer").when(s.contains("appl"), "Applied").otherwise("Not Applied")
    return rows.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def dashboard(rows: DataFrame) -> DataFrame:
    """Panel, label, n of rows (status, source, state, mode, day): applied rows by source, state, mode, month and ISO week with its
    running total, and the funnel from all rows to interviews and offers. One pass; each row goes to a cell of each panel."""
    s = F.lower(C.text(F.col("status")))
    applied = s.rlike("appl|interview|offer|reject") & ~s.contains("not appl")
    cell = lambda panel, label, when=None: F.when(F.lit(True) if when is None else when, F.struct(F.lit(panel).alias("panel"), F.coalesce(F.nullif(label, F.lit("")), F.lit("Unknown")).alias("label")))
    cells = F.array(
        cell("source", F.col("source"), applied), cell("state", F.col("state"), applied), cell("mode", F.col("mode"), applied), cell("month", F.date_format("day", "yyyy-MM"), applied), cell("week", F.date_trunc("week", "day").cast("date").cast("string"), applied),
        cell("funnel", F.lit("1 all")), cell("funnel", F.lit("2 applied"), applied), cell("funnel", F.lit("3 interview"), s.rlike("interview|offer")), cell("funnel", F.lit("4 offer"), s.contains("offer")),
    )
    counts = rows.select(F.explode(F.filter(cells, lambda c: c.isNotNull())).alias("c")).groupBy("c.panel", "c.label").agg(F.count(F.lit(1)).alias("n"))
    weeks = counts.where("panel = 'week' AND label <> 'Unknown'")  # a row a week: the span of time bounds the window
    return counts.unionByName(weeks.select(F.lit("cumulative").alias("panel"), "label", F.sum("n").over(Window.partitionBy("panel").orderBy("label")).alias("n")))


def repaired(rows: DataFrame) -> DataFrame:
    """P50: rows whose remote column holds a date are shifted by one: the four fields move back."""
    shifted = F.col("remote").rlike(r"^\d{4}-\d{2}-\d{2}")
    return rows.select(*[c for c in rows.columns if c not in ("remote", "entry_date", "source", "sponsorship")], F.when(shifted, "Unknown").otherwise(F.col("remote")).alias("remote"), F.when(shifted, F.col("remote")).otherwise(F.col("entry_date")).alias("entry_date"), F.when(shifted, F.col("entry_date")).otherwise(F.col("source")).alias("source"), F.when(shifted, F.col("source")).otherwise(F.col("sponsorship")).alias("sponsorship"))


def by_sponsorship(jobs: DataFrame) -> DataFrame:
    """Only rows not applied to move, among their own places, by sponsorship, company, title; the others keep theirs."""
    rank = F.when(F.col("sponsorship") == "Yes", 0).when(F.col("sponsorship") == "Unknown", 1).otherwise(2)
    movable = jobs.where("outcome <> 'valid'").select("id", "source", "company", "title", rank.alias("sponsors"))
    places = ranked(movable.select("id", "source"), "slot", F.col("id"), by=("source",)).select("source", "slot", F.col("id").alias("place"))
    order = ranked(movable, "rank", *map(F.col, ("sponsors", "company", "title", "id")), by=("source",))
    moved = order.alias("m").join(places.alias("p"), F.col("m.source").eqNullSafe(F.col("p.source")) & (F.col("m.rank") == F.col("p.slot"))).select("m.id", "p.place")
    return moved.unionByName(jobs.where("outcome = 'valid'").select("id", F.col("id").alias("place")))


EK = sql_company_key("name")
A33 = f"SELECT {EK} AS employer_key, sum(approvals)::BIGINT AS approvals, arg_max(name, (length(name), name)) AS name FROM employers GROUP BY 1"
query("a33_s7_employer_approvals", A33, "employers")(lambda s, d: employer_approvals(tables.employers(s, d)))
query("j7_approvals_lookup", f"""WITH e AS ({A33}), n AS (SELECT DISTINCT company, {sql_company_key('company')} AS q FROM jobs), m AS (SELECT n.company, max((e.approvals, e.name)) AS hit FROM n JOIN e ON length(q) >= 3 AND (q = employer_key OR (length(split_part(q, ' ', 1)) >= 4
    AND split_part(q, ' ', 1) = split_part(employer_key, ' ', 1) AND (split_part(q, ' ', 2) = '' OR list_contains(string_split(employer_key, ' '), split_part(q, ' ', 2))))) GROUP BY 1)
    SELECT id, jobs.company, CASE WHEN hit IS NULL THEN 'Unknown' ELSE 'Yes' END AS verdict, coalesce(hit[1], 0) AS approvals, coalesce(hit[2], '') AS employer FROM jobs LEFT JOIN m ON jobs.company = m.company""", "jobs", "employers")(
    lambda s, d: approvals_lookup(tables.jobs(s, d).select("id", "company"), employer_approvals(tables.employers(s, d)))
)
SQ = f"regexp_replace({sql_company_key('company')}, '[^a-z0-9]', '', 'g')"
query("j8_filings_lookup", f"""WITH e AS (SELECT regexp_replace({EK}, '[^a-z0-9]', '', 'g') AS k, name, approvals AS f FROM ({A33})), n AS (SELECT DISTINCT company, {SQ} AS q FROM jobs),
    m AS (SELECT company, max((CASE WHEN q = k THEN 1 ELSE 0 END, f, name)) AS hit FROM n JOIN e ON q = k OR (length(q) >= 5 AND length(k) >= 5 AND (starts_with(q, k) OR starts_with(k, q))) GROUP BY 1)
    SELECT id, jobs.company, CASE WHEN hit[2] >= 100 THEN 1 WHEN hit[2] >= 20 THEN 2 WHEN hit IS NOT NULL THEN 3 ELSE 4 END AS tier, coalesce(hit[2], 0) AS filings FROM jobs LEFT JOIN m ON jobs.company = m.company""", "jobs", "employers")(
    lambda s, d: filings_lookup(tables.jobs(s, d).select("id", "company"), employer_approvals(tables.employers(s, d)))
)
query("j9_blacklisted", f"WITH r AS (SELECT DISTINCT regexp_replace({EK}, '[^a-z0-9]', '', 'g') AS r FROM employers WHERE approvals > 5000), k AS (SELECT id, {SQ} AS k FROM jobs) SELECT id FROM k WHERE length(k) >= 4 AND EXISTS (SELECT 1 FROM r WHERE length(r) >= 4 AND (starts_with(k, r) OR starts_with(r, k)))", "jobs", "employers")(
    lambda s, d: blacklisted(tables.jobs(s, d), tables.employers(s, d).where("approvals > 5000")).select("id")
)
query("f24_blacklisted_titles", "SELECT id FROM jobs WHERE ' ' || trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) || ' ' LIKE '% data analyst %' OR lower(title) LIKE 'solutions engineer%'", "jobs")(
    lambda s, d: whole_word_terms(tables.jobs(s, d), tables.table(s, d, "region").select(F.when(F.col("r_regionkey") == 0, "Data Analyst").otherwise("solutions engineer").alias("term")))
)
query("j16_feature_vectors", """WITH c AS (SELECT company, count(*) AS n, round(count(*) FILTER (outcome = 'valid')::DOUBLE / count(*), 4) AS r FROM fact GROUP BY 1), s AS (SELECT source, round(count(*) FILTER (outcome = 'valid')::DOUBLE / count(*), 4) AS r FROM fact GROUP BY 1),
    l AS (SELECT location_state, count(*) FILTER (outcome = 'valid') AS n FROM fact GROUP BY 1)
    SELECT id, c.n AS company_times_seen, c.r AS company_valid_rate, coalesce(s.r, 0.0) AS source_valid_rate, f.location_state, coalesce(l.n, 0) AS location_job_density, length(title) AS title_length,
    CASE WHEN regexp_matches(lower(title), 'ai|ml|machine learning|data science') THEN 1 ELSE 0 END AS has_ai_ml, CASE WHEN regexp_matches(lower(title), 'software|sde|backend|frontend|full stack') THEN 1 ELSE 0 END AS has_sde
    FROM fact f LEFT JOIN c ON f.company = c.company LEFT JOIN s ON f.source = s.source LEFT JOIN l ON f.location_state = l.location_state""", "fact")(lambda s, d: feature_vectors(reports.fact(tables.jobs(s, d))))  # fmt: skip
query("p47_f27_sponsorship", "SELECT id, CASE WHEN job_type IN ('Internship', 'Co-op') THEN 'Unknown' WHEN sponsorship IN ('Yes', 'No') THEN sponsorship WHEN id % 2 = 0 THEN 'Yes' ELSE 'Unknown' END AS sponsorship FROM jobs", "jobs")(
    lambda s, d: tables.jobs(s, d).select("id", sponsorship(F.col("sponsorship"), F.when(F.col("id") % 2 == 0, "Yes"), F.col("job_type")).alias("sponsorship"))
)
query("p47_page_sponsorship", "SELECT page_id, CASE WHEN regexp_matches(lower(html), '(no|not|unable to|without) (offer |provide )?(visa )?sponsor') THEN 'No' WHEN regexp_matches(lower(html), '(will|can|offers?|provides?) (visa )?sponsor') THEN 'Yes' ELSE 'Unknown' END AS sponsorship FROM pages")(
    lambda s, d: tables.table(s, d, "pages").select("page_id", sponsorship_from_text(F.col("html")).alias("sponsorship"))
)
query("o6_p52_relevance")(lambda s, d: tables.jobs(s, d).select("id", relevance(F.col("title"), F.col("company"), F.col("job_type")).alias("score")).orderBy(F.desc("score"), "id"))
query("p53_a50_title_preference")(lambda s, d: title_preference(tables.jobs(s, d), tables.jobs(s, d).where("outcome = 'valid'")))
query("a38_auto_blacklist", "SELECT company, trim(split_part(rejection_reason, '(', 1)) AS reason, count(*) AS count FROM jobs WHERE outcome = 'discarded' AND trim(company) <> '' AND regexp_matches(rejection_reason, 'URGENT|HIGH') AND company <> 'Unknown' GROUP BY 1, 2 HAVING count(*) >= 3", "jobs")(
    lambda s, d: auto_blacklist(tables.jobs(s, d), tables.table(s, d, "region").select(F.lit("Unknown").alias("company")), "URGENT|HIGH")
)
query("a39_blacklist_review", f"""WITH b AS (SELECT company, rejection_reason AS r, count(*) AS n FROM jobs WHERE outcome = 'discarded' AND processed_at >= strftime(DATE '{tables.JOBS_AS_OF}' - 30, '%Y-%m-%d') AND company <> '' GROUP BY 1, 2)
    SELECT company, sum(n)::BIGINT AS rejections, arg_max(r, (n, r)) AS top_reason, count(*) > 1 AS mixed, sum(n) >= 10 AS auto FROM b GROUP BY 1 HAVING sum(n) >= 3""", "jobs")(lambda s, d: blacklist_review(tables.jobs(s, d), tables.JOBS_AS_OF))  # fmt: skip
query("a40_domain_reputation", "SELECT 'd' || (user_id % 7) || '.example' AS domain, count(*) AS bounces, greatest(0, 100 - 30 * count(*)) AS score, count(*) >= 5 AS blocked FROM events WHERE event_type = 'error' GROUP BY 1")(
    lambda s, d: domain_reputation(tables.table(s, d, "events").where("event_type = 'error'").select(F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@D"), (F.col("user_id") % 7).cast("string"), F.lit(".example")).alias("email")))
)
query("a41_moving_success")(lambda s, d: moving_success(tables.table(s, d, "events").select(F.concat("event_type", (F.col("user_id") % 50).cast("string")).alias("pattern"), "ts", "event_id", (F.col("value") >= 50).alias("ok"))))
query("a42_burn_rate", "WITH d AS (SELECT event_type AS api, ts::DATE AS day, count(*) AS used FROM events GROUP BY 1, 2), m AS (SELECT *, avg(used) OVER (PARTITION BY api ORDER BY day ROWS 6 PRECEDING) AS m FROM d) SELECT api, day, used, round(m, 4) AS mean_7, round(1000 / m, 2) AS days_left FROM m")(lambda s, d: burn_rate(tables.table(s, d, "events").select(F.col("event_type").alias("api"), "ts"), 1000))
query("j15_tracker_sync")(lambda s, d: tracker_sync(tables.jobs(s, d), tables.jobs(s, d).where("outcome <> 'discarded'").select("id", "job_id", "company", "title", F.when(F.col("outcome") == "valid", "Applied").otherwise("Not Applied").alias("status"))))
query("j18_contact_priority", "SELECT id, CASE WHEN sponsorship = 'No' THEN 'Skip' WHEN sponsorship = 'Yes' AND regexp_matches(location, 'Boston|New York|Seattle|San Francisco|Remote') THEN 'yes' WHEN outcome = 'valid' THEN 'yes' ELSE 'later' END AS priority FROM jobs", "jobs")(
    lambda s, d: contact_priority(tables.jobs(s, d).select("id", F.when(F.col("outcome") == "valid", "Applied").alias("status")), tables.jobs(s, d))
)
query("j13_nearest_name", "WITH r AS (SELECT DISTINCT name FROM employers), n AS (SELECT DISTINCT upper(company) AS known FROM jobs), p AS (SELECT name, known, levenshtein(lower(name), lower(known)) AS distance FROM r JOIN n ON levenshtein(lower(name), lower(known)) <= 2) SELECT name, arg_min(known, (distance, known)) AS known, min(distance) AS distance FROM p GROUP BY 1", "employers", "jobs")(
    lambda s, d: nearest_name(tables.employers(s, d), tables.jobs(s, d).select(F.upper("company").alias("name")))
)
query("o4_by_sponsorship")(lambda s, d: by_sponsorship(tables.jobs(s, d)))
query("p51_send_at")(lambda s, d: tables.jobs(s, d).select("id", send_at(F.col("location"), F.substring("processed_at", 1, 10).cast("date")).alias("send_at")))
STATUS = "CASE id % 10 WHEN 0 THEN 'Interview' WHEN 1 THEN 'Offer' WHEN 2 THEN 'Rejected' WHEN 3 THEN 'Not Applied' WHEN 4 THEN '' ELSE 'Applied' END"
query("a44_dashboard", f"""WITH r AS (SELECT {STATUS} AS status, coalesce(nullif(source, ''), 'Unknown') AS source, coalesce(nullif(regexp_extract(location, ',\\s*([A-Z]{{2}})\\b', 1), ''), 'Unknown') AS state, coalesce(nullif(remote, ''), 'Unknown') AS mode, substr(processed_at, 1, 10)::DATE AS day FROM jobs),
    a AS (SELECT * FROM r WHERE status NOT IN ('', 'Not Applied')), w AS (SELECT date_trunc('week', day)::DATE::VARCHAR AS label, count(*) AS n FROM a GROUP BY 1)
    SELECT 'source' AS panel, source AS label, count(*) AS n FROM a GROUP BY 2 UNION ALL SELECT 'state', state, count(*) FROM a GROUP BY 2 UNION ALL SELECT 'mode', mode, count(*) FROM a GROUP BY 2 UNION ALL SELECT 'month', strftime(day, '%Y-%m'), count(*) FROM a GROUP BY 2 UNION ALL SELECT 'week', label, n FROM w
    UNION ALL SELECT 'cumulative', label, (sum(n) OVER (ORDER BY label))::BIGINT FROM w UNION ALL SELECT 'funnel', '1 all', count(*) FROM r UNION ALL SELECT 'funnel', '2 applied', count(*) FROM a UNION ALL SELECT 'funnel', '3 interview', count(*) FROM r WHERE status IN ('Interview', 'Offer') UNION ALL SELECT 'funnel', '4 offer', count(*) FROM r WHERE status = 'Offer'""", "jobs")(
    lambda s, d: dashboard(tables.jobs(s, d).select(F.expr(STATUS).alias("status"), "source", C.state_code(F.col("location")).alias("state"), F.col("remote").alias("mode"), F.to_date(F.substring("processed_at", 1, 10)).alias("day")))
)
query("a43_a44_status_counts", "SELECT CASE outcome WHEN 'valid' THEN 'Applied' WHEN 'discarded' THEN 'Rejected' ELSE 'Not Applied' END AS status, count(*) AS n FROM jobs GROUP BY 1", "jobs")(
    lambda s, d: status_counts(tables.jobs(s, d).select(F.when(F.col("outcome") == "valid", "applied on site").when(F.col("outcome") == "discarded", "Rejected!").alias("status")))
)
