"""Duplicate postings: keys, tiers, similar titles and set operations."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.functions import columns as C
from postmill.operators import seen
from postmill.operators.lineage import cut
from postmill.plans.registry import query, sql_company_key
from postmill.sources import tables

BLOCK_ROWS, SLICE = 1000, 256
#: fixed values: level marks of titles and their rank
LEVELS = {"i": 1, "1": 1, "ii": 2, "2": 2, "iii": 3, "3": 3, "iv": 4, "4": 4, "v": 5, "5": 5, "jr": 10, "junior": 10, "associate": 11, "sr": 90, "senior": 90, "staff": 91, "principal": 92}
#: fixed values: words of titles that tell no two postings apart
FILLER = ("the a an of for and or in at to with on services service group team teams department division program programs co op coop intern internship graduate grad new student students us usa united "
          "states remote hybrid onsite full part time summer fall spring winter position role opportunity opportunities job jobs engineer engineering developer development analyst scientist software technology technical technologies").split()  # fmt: skip


def dedup_key(company: Column, title: Column) -> Column:
    """Company without legal suffix and title without brackets, letters and digits only."""
    return F.concat_ws("|", C.squash(C.company_key(company)), C.squash(F.regexp_replace(C.text(title), r"\([^)]*\)", "")))


def first_of(rows: DataFrame, order: str, *keys: Column) -> DataFrame:
    """The first row of each key; rows are compared where they are read, so a hot key sends one row a task."""
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    return rows.groupBy(*named).agg(F.min_by(F.struct("*"), F.col(order)).alias("_row")).select("_row.*")


def tiers(jobs: DataFrame, days: int = seen.DAYS, fuzzy: float = 0.90) -> DataFrame:
    """D3: id and the strongest tier by which an earlier row stands for it: job_id, run, url, key, fuzzy, or null.

    job_id: the registry of company and id holds an entry of the last `days` days. run: a row of the same run has the same id, whatever
    its company. url, key: an earlier row of any time has the same identifying URL, or company and title. fuzzy: an earlier title of
    the company has at least that cosine similarity and differs in no level or meaningful word. A row without an id (or URL,
    company, title) has no key in that tier, so missing values are never duplicates and never meet in one task.
    """
    entry = F.col("_entry")
    rows = jobs.withColumn("_entry", seen.registry_key(F.col("company"), F.col("job_id")))
    k1 = F.when(entry.isNotNull(), F.concat_ws("|", F.coalesce("run_id", F.lit("")), C.normal_job_id(F.col("job_id"))))
    k2 = F.when(C.is_identifying_url(F.col("url")), C.canonical_url(F.col("url")))
    k3 = F.when(C.squash(F.col("company")) != "", dedup_key(F.col("company"), F.col("title")))
    keys = F.filter(F.array(*[F.struct(F.lit(tier).alias("tier"), k.alias("key")) for tier, k in enumerate((k1, k2, k3), 1)]), lambda k: k["key"].isNotNull())
    # read twice below, so it is written once
    each = cut(rows.select("id", F.explode(keys).alias("k")).select("id", "k.tier", "k.key"))
    # one least id per key, counted where the rows are read; only keys that occur twice are joined
    again = each.groupBy("tier", "key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    hits = each.join(again, ["tier", "key"]).where(F.col("id") > F.col("first")).select("id", "tier")
    entered = seen.known(rows.select("id", F.col("_entry").alias("key"), F.to_date(F.substring("processed_at", 1, 10)).alias("day")), days).where("known").select("id", F.lit(0).alias("tier"))
    titles = jobs.select("id", C.company_key(F.col("company")).alias("company"), "title").where("company <> ''")
    nodes = titles.groupBy("company", "title").agg(F.min("id").alias("id"))
    near = top_matches(nodes, fuzzy, 1, guard=True, earlier=True).select(F.col("a").alias("id"), F.lit(4).alias("tier"))
    best = hits.unionByName(entered).unionByName(near).groupBy("id").agg(F.min("tier").alias("best"))
    names = F.array(*map(F.lit, ("job_id", "run", "url", "key", "fuzzy")))
    return jobs.select("id").join(best, "id", "left").select("id", F.get(names, F.col("best")).alias("tier"))


def run_repeats(jobs: DataFrame) -> DataFrame:
    """Ids of rows whose company and title an earlier row of the same run has."""
    key = F.when(C.squash(F.col("company")) != "", dedup_key(F.col("company"), F.col("title")))
    keyed = jobs.select("id", F.coalesce("run_id", F.lit("")).alias("run"), key.alias("key")).where("key IS NOT NULL")
    first = keyed.groupBy("run", "key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return keyed.join(first, ["run", "key"]).where(F.col("id") > F.col("first")).select("id")


def tokens(title: Column) -> Column:
    return F.filter(F.split(F.lower(C.text(title)), "[^a-z0-9]+"), lambda t: t != "")


def levels(title: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in LEVELS.items() for x in kv])
    return F.array_sort(F.array_distinct(F.transform(F.filter(tokens(title), lambda t: t.isin(*LEVELS)), lambda t: F.element_at(table, t))))


def meaningful(title: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(tokens(title), lambda t: (F.length(t) > 1) & ~t.isin(*FILLER) & ~t.isin(*LEVELS) & ~t.rlike(r"^\d{4}$"))))


def differs(a: Column, b: Column) -> Column:
    """Titles that must not be merged: other levels, or a meaningful word that only one has."""
    wa, wb = meaningful(a), meaningful(b)
    return (levels(a) != levels(b)) | ((F.size(wa) > 0) & (F.size(wb) > 0) & (wa != wb))


def weights(titles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, company, term, unit-length weight) and (term, df), with tf = count / length and idf = ln((n + 1) / (df + 1)) + 1."""
    words = titles.select("id", "company", tokens(F.col("title")).alias("t"))
    counts = words.select("id", "company", F.size("t").alias("n_tokens"), F.explode("t").alias("term")).groupBy("id", "company", "term", "n_tokens").agg(F.count(F.lit(1)).alias("c"))
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = titles.agg(F.count(F.lit(1)).alias("n"))
    raw = counts.join(df, "term").crossJoin(F.broadcast(n)).withColumn("w", F.col("c") / F.col("n_tokens") * (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    return raw.select("id", "company", "term", "df", (F.col("w") / norm).alias("w")), df


def similar_titles(titles: DataFrame, threshold: float = 0.7) -> DataFrame:
    """A, b, score of titles (id, company, title) of one company with cosine similarity of at least the threshold.

    Equal titles of a company are one node (its smallest id), so copies make no pairs. Exact prefix filter: with terms in
    order of rarity, two unit vectors can only reach the threshold if they share a term before the point from which the
    rest is shorter than the threshold; only those terms are joined, and then whole vectors are compared.
    """
    nodes = titles.groupBy("company", "title").agg(F.min("id").alias("id"))
    w, _ = weights(nodes)
    order = Window.partitionBy("id").orderBy("df", "term")
    rest = F.sqrt(F.greatest(F.lit(0.0), F.sum(F.col("w") * F.col("w")).over(order.rowsBetween(0, Window.unboundedFollowing))))
    prefix = w.withColumn("rest", rest).where(F.col("rest") >= threshold - 1e-9).select("id", "company", "term")
    a, b = (prefix.select(F.col("id").alias(x), "company", "term") for x in "ab")
    pairs = a.join(b, ["company", "term"]).where("a < b").select("a", "b").distinct()
    vectors = w.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("term", "w"))).alias("v"))
    both = pairs.join(vectors.select(F.col("id").alias("a"), F.col("v").alias("va")), "a").join(vectors.select(F.col("id").alias("b"), F.col("v").alias("vb")), "b")
    score = F.aggregate(F.map_entries("va"), F.lit(0.0), lambda s, e: s + e["value"] * F.coalesce(F.try_element_at("vb", e["key"]), F.lit(0.0)))
    return both.select("a", "b", score.alias("score")).where(F.col("score") >= threshold)


def _nearest(threshold: float, k: int, guard: bool, earlier: bool):
    """The best partners of each row of a pair of blocks, by a sparse product of their vectors; a heap of k a row goes out."""

    def meet(rows: pd.DataFrame, best: dict[int, list[tuple[float, int]]]) -> None:
        order = {t: i for i, t in enumerate(sorted({t for terms in rows["terms"] for t in terms}))}
        side, ids = rows["side"].to_numpy(), rows["id"].to_numpy()
        vectors = np.zeros((len(rows), len(order)))
        for i, (terms, weights_) in enumerate(zip(rows["terms"], rows["ws"], strict=True)):
            vectors[i, [order[t] for t in terms]] = weights_
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)  # 2: both
        levels_, words = [tuple(x) for x in rows["levels"]], [tuple(x) for x in rows["meaningful"]]
        for a in range(0, len(left), SLICE):
            part = left[a : a + SLICE]
            scores = vectors[part] @ vectors[right].T
            for x, y in zip(*np.nonzero(scores >= threshold - 1e-9), strict=True):
                i, j = part[x], right[y]
                if ids[i] == ids[j] or (guard and (levels_[i] != levels_[j] or (words[i] and words[j] and words[i] != words[j]))):
                    continue
                score = round(float(scores[x, y]), 6)
                for p, q in ((i, j), (j, i)):
                    if not earlier or ids[q] < ids[p]:
                        heap = best.setdefault(int(ids[p]), [])
                        entry = (score, -int(ids[q]))
                        if entry not in heap:
                            (heapq.heappush if len(heap) < k else heapq.heappushpop)(heap, entry)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        best: dict[int, list[tuple[float, int]]] = {}
        for _, part in rows.groupby(["company", "term", "ca", "cb", "i", "j"], sort=False):
            if len(part) > 1:
                meet(part, best)
        out = [(p, -q, score) for p, heap in best.items() for score, q in heap]
        return pd.DataFrame(out, columns=["a", "b", "score"]).astype({"a": "int64", "b": "int64", "score": "float64"})

    return run


def top_matches(titles: DataFrame, threshold: float = 0.7, k: int = 5, guard: bool = False, earlier: bool = False, most: int = BLOCK_ROWS) -> DataFrame:
    """A, b, score: for each title (id, company, title) its k most similar others of the company, ties to smaller ids.

    guard: titles that differ() are no match, and take no place among the k. earlier: only smaller ids match. Titles of one company
    must be distinct. Scores of at least the threshold count, rounded to six places. By the prefix filter of similar_titles()
    two titles meet under a rare term. There w = cos(x) is the term's weight, and the product of two unit vectors is at most
    cos(x - y), so where more than `most` titles share a term they are laid in cells of x as wide as the threshold's angle, and a cell
    meets itself and the next one. A cell of more than `most` rows is dealt in blocks by hash, and each pair of blocks is compared
    alone, with at most about twice `most` rows, whatever the company or term; only k partners a row leave it. Small groups
    share a task.
    """
    w, _ = weights(titles)
    order = Window.partitionBy("id").orderBy("df", "term")
    rest = F.sqrt(F.greatest(F.lit(0.0), F.sum(F.col("w") * F.col("w")).over(order.rowsBetween(0, Window.unboundedFollowing))))
    angle = math.acos(min(threshold, 1.0)) + 1e-6
    cell = F.when(F.count(F.lit(1)).over(Window.partitionBy("company", "term")) > most, F.floor(F.acos(F.least(F.col("w"), F.lit(1.0))) / angle)).otherwise(0)
    prefix = cut(w.withColumn("rest", rest).where(F.col("rest") >= threshold - 1e-9).select("id", "company", "term", cell.alias("cell")))
    buckets = prefix.count() // most + 1
    sizes = prefix.groupBy("company", "term", "cell").agg(F.ceil(F.count(F.lit(1)) / most).alias("n"))
    follow = sizes.select("company", "term", (F.col("cell") - 1).alias("cell"), F.col("n").alias("next"))
    before = sizes.select("company", "term", (F.col("cell") + 1).alias("cell"), F.col("n").alias("last"))
    placed = prefix.join(sizes, ["company", "term", "cell"]).join(follow, ["company", "term", "cell"], "left").join(before, ["company", "term", "cell"], "left").withColumn("i", F.pmod(F.xxhash64("id"), F.col("n")))
    meeting = lambda a, b, i, j, side: F.struct(a.alias("ca"), b.alias("cb"), i.cast("long").alias("i"), j.cast("long").alias("j"), side.alias("side"))
    c, i = F.col("cell"), F.col("i")
    blocks = lambda n: F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    own = F.transform(blocks(F.col("n")), lambda j: meeting(c, c, F.least(i, j), F.greatest(i, j), F.when(j == i, 2).when(i < j, 0).otherwise(1)))
    ahead = F.transform(blocks(F.col("next")), lambda j: meeting(c, c + 1, i, j, F.lit(0)))
    behind = F.transform(blocks(F.col("last")), lambda j: meeting(c - 1, c, j, i, F.lit(1)))
    met = placed.select("id", "company", "term", F.explode(F.concat(own, ahead, behind)).alias("m")).select("id", "company", "term", "m.*")
    vectors = w.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("v")).select("id", F.col("v.term").alias("terms"), F.col("v.w").alias("ws"))
    full = vectors.join(titles.select("id", levels(F.col("title")).alias("levels"), meaningful(F.col("title")).alias("meaningful")), "id")
    bucket = F.pmod(F.xxhash64("company", "term", "ca", "cb", "i", "j"), F.lit(buckets)).alias("bucket")
    found = met.join(full, "id").groupBy(bucket).applyInPandas(_nearest(threshold, k, guard, earlier), "a long, b long, score double")
    listed = found.groupBy("a").agg(F.slice(F.sort_array(F.collect_set(F.struct((-F.col("score")).alias("minus"), "b"))), 1, k).alias("top"))
    return listed.select("a", F.explode("top").alias("t")).select("a", "t.b", (-F.col("t.minus")).alias("score"))


def duplicate_groups(pairs: DataFrame) -> DataFrame:
    """Id and the smallest id of its group, by minimum labels over pairs until nothing changes; each round is checkpointed.

    After each hop a label gives way to its own label, so long chains take few rounds.
    """
    edges = cut(pairs.select(F.col("a"), F.col("b")).unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = edges.select(F.col("a").alias("id"), F.col("a").alias("group")).distinct()
    while True:
        least = edges.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("group").alias("m"))
        new = cut(labels.join(least, F.col("id") == F.col("a"), "left").select("id", F.least("group", F.coalesce("m", "group")).alias("group"), (F.coalesce(F.col("m"), F.col("group")) < F.col("group")).alias("moved")))
        if new.where("moved").isEmpty():
            return new.select("id", "group")
        far = new.select(F.col("id").alias("_id"), F.col("group").alias("_far"))
        labels = cut(new.join(far, F.col("group") == F.col("_id")).select("id", F.col("_far").alias("group")))


def title_groups(titles: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Every row's id and the smallest id of its group of similar titles; rows of one company and title share theirs."""
    first = titles.groupBy(F.col("company").alias("_c"), F.col("title").alias("_t")).agg(F.min("id").alias("_first"))
    groups = duplicate_groups(similar_titles(titles, threshold)).select(F.col("id").alias("_first"), "group")
    named = first.join(groups, "_first", "left").select("_c", "_t", F.coalesce("group", "_first").alias("group"))
    return titles.join(named, F.col("company").eqNullSafe(F.col("_c")) & F.col("title").eqNullSafe(F.col("_t"))).select("id", "group")


def corpus_stats(titles: DataFrame) -> DataFrame:
    """D6."""
    words = titles.select("id", tokens(F.col("title")).alias("t"))
    terms = words.select(F.explode("t").alias("term")).agg(F.count_distinct("term").alias("vocabulary"))
    return words.agg(F.count(F.lit(1)).alias("documents"), F.round(F.avg(F.size("t")), 4).alias("mean_tokens")).crossJoin(terms)


def rejected_once(rows: DataFrame) -> DataFrame:
    """Rejected rows once per (url, reason), then once per company and title; the first by id stays."""
    return first_of(first_of(rows, "id", F.col("url"), F.col("rejection_reason")), "id", dedup_key(F.col("company"), F.col("title")))


def repeated_job_ids(rows: DataFrame) -> DataFrame:
    """Later rows of one company and job id."""
    known = rows.where((C.text(F.col("job_id")) != "") & (F.col("job_id") != "N/A"))
    first = known.groupBy(F.col("company").alias("_c"), F.col("job_id").alias("_j")).agg(F.min("id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return known.join(first, F.col("company").eqNullSafe(F.col("_c")) & (F.col("job_id") == F.col("_j")) & (F.col("id") > F.col("_first")), "left_semi")


def not_sent(drafts: DataFrame, log: DataFrame, days: int = 30) -> DataFrame:
    """Drafts (recipient, subject, at) without a sent message of the same recipient and subject in the days before."""
    sent = log.select(F.col("recipient").alias("_r"), F.col("subject").alias("_s"), F.col("at").alias("_at"))
    return drafts.join(sent, (F.col("recipient") == F.col("_r")) & (F.col("subject") == F.col("_s")) & (F.col("_at") < F.col("at")) & (F.col("_at") >= F.col("at") - F.expr(f"INTERVAL {days} DAYS")), "left_anti")


def known_keys(*tables_: DataFrame) -> DataFrame:
    """The keys of several posting tables: kind, key."""
    parts = None
    for rows in tables_:
        keys = F.array(F.struct(F.lit("key").alias("kind"), dedup_key(F.col("company"), F.col("title")).alias("key")), F.when(C.is_identifying_url(F.col("url")), F.struct(F.lit("url").alias("kind"), C.canonical_url(F.col("url")).alias("key"))))
        found = rows.select(F.explode(F.filter(keys, lambda x: x.isNotNull())).alias("k")).select("k.*")
        parts = found if parts is None else parts.unionByName(found, allowMissingColumns=True)
    return parts.distinct()


def unseen(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose key isn't known."""
    return rows.withColumn("_k", dedup_key(F.col("company"), F.col("title"))).join(known.where("kind = 'key'").select(F.col("key").alias("_k")), "_k", "left_anti").drop("_k")


def exclusive(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rejected rows whose company and title no accepted row has."""
    key = dedup_key(F.col("company"), F.col("title"))
    return rejected.withColumn("_k", key).join(accepted.select(key.alias("_k")).distinct(), "_k", "left_anti").drop("_k")


K = f"regexp_replace({sql_company_key('company')}, '[^a-z0-9]', '', 'g') || '|' || regexp_replace(lower(regexp_replace(title, '\\([^)]*\\)', '', 'g')), '[^a-z0-9]', '', 'g')"
query("d2_dedup_key", f"SELECT id, {K} AS key FROM jobs", "jobs")(lambda s, d: tables.jobs(s, d).select("id", dedup_key(F.col("company"), F.col("title")).alias("key")))
SQUASHED = f"regexp_replace({sql_company_key('company')}, '[^a-z0-9]', '', 'g')"
SIMILAR = """WITH n AS (SELECT company, title, min(id) AS id FROM titles GROUP BY 1, 2), t AS (SELECT id, company, list_filter(string_split_regex(lower(title), '[^a-z0-9]+'), lambda x: x <> '') AS t FROM n),
    c AS (SELECT id, company, term, len(t) AS l, count(*) AS c FROM (SELECT id, company, t, unnest(t) AS term FROM t) GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM c GROUP BY 1),
    w AS (SELECT id, company, term, c / l::DOUBLE * (ln(((SELECT count(*) FROM n) + 1) / (df + 1)::DOUBLE) + 1) AS w FROM c JOIN f USING (term)), u AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS x FROM w) """
WORDS = "list_sort(list_distinct(list_filter(list_filter(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda x: length(x) > 1), lambda x: NOT list_contains([{1}], x) AND NOT regexp_full_match(x, '[0-9]{{4}}'))))"
MARKS = "list_sort(list_distinct(list_filter(list_transform(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda x: CASE {1} END), lambda r: r IS NOT NULL)))"
_STOP, _RANK = ", ".join(f"'{w}'" for w in (*FILLER, *LEVELS)), " ".join(f"WHEN x = '{k}' THEN {v}" for k, v in LEVELS.items())
DIFFER = "(x.ls <> y.ls OR (len(x.ws) > 0 AND len(y.ws) > 0 AND x.ws <> y.ws))"
GUARDED = f"""p AS (SELECT a.id AS a, b.id AS b, round(sum(a.x * b.x), 6) AS score FROM u a JOIN u b ON a.company = b.company AND a.term = b.term AND a.id <> b.id GROUP BY 1, 2 HAVING sum(a.x * b.x) >= {{0}} - 1e-9),
    z AS (SELECT id, {WORDS.format('title', _STOP)} AS ws, {MARKS.format('title', _RANK)} AS ls FROM n), ok AS (SELECT a, b, score FROM p JOIN z x ON p.a = x.id JOIN z y ON p.b = y.id WHERE NOT {DIFFER})"""
#: jobs under ids that return, in runs of a month, with titles in three spellings
REPEATED = """r AS (SELECT id, url, company, title || CASE id % 3 WHEN 0 THEN '' WHEN 1 THEN ' - Remote' ELSE ' (US)' END AS title, CASE WHEN job_id = 'N/A' THEN job_id ELSE 'JR-00' || id % 61 END AS job_id, processed_at, substr(processed_at, 1, 7) AS run_id FROM jobs)"""
#: the registry in SQL: entry by entry, the next one being the first day after the expiry
ENTRIES = """s AS (SELECT key, day, min(id) AS id FROM k WHERE key IS NOT NULL GROUP BY 1, 2), e AS (WITH RECURSIVE e(key, day) AS (SELECT key, min(day) FROM s GROUP BY key UNION ALL SELECT s.key, min(s.day) FROM e JOIN s ON s.key = e.key AND s.day > e.day + 90 GROUP BY s.key, e.day) SELECT DISTINCT s.key, s.day, s.id FROM e JOIN s USING (key, day)),
    known AS (SELECT k.id, max(e.day) AS own, arg_max(e.id, e.day) AS first FROM k JOIN e ON k.key = e.key AND e.day <= k.day GROUP BY k.id, k.day)"""
ID_KEY = f"CASE WHEN coalesce(job_id, '') NOT IN ('', 'N/A') THEN regexp_replace({sql_company_key('company')}, '[^a-z0-9]', '', 'g') || '|' || ltrim(regexp_replace(lower(job_id), '[^a-z0-9]', '', 'g'), '0') END"
query("d3_d12_tiers", f"""WITH {REPEATED}, k AS (SELECT id, {ID_KEY} AS key, substr(processed_at, 1, 10)::DATE AS day, run_id || '|' || ltrim(regexp_replace(lower(job_id), '[^a-z0-9]', '', 'g'), '0') AS k1, CASE WHEN url LIKE 'https://boards%' THEN regexp_replace(lower(url), '[?].*', '') ELSE '#' || id END AS k2,
    CASE WHEN regexp_replace(lower(company), '[^a-z0-9]', '', 'g') <> '' THEN {K} ELSE '#' || id END AS k3 FROM r), {ENTRIES}, titles AS (SELECT id, {sql_company_key('company')} AS company, title FROM r WHERE {sql_company_key('company')} <> ''), {SIMILAR[5:]}, {GUARDED.replace("{0}", "0.9")},
    m AS (SELECT k.id, own IS NOT NULL AND (own <> day OR first <> k.id) AS a, key IS NOT NULL AND k.id > min(k.id) OVER (PARTITION BY CASE WHEN key IS NULL THEN '#' || k.id ELSE k1 END) AS b, k.id > min(k.id) OVER (PARTITION BY k2) AS c, k.id > min(k.id) OVER (PARTITION BY k3) AS d FROM k LEFT JOIN known ON k.id = known.id)
    SELECT id, CASE WHEN a THEN 'job_id' WHEN b THEN 'run' WHEN c THEN 'url' WHEN d THEN 'key' WHEN EXISTS (SELECT 1 FROM ok WHERE ok.a = m.id AND ok.b < m.id) THEN 'fuzzy' END AS tier FROM m""", "jobs")(lambda s, d: tiers(_repeated(s, d)))  # fmt: skip
query("d12_run_repeats", f"WITH {REPEATED} SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY run_id, {K} ORDER BY id) AS n FROM r WHERE regexp_replace(lower(company), '[^a-z0-9]', '', 'g') <> '') WHERE n > 1", "jobs")(lambda s, d: run_repeats(_repeated(s, d)))
query("d3_x2_registry", f"WITH {REPEATED}, k AS (SELECT id, {ID_KEY} AS key, substr(processed_at, 1, 10)::DATE AS day FROM r), {ENTRIES} SELECT k.id, coalesce(own IS NOT NULL AND (own <> day OR first <> k.id), false) AS known, CASE WHEN own <> day OR first <> k.id THEN own END AS seen_at FROM k LEFT JOIN known ON k.id = known.id", "jobs")(
    lambda s, d: seen.known(_repeated(s, d).select("id", seen.registry_key(F.col("company"), F.col("job_id")).alias("key"), F.to_date(F.substring("processed_at", 1, 10)).alias("day")))
)
TOP = "SELECT a, b, score FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS r FROM {0}) WHERE r <= 5"
query("d4_top_matches", SIMILAR + ", " + GUARDED.replace("{0}", "0.7") + " " + TOP.format("p"), "titles")(lambda s, d: top_matches(_nodes(tables.titles(s, d))))
query("d4_top_same_postings", SIMILAR + ", " + GUARDED.replace("{0}", "0.7") + " " + TOP.format("ok"), "titles")(lambda s, d: top_matches(_nodes(tables.titles(s, d)), guard=True))
query("d4_j17_similar_titles", SIMILAR + "SELECT a.id AS a, b.id AS b, round(sum(a.x * b.x), 4) AS score FROM u a JOIN u b ON a.company = b.company AND a.term = b.term AND a.id < b.id GROUP BY 1, 2 HAVING sum(a.x * b.x) >= 0.7", "titles")(lambda s, d: similar_titles(tables.titles(s, d)).select("a", "b", F.round("score", 4).alias("score")))
query("d5_u5_discriminator", SIMILAR + f""", p AS (SELECT a.id AS a, b.id AS b FROM u a JOIN u b ON a.company = b.company AND a.term = b.term AND a.id < b.id GROUP BY 1, 2 HAVING sum(a.x * b.x) >= 0.7),
    z AS (SELECT id, {WORDS.format('title', _STOP)} AS ws, {MARKS.format('title', _RANK)} AS ls FROM titles)
    SELECT p.a, p.b, x.ls <> y.ls OR (len(x.ws) > 0 AND len(y.ws) > 0 AND x.ws <> y.ws) AS differs FROM p JOIN z x ON p.a = x.id JOIN z y ON p.b = y.id""", "titles")(lambda s, d: _guarded(s, d))
query("d6_corpus_stats", "WITH t AS (SELECT id, list_filter(string_split_regex(lower(title), '[^a-z0-9]+'), lambda x: x <> '') AS t FROM titles) SELECT count(*) AS documents, round(avg(len(t)), 4) AS mean_tokens, (SELECT count(DISTINCT x) FROM (SELECT unnest(t) AS x FROM t)) AS vocabulary FROM t", "titles")(lambda s, d: corpus_stats(tables.titles(s, d)))
query("d7_w1_first_rows", f"SELECT min(id) AS id FROM jobs GROUP BY {K}", "jobs")(lambda s, d: first_of(tables.jobs(s, d), "id", dedup_key(F.col("company"), F.col("title"))).select("id"))
query("d8_rejected_once", f"SELECT min(id) AS id FROM (SELECT id, company, title, row_number() OVER (PARTITION BY url, rejection_reason ORDER BY id) AS n FROM jobs WHERE outcome = 'discarded') WHERE n = 1 GROUP BY {K}", "jobs")(lambda s, d: rejected_once(tables.jobs(s, d).where("outcome = 'discarded'")).select("id"))
query("d9_repeated_job_ids", "SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY company, job_id ORDER BY id) AS n FROM (SELECT id, company, CASE WHEN job_id = 'N/A' THEN job_id ELSE 'JR-' || id % 50 END AS job_id FROM jobs) WHERE job_id NOT IN ('', 'N/A')) WHERE n > 1", "jobs")(
    lambda s, d: repeated_job_ids(tables.jobs(s, d).withColumn("job_id", F.when(F.col("job_id") == "N/A", "N/A").otherwise(F.concat(F.lit("JR-"), (F.col("id") % 50).cast("string"))))).select("id")
)
query("d10_not_sent", "WITH e AS (SELECT event_id, CAST(user_id AS STRING) AS r, event_type AS s, ts FROM events) SELECT a.event_id FROM e a WHERE NOT EXISTS (SELECT 1 FROM e b WHERE a.r = b.r AND a.s = b.s AND b.ts < a.ts AND b.ts >= a.ts - INTERVAL 30 DAY)")(lambda s, d: _drafts(s, d))
query("d11_duplicate_groups", SIMILAR + ", p AS (SELECT a.id AS a, b.id AS b FROM u a JOIN u b ON a.company = b.company AND a.term = b.term AND a.id < b.id GROUP BY 1, 2 HAVING sum(a.x * b.x) >= 0.7), e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p), r AS (SELECT DISTINCT a AS id, a AS g FROM e), q AS (WITH RECURSIVE x(id, g) AS (SELECT id, g FROM r UNION SELECT e.b, x.g FROM x JOIN e ON x.id = e.a) SELECT * FROM x), m AS (SELECT id, min(g) AS g FROM q GROUP BY 1) SELECT titles.id, coalesce(m.g, n.id) AS \"group\" FROM titles JOIN n ON titles.company = n.company AND titles.title = n.title LEFT JOIN m ON n.id = m.id", "titles")(lambda s, d: title_groups(tables.titles(s, d)))
NUMBERED = "WITH j AS (SELECT id, outcome, company, title || ' ' || id % 997 AS title FROM jobs) "
query("j4_j6_u4_unseen", NUMBERED + f"SELECT id FROM j WHERE outcome = 'valid' AND {K} NOT IN (SELECT {K} FROM j WHERE outcome = 'discarded')", "jobs")(lambda s, d: unseen(_numbered(s, d, "valid"), known_keys(_numbered(s, d, "discarded"))).select("id"))
query("j5_u3_exclusive", NUMBERED + f"SELECT id FROM j WHERE outcome = 'discarded' AND {K} NOT IN (SELECT {K} FROM j WHERE outcome = 'reviewed')", "jobs")(lambda s, d: exclusive(_numbered(s, d, "reviewed"), _numbered(s, d, "discarded")).select("id"))


def _nodes(titles):
    """One row per company and title: its smallest id."""
    return titles.groupBy("company", "title").agg(F.min("id").alias("id"))


def _repeated(spark, sf_dir):
    """Jobs under ids that return, in runs of a month, with titles in three spellings."""
    k = F.col("id") % 3
    spelled = F.concat("title", F.when(k == 0, "").when(k == 1, " - Remote").otherwise(" (US)"))
    ids = F.when(F.col("job_id") == "N/A", "N/A").otherwise(F.concat(F.lit("JR-00"), (F.col("id") % 61).cast("string")))
    return tables.jobs(spark, sf_dir).select("id", "url", "company", spelled.alias("title"), ids.alias("job_id"), "processed_at", F.substring("processed_at", 1, 7).alias("run_id"))


def _guarded(spark, sf_dir):
    rows = tables.titles(spark, sf_dir)
    a, b = (rows.select(F.col("id").alias(x), F.col("title").alias(f"t{x}")) for x in "ab")
    return similar_titles(rows).join(a, "a").join(b, "b").select("a", "b", differs(F.col("ta"), F.col("tb")).alias("differs"))


def _numbered(spark, sf_dir, outcome):
    """Jobs of an outcome under titles that few others share."""
    return tables.jobs(spark, sf_dir).where(F.col("outcome") == outcome).withColumn("title", F.concat("title", F.lit(" "), (F.col("id") % 997).cast("string")))


def _drafts(spark, sf_dir):
    log = tables.table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("recipient"), F.col("event_type").alias("subject"), F.col("ts").alias("at"))
    return not_sent(log, log).select("event_id")
