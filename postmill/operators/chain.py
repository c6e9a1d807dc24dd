"""The full gate chain (F25, F26): the first gate that a posting fails, in the order of the pipeline, with lookups for rows still alive only.

Gates are grouped in stages. A stage first joins what its gates need (company rules, title verdicts, known keys, pages), then
judges; rows that fail leave before the next stage's join. Verdicts on titles are found once per distinct title, and a hot
title or company is dealt over SALTS parts of its lookup.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions import columns as C
from postmill.operators import dedup, gates
from postmill.operators.enrich import company_rules, whole_word_terms
from postmill.operators.lineage import cut
from postmill.operators.restrictions import restriction
from postmill.plans.registry import query
from postmill.sources import tables

SALTS = 16


class Stage(NamedTuple):
    """lookup joins columns to the rows that are alive; gates are (name, reason or flag) in order, a flag's reason being its name."""

    name: str
    lookup: Callable[[DataFrame], DataFrame] | None
    gates: tuple[tuple[str, Column], ...]


def looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """rows with the columns of a table of distinct keys (null is a key), whose rows are repeated for each salt of the rows."""
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed(key, "_key")
    dealt = rows.withColumn("_deal", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_deal") == F.col("_salt")), "left").drop("_key", "_salt", "_deal")


def title_verdicts(titles: DataFrame) -> DataFrame:
    """title, validity, gate, technical of each distinct title: F8's reason, the reason of F3, F6 and F7, and F5."""
    t = F.col("title")
    return titles.select("title").distinct().select("title", gates.first_reason(gates.TITLE_VALIDITY, t).alias("validity"), gates.title_reason(t).alias("gate"), gates.more_technical(t).alias("technical"))


def run_chain(rows: DataFrame, stages: tuple[Stage, ...]) -> DataFrame:
    """id, first_fail, lookups of rows: the first failing gate (null if none), and how many lookups the row took part in.

    Each stage is written once: rows that it rejects go to the result, and only the others are joined further on.
    """
    alive, done, n = rows, None, 0
    for stage in stages:
        if stage.lookup:
            alive, n = stage.lookup(alive), n + 1
        reason = F.coalesce(*[F.when(flag, name) if dict(alive.select(flag.alias("x")).dtypes)["x"] == "boolean" else flag for name, flag in stage.gates])
        judged = cut(alive.withColumn("first_fail", reason))
        rejected = judged.where("first_fail IS NOT NULL").select("id", "first_fail", F.lit(n).alias("lookups"))
        done = rejected if done is None else done.unionByName(rejected)
        alive = judged.where("first_fail IS NULL").select(*rows.columns)
    return done.unionByName(alive.select("id", F.lit(None).cast("string").alias("first_fail"), F.lit(n).alias("lookups")))


def full_chain(jobs: DataFrame, rules: DataFrame, terms: DataFrame, known: DataFrame, pages: DataFrame) -> DataFrame:
    """jobs (with age, in days) through all gates; rules (name) and terms (term) are blacklists, known (kind, key) the keys of known_keys(), pages (id, body, page_age) the fetched texts.

    Order: blacklist, term, age, title, dedup, senior and other title gates, tech, address, location, page restriction, page age, pay, experience, quality, integrity.
    """
    title = F.col("title")

    def by_company(alive: DataFrame) -> DataFrame:
        words = whole_word_terms(alive, terms).select(F.col("id").alias("_w"), F.lit(True).alias("_term"))
        return looked_up(alive, company_rules(alive, rules), "company").join(words, F.col("id") == F.col("_w"), "left").drop("_w")

    def by_key(alive: DataFrame) -> DataFrame:
        urls, keys = (known.where(F.col("kind") == kind).select(F.col("key").alias(f"_{kind}"), F.lit(True).alias(f"_is_{kind}")).distinct() for kind in ("url", "key"))
        keyed = alive.withColumn("_u", F.when(C.is_identifying_url(F.col("url")), C.canonical_url(F.col("url"))).otherwise(F.concat(F.lit("#"), "id"))).withColumn("_k", dedup.dedup_key(F.col("company"), title))
        return keyed.join(urls, F.col("_u") == F.col("_url"), "left").join(keys, F.col("_k") == F.col("_key"), "left")

    by_page = lambda alive: alive.join(pages.select(F.col("id").alias("_p"), "body", "page_age"), F.col("id") == F.col("_p"), "left")
    by_title = lambda alive: looked_up(alive, title_verdicts(alive), "title")
    return run_chain(jobs, (
        Stage("blacklist", by_company, (("blacklist", F.coalesce("listed", F.lit(False)) | F.coalesce("_term", F.lit(False))), ("term", gates.should_drop_summer(title, F.col("job_type"))), ("age", gates.too_old(F.col("age"))))),
        Stage("title", by_title, (("title", F.concat(F.lit("title:"), "validity")),)),
        Stage("dedup", by_key, (("duplicate_url", F.coalesce("_is_url", F.lit(False))), ("duplicate_key", F.coalesce("_is_key", F.lit(False))))),
        Stage("role", by_title, (("gate", F.concat(F.lit("gate:"), "gate")), ("tech", ~F.col("technical")), ("address", ~gates.is_job_url(F.col("url"))), ("location", ~gates.is_us_location(F.col("location"))))),
        Stage("page", by_page, (("page", F.concat(F.lit("page:"), restriction(F.col("body")))), ("page_age", gates.too_old(F.col("page_age"), keep_undated=True)), ("pay", gates.pay_reason(F.col("body"))), ("experience", gates.experience_reason(F.col("body"))),
                               ("quality", gates.write_quality() < 4), ("integrity", F.concat(F.lit("integrity:"), gates.integrity_reason())))),
    ))


#: the chain's tables: new postings from 1996 on, whose ids end in all digits; older ones are known; rules and a term of the blacklists
RULES, TERMS = ("Acme 13", "Acme 3 Holdings"), ("analyst co op",)


def _inputs(spark, sf_dir):
    rows = tables.jobs(spark, sf_dir).withColumn("title", F.concat("title", F.when(F.col("id") % 7 < 5, F.concat(F.lit(" "), (F.col("id") % 97).cast("string"))).otherwise("")))
    new = rows.where("processed_at >= '1996'").withColumn("age", F.when(F.col("id") % 11 == 0, None).otherwise((F.col("id") % 5).cast("int")))
    pages = tables.samples(spark, sf_dir).select("id", "body", F.when(F.col("id") % 3 > 0, (F.col("id") % 6).cast("int")).alias("page_age"))
    named = lambda values, name: spark.createDataFrame([(v,) for v in values], f"{name} string")
    return new, named(RULES, "name"), named(TERMS, "term"), dedup.known_keys(rows.where("processed_at < '1996'")), pages


_PAGE = "CASE id % 28 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(gates.TEXT_VERDICTS) if v) + " END"
_KEY = "regexp_replace(lower(regexp_replace(trim(regexp_replace(regexp_replace(company, '[,.]', ' ', 'g'), '\\s+', ' ', 'g')), '( (Inc|LLC|Technologies|Group))+$', '')), '[^a-z0-9]', '', 'g')"
query("f25_full_chain", f"""WITH r AS (SELECT *, title || CASE WHEN id % 7 < 5 THEN ' ' || id % 97 ELSE '' END AS t, {_KEY} AS k, regexp_replace(regexp_replace(lower(url), '[?].*', ''), '/+$', '') AS u FROM jobs), j AS (SELECT *, regexp_replace(lower(t), '[^a-z0-9]', '', 'g') AS s FROM r),
    old AS (SELECT * FROM j WHERE processed_at < '1996'), new AS (SELECT * FROM j WHERE processed_at >= '1996'),
    f AS (SELECT id, CASE WHEN k IN ('acme13', 'acme1', 'acme3') OR starts_with(k, 'acme13') OR (starts_with(k, 'acme3') AND length(k) >= 4) THEN 'blacklist' WHEN contains(' ' || trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')) || ' ', ' analyst co op ') THEN 'blacklist'
      WHEN title LIKE 'Summer 2027%' AND coalesce(job_type, '') <> 'Full Time' THEN 'term' WHEN id % 11 = 0 OR id % 5 > 3 THEN 'age' WHEN url LIKE 'https://boards%' AND u IN (SELECT u FROM old WHERE url LIKE 'https://boards%') THEN 'duplicate_url' WHEN (k, s) IN (SELECT (k, s) FROM old) THEN 'duplicate_key'
      WHEN title = 'Solutions Engineer' THEN 'gate:business_role' WHEN title LIKE 'Summer 2027%' THEN 'gate:wrong_term' WHEN title = 'Software Engineer III' OR (id % 7 < 5 AND id % 97 IN (3, 4, 5) AND NOT regexp_matches(lower(title), 'intern|co-op')) THEN 'gate:too_senior' WHEN url IS NULL OR url NOT LIKE 'http%' OR url LIKE '%google.com/search%' THEN 'address'
      WHEN {_PAGE} IS NOT NULL THEN 'page:' || {_PAGE} WHEN id % 3 > 0 AND id % 6 > 3 THEN 'page_age' WHEN id % 28 = 24 THEN 'low_pay' WHEN id % 28 = 26 THEN 'experience'
      WHEN CASE WHEN company IN ('', 'Unknown') THEN 0 ELSE 1 END + 1 + CASE WHEN location = 'Unknown' THEN 0 ELSE 1 END + CASE WHEN job_id = 'N/A' THEN 0 ELSE 1 END + 1 + CASE WHEN remote = 'Unknown' THEN 0 ELSE 1 END + CASE WHEN sponsorship = 'Unknown' THEN 0 ELSE 1 END < 4 THEN 'quality' WHEN company = '' THEN 'integrity:empty_company' END AS first_fail FROM new)
    SELECT * FROM f""", "jobs")(lambda s, d: full_chain(*_inputs(s, d)).select("id", "first_fail"))  # fmt: skip
