"""Q11: the audit after a write as a change set, and its merge into the table by rewriting the partitions that it touches.

An action is a row (id, check, action, column, value): fix sets a column, delete removes the row, flag only reports. The merge reads
the partitions that hold rows which an action would really change, and replaces those alone, so merging the same set again
writes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.functions import columns as C
from postmill.operators import chain, dedup, enrich
from postmill.operators.lineage import cut, ranked, shared_path
from postmill.plans.registry import query, sql_company_key
from postmill.sources import tables

#: fixed values: words of places that are no places, and of agencies
NO_PLACE = ("responsibilities", "requirements", "qualifications", "experience", "salary", "benefits", "apply now", "all jobs", "about us")
AGENCIES = ("staffing", "recruiting", "recruitment", "talent solutions", "employment agency", "manpower")


def actions(jobs: DataFrame, clearance: DataFrame, names: DataFrame, agencies: tuple[str, ...] = AGENCIES) -> DataFrame:
    """id, check, action, column, value: what eleven checks would do to jobs. clearance: name; names: slug, name (company names to set right)."""
    title, url, place = F.col("title"), F.col("url"), F.trim(C.text(F.col("location")))
    found_id, slug = C.board_job_id(url), C.company_slug(url)
    link, searched = F.concat(F.lit("https://www.google.com/search?q="), F.url_encode(F.concat_ws(" ", "company", "title", F.lit("careers")))), C.text(url).contains("google.com/search")
    state, city = F.regexp_extract(place, rf"^({'|'.join(C.STATES)}) ([A-Z][A-Za-z ]+)$", 1), F.regexp_extract(place, rf"^({'|'.join(C.STATES)}) ([A-Z][A-Za-z ]+)$", 2)
    act = lambda check, when, action, column="", value=None: F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(check).alias("check"), F.lit(action).alias("action"), F.lit(column).alias("column"), (F.lit(None) if value is None else value).cast("string").alias("value")))
    rows = chain.looked_up(jobs, chain.title_verdicts(jobs), "title")
    rows = chain.looked_up(rows, chain.company_rules(jobs, clearance), "company")
    fixes = names.select(C.squash(F.col("slug")).alias("_slug"), F.col("name").alias("_right")).dropDuplicates(["_slug"])
    companies = jobs.select("company").distinct().join(fixes, C.squash(F.col("company")) == F.col("_slug")).select("company", "_right")
    rows = chain.looked_up(rows, companies, "company")
    own = F.array(
        act("01_url_company", (slug != "") & ~enrich.same_employer(F.col("company"), slug), "flag"), act("02_non_tech", F.col("gate").isNotNull() | ~F.col("technical"), "delete"), act("03_missing_id", (F.col("job_id") == "N/A") & found_id.isNotNull() & (found_id != ""), "fix", "job_id", found_id),
        act("04_search_link", searched & (url != link), "fix", "url", link), act("06_clearance", F.col("listed"), "delete"), act("07_agency", F.lower("company").rlike("|".join(agencies)), "delete"), act("08_company_name", F.col("_right") != F.col("company"), "fix", "company", F.col("_right")),
        act("09_location", F.lower(place).rlike("|".join(NO_PLACE)) | (F.length(place) > 60), "fix", "location", F.lit("Unknown")), act("09_state_first", state != "", "fix", "location", F.concat(city, F.lit(", "), state)),
    )
    first = rows.select("id", F.explode(F.filter(own, lambda x: x.isNotNull())).alias("x")).select("id", "x.*")
    gone = lambda df, check: df.select("id", F.lit(check).alias("check"), F.lit("delete").alias("action"), F.lit("").alias("column"), F.lit(None).cast("string").alias("value"))
    return first.unionByName(gone(shifted(jobs), "10_row_shift")).unionByName(gone(dedup.repeated_job_ids(jobs), "11_repeated_id"))


def shifted(jobs: DataFrame) -> DataFrame:
    """Rows whose title the two rows before have as well, or the one before and the one after, in the order of ids.

    Rows are numbered by ranges; each hands its title to its neighbours' numbers, so no window runs over the table.
    """
    numbered = ranked(jobs.select("id", "title"), "n", F.col("id"))
    handed = F.array(*[F.struct((F.col("n") + k).alias("to"), F.lit(k).alias("k")) for k in (0, 1, 2, -1)])
    near = numbered.select("id", "title", F.explode(handed).alias("h")).groupBy("h.to").agg(*[F.max(F.when(F.col("h.k") == k, F.col(c))).alias(a) for k, c, a in ((0, "id", "id"), (0, "title", "t"), (1, "title", "p1"), (2, "title", "p2"), (-1, "title", "n1"))])
    return near.where("id IS NOT NULL AND t <> '' AND t = p1 AND (t = p2 OR t = n1)").select("id")


def merge(spark: SparkSession, path: str, partitions: tuple[str, ...], changes: DataFrame) -> int:
    """Merges changes into the Parquet table at path; the number of partitions that were written anew.

    Deletes go before fixes; of two fixes of a column the first by check counts. Partitions without an effective change aren't read
    for writing, and one that loses all its rows is removed.
    """
    table = spark.read.option("basePath", path).parquet(path)
    columns = [c for c in table.columns if c not in ("id", *partitions)]
    fixes = changes.where("action = 'fix'").groupBy("id", "column").agg(F.min_by("value", "check").alias("value")).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("column", "value"))).alias("_fix"))
    marked = changes.where("action = 'delete'").select("id").distinct().withColumn("_gone", F.lit(True)).join(fixes, "id", "full")
    fixed = lambda c: F.coalesce(F.try_element_at(F.col("_fix"), F.lit(c)).cast(table.schema[c].dataType), F.col(c))
    effective = F.coalesce("_gone", F.lit(False))
    for c in columns:
        effective = effective | ~fixed(c).eqNullSafe(F.col(c))
    both = table.join(marked, "id", "left")
    touched = cut(both.where(effective).select(*partitions).distinct())
    n = touched.count()
    if not n:
        return 0
    same = F.lit(True)
    for p in partitions:
        same = same & F.col(p).eqNullSafe(F.col(f"_{p}"))
    held = both.join(touched.select(*[F.col(p).alias(f"_{p}") for p in partitions]), same, "left_semi").where(~F.coalesce("_gone", F.lit(False)))
    # the result is written aside first: it is read from the partitions that it replaces
    staged = cut(held.select(*[fixed(c).alias(c) if c in columns else F.col(c) for c in table.columns]))
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    empty = touched.join(staged.select(*partitions).distinct().select(*[F.col(p).alias(f"_{p}") for p in partitions]), same, "left_anti")
    for row in empty.collect():  # partitions, not rows
        folder = spark._jvm.org.apache.hadoop.fs.Path(path + "".join(f"/{p}={row[p]}" for p in partitions))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return n


#: the audit's tables: a company whose postings are of another name, and names of clearance
CLEARANCE, NAMES = ("Acme 13 Labs",), (("acme 5", "Acme Five"), ("acme 6 inc", "Acme Six"))


def _audited(spark, sf_dir):
    location = F.when(F.col("id") % 9 == 0, "MA Boston").when(F.col("id") % 9 == 1, "Responsibilities include").otherwise(F.col("location"))
    company = F.when(F.col("id") % 41 == 0, "Best Staffing").otherwise(F.col("company"))
    ids = F.when(F.col("job_id") == "N/A", "N/A").otherwise(F.concat(F.lit("JR-"), (F.col("id") % 500).cast("string")))
    title = F.when((F.col("id") % 64).between(1, 4), "Data Engineer").otherwise(F.col("title"))
    return tables.jobs(spark, sf_dir).select("id", "url", company.alias("company"), title.alias("title"), location.alias("location"), ids.alias("job_id"), "outcome", F.substring("processed_at", 1, 4).alias("year"))


def _lists(spark):
    return spark.createDataFrame([(x,) for x in CLEARANCE], "name string"), spark.createDataFrame(NAMES, "slug string, name string")


def _merged(spark, sf_dir):
    """Written, audited and merged; then merged again, which must touch nothing."""
    path = shared_path(spark, "audited")
    _audited(spark, sf_dir).write.partitionBy("outcome", "year").parquet(path)
    changes = cut(actions(spark.read.parquet(path), *_lists(spark)))
    merge(spark, path, ("outcome", "year"), changes)
    again = merge(spark, path, ("outcome", "year"), changes)
    return spark.read.parquet(path).select("id", "url", "company", "location", "job_id", F.lit(again).cast("long").alias("touched_again"))


_K = sql_company_key("company")
AUDIT = f"""a AS (SELECT id, url, CASE WHEN id % 41 = 0 THEN 'Best Staffing' ELSE company END AS company, CASE WHEN id % 64 BETWEEN 1 AND 4 THEN 'Data Engineer' ELSE title END AS title, CASE id % 9 WHEN 0 THEN 'MA Boston' WHEN 1 THEN 'Responsibilities include' ELSE location END AS location, CASE WHEN job_id = 'N/A' THEN job_id ELSE 'JR-' || id % 500 END AS job_id FROM jobs),
    k AS (SELECT *, regexp_replace({_K}, '[^a-z0-9]', '', 'g') AS ck, regexp_replace(lower(company), '[^a-z0-9]', '', 'g') AS sq, lead(title) OVER w AS n1, lag(title) OVER w AS p1, lag(title, 2) OVER w AS p2, row_number() OVER (PARTITION BY company, job_id ORDER BY id) AS nth,
      'https://www.google.com/search?q=' || replace(url_encode(company || ' ' || title || ' careers'), '%20', '+') AS link, CASE WHEN url LIKE '%greenhouse.io%' THEN regexp_extract(url, '/jobs/([0-9]+)', 1) END AS board FROM a WINDOW w AS (ORDER BY id)),
    x AS (SELECT id, '02_non_tech' AS "check", 'delete' AS action, '' AS "column", NULL AS value FROM k WHERE title IN ('Solutions Engineer', 'Software Engineer III', 'Summer 2027 Intern - Data') UNION ALL SELECT id, '03_missing_id', 'fix', 'job_id', board FROM k WHERE job_id = 'N/A' AND board <> ''
      UNION ALL SELECT id, '04_search_link', 'fix', 'url', link FROM k WHERE url LIKE '%google.com/search%' AND url <> link UNION ALL SELECT id, '06_clearance', 'delete', '', NULL FROM k WHERE length(ck) >= 4 AND (starts_with(ck, 'acme13') OR starts_with('acme13', ck)) UNION ALL SELECT id, '07_agency', 'delete', '', NULL FROM k WHERE company = 'Best Staffing'
      UNION ALL SELECT id, '08_company_name', 'fix', 'company', CASE sq WHEN 'acme5' THEN 'Acme Five' ELSE 'Acme Six' END FROM k WHERE sq IN ('acme5', 'acme6inc') UNION ALL SELECT id, '09_location', 'fix', 'location', 'Unknown' FROM k WHERE location = 'Responsibilities include' UNION ALL SELECT id, '09_state_first', 'fix', 'location', 'Boston, MA' FROM k WHERE location = 'MA Boston'
      UNION ALL SELECT id, '10_row_shift', 'delete', '', NULL FROM k WHERE title = p1 AND (title = p2 OR title = n1) UNION ALL SELECT id, '11_repeated_id', 'delete', '', NULL FROM k WHERE job_id NOT IN ('', 'N/A') AND nth > 1)"""
query("q11_actions", f"WITH {AUDIT} SELECT * FROM x", "jobs")(lambda s, d: actions(_audited(s, d), *_lists(s)).where("action <> 'flag'"))
query("q11_merged", f"""WITH {AUDIT}, f AS (SELECT id, max(value) FILTER ("column" = 'url') AS u, max(value) FILTER ("column" = 'company') AS c, max(value) FILTER ("column" = 'location') AS l, max(value) FILTER ("column" = 'job_id') AS j FROM x GROUP BY id)
    SELECT a.id, coalesce(u, url) AS url, coalesce(c, company) AS company, coalesce(l, location) AS location, coalesce(j, job_id) AS job_id, 0::BIGINT AS touched_again FROM a LEFT JOIN f ON a.id = f.id WHERE a.id NOT IN (SELECT id FROM x WHERE action = 'delete')""", "jobs")(_merged)  # fmt: skip
