"""Queries over operators that write files and read them back, and over lookups and repairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.functions import columns as C
from postmill.operators import checks, enrich, layers, sinks
from postmill.operators.lineage import shared_path
from postmill.plans.registry import query, sql_company_key
from postmill.sources import feeds, tables


@query("k1_k2_s2_layers", "SELECT p_source, substr(p_week, 1, 4) AS p_year, count(*) AS n FROM bronze GROUP BY 1, 2", "bronze")
def _layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer is written, then the partitions of one source are written again; both are read as one."""
    rows, path = layers.bronze(tables.jobs(spark, sf_dir)).select("id", "title", "p_source", F.substring("p_week", 1, 4).alias("p_year")), shared_path(spark, "layer")
    layers.write_layer(rows, path, "p_source", "p_year")
    layers.write_layer(rows.where("p_source = 'building'"), path, "p_source", "p_year")
    return layers.read_layer(spark, path).groupBy("p_source", "p_year").agg(F.count(F.lit(1)).alias("n"))


@query("k8_snapshot", "SELECT source, count(*) AS n FROM jobs GROUP BY 1", "jobs")
def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "snapshot")
    sinks.write_snapshot(tables.jobs(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.schema("source string, n long").json(path)


@query("k9_k10_history", "SELECT night AS snapshot_date, count(*) AS n, count(*) AS dated FROM jobs, (VALUES ('2001-07-01'), ('2001-07-02')) t(night) GROUP BY 1", "jobs")
def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two nights; the second is loaded twice and counts once."""
    path, rows = shared_path(spark, "history"), tables.jobs(spark, sf_dir).select("id", "company", F.try_to_date(F.substring("processed_at", 1, 10)).alias("entry_date"))
    for night in ("2001-07-01", "2001-07-02", "2001-07-02"):
        sinks.write_history(rows, path, night)
    return spark.read.parquet(path).groupBy(F.col("snapshot_date").cast("string").alias("snapshot_date")).agg(F.count(F.lit(1)).alias("n"), F.count("entry_date").alias("dated"))


query("k11_p6_conformed", "SELECT id, TRY_CAST(job_id AS BIGINT) AS job_id, processing_time_ms::DOUBLE AS processing_time_ms, NULL::VARCHAR AS note FROM jobs", "jobs")(
    lambda s, d: layers.conformed(tables.jobs(s, d).select("id", "job_id", F.col("processing_time_ms").cast("string").alias("processing_time_ms")), T.StructType([T.StructField("id", T.LongType()), T.StructField("job_id", T.LongType()), T.StructField("processing_time_ms", T.DoubleType()), T.StructField("note", T.StringType())]))
)
query("k13_corrections", "SELECT company, 'title' AS field, title AS old, title || '!' AS new FROM jobs WHERE id % 7 <> 0", "jobs")(
    lambda s, d: sinks.read_corrections(tables.jobs(s, d).select(F.when(F.col("id") % 7 == 0, "{broken").otherwise(F.to_json(F.struct("company", F.lit("title").alias("field"), F.col("title").alias("old"), F.concat("title", F.lit("!")).alias("new")))).alias("value")))
)
query("o7_numbered", "SELECT id, row_number() OVER (ORDER BY id) AS sr_no FROM jobs", "jobs")(lambda s, d: sinks.renumbered(tables.jobs(s, d).select("id"), "id"))
query("p17_p18_dates", "SELECT id, substr(processed_at, 1, 10)::DATE AS day, substr(processed_at, 1, 7) AS month FROM jobs", "jobs")(
    lambda s, d: tables.jobs(s, d).select("id", C.entry_date(F.concat(F.lit("Rescued "), F.date_format(F.to_date(F.substring("processed_at", 1, 10)), "MMM d, yyyy")), F.lit(tables.JOBS_AS_OF).cast("date")).alias("day")).withColumn("month", F.date_format("day", "yyyy-MM"))
)
query("p38_days_ago", "SELECT id, CASE id % 5 WHEN 0 THEN id % 30 WHEN 1 THEN id % 8 * 7 WHEN 2 THEN 0 WHEN 3 THEN 1 ELSE id % 6 * 30 END::INT AS days FROM jobs", "jobs")(
    lambda s, d: tables.jobs(s, d).select("id", C.days_ago(F.expr("CASE id % 5 WHEN 0 THEN concat(id % 30, '+ days ago') WHEN 1 THEN concat('about ', id % 8, ' weeks ago') WHEN 2 THEN concat(id % 20, ' hours ago') WHEN 3 THEN 'Yesterday' ELSE concat('Posted ', id % 6, ' Months Ago') END")).alias("days"))
)
query("p50_repaired", "SELECT id, CASE WHEN id % 5 = 0 THEN 'Unknown' ELSE remote END AS remote, substr(processed_at, 1, 10) AS entry_date, coalesce(source, 'none') AS source, sponsorship FROM jobs", "jobs")(
    lambda s, d: enrich.repaired(
        tables.jobs(s, d).selectExpr("id", "substr(processed_at, 1, 10) AS day", "coalesce(source, 'none') AS src", "remote AS r", "sponsorship AS sp").selectExpr("id", "IF(id % 5 = 0, day, r) AS remote", "IF(id % 5 = 0, src, day) AS entry_date", "IF(id % 5 = 0, sp, src) AS source", "IF(id % 5 = 0, 'lost', sp) AS sponsorship")
    )
)


@query("q6_q7_q8_gate", f"""WITH x AS (SELECT *, right(p_week, 2)::INT AS w, {sql_company_key("company")} AS k FROM gated WHERE p_week <> 'unknown'), e AS (SELECT x.*, r FROM x, range(10) t(r) WHERE r = 0 OR w % 5 = 0), l AS (SELECT * FROM e WHERE w % 7 <> 0 OR id % 2 = 1),
    n AS (SELECT p_week, count(*) AS extracted FROM e GROUP BY 1), f AS (SELECT p_week, count(*) AS landed, count(DISTINCT k || '|' || lower(trim(title)) || '|' || lower(trim(coalesce(source, 'none')))) FILTER (reason IS NULL) AS silver FROM l GROUP BY 1),
    y AS (SELECT p_week FROM n UNION SELECT (1990 + k) || '-W01' FROM range(40) t(k)), j AS (SELECT p_week, coalesce(extracted, 0) AS extracted, coalesce(landed, 0) AS landed, coalesce(silver, 0) AS silver FROM y LEFT JOIN n USING (p_week) LEFT JOIN f USING (p_week))
    SELECT *, CASE WHEN landed > 0 THEN round(silver / landed::DOUBLE, 6) ELSE 0 END AS rate, CASE WHEN extracted = 0 THEN 'skip' WHEN extracted <> landed THEN 'lost' WHEN landed = 0 OR silver / landed::DOUBLE < 0.2 THEN 'stop' ELSE 'pass' END AS verdict FROM j""", "gated")
def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth week's rows come ten times, every seventh week loses half of its rows, and some weeks have none."""
    rows = layers.bronze(tables.jobs(spark, sf_dir)).where("p_week <> 'unknown'").withColumn("_w", F.right("p_week", F.lit(2)).cast("int"))
    extracted = rows.withColumn("_copy", F.explode(F.when(F.col("_w") % 5 == 0, F.sequence(F.lit(0), F.lit(9))).otherwise(F.array(F.lit(0)))))
    weeks = rows.select("p_week").unionByName(spark.range(40).select(F.concat((F.col("id") + 1990).cast("string"), F.lit("-W01")).alias("p_week")))
    return checks.week_gate(extracted, extracted.where("_w % 7 <> 0 OR id % 2 = 1"), weeks)


@query("s6_employer_export", "SELECT name, sum(approvals)::BIGINT AS approvals FROM employers GROUP BY 1", "employers")
def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employers as UTF-16 text with tabs, with approvals split over two columns."""
    path = shared_path(spark, "export")
    rows = tables.employers(spark, sf_dir).select(F.col("name").alias("Petitioner Employer"), F.floor(F.col("approvals") / 2).alias("Initial Approval"), F.ceil(F.col("approvals") / 2).alias("Continuing Approval"))
    rows.write.csv(path, sep="\t", encoding="UTF-16", header=True)
    return feeds.employer_export(spark, path).groupBy("name").agg(F.sum("approvals").cast("long").alias("approvals"))


@query("s8_filings_export", f"WITH k AS (SELECT regexp_replace({sql_company_key('name')}, '[^a-z0-9]', '', 'g') AS employer_key, name, approvals FROM employers) SELECT employer_key, max(approvals)::BIGINT AS lcas FROM k WHERE length(employer_key) >= 4 GROUP BY 1", "employers")
def _filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings as files that hold one JSON list each."""
    path = shared_path(spark, "filings")
    rows = tables.employers(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("name", "approvals"), F.lit(16)))
    lists = rows.groupBy("part").agg(F.to_json(F.collect_list(F.struct("name", F.col("approvals").alias("lcas")))).alias("value"))
    lists.repartition(16, "part").write.partitionBy("part").text(path)
    return feeds.filings_export(spark, f"{path}/*").select("employer_key", "lcas")


query("j10_mapped", "SELECT id, CASE source WHEN 'BUILDING' THEN 'Builders' WHEN 'MACHINERY' THEN 'Machines' ELSE source END AS source FROM jobs", "jobs")(
    lambda s, d: enrich.mapped(tables.jobs(s, d).select("id", "source"), tables.table(s, d, "customer").select(F.col("c_mktsegment").alias("key")).distinct().select("key", F.when(F.col("key") == "BUILDING", "Builders").when(F.col("key") == "MACHINERY", "Machines").otherwise(F.col("key")).alias("value")), "source", "source")
)
query("j19_contact_lookup", f"""WITH c AS (SELECT {sql_company_key('name')} AS c, min(lower(replace(name, ' ', '')) || '@x.com') AS email FROM employers WHERE approvals % 3 < 2 GROUP BY 1)
    SELECT jobs.id, c.email FROM jobs LEFT JOIN c ON {sql_company_key('company')} = c.c AND jobs.title = 'Software Engineer II'""", "jobs", "employers")(
    lambda s, d: enrich.contact_lookup(tables.jobs(s, d).select("id", "company", "title"), tables.employers(s, d).select(F.col("name").alias("company"), F.lit("software engineer-ii").alias("role"), F.concat(F.lower(F.replace("name", F.lit(" "), F.lit(""))), F.lit("@x.com")).alias("email"), (F.col("approvals") % 3).alias("bounces"))).select("id", "email")
)
query("a49_learned_report", """SELECT 'size' AS section, unnest(['companies', 'sources', 'accepted']) AS label, unnest([count(DISTINCT company), count(DISTINCT source), count(*) FILTER (outcome = 'valid')]) AS n FROM jobs
    UNION ALL (SELECT 'error', rejection_reason, count(*) FROM jobs WHERE outcome = 'discarded' AND rejection_reason <> '' GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10) UNION ALL (SELECT 'role', title, count(*) FROM jobs WHERE outcome = 'valid' GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)""", "jobs")(lambda s, d: enrich.learned_report(tables.jobs(s, d)))  # fmt: skip
