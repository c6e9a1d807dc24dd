"""Job ids from addresses by patterns whose confidences are learned (P31, A41): each run's outcomes update them, a version per run.

The confidence of a pattern is an exponential mean of its successes in order. A version is a folder of one row per pattern,
written whole and named by its number and its run, so a run is learned once, whatever is repeated, and the next run reads the latest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.functions import columns as C
from postmill.operators.lineage import ranked, shared_path
from postmill.plans.registry import query
from postmill.sources import tables

KEEP = 0.95
#: fixed values: patterns of addresses, in order, and the confidence that each starts with
PATTERNS = (
    ("query_id", r"[?&](?:gh_jid|job_?id|jid)=([A-Za-z0-9-]+)", 0.95), ("jobs_path", r"/jobs?/(\d{4,})", 0.9), ("requisition", r"_((?:JR|R|REQ)-?\d+)", 0.9), ("uuid", r"/([0-9a-f]{8}-[0-9a-f-]{27})", 0.85), ("number", r"/(\d{5,})(?:/|$|\?)", 0.6),
)


def starting(spark: SparkSession) -> DataFrame:
    """pattern, confidence, tries before any run."""
    return spark.createDataFrame([(name, c, 0) for name, _, c in PATTERNS], "pattern string, confidence double, tries long")


def candidates(url: Column) -> Column:
    """array of (pattern, job_id): every pattern that an address fits, in order."""
    u = C.text(url)
    return F.filter(F.array(*[F.struct(F.lit(name).alias("pattern"), F.regexp_extract(u, p, 1).alias("job_id")) for name, p, _ in PATTERNS]), lambda x: x["job_id"] != "")


def votes(rows: DataFrame, confidences: DataFrame) -> DataFrame:
    """id, pattern, job_id, confidence of rows (id, url): of the patterns that fit, the most confident, ties to the first by name; null if none."""
    held = confidences.agg(F.map_from_entries(F.collect_list(F.struct("pattern", "confidence"))).alias("_c"))  # a row per pattern
    scored = F.transform(candidates(F.col("url")), lambda x: F.struct((-F.coalesce(F.try_element_at(F.col("_c"), x["pattern"]), F.lit(0.0))).alias("minus"), x["pattern"].alias("pattern"), x["job_id"].alias("job_id")))
    best = F.get(F.array_sort(scored), F.lit(0))
    return rows.crossJoin(F.broadcast(held)).select("id", best.alias("b")).select("id", "b.pattern", "b.job_id", F.round(-F.col("b.minus"), 6).alias("confidence"))


def updated(confidences: DataFrame, outcomes: DataFrame, keep: float = KEEP) -> DataFrame:
    """The confidences after a run's outcomes (pattern, at, id, ok), in order of at and id: c * keep + (1 - keep) * ok for each.

    This is a weighted sum: k tries before the end a success weighs (1 - keep) * keep ** k. Tries are numbered by ranges, so a
    pattern with all the tries is no task of its own. Unknown patterns start at 0; patterns without tries keep what they have.
    """
    numbered = ranked(outcomes.select("pattern", "at", "id", "ok"), "n", F.col("at"), F.col("id"), by=("pattern",))
    total = outcomes.groupBy("pattern").agg(F.count(F.lit(1)).alias("total"))
    gain = F.when(F.col("ok"), (1 - keep) * F.pow(F.lit(keep), F.col("total") - F.col("n"))).otherwise(0.0)
    run = numbered.join(total, "pattern").groupBy("pattern").agg(F.sum(gain).alias("gain"), F.max("total").alias("total"))
    before, n = F.coalesce("confidence", F.lit(0.0)), F.coalesce("total", F.lit(0))
    return confidences.join(run, "pattern", "full").select("pattern", (before * F.pow(F.lit(keep), n) + F.coalesce("gain", F.lit(0.0))).alias("confidence"), (F.coalesce("tries", F.lit(0)) + n).cast("long").alias("tries"))


def versions(spark: SparkSession, folder: str) -> list[tuple[int, str, str]]:
    """(number, run, path) of the complete versions in a folder, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path)]
    done = [p for p in found if p.getName().startswith("version=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted((int(p.getName()[8:].split("-", 1)[0]), p.getName().split("-", 1)[1], p.toString()) for p in done)


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """The confidences of the latest version, or the starting ones."""
    found = versions(spark, folder)
    return spark.read.parquet(found[-1][2]) if found else starting(spark)


def learn(spark: SparkSession, folder: str, run: str, outcomes: DataFrame) -> int:
    """Learns a run's outcomes on top of the latest version; the number of the run's version. A run that was learned before changes nothing."""
    found = versions(spark, folder)
    for number, name, _ in found:
        if name == run:
            return number
    number = found[-1][0] + 1 if found else 1
    updated(latest(spark, folder), outcomes).coalesce(1).write.mode("overwrite").parquet(f"{folder}/version={number}-{run}")  # a row per pattern
    return number


def _addresses(spark, sf_dir):
    """Jobs under addresses of five shapes, some of which fit two patterns."""
    n = F.col("id").cast("string")
    shape = F.when(F.col("id") % 5 == 0, F.concat(F.lit("https://a.com/x?gh_jid="), n)).when(F.col("id") % 5 == 1, F.concat(F.lit("https://a.com/jobs/1000"), n)).when(F.col("id") % 5 == 2, F.concat(F.lit("https://a.com/p_JR-"), n, F.lit("/10000"), n)).when(F.col("id") % 5 == 3, F.concat(F.lit("https://a.com/10000"), n))
    return tables.jobs(spark, sf_dir).select("id", shape.alias("url"), F.col("processed_at").alias("at"), (F.col("outcome") == "valid").alias("ok"))


def _learned(spark, sf_dir):
    """Two runs are learned, the second twice; then all rows are judged."""
    rows, folder = _addresses(spark, sf_dir), shared_path(spark, "confidences")
    for run in ("1995", "1996", "1996"):
        tried = rows.where(F.col("at").startswith(run))
        learn(spark, folder, run, votes(tried, latest(spark, folder)).where("pattern IS NOT NULL").join(tried.select("id", "at", "ok"), "id").select("pattern", "at", "id", "ok"))
    return votes(rows, latest(spark, folder)).where("pattern IS NOT NULL")


_STEP = """{1} AS (SELECT p.pattern, c0 * pow(0.95::DOUBLE, coalesce(n, 0)) + coalesce(g, 0) AS c0 FROM {0} p LEFT JOIN (SELECT pattern, count(*) AS n, sum(CASE WHEN ok THEN 0.05::DOUBLE * pow(0.95::DOUBLE, b) ELSE 0 END) AS g FROM (SELECT pattern, ok, row_number() OVER (PARTITION BY pattern ORDER BY seen DESC, id DESC) - 1 AS b FROM
    (SELECT f.id, seen, ok, arg_min(f.pattern, (-c0, f.pattern)) AS pattern FROM fit f JOIN {0} q ON f.pattern = q.pattern WHERE starts_with(seen, '{2}') GROUP BY 1, 2, 3)) GROUP BY 1) r ON p.pattern = r.pattern)"""
query("p31_a41_learned_ids", f"""WITH fit AS (SELECT id, processed_at AS seen, outcome = 'valid' AS ok, unnest(CASE id % 5 WHEN 0 THEN ['query_id'] WHEN 1 THEN ['jobs_path', 'number'] WHEN 2 THEN ['requisition', 'number'] WHEN 3 THEN ['number'] ELSE [] END) AS pattern FROM jobs),
    v0(pattern, c0) AS (VALUES ('query_id', 0.95::DOUBLE), ('jobs_path', 0.9), ('requisition', 0.9), ('uuid', 0.85), ('number', 0.6)), {_STEP.format('v0', 'v1', '1995')}, {_STEP.format('v1', 'v2', '1996')},
    b AS (SELECT f.id, arg_min(f.pattern, (-c0, f.pattern)) AS pattern, max(c0) AS c FROM fit f JOIN v2 ON f.pattern = v2.pattern GROUP BY 1)
    SELECT id, pattern, CASE WHEN id % 5 = 2 AND pattern = 'requisition' THEN 'JR-' || id WHEN id % 5 = 1 THEN '1000' || id WHEN id % 5 = 0 THEN id::VARCHAR ELSE '10000' || id END AS job_id, round(c, 6) AS confidence FROM b""", "jobs")(_learned)  # fmt: skip
