"""Rates per source and day, control limits, alerts and streaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.functions import columns as C
from postmill.plans import reports
from postmill.plans.registry import query
from postmill.sources import tables
from postmill.sources.tables import JOBS_AS_OF


def daily_rates(jobs: DataFrame, as_of: str, days: int = 30, densify: bool = False) -> DataFrame:
    """source, day, total, rate of the last days; with `densify` also the days without rows (T8), at rate 0."""
    rows = jobs.where("source NOT IN ('Unknown', '')").where(F.col("processed_at") >= reports.since(as_of, days))
    found = rows.groupBy("source", F.substring("processed_at", 1, 10).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("outcome") == "valid").alias("valid"))
    if densify:
        spans = found.groupBy("source").agg(F.min("day").alias("a")).select("source", F.explode(F.sequence("a", F.lit(as_of).cast("date"))).alias("day"))
        found = spans.join(found, ["source", "day"], "left").na.fill(0, ["total", "valid"])
    return found.select("source", "day", "total", C.valid_rate(100.0 * F.col("valid"), F.col("total"), 10).alias("rate"))


def source_stats(rates: DataFrame, exclude_current: bool = False) -> DataFrame:
    """Per source with three days or more: mean, sample deviation, z of the last day, limits at two deviations.

    With `exclude_current` the last day isn't part of its own baseline (T7). Days per source are few; all sources go at once.
    """
    back = Window.partitionBy("source").orderBy(F.desc("day"))
    rows = rates.withColumn("back", F.row_number().over(back))
    base = F.when(F.col("back") > 1, F.col("rate")) if exclude_current else F.col("rate")
    at = lambda k, c: F.max(F.when(F.col("back") == k, F.col(c)))
    found = rows.groupBy("source").agg(F.avg(base).alias("mean"), F.coalesce(F.stddev_samp(base), F.lit(0.0)).alias("std"), at(1, "rate").alias("current_rate"), at(1, "total").alias("current_volume"), at(2, "rate").alias("previous"), at(3, "rate").alias("before_previous"), F.count(F.lit(1)).alias("days_tracked"), F.sum("total").alias("total_volume"))
    z = F.when(F.col("std") > 0, (F.col("current_rate") - F.col("mean")) / F.col("std")).otherwise(0.0)
    return found.where("days_tracked >= 3").select("*", z.alias("z_score"), (F.col("mean") + 2 * F.col("std")).alias("ucl"), F.greatest(F.lit(0.0), F.col("mean") - 2 * F.col("std")).alias("lcl"))


def alerts(stats: DataFrame) -> DataFrame:
    """Source, alert_type, severity, most severe first."""
    level = F.when(F.col("current_volume") == 0, F.array(F.lit("outage"), F.lit("critical"))).when(F.col("z_score") < -2, F.array(F.lit("degradation"), F.lit("warning"))).when((F.col("current_rate") < F.col("lcl")) & (F.col("std") > 0), F.array(F.lit("anomaly"), F.lit("info")))
    recovered = F.when((F.col("previous") < F.col("lcl")) & (F.col("before_previous") < F.col("lcl")) & (F.col("current_rate") >= F.col("mean")), F.array(F.lit("recovery"), F.lit("info")))
    found = stats.select("source", F.explode(F.filter(F.array(level, recovered), lambda x: x.isNotNull())).alias("a"), "current_rate", "mean")
    return found.select("source", F.col("a")[0].alias("alert_type"), F.col("a")[1].alias("severity"), "current_rate", "mean").orderBy(F.when(F.col("severity") == "critical", 0).when(F.col("severity") == "warning", 1).otherwise(2), "source")


def spc_report(stats: DataFrame) -> DataFrame:
    """A31."""
    status = F.when(F.col("z_score") < -2.5, "critical").when(F.col("z_score") < -2, "warning").when(F.col("current_rate") < F.col("lcl"), "degraded").otherwise("healthy")
    r = lambda c, n=1: F.round(c, n).alias(c)
    return stats.select("source", F.round("mean", 1).alias("mean_rate"), r("std"), r("current_rate"), r("z_score", 2), r("ucl"), r("lcl"), "days_tracked", "total_volume", status.alias("status"))


def drop_alerts(runs: DataFrame) -> DataFrame:
    """Of the last 30 runs of a source (source, run, fetched), the last against the mean of those before."""
    back = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("run")))
    found = runs.withColumn("back", back).where("back <= 30").groupBy("source").agg(F.max(F.when(F.col("back") == 1, F.col("fetched"))).alias("latest"), F.avg(F.when(F.col("back") > 1, F.col("fetched"))).alias("mean"), F.count(F.lit(1)).alias("runs"))
    status = F.when((F.col("latest") == 0) & (F.col("mean") >= 10), "down").when((F.col("mean") > 0) & (F.col("latest") < 0.2 * F.col("mean")), "degraded").otherwise("ok")
    return found.where("runs >= 3").select("source", "latest", F.round("mean", 4).alias("mean"), status.alias("status"))


def lifetime_ratios(runs: DataFrame) -> DataFrame:
    """Per source and run: its ratio and the ratio of all runs up to it."""
    w = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
    ratio = lambda v, n: F.round(v / F.greatest(F.lit(1), n), 6)
    return runs.select("source", "run", ratio(F.col("valid"), F.col("fetched")).alias("recent_ratio"), ratio(F.sum("valid").over(w), F.sum("fetched").over(w)).alias("lifetime_ratio"))


def decay(runs: DataFrame, least_lifetime: float = 0.02) -> DataFrame:
    """After each run, whether the mean of the last seven rates is below half of the lifetime rate."""
    to_now, seven = (Window.partitionBy("source").orderBy("run").rowsBetween(a, 0) for a in (Window.unboundedPreceding, -6))
    rate = C.valid_rate(F.col("valid"), F.col("fetched"), 6)
    rows = runs.withColumn("rate", rate).select("source", "run", F.round(F.avg("rate").over(seven), 6).alias("recent"), C.valid_rate(F.sum("valid").over(to_now), F.sum("fetched").over(to_now), 3).alias("lifetime"), F.count(F.lit(1)).over(seven).alias("n"))
    return rows.select("source", "run", "recent", "lifetime", ((F.col("n") >= 7) & (F.col("lifetime") > least_lifetime) & (F.col("recent") < 0.5 * F.col("lifetime"))).alias("decayed"))


def islands(rows: DataFrame, by: list[str], order: str, condition: Column) -> DataFrame:
    """Runs of consecutive rows that meet a condition: by, first, last, length."""
    w = Window.partitionBy(*by).orderBy(order)
    marked = rows.withColumn("_ok", condition).withColumn("_n", F.row_number().over(w))
    kept = marked.where("_ok").withColumn("_island", F.col("_n") - F.row_number().over(w))
    return kept.groupBy(*by, "_island").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("length")).drop("_island")


def run_metrics(runs: DataFrame) -> DataFrame:
    """Totals, accuracy, mean of the last thirty runs."""
    last = runs.withColumn("back", F.row_number().over(Window.orderBy(F.desc("ts"))))  # a row a run
    return last.agg(F.sum("valid").alias("valid"), F.sum("discarded").alias("discarded"), C.valid_rate(F.sum("valid"), F.sum("valid") + F.sum("discarded")).alias("accuracy"), F.round(F.avg(F.when(F.col("back") <= 30, F.col("valid"))), 4).alias("mean_last_30"), F.count(F.lit(1)).alias("runs"))


def cumulative(rows: DataFrame, order: str, value: str) -> DataFrame:
    """A running total over an aggregated (small) table."""
    return rows.withColumn("cumulative", F.sum(value).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def throttle(events: DataFrame, quiet_hours: float = 6) -> DataFrame:
    """Module, ts, kind (events), and whether the alert is sent: on a new kind, on recovery, or after quiet hours.

    A change of kind always sends (but for a first "ok"), so the last alert sent matters only inside a run of one kind: each
    run is scanned by itself, and runs of "ok" need no scan.
    """
    w = Window.partitionBy("module").orderBy("ts", "kind")
    rows = events.select("module", "ts", "kind").withColumn("_before", F.lag("kind").over(w)).withColumn("_new", F.col("_before").isNull() | (F.col("_before") != F.col("kind")))
    rows = rows.withColumn("_run", F.count_if("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    calm = rows.where("kind = 'ok'").select("module", "ts", "kind", (F.col("_new") & F.col("_before").isNotNull()).alias("sent"))
    quiet = int(quiet_hours * 3600 * 1_000_000)
    start = F.struct(F.lit(None).cast("bigint").alias("at"), F.array().cast("array<boolean>").alias("sent"))

    def scan(state: Column, ts: Column) -> Column:
        now = F.unix_micros(ts)
        send = state["at"].isNull() | (now - state["at"] >= quiet)
        return F.struct(F.when(send, now).otherwise(state["at"]).alias("at"), F.concat(state["sent"], F.array(send)).alias("sent"))

    runs = rows.where("kind <> 'ok'").groupBy("module", "kind", "_run").agg(F.array_sort(F.collect_list("ts")).alias("all"))
    sent = runs.withColumn("s", F.aggregate("all", start, scan)["sent"]).select("module", "kind", F.explode(F.arrays_zip("all", "s")).alias("x"))
    return calm.unionByName(sent.select("module", F.col("x.all").alias("ts"), "kind", F.col("x.s").alias("sent")))


def heartbeat(runs: DataFrame, as_of: str, stale_hours: int = 8) -> DataFrame:
    """Checks over the run table, one row each: check, failed."""
    last = runs.agg(F.max("ts").alias("last"), F.max_by("valid", "ts").alias("valid"), F.max_by("discarded", "ts").alias("discarded"), F.count(F.lit(1)).alias("n"))
    hours = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.col("last").cast("timestamp"))) / 3600
    checks = {"no_runs": F.col("n") == 0, "stale_run": hours > stale_hours, "zero_valid": F.col("valid") == 0, "no_rejects": F.col("discarded") == 0}
    return last.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.coalesce(v, F.lit(True)).alias("failed")) for k, v in checks.items()])).alias("c")).select("c.*")


def _stats(spark, sf_dir, **kw):
    return source_stats(daily_rates(reports.fact(tables.jobs(spark, sf_dir)), JOBS_AS_OF, **kw))


RATES = f"""WITH r AS (SELECT source, substr(processed_at, 1, 10)::DATE AS day, count(*) AS total, round(100.0::DOUBLE * count(*) FILTER (outcome = 'valid') / count(*), 10) AS rate FROM jobs
    WHERE source NOT IN ('Unknown', '') AND processed_at >= strftime(DATE '{JOBS_AS_OF}' - 30, '%Y-%m-%d') GROUP BY 1, 2),
    k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY day DESC) AS b FROM r),
    s AS (SELECT source, avg(rate) AS mean, coalesce(stddev_samp(rate), 0) AS std, max(rate) FILTER (b = 1) AS current_rate, count(*) AS days_tracked, sum(total)::BIGINT AS total_volume FROM k GROUP BY 1 HAVING count(*) >= 3),
    z AS (SELECT *, CASE WHEN std > 0 THEN (current_rate - mean) / std ELSE 0 END AS z_score, mean + 2 * std AS ucl, greatest(0, mean - 2 * std) AS lcl FROM s) """
query("a29_a31_spc_report", RATES + "SELECT source, round(mean, 1) AS mean_rate, round(std, 1) AS std, round(current_rate, 1) AS current_rate, round(z_score, 2) AS z_score, round(ucl, 1) AS ucl, round(lcl, 1) AS lcl, days_tracked, total_volume, CASE WHEN z_score < -2.5 THEN 'critical' WHEN z_score < -2 THEN 'warning' WHEN current_rate < lcl THEN 'degraded' ELSE 'healthy' END AS status FROM z", "jobs")(lambda s, d: spc_report(_stats(s, d)))
query("a30_alerts")(lambda s, d: alerts(_stats(s, d, densify=True)))
query("a31_trend", RATES + "SELECT source, day, total, round(rate, 4) AS rate FROM r", "jobs")(lambda s, d: daily_rates(tables.jobs(s, d), JOBS_AS_OF).select("source", "day", "total", F.round("rate", 4).alias("rate")))
query("a32_w4_drop_alerts", """WITH k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY run DESC) AS b FROM source_runs), s AS (SELECT source, max(fetched) FILTER (b = 1) AS latest, avg(fetched) FILTER (b > 1) AS m, count(*) AS n FROM k WHERE b <= 30 GROUP BY 1)
    SELECT source, latest, round(m, 4) AS mean, CASE WHEN latest = 0 AND m >= 10 THEN 'down' WHEN m > 0 AND latest < 0.2 * m THEN 'degraded' ELSE 'ok' END AS status FROM s WHERE n >= 3""", "source_runs")(lambda s, d: drop_alerts(tables.source_runs(s, d)))  # fmt: skip
query("a34_lifetime_ratios", "SELECT source, run, round(valid / greatest(1, fetched)::DOUBLE, 6) AS recent_ratio, round(sum(valid) OVER w / greatest(1, sum(fetched) OVER w)::DOUBLE, 6) AS lifetime_ratio FROM source_runs WINDOW w AS (PARTITION BY source ORDER BY run ROWS UNBOUNDED PRECEDING)", "source_runs")(lambda s, d: lifetime_ratios(tables.source_runs(s, d)))
query("a35_decay", """WITH r AS (SELECT *, round(valid / fetched::DOUBLE, 6) AS rate FROM source_runs), q AS (SELECT source, run, round(avg(rate) OVER s, 6) AS recent, round(sum(valid) OVER w / (sum(fetched) OVER w)::DOUBLE, 3) AS lifetime, count(*) OVER s AS n FROM r
    WINDOW w AS (PARTITION BY source ORDER BY run ROWS UNBOUNDED PRECEDING), s AS (PARTITION BY source ORDER BY run ROWS 6 PRECEDING)) SELECT source, run, recent, lifetime, n >= 7 AND lifetime > 0.02 AND recent < 0.5 * lifetime AS decayed FROM q""", "source_runs")(lambda s, d: decay(tables.source_runs(s, d)))  # fmt: skip
query("a36_run_metrics", "SELECT sum(valid)::BIGINT AS valid, sum(discarded)::BIGINT AS discarded, round(sum(valid) / (sum(valid) + sum(discarded))::DOUBLE, 4) AS accuracy, round(avg(valid) FILTER (b <= 30), 4) AS mean_last_30, count(*) AS runs FROM (SELECT *, row_number() OVER (ORDER BY ts DESC) AS b FROM runs)", "runs")(lambda s, d: run_metrics(tables.runs(s, d)))
query("w7_islands", """WITH m AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY run) AS n FROM source_runs), k AS (SELECT *, n - row_number() OVER (PARTITION BY source ORDER BY run) AS g FROM m WHERE valid * 2 >= fetched)
    SELECT source, min(run) AS first, max(run) AS last, count(*) AS length FROM k GROUP BY source, g""", "source_runs")(lambda s, d: islands(tables.source_runs(s, d), ["source"], "run", F.col("valid") * 2 >= F.col("fetched")))  # fmt: skip
query("w6_cumulative", "SELECT week, postings, sum(postings) OVER (ORDER BY week)::BIGINT AS cumulative FROM (SELECT p_week AS week, count(*) AS postings FROM bronze GROUP BY 1)", "bronze")(
    lambda s, d: cumulative(tables.jobs(s, d).groupBy(C.iso_week(F.col("run_id")).alias("week")).agg(F.count(F.lit(1)).alias("postings")), "week", "postings")
)
query("w5_shifted_titles", """SELECT id FROM (SELECT id, company, title = lag(title) OVER w AND title = lead(title) OVER w AS hit FROM jobs WINDOW w AS (PARTITION BY company ORDER BY id)) WHERE hit""", "jobs")(
    lambda s, d: tables.jobs(s, d).select("id", *[(f("title").over(Window.partitionBy("company").orderBy("id")) == F.col("title")).alias(n) for n, f in (("a", F.lag), ("b", F.lead))]).where("a AND b").select("id")
)
query("w11_throttle")(lambda s, d: throttle(tables.table(s, d, "events").select(F.col("user_id").cast("string").alias("module"), F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_type") == "error", "down").when(F.col("event_type") == "click", "slow").otherwise("ok").alias("kind"))))
query("q13_w10_heartbeat", "SELECT unnest(['no_runs', 'stale_run', 'zero_valid', 'no_rejects']) AS \"check\", unnest([count(*) = 0, date_diff('second', max(ts), TIMESTAMP '2024-02-01') / 3600.0 > 8, arg_max(valid, ts) = 0, arg_max(discarded, ts) = 0]) AS failed FROM runs", "runs")(lambda s, d: heartbeat(tables.runs(s, d), "2024-02-01"))


