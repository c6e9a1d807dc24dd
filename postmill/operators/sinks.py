"""Upserts, snapshots and histories as Parquet writes (K4-K6, K8-K13, X3's sink)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.lineage import ranked
from postmill.plans.registry import query
from postmill.sources import tables


def upsert(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Old and new rows, of each key the new one; of several new ones the last by all other columns."""
    both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (*keys, "_age")]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("_age", *rest)).alias("_r")).select(*keys, "_r.*")


def add_counts(old: DataFrame, new: DataFrame, count: str, *keys: str) -> DataFrame:
    """K5: counts add up by key."""
    return old.unionByName(new).groupBy(*keys).agg(F.sum(count).alias(count))


def company_counters(events: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """K6: per company one counter per kind, and when it was last seen."""
    return events.groupBy("company").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds], F.max("ts").alias("last_seen"))


def write_snapshot(df: DataFrame, path: str) -> None:
    """K8: a small result as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_history(df: DataFrame, path: str, night: str) -> None:
    """A night's rows under its date, replacing only that date; sorted by company inside files."""
    dated = df.withColumn("snapshot_date", F.lit(night))
    (dated.sortWithinPartitions("company") if "company" in df.columns else dated).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)


def move(rows: DataFrame, due: DataFrame, target: DataFrame, reason: str) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, rows to append to target with a reason); rows whose URL the target holds aren't moved twice."""
    moved = rows.join(due.select("id"), "id", "left_semi")
    fresh = moved.join(target.select("url"), "url", "left_anti").withColumn("reason", F.lit(reason))
    return rows.join(due.select("id"), "id", "left_anti"), fresh


def renumbered(rows: DataFrame, order: str) -> DataFrame:
    """1..N in order."""
    return ranked(rows, "sr_no", F.col(order))


def read_corrections(df: DataFrame) -> DataFrame:
    """JSON lines (value) of corrections; damaged ones are skipped."""
    return df.select(F.from_json("value", "company string, field string, old string, new string").alias("r")).where("r.company IS NOT NULL").select("r.*")


EVENTS = ("view", "click", "purchase", "error", "signup")
query("k4_w9_upsert", "SELECT source, arg_max(valid, (run, valid)) AS valid FROM source_runs GROUP BY 1", "source_runs")(
    lambda s, d: upsert(tables.source_runs(s, d).where("run < '2024-01-01'").select("source", "run", "valid"), tables.source_runs(s, d).select("source", "run", "valid"), "source").select("source", "valid")
)
query("k5_add_counts", "SELECT stage, reason_category, 2 * sum(count)::BIGINT AS count FROM rejection_funnel GROUP BY 1, 2", "rejection_funnel")(
    lambda s, d: add_counts(*[tables.rejection_funnel(s, d).groupBy("stage", "reason_category").agg(F.sum("count").alias("count"))] * 2, "count", "stage", "reason_category")
)
query("k6_company_counters", "SELECT user_id % 100 AS company, " + ", ".join(f"count(*) FILTER (event_type = '{k}') AS {k}" for k in EVENTS) + " FROM events GROUP BY 1")(
    lambda s, d: company_counters(tables.table(s, d, "events").select((F.col("user_id") % 100).alias("company"), F.col("event_type").alias("kind"), "ts"), EVENTS).drop("last_seen")
)
query("k12_move", "SELECT id, url FROM jobs WHERE outcome = 'reviewed' AND url NOT IN (SELECT url FROM jobs WHERE outcome = 'valid' AND url IS NOT NULL)", "jobs")(
    lambda s, d: move(tables.jobs(s, d).select("id", "url"), tables.jobs(s, d).where("outcome = 'reviewed'"), tables.jobs(s, d).where("outcome = 'valid' AND url IS NOT NULL"), "expired")[1].where("url IS NOT NULL").select("id", "url")
)
