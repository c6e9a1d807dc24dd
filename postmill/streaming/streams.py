"""Incremental and streaming forms of the batch work (X1-X7). Each has a batch twin; the streams run with availableNow."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from postmill.operators import seen
from postmill.operators.lineage import shared_path
from postmill.plans.registry import query
from postmill.sources import tables


def stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    """A file source; ts becomes a timestamp, since watermarks refuse other types."""
    return spark.readStream.schema(schema).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def land(events: DataFrame, path: str, checkpoint: str):
    """Appends new rows to Bronze by day, once each; gives the running query."""
    return events.withColumn("p_day", F.to_date("ts")).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("p_day").trigger(availableNow=True).start()


def first_seen(events: DataFrame, key: str, days: int = 90) -> DataFrame:
    """The first row of a key within the expiry; state older than it is dropped."""
    return events.withWatermark("ts", f"{days} days").dropDuplicatesWithinWatermark([key])


def weekly(events: DataFrame, late: str = "14 days") -> DataFrame:
    """Counts per Monday week and type; the watermark bounds state."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", "7 days", startTime="4 days").start.alias("week"), "event_type").agg(F.count(F.lit(1)).alias("n"))


def daily(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Daily volume and rate per source."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", "1 day").start.alias("day"), "event_type").agg(F.count(F.lit(1)).alias("fetched"), F.count_if(F.col("value") >= 50).alias("valid"))


def velocity(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Counts per key in windows of thirty days that start every day."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", "30 days", "1 day").start.alias("start"), "event_type").agg(F.count(F.lit(1)).alias("n"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Sessions per user: start, decisions, seconds."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    found = rows.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("decisions"), F.max("ts").alias("last"))
    return found.select("user_id", F.col("w.start").alias("start"), "decisions", (F.unix_timestamp("last") - F.unix_timestamp(F.col("w.start"))).alias("seconds"))


def review_effort(found: DataFrame, baseline: float | None) -> DataFrame:
    """Seconds per posting over all sessions, weighted by the postings of each, and its reduction against a baseline in seconds.

    One row; both are null without a posting, and the reduction without a baseline."""
    total = found.agg(F.sum("decisions").alias("jobs"), F.sum("seconds").alias("seconds"))
    mean = F.when(F.col("jobs") > 0, F.round(F.col("seconds") / F.col("jobs"), 1))
    return total.select(F.coalesce("jobs", F.lit(0)).alias("jobs"), mean.alias("seconds_per_job"), F.round(1 - mean / (F.lit(baseline or None).cast("double")), 3).alias("reduction"))


def last_runs(events: DataFrame, keep: int = 30) -> DataFrame:
    """Per source, how many of its last `keep` values lie at 50 or above, kept in state between batches."""
    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, values = state.get if state.exists else ([], [])
        held = pd.DataFrame({"ts": list(at), "value": list(values)})
        for part in parts:
            # only the last rows are kept between chunks, whatever their number
            held = pd.concat([held, pd.DataFrame({"ts": part["ts"].astype("int64"), "value": part["value"]})]).sort_values("ts", kind="stable").tail(keep)
        state.update((held["ts"].tolist(), held["value"].tolist()))
        yield pd.DataFrame({"event_type": [key[0]], "n": [len(held)], "high": [int((held["value"] >= 50).sum())]})

    return events.groupBy("event_type").applyInPandasWithState(update, "event_type string, n long, high long", "ts array<bigint>, values array<double>", "update", GroupStateTimeout.NoTimeout)


def _events(spark, sf_dir):
    return tables.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream(spark, f"{sf_dir}/event[s].parquet", tables.table(spark, sf_dir, "events").schema)


def _written(rows: DataFrame) -> DataFrame:
    """The rows of a stream's append output, once all input is read."""
    path = shared_path(rows.sparkSession, "stream")
    rows.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/rows")


def _updated(rows: DataFrame) -> DataFrame:
    """The rows of a stream's update output, batch by batch, once all input is read."""
    path = shared_path(rows.sparkSession, "stream")
    query_ = rows.writeStream.outputMode("update").foreachBatch(lambda df, number: df.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")).option("checkpointLocation", f"{path}/state")
    query_.trigger(availableNow=True).start().awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/rows").select(rows.columns)


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "landed")
    land(_source(spark, sf_dir), f"{path}/rows", f"{path}/state").awaitTermination()
    return spark.read.parquet(f"{path}/rows")


def _taken_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as postings that come in: a company and id return in different months."""
    name, store = seen.STORE
    before = spark.conf.get(name, None)
    spark.conf.set(name, store)
    try:
        orders = spark.readStream.schema(tables.table(spark, sf_dir, "orders").schema).parquet(f"{sf_dir}/order[s].parquet")
        key = F.concat_ws("|", (F.col("o_custkey") % 40).cast("string"), (F.col("o_orderkey") % 61).cast("string"))
        return _written(seen.taken_in(orders.select(key.alias("key"), F.col("o_orderdate").cast("timestamp").alias("ts"), F.col("o_orderkey").alias("id"))))
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


query("x2_registry_stream", """WITH k AS (SELECT (o_custkey % 40) || '|' || (o_orderkey % 61) AS key, o_orderdate::DATE AS day, o_orderkey AS id FROM orders), s AS (SELECT key, day, min(id) AS id FROM k GROUP BY 1, 2),
    e AS (WITH RECURSIVE e(key, day) AS (SELECT key, min(day) FROM s GROUP BY key UNION ALL SELECT s.key, min(s.day) FROM e JOIN s ON s.key = e.key AND s.day > e.day + 90 GROUP BY s.key, e.day) SELECT DISTINCT s.key, s.day, s.id FROM e JOIN s USING (key, day))
    SELECT key, (day - DATE '1970-01-01')::INT AS epoch_day, id FROM e""")(_taken_in)
query("x1_landed", "SELECT ts::DATE AS p_day, count(*) AS n FROM events GROUP BY 1")(lambda s, d: _landed(s, d).groupBy("p_day").agg(F.count(F.lit(1)).alias("n")))
query("x2_first_seen", "SELECT DISTINCT user_id FROM events")(lambda s, d: _written(first_seen(_source(s, d), "user_id")).select("user_id"))
query("x5_last_runs", "SELECT event_type, count(*) AS n, count(*) FILTER (value >= 50) AS high FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS b FROM events) WHERE b <= 30 GROUP BY 1")(lambda s, d: _updated(last_runs(_source(s, d))))
query("x3_weekly", "SELECT date_trunc('week', ts)::TIMESTAMP AS week, event_type, count(*) AS n FROM events GROUP BY 1, 2")(lambda s, d: weekly(_events(s, d)).withColumn("week", F.col("week").cast("timestamp_ntz")))
query("x4_daily", "SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS fetched, count(*) FILTER (value >= 50) AS valid FROM events GROUP BY 1, 2")(lambda s, d: daily(_events(s, d)).withColumn("day", F.col("day").cast("timestamp_ntz")))
query("x6_velocity", "SELECT date_trunc('day', ts)::TIMESTAMP - to_days(k) AS start, event_type, count(*) AS n FROM events, range(0, 30) t(k) GROUP BY 1, 2")(lambda s, d: velocity(_events(s, d)).withColumn("start", F.col("start").cast("timestamp_ntz")))
SESSIONS = """g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g),
    f AS (SELECT count(*) AS decisions, (floor(epoch(max(ts))) - floor(epoch(min(ts))))::BIGINT AS seconds FROM s GROUP BY user_id, k), t AS (SELECT sum(decisions)::BIGINT AS jobs, round(sum(seconds) / sum(decisions)::DOUBLE, 1) AS m FROM f)"""
query("a47_review_effort", f"WITH {SESSIONS} SELECT jobs, m AS seconds_per_job, round(1 - m / 40.0::DOUBLE, 3) AS reduction FROM t")(lambda s, d: review_effort(sessions(_events(s, d)), 40.0))
query("x7_a47_sessions", """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
    SELECT user_id, min(ts) AS start, count(*) AS decisions, (floor(epoch(max(ts))) - floor(epoch(min(ts))))::BIGINT AS seconds FROM s GROUP BY user_id, k""")(lambda s, d: sessions(_events(s, d)).withColumn("start", F.col("start").cast("timestamp_ntz")))  # fmt: skip
