"""Mixing sources to target weights by hash-threshold histograms, with DataFrame operations only.

Every row has a fixed 60-bit hash of its id, or of its text where it has no id. A source's budget picks the rows whose hash lies below a threshold. The
thresholds come from histograms: sizes are summed by source and the hash's top 12 bits, the bucket in which the running sum
crosses the budget is found, and only the rows of that bucket are summed again by the next 12 bits, until all 60 are used.
No rows are sorted, and a threshold found for a smaller budget lies below one for a larger budget (nested).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.shared import materialize
from postmill.llm.words import COUNT_SQL

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BITS, LEVELS = 12, 5


def id_hash(column: Column, text: Column) -> Column:
    """60 bits of the MD5 of the id as text; rows without an id have that of their text behind a sign of its own."""
    return F.conv(F.substring(F.md5(F.coalesce(column.cast("string"), F.concat(F.lit("#"), F.coalesce(text, F.lit("")))).cast("binary")), 1, 15), 16, 10).cast("long")


def word_count(column: str) -> Column:
    return F.expr(COUNT_SQL.format(column)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """source, source_size, weight, target of a table (source, size).

    Sources get the weights in turn, by code point, null last. The targets share the whole size by weight; a target stops
    at `most` times its source's size and what it can't use is shared among the others by weight, until none is above.
    With w the weights that are still open, each open target is rate * w; the rate only rises, so the loop over the (small,
    aggregated) source table ends after at most as many rounds as there are capped sources. An empty table has no targets.
    """
    n = len(weights)
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.select("source", "source_size", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("rank"))
    table = materialize(ranked.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % n + 1).cast("int")).alias("weight")), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    cap, rate, capped = F.col("source_size") * most, 0.0, -1
    while True:
        above = (cap <= F.lit(rate) * F.col("weight")) if capped >= 0 else F.lit(False)
        used, open_weight, now = table.agg(F.coalesce(F.sum(F.when(above, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)), F.count_if(above)).first()
        if now == capped or not open_weight:
            break
        capped, rate = now, (total - used) / open_weight
    return table.withColumn("target", F.when(cap <= F.lit(rate) * F.col("weight"), cap.cast("double")).otherwise(F.lit(rate) * F.col("weight")))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, threshold: the rows of a source whose hash is below the threshold sum up to nearly its budget.

    rows: source, size, hash; budgets: source, budget (long). The row whose size crosses the budget is taken if that brings
    the sum nearer to the budget (equal: not taken); rows of one hash, such as repeated rows, go together. A budget of
    nothing takes nothing; one that no prefix crosses takes all.
    """
    span = 1 << BITS
    state = budgets.select(F.col("source").alias("s"), F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"), "budget", F.lit(False).alias("whole"))
    narrowed = rows.select("source", "size", "hash")
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        bucket = F.shiftrightunsigned("hash", shift)
        if level:
            narrowed = narrowed.join(state.where(~F.col("whole")), F.col("source").eqNullSafe(F.col("s")) & (F.shiftrightunsigned("hash", shift + BITS) == F.col("prefix"))).select("source", "size", "hash")
        histogram = narrowed.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"))
        first = state.join(histogram, F.col("source").eqNullSafe(F.col("s")) & ~F.col("whole"), "left")
        running = F.col("before") + F.coalesce(F.sum("size").over(Window.partitionBy("s").orderBy("bucket")), F.lit(0))
        crossing = first.withColumn("running", running).groupBy("s").agg(
            F.first("budget").alias("budget"), F.first("whole").alias("was_whole"), F.first("prefix").alias("was"), F.first("before").alias("was_before"),
            F.min(F.when(F.col("running") > F.col("budget"), F.struct("bucket", (F.col("running") - F.col("size")).alias("before"), "running"))).alias("x"),
        )
        state = crossing.select(
            "s",
            F.when(F.col("was_whole"), F.col("was")).otherwise(F.coalesce(F.col("x.bucket"), F.lit(span ** (level + 1)))).alias("prefix"),
            F.when(F.col("was_whole"), F.col("was_before")).otherwise(F.coalesce(F.col("x.before"), F.col("was_before"))).alias("before"),
            "budget",
            (F.col("was_whole") | F.col("x").isNull()).alias("whole"),
            F.col("x.running").alias("after"),
        )
        state = materialize(state.drop("after") if level < LEVELS - 1 else state, "thresholds")
    take = ~F.col("whole") & (F.col("after") - F.col("budget") < F.col("budget") - F.col("before"))
    # a whole source has no crossing row: its prefix counts whole spans at the level where that showed
    return state.select(F.col("s").alias("source"), F.when(F.col("whole"), F.lit(1 << 60)).when(take, F.col("prefix") + 1).otherwise(F.col("prefix")).alias("threshold"))


def mix_plan(rows: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """_source, source_size, target, repeats, threshold of a table (source, size, hash); a row per source.

    A source's rows are taken `repeats` times each, and those with a hash below `threshold` once more.
    """
    table = materialize(source_targets(rows, weights, most), "targets")
    repeats = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0)
    rest = F.when(repeats >= most, F.lit(0)).otherwise(F.round(F.col("target") - repeats * F.col("source_size")).cast("long"))
    hashed = rows.select("source", "size", "hash")
    found = thresholds(hashed, table.select("source", rest.alias("budget"))).withColumnRenamed("source", "_t")
    plan = table.select(F.col("source").alias("_source"), "source_size", "target", repeats.cast("long").alias("repeats")).join(found, F.col("_source").eqNullSafe(F.col("_t"))).drop("_t")
    # a table of its own, so that Spark knows its size: it broadcasts a small one and need not deal the documents by source
    return materialize(plan, "mix-plan")


def _sizes(docs: DataFrame) -> DataFrame:
    return materialize(docs.select("doc_id", "source", word_count("text").alias("size"), id_hash(F.col("doc_id"), F.col("text")).alias("hash")), "sizes")


def _copies(hash_: Column) -> Column:
    return F.col("repeats") + F.when(hash_ < F.col("threshold"), 1).otherwise(0)


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per row of docs (doc_id, text, source): doc_id, size, source_size, target, taken.

    size is the number of words of the text (null: 0). Each source takes every row as often as its target holds its whole
    size, and fills the rest with the rows below its hash threshold, so `taken` is a multiple of size, at most `most` times.
    The sums come within half the crossing row of the target. Rows are kept as they are: repeated rows count and return as
    often as they occur, sources of size 0 take nothing, and reruns agree since only ids and sizes decide. Rows without a
    doc_id are picked by their texts. Extra columns of docs are not read.
    """
    rows = _sizes(docs)
    return rows.join(mix_plan(rows, weights, most), F.col("source").eqNullSafe(F.col("_source")), "left").select("doc_id", "size", "source_size", "target", (F.col("size") * _copies(F.col("hash"))).alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """The rows of docs, each as often as mix_sources() takes it, with all their columns, whatever their names.

    Nulls, ties and repeated rows are as there; an empty text has size 0 and comes as often as its hash says; a very long one counts
    whole; an empty table stays empty.
    """
    plan = mix_plan(_sizes(docs), weights, most)
    rows = docs.select(F.struct("*").alias("_row"), "source", id_hash(F.col("doc_id"), F.col("text")).alias("_hash"))
    times = F.explode(F.array_repeat(F.lit(0), _copies(F.col("_hash")).cast("int")))
    return rows.join(plan, F.col("source").eqNullSafe(F.col("_source"))).select("_row", times.alias("_copy")).select("_row.*")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '#' || coalesce(text, ''))), 1, 15))::BIGINT AS hash FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY source),
r AS (SELECT *, 3 * source_size / weight::DOUBLE AS ratio FROM s),
a AS (SELECT *, coalesce(sum(3 * source_size) OVER w, 0) AS used, sum(weight) OVER (ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
    (SELECT sum(source_size) FROM s) AS total FROM r WINDOW w AS (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT min(CASE WHEN (total - used)::DOUBLE / open < ratio THEN ratio END) AS first_open FROM a),
rate AS (SELECT (total - used)::DOUBLE / open AS rate FROM a, l WHERE ratio = first_open ORDER BY ratio, source LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN 3 * source_size <= rate * weight THEN (3 * source_size)::DOUBLE ELSE rate * weight END AS target FROM s, rate),
b AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS repeats FROM t),
c AS (SELECT *, CASE WHEN repeats >= 3 THEN 0 ELSE round(target - repeats * source_size)::BIGINT END AS budget FROM b),
h AS (SELECT source, hash, sum(size)::BIGINT AS size FROM d GROUP BY source, hash),
p AS (SELECT h.source, hash, budget, sum(h.size) OVER (PARTITION BY h.source ORDER BY hash) AS running, h.size FROM h JOIN c ON h.source IS NOT DISTINCT FROM c.source),
x AS (SELECT source, hash, running <= budget OR (running - size <= budget AND running - budget < budget - (running - size)) AS chosen FROM p)
SELECT d.doc_id, d.size, c.source_size, c.target, (d.size * (c.repeats + CASE WHEN x.chosen THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.hash = x.hash
"""
