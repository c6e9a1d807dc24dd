"""Importance resampling of documents towards a target's distribution of hashed word n-grams.

A batch's texts are joined with a sentinel between them; one regular expression pass finds all words, a sorted search of their
starts gives each word's document, and n-grams whose words lie in two documents are masked before counting. The hash of an
n-gram is put together from its words' hashes: crc32 is linear, so a crc moves past further bytes by table look-ups. The log ratio of
both bucket distributions is a table of a fixed size; each document's weight is its sum over the document's n-grams. Gumbel
noise from a hash of the id makes the highest scores a draw without replacement in proportion to the weights' exponentials.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postmill.llm import words as W
from postmill.llm.shared import materialize
from postmill.operators.lineage import ranked

BUCKETS, NGRAM, LEAST_WORDS, PERCENT, SEED, STEP = 10_000, 3, 20, 5, 42, 1 << 12
CHUNK_BYTES, LONG_WORD = 1 << 20, 255
WORDS = re.compile(rb"([0-9a-z\x80-\xff]+)")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


@cache
def _moves() -> np.ndarray:
    """[n, k, b]: what byte k of a crc, being b, adds to the crc of n more zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> 1) ^ np.where(step & 1, np.uint32(0xEDB88320), np.uint32(0))
    out = np.empty((LONG_WORD + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(LONG_WORD):
        out[n + 1] = (out[n] >> 8) ^ step[out[n] & 255]
    return out


def _followed(crc: np.ndarray, size: np.ndarray | int, by: np.ndarray | int) -> np.ndarray:
    """The crc of two strings from that of the first, the size of the second, and the second's crc."""
    table = _moves()
    moved = table[size, 0, crc & 255]
    for k in (1, 2, 3):
        moved = moved ^ table[size, k, (crc >> (8 * k)) & 255]
    return moved ^ by


def ngram_crcs(texts: list[bytes], most: int = NGRAM) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 to most: (text, crc32) of every run of n words of one text, joined by one space."""
    joined = b"\0".join(texts).translate(LOWER)
    offsets = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    parts = WORDS.split(joined)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
    words, starts = parts[1::2], ends[:-1:2]
    text = np.searchsorted(offsets, starts, side="right")
    size = np.fromiter(map(len, words), np.int64, len(words))
    crc = single = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    yield text, single
    space = np.uint32(zlib.crc32(b" "))
    for n in range(2, most + 1):
        # crc has the runs of n - 1 words, by first word; the next word follows
        k = max(len(words) - n + 1, 0)
        crc = _followed(_followed(crc[:k], 1, space), np.minimum(size[n - 1 : n - 1 + k], LONG_WORD), single[n - 1 : n - 1 + k])
        for i in np.flatnonzero(size[n - 1 : n - 1 + k] > LONG_WORD).tolist():
            crc[i] = zlib.crc32(b" ".join(words[i : i + n]))
        whole = text[:k] == text[n - 1 : n - 1 + k]
        yield text[:k][whole], crc[whole]


def _batches(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    for row, data, offsets in W.chunks(column, CHUNK_BYTES):
        raw = data.tobytes()
        yield row, [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def bucket_counts(texts: DataFrame, column: str, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: the n-grams of all texts by hash bucket; a row per bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part in _batches(batch.column(0)):
                for _, crc in ngram_crcs(part):
                    total += np.bincount(crc % buckets, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["bucket", "n"])

    return texts.select(column).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain of two tables of bucket_counts(): floor of 1000 times the log of the ratio of their smoothed shares."""
    counts = target.select("bucket", F.col("n").alias("t"), F.lit(0).alias("s")).unionByName(source.select("bucket", F.lit(0).alias("t"), F.col("n").alias("s")))
    counts = counts.unionByName(source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).alias("t"), F.lit(0).alias("s")))
    counts = counts.groupBy("bucket").agg(F.sum("t").cast("double").alias("t"), F.sum("s").cast("double").alias("s"))
    totals = counts.agg(F.sum("t").alias("all_t"), F.sum("s").alias("all_s"))
    ratio = (F.col("t") + 1) * (F.col("all_s") + buckets) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    return counts.crossJoin(F.broadcast(totals)).select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of each row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, part in _batches(batch.column(1)):
                counts, weight = [], np.zeros(len(part))
                for text, crc in ngram_crcs(part):
                    counts.append(np.bincount(text, minlength=len(part)))
                    weight += np.bincount(text, gain[crc % len(gain)], len(part))  # whole numbers far below 2^53
                yield pa.record_batch([batch.column(0).slice(row, len(part)), *map(pa.array, (counts[0], sum(counts), weight.astype(np.int64)))], names=["doc_id", "n_words", "n_features", "weight"])

    out = StructType().add("doc_id", docs.schema["doc_id"].dataType).add("n_words", "long").add("n_features", "long").add("weight", "long")
    return docs.select("doc_id", "text").mapInArrow(run, out)


def drawn(scored: DataFrame, n: int) -> DataFrame:
    """scored (doc_id, score, eligible, ...) with rank: 1 to n for the n highest scores of eligible rows, ties to smaller doc_id, else null.

    A histogram of the scores in steps of STEP gives the step in which the n-th lies. Rows of that step and above are numbered
    by ranges of their order; all others pass by without a shuffle.
    """
    step = F.floor(F.col("score") / STEP)
    histogram = scored.where("eligible").groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k"))
    # a row per step of scores: their span, not the table, bounds it
    reached = histogram.withColumn("sum", F.sum("k").over(Window.orderBy(F.col("step").desc())))
    first = reached.where(F.col("sum") >= n).agg(F.max("step")).first()[0] if n > 0 else None
    if first is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    above = F.col("eligible") & (step >= first)
    numbered = ranked(scored.where(above), "rank", F.col("score").desc(), F.col("doc_id").asc_nulls_last()).withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    return numbered.unionByName(scored.where(~above).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, column: str = "text", least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_features, weight, score, rank; target's texts are in its column `column`.

    Features are runs of 1 to 3 words. Of the rows with at least `least_words` words, `percent` in a hundred (rounded down) are
    drawn and numbered by score; others have no rank. Null and empty texts have no features and weight 0; a null doc_id
    draws its noise as empty text and comes last in ties; repeated rows score alike and take ranks one after another; a text longer
    than CHUNK_BYTES is a batch of its own; an empty table has no rows; an empty target has all buckets alike; extra columns are not read.
    """
    table = gains(bucket_counts(docs, "text"), bucket_counts(target, column))
    gain = np.zeros(BUCKETS)
    for row in table.collect():  # BUCKETS rows
        gain[row.bucket] = row.gain
    noise = (F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long") + 0.5) / 4294967296.0
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log(noise)))
    scored = materialize(weights(docs, gain).select("doc_id", "n_features", "weight", score.alias("score"), (F.col("n_words") >= least_words).alias("eligible")), "scores")
    n = scored.where("eligible").count() * percent // 100
    return drawn(scored, n).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = r"""
WITH RECURSIVE crc_step(b, c, i) AS (SELECT b, b::UBIGINT, 0 FROM range(256) t(b) UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, i + 1 FROM crc_step WHERE i < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM crc_step WHERE i = 8),
texts AS (SELECT doc_id AS id, 'd' AS side, text FROM documents UNION ALL SELECT item_id, 'b', text FROM benchmark),
words AS (SELECT id, side, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (SELECT id, side, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS f FROM words, range(1, 4) r(n)),
counted AS (SELECT id, side, f, count(*) AS k FROM runs GROUP BY ALL),
distinct_f AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM counted)),
hashed AS (SELECT f, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::UBIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) % 256)::BIGINT + 1])), 4294967295::UBIGINT) % 10000 AS bucket FROM distinct_f, crc),
placed AS (SELECT id, side, bucket, k FROM counted JOIN hashed USING (f)),
bucket_sums AS (SELECT bucket, coalesce(sum(k) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(k) FILTER (side = 'b'), 0)::DOUBLE AS t FROM placed GROUP BY bucket),
totals AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM bucket_sums),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain FROM bucket_sums, totals),
weight AS (SELECT id, sum(k)::BIGINT AS n_features, sum(k * gain)::BIGINT AS weight FROM placed JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (SELECT w.id AS doc_id, len(w) AS n, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || w.id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM words w LEFT JOIN weight g ON w.id = g.id WHERE side = 'd'),
ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN r <= 5 * ranks.n // 100 THEN r END AS rank FROM scored s LEFT JOIN ranks ON s.doc_id = ranks.doc_id
"""
