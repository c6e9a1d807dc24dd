"""Language mixtures: expectation-maximisation over n-gram likelihoods, and a language set by penalised likelihood.

Each language has a distribution over hashed byte trigrams of words (ASCII letters in lower case, other ASCII signs as word
ends). A word's likelihood in a language is the product of its trigrams'. A document is a mixture: EM finds the share of each
language from its words. A language stays in the document's set only if dropping it costs more log-likelihood than the penalty
(half the logarithm of the number of words, times PENALTY). The prediction is the language with the largest share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm import words as W

BUCKETS = 1 << 16
SAMPLE_PER_LANGUAGE = 3000
SMOOTHING = 0.1
ROUNDS, PENALTY = 8, 4.0
UNKNOWN = "und"
#: bytes as the trigrams see them: letters in lower case, bytes of longer code points as they are, else a space
FOLD = np.full(256, 32, np.uint8)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)
IS_ASCII_LETTER = np.zeros(256, bool)
IS_ASCII_LETTER[65:91] = IS_ASCII_LETTER[97:123] = True


@dataclass(frozen=True)
class Model:
    """languages, and table[bucket, language] of log-probabilities."""

    languages: tuple[str, ...]
    table: np.ndarray


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of the trigram around each word byte, first byte of each word among those, row of each word)."""
    folded = FOLD[data]
    inside = folded != 32
    padded = np.full(len(folded) + 2, 32, np.uint32)
    padded[1:-1] = folded
    left, right = padded[:-2].copy(), padded[2:].copy()
    left[offsets[:-1][offsets[:-1] < len(folded)]] = 32
    right[offsets[1:][offsets[1:] > 0] - 1] = 32
    code = (left << np.uint32(16)) | (padded[1:-1] << np.uint32(8)) | right
    bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(16))[inside]
    at = np.flatnonzero(inside)
    first = np.flatnonzero(left[at] == 32)
    return bucket.astype(np.int64), first, np.searchsorted(offsets[1:], at[first], side="right")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model from rows of docs (doc_id, text, lang) that are not held out and have an id, a text and a lang.

    Of a language with n rows, those whose hash of doc_id is 0 modulo n // per_language are read: a sample of about
    `per_language` to twice as many rows per language, the same on each run. Only counts reach the driver.
    """
    known = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    steps = {r["lang"]: max(1, r["count"] // per_language) for r in known.groupBy("lang").count().collect()}
    if not steps:
        return Model((), np.zeros((BUCKETS, 0), np.float32))
    step = F.element_at(F.create_map(*[F.lit(x) for kv in steps.items() for x in kv]), F.col("lang"))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), step) == 0).select("text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1).to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])
            counts = np.zeros(len(names) * BUCKETS, np.int64)
            for row, data, offsets in W.chunks(batch.column(0)):
                bucket, first, rows = _trigrams(data, offsets)
                of = np.repeat(number[row + rows], np.diff(np.r_[first, len(bucket)]))
                counts += np.bincount(of * BUCKETS + bucket, minlength=len(counts))
            at = np.flatnonzero(counts)
            yield pa.record_batch([pa.array([names[i] for i in at // BUCKETS], pa.string()), pa.array(at % BUCKETS), pa.array(counts[at])], names=["lang", "bucket", "n"])

    found = chosen.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(steps))
    counts = np.zeros((BUCKETS, len(languages)))
    counts[found["bucket"].to_numpy(int), [languages.index(x) for x in found["lang"]]] = found["n"].to_numpy(float)
    return Model(languages, np.log((counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * BUCKETS)).astype(np.float32))


def mixtures(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """shares[row, language]; rows without a word have none. Dropped languages have share 0."""
    n_rows, n_langs = len(offsets) - 1, len(model.languages)
    shares = np.zeros((n_rows, n_langs))
    bucket, first, rows = _trigrams(data, offsets)
    if not len(first) or not n_langs:
        return shares
    # word likelihoods, scaled by each word's best language
    score = np.stack([np.add.reduceat(model.table[bucket, lang], first) for lang in range(n_langs)], 1)
    score = np.exp(score - score.max(1, keepdims=True))
    present, start, n_words = np.unique(rows, return_index=True, return_counts=True)
    of = np.repeat(np.arange(len(present)), n_words)
    penalty = PENALTY * 0.5 * np.log(n_words + 1)

    def em(share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(ROUNDS):
            joint = share.astype(np.float32)[of] * score
            joint /= np.maximum(joint.sum(1, keepdims=True), 1e-30)
            share = np.add.reduceat(joint, start, axis=0, dtype=np.float64) / n_words[:, None]
        total = (share.astype(np.float32)[of] * score).sum(1)
        return share, np.add.reduceat(np.log(np.maximum(total, 1e-30)), start, dtype=np.float64)

    share, likely = em(np.full((len(present), n_langs), 1 / n_langs))
    for _ in range(n_langs - 1):
        some = share > 0
        least = np.where(some, share, 2).argmin(1)
        fewer = share.copy()
        fewer[np.arange(len(present)), least] = 0
        fewer /= np.maximum(fewer.sum(1, keepdims=True), 1e-30)
        alone = some.sum(1) < 2
        fewer[alone] = share[alone]
        fewer, now = em(fewer)
        better = ~alone & (now + penalty >= likely)
        if not better.any():
            break
        share[better], likely[better] = fewer[better], now[better]
    shares[present] = share
    return shares


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, held_out, lang_pred, score, shares (map of the set's languages).

    A text without a letter, or null, is `und` with score 0; so is every text if the model has no language. Only the text
    decides. Ties go to the first language by name; null doc_ids pass through; repeated rows give equal results; a very long text is
    a chunk of its own; an empty table gives no rows; extra columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in W.chunks(batch.column(1)):
                n = len(offsets) - 1
                shares = mixtures(model, data, offsets)
                plain, wide = (np.r_[0, np.cumsum(mask)] for mask in (IS_ASCII_LETTER[data], data >= 128))
                letters = plain[offsets[1:]] > plain[offsets[:-1]]
                for r in np.flatnonzero(~letters & (wide[offsets[1:]] > wide[offsets[:-1]])):
                    letters[r] = any(c.isalpha() for c in data[offsets[r] : offsets[r + 1]].tobytes().decode())
                known = letters & (shares.sum(1) > 0)
                best = shares.argmax(1) if shares.shape[1] else np.zeros(n, int)
                score = np.where(known, shares[np.arange(n), best] if shares.shape[1] else 0.0, 0.0)
                names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                maps = [[(model.languages[j], float(s[j])) for j in np.flatnonzero(s)] for s in shares]
                yield pa.record_batch([batch.column(0).slice(row, n), pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(maps, pa.map_(pa.string(), pa.float64()))], names=["doc_id", "lang_pred", "score", "shares"])

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, shares map<string,double>")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "shares")
