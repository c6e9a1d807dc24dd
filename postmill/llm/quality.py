"""Quality rules: exact counts of each text, and line labels by a linear-chain conditional random field.

Each line with a word is content or boilerplate. The field's scores are sums of weights of a line's discrete features and of
the step from the label before; Viterbi decoding gives the best label sequence of a text, and the share of words in content
lines decides. Weights and steps maximise the exact penalised likelihood (forward-backward) of a bounded sample of labelled
documents. Lines of bad documents are boilerplate; those of good ones are content, but for lines that repeat an earlier one or
stand in several documents of the sample (navigation, licences, shared passages), so labels change inside a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm import words as W

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MOST_REPEATED = 50, 50
#: bounds of the sample: documents, lines of a document (longer ones are not in the sample), documents that share a line
SAMPLE_DOCUMENTS, SAMPLE_LINES, SHARED_LINE = 2000, 100, 3
CONTENT_SHARE = 0.3
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS.encode())] = True
IS_UPPER, IS_LOWER, IS_DIGIT, IS_END, IS_MARK = (np.zeros(256, bool) for _ in range(5))
IS_UPPER[65:91] = IS_LOWER[97:123] = IS_DIGIT[48:58] = True
IS_END[list(b".!?:;\"')")] = True
IS_MARK[list(b"!|=_~^{}[]\\/")] = True
#: feature: upper bounds of its classes but the last
BOUNDS = {"words": (1, 3, 7, 15), "symbols": (0.0, 0.02, 0.08), "repeated": (0.0, 0.34, 0.67), "upper": (0.1, 0.5), "digits": (0.02, 0.2), "marks": (0.0, 0.03), "duplicate": (0,), "ended": (0,), "place": (0, 1)}
SIZES = {k: len(v) + 1 for k, v in BOUNDS.items()}
N_FEATURES = sum(SIZES.values())


@dataclass(frozen=True)
class Field:
    """weights[feature, label]; steps[label before, label]; label 1 is content."""

    weights: np.ndarray
    steps: np.ndarray

    @staticmethod
    def default() -> Field:
        """A hand-set field for when no labelled rows are given: symbols, capitals, marks and repeats speak for boilerplate."""
        against = {"symbols": (0, -0.2, 1, 3), "repeated": (0, 0.5, 2), "upper": (0, 0.5, 2), "digits": (0, 0.2, 1), "marks": (0, 0.3, 2), "duplicate": (0, 2), "ended": (0.3, 0)}
        column = np.concatenate([np.resize(np.array(against.get(k, (0,)), float), n) if k in against else np.zeros(n) for k, n in SIZES.items()])
        return Field(np.stack([column - 0.5, -column + 0.5], 1), np.array([[0.5, -0.5], [-0.5, 0.5]]))


def _per_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64)


def measure(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts of each row; of each line with a word: its row, its features (classes), its words, its hash."""
    n = len(offsets) - 1
    starts, ends, rows = W.spans(data, offsets)
    n_words = np.bincount(rows, minlength=n)
    inside = ~W.IS_SEPARATOR[data]
    points = np.r_[0, np.cumsum(inside & ((data & 0xC0) != 0x80))]
    symbols = np.r_[0, np.cumsum(IS_SYMBOL[data])]
    hashes = W.word_hashes(data, starts, ends)
    whole = np.flatnonzero(W.whole_windows(rows, 3))
    value = W.mix(W.window_hashes(hashes, 3)[whole] ^ (rows[whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(value, kind="stable")
    same = value[order][1:] == value[order][:-1]
    repeated = W.covered(len(rows), whole[order[np.r_[same, False] | np.r_[False, same]]] if len(order) else whole, 3)

    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.unique(np.r_[offsets[:-1], breaks + 1])
    line_starts = line_starts[line_starts < len(data)]
    # a break that ends its row starts no line of that row: the next row's start is the same place, and an empty one has no word
    line_of_word = np.searchsorted(line_starts, starts, side="right") - 1
    with_words, first_word, line_words = np.unique(line_of_word, return_index=True, return_counts=True)
    a = line_starts[with_words]
    next_break = np.r_[breaks, len(data)][np.searchsorted(breaks, a)]
    line_rows = rows[first_word]
    b = np.minimum(next_break, offsets[line_rows + 1])
    line_keys = W.word_hashes(data, a, b, seed=11) if len(a) else np.zeros(0, np.uint64)
    key = W.mix(line_keys ^ (line_rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    duplicate = np.ones(len(a), bool)
    duplicate[np.unique(key, return_index=True)[1]] = False

    def between(mask: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(mask)]
        return total[b] - total[a]

    length = np.maximum(b - a, 1)
    letters = np.maximum(between(IS_UPPER[data] | IS_LOWER[data]), 1)
    repeats = np.r_[0, np.cumsum(repeated)]
    last_word = first_word + line_words
    end_byte = data[ends[last_word - 1] - 1] if len(a) else np.zeros(0, np.uint8)
    edge = np.ones(len(a), int)
    if len(a):
        edge[np.r_[True, line_rows[1:] != line_rows[:-1]]] = 0
        edge[np.r_[line_rows[1:] != line_rows[:-1], True]] = 2
    raw = {
        "words": line_words, "symbols": (symbols[b] - symbols[a]) / length, "repeated": (repeats[last_word] - repeats[first_word]) / np.maximum(line_words, 1),
        "upper": between(IS_UPPER[data]) / letters, "digits": between(IS_DIGIT[data]) / length, "marks": between(IS_MARK[data]) / length,
        "duplicate": duplicate, "ended": IS_END[end_byte], "place": edge,
    }
    classes = np.stack([np.searchsorted(BOUNDS[k], raw[k]) for k in BOUNDS], 1) if len(a) else np.zeros((0, len(BOUNDS)), np.int64)
    counts = {
        "n_words": n_words, "word_chars": points[offsets[1:]] - points[offsets[:-1]], "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": _per_row(duplicate, line_rows, n), "n_repeat_words": _per_row(repeated, rows, n),
    }
    return counts, line_rows, classes + np.r_[0, np.cumsum(list(SIZES.values()))[:-1]], line_words, line_keys


def viterbi(field: Field, line_rows: np.ndarray, features: np.ndarray) -> np.ndarray:
    """The best label of each line; lines of a row stand together. Ties go to content."""
    score = field.weights[features].sum(1)
    n = len(line_rows)
    place = np.arange(n) - np.searchsorted(line_rows, line_rows)
    best, back = score.copy(), np.zeros((n, 2), np.int8)
    order = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[order], np.arange(1, (place.max() if n else 0) + 2))
    for p in range(1, len(cuts)):
        at = order[cuts[p - 1] : cuts[p]]
        step = best[at - 1][:, :, None] + field.steps
        back[at] = 1 - np.argmax(step[:, ::-1], axis=1)
        best[at] += step.max(axis=1)
    label = np.zeros(n, np.int8)
    last = np.r_[line_rows[1:] != line_rows[:-1], True] if n else np.zeros(0, bool)
    label[last] = best[last, 1] >= best[last, 0]
    for p in range(len(cuts) - 1, 0, -1):
        at = order[cuts[p - 1] : cuts[p]]
        label[at - 1] = back[at, label[at]]
    return label


def likelihood(field: Field, starts: np.ndarray, features: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The log likelihood of label sequences, and its slopes by weights and steps (forward-backward).

    The lines of a sequence stand together from its start on; sequences are in descending order of length.
    """
    n = len(labels)
    sizes = np.diff(np.r_[starts, n])
    score = field.weights[features].sum(1)
    at = [starts[: np.searchsorted(-sizes, -t)] + t for t in range(sizes[0])]
    alpha, beta = score.copy(), np.zeros((n, 2))
    for i in at[1:]:
        alpha[i] += np.logaddexp(alpha[i - 1, :1] + field.steps[0], alpha[i - 1, 1:] + field.steps[1])
    for i in at[:0:-1]:
        after = score[i] + beta[i]
        beta[i - 1] = np.logaddexp(field.steps[:, 0] + after[:, :1], field.steps[:, 1] + after[:, 1:])
    last = starts + sizes - 1
    total = np.logaddexp(alpha[last, 0], alpha[last, 1])
    of_line = np.repeat(total, sizes)[:, None]
    own = np.eye(2)[labels]
    seen = own - np.exp(alpha + beta - of_line)
    slopes = np.stack([np.bincount(features.ravel(), np.repeat(seen[:, y], features.shape[1]), N_FEATURES) for y in (0, 1)], 1)
    later = np.setdiff1d(np.arange(n), starts)
    pair = np.exp(alpha[later - 1][:, :, None] + field.steps + (score + beta)[later][:, None, :] - of_line[later][:, :, None])
    steps = np.array([[np.sum((labels[later - 1] == a) & (labels[later] == b)) for b in (0, 1)] for a in (0, 1)]) - pair.sum(0)
    value = score[np.arange(n), labels].sum() + field.steps[labels[later - 1], labels[later]].sum() - total.sum()
    return float(value), slopes, steps


def fit(rows: np.ndarray, features: np.ndarray, labels: np.ndarray, rounds: int = 300, penalty: float = 1.0) -> Field:
    """The field that maximises the penalised likelihood; lines of a row stand together."""
    n = len(labels)
    if not n or labels.min() == labels.max():
        return Field.default()
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    sizes = np.diff(np.r_[starts, n])
    longest = np.argsort(-sizes, kind="stable")
    order = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in longest])
    starts = np.r_[0, np.cumsum(sizes[longest])[:-1]]
    field = Field(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)))
    pace = [np.full(v.shape, 1e-9) for v in (field.weights, field.steps)]
    for _ in range(rounds):
        slopes = likelihood(field, starts, features[order], labels[order])[1:]
        for value, slope, past in zip((field.weights, field.steps), slopes, pace, strict=True):
            slope = (slope - penalty * value) / n
            past += slope**2
            value += 0.3 * slope / np.sqrt(past)
    return field


def labelled_lines(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, features, label) of the lines of at most `sample` documents of docs (doc_id, text) that labels (doc_id, quality) covers.

    The documents are those of smallest hash of doc_id, but for those of more than SAMPLE_LINES lines. The lines' features and
    hashes, not the texts, reach the driver: 17 bytes a line.
    """
    chosen = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quality, ids, out = batch.column(2).to_numpy(), batch.column(0).to_numpy(), []
            for row, data, offsets in W.chunks(batch.column(1)):
                _, rows, features, _, keys = measure(data, offsets)
                for r in np.unique(rows):
                    a, b = np.searchsorted(rows, [r, r + 1])
                    if b - a <= SAMPLE_LINES:
                        out.append((int(ids[row + r]), int(quality[row + r]), features[a:b].astype(np.uint8).tobytes(), keys[a:b].tobytes()))
            yield pa.record_batch([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary()), pa.array([x[3] for x in out], pa.binary())], names=["id", "quality", "features", "keys"])

    found = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("quality").cast("int")).mapInArrow(run, "id long, quality int, features binary, keys binary")
    # rows of one doc_id beyond the first are not needed; a table of labels with at most `sample` ids bounds the rest
    found = found.dropDuplicates(["id"]).toPandas().sort_values("id", kind="stable")
    features = [np.frombuffer(x, np.uint8).reshape(-1, len(BOUNDS)).astype(np.int64) for x in found["features"]]
    keys = [np.frombuffer(x, np.uint64) for x in found["keys"]]
    row = np.repeat(np.arange(len(found)), [len(k) for k in keys])
    if not len(row):
        return row, np.zeros((0, len(BOUNDS)), np.int64), np.zeros(0, np.int64)
    features, keys = np.concatenate(features), np.concatenate(keys)
    once = np.unique(np.stack([keys, row.astype(np.uint64)]), axis=1)[0]
    values, n = np.unique(once, return_counts=True)
    duplicate = int(np.cumsum(list(SIZES.values()))[list(SIZES).index("duplicate")] - 1)
    good = np.repeat(found["quality"].to_numpy() == 1, np.bincount(row, minlength=len(found)))
    return row, features, (good & ~(features == duplicate).any(1) & (n[np.searchsorted(values, keys)] < SHARED_LINE)).astype(np.int64)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Field:
    """A field from a sample of labelled_lines(); if the sample has not both labels, the hand-set one."""
    return fit(*labelled_lines(docs, labels, sample))


def _judged(field: Field, text: pa.Array) -> Iterator[tuple[int, dict[str, np.ndarray], np.ndarray, np.ndarray]]:
    """By chunk: first row, counts, whether the base rules fail, share of words in content lines."""
    for row, data, offsets in W.chunks(text):
        counts, rows, features, line_words, _ = measure(data, offsets)
        n = counts["n_words"]
        content = _per_row(line_words * viterbi(field, rows, features), rows, len(n)) / np.maximum(n, 1)
        yield row, counts, (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * n), content


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def label_lines(docs: DataFrame, field: Field, share: float = CONTENT_SHARE) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, the five counts, base_failed, kept, content_share.

    base_failed: fewer than 50 words, or over half the words lie in repeated three-word windows. kept: not that, and at
    least `share` of the words lie in lines that Viterbi decoding marks as content. A null or empty text has no words and
    fails; a null doc_id passes through; repeated rows give equal results; a very long text is decoded whole, alone in its chunk; ties of
    paths go to content; an empty table gives no rows; extra columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, counts, failed, content in _judged(field, batch.column(1)):
                n = counts["n_words"]
                out = [batch.column(0).slice(row, len(n)), *(pa.array(counts[c].astype(np.int64)) for c in COLUMNS), pa.array(failed), pa.array(~failed & (content >= share)), pa.array(content)]
                yield pa.record_batch(out, names=["doc_id", *COLUMNS, "base_failed", "kept", "content_share"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, {', '.join(f'{c} long' for c in COLUMNS)}, base_failed boolean, kept boolean, content_share double")


def keep_content(docs: DataFrame, field: Field, share: float = CONTENT_SHARE) -> DataFrame:
    """The rows of docs that label_lines() marks as kept, with all their columns, whatever their names, without a shuffle.

    Null, empty and very long texts, ties and repeated rows are judged as there; an empty table stays empty.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [~failed & (content >= share) for _, _, failed, content in _judged(field, batch.column(at))]
            yield batch.filter(pa.array(np.concatenate(kept))) if kept else batch

    return docs.mapInArrow(run, docs.schema)
