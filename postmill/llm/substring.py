"""Removal of repeated passages by difference-cover anchors.

A difference cover D of period v holds, for any two word positions i and j, a shift below v that brings both onto D (mod v).
So two texts that share a window of 13 words share an aligned anchor of 13 - v + 1 words at positions on D, and only those
anchors (3 of 7) are shuffled. The steps, all in one lazy plan over one exchange of the texts by group g:

1. anchors: each group's distinct anchors, packed by hash bucket;
2. shared anchors: hashes that occur in two groups go back to the groups that hold them;
3. extension: windows of 13 words around a shared anchor, as 128-bit values with the group's smallest doc_id;
4. earlier windows: values with a smaller doc_id in another group go back;
5. removal: words under such windows, or under windows that another text of the group holds with a smaller doc_id.

Equal texts are one text: the first keeps its place and the others lose all words (from 13 words on). A group holds few MB of
texts, chosen by the text's hash, and a frequent passage counts once per group, so no key gathers more than the number of
groups. A text is never split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm import words as W

WINDOW, PERIOD, COVER = 13, 7, (0, 1, 3)
GROUP_BYTES = 4 << 20
BUCKET_VALUES = 400_000
LAST = (1 << 63) - 1
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def is_cover(cover: tuple[int, ...], period: int) -> bool:
    """Whether every difference modulo the period occurs between two members."""
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def _chunks(table: pa.Table, window: int) -> Iterator[tuple]:
    """Of the distinct texts (smallest d first): rows, word rows, word hashes, whether the word's row has a whole window."""
    order = np.lexsort((table["d"].to_numpy(), table["h2"].to_numpy(), table["h1"].to_numpy()))
    h = np.stack([table["h1"].to_numpy()[order], table["h2"].to_numpy()[order]])
    first = np.ones(len(order), bool)
    first[1:] = (h[:, 1:] != h[:, :-1]).any(0)
    table = table.take(pa.array(order[first]))
    text = table["text"].combine_chunks()
    for row, data, offsets in W.chunks(text):
        starts, ends, rows = W.spans(data, offsets)
        part = table.slice(row, len(offsets) - 1)
        yield part, data, offsets, rows, W.word_hashes(data, starts, ends)


def _flagged(table: pa.Table) -> np.ndarray:
    found = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _isin(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


def _anchors(rows: np.ndarray, hashes: np.ndarray, window: int, period: int, cover: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, value) of the anchors at cover positions of rows that hold a whole window."""
    k = window - period + 1
    n = max(len(rows) - k + 1, 0)
    at = np.arange(n)
    first = np.searchsorted(rows, rows[:n])
    whole = np.zeros(n, bool)
    whole[: max(len(rows) - window + 1, 0)] = W.whole_windows(rows, window)
    # an anchor may end the row: some window of the row holds it if the row has a whole window at all
    roomy = (first + window <= len(rows)) & (rows[np.minimum(first + window - 1, len(rows) - 1)] == rows[:n])
    chosen = np.flatnonzero(np.isin((at - first) % period, cover) & W.whole_windows(rows, k) & roomy)
    return chosen, W.window_hashes(hashes, k)[chosen]


def _blocks(bucket: np.ndarray, columns: dict[str, np.ndarray], g: int, names: tuple[str, ...]) -> pa.Table:
    order = np.argsort(bucket, kind="stable")
    cuts = [order[a:b] for a, b in _runs(bucket[order])]
    out = {"bucket": pa.array([bucket[c[0]] for c in cuts], pa.int32()), "g": pa.array([g] * len(cuts), pa.int32())}
    return pa.table(out | {n: pa.array([columns[n][c].tobytes() for c in cuts], pa.binary()) for n in names})


def _anchor_blocks(window: int, period: int, cover: tuple[int, ...], buckets: int):
    def run(table: pa.Table) -> pa.Table:
        found = [_anchors(rows, hashes, window, period, cover)[1] for _, _, _, rows, hashes in _chunks(table, window)]
        values = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
        return _blocks((values % np.uint64(buckets)).astype(np.int32), {"hashes": values}, table["g"][0].as_py(), ("hashes",))

    return run


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the runs of equal keys."""
    if not len(keys):
        return []
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return list(zip([0, *cuts], [*cuts, len(keys)], strict=True))


def _by_group(g: np.ndarray, values: np.ndarray) -> pa.Table:
    runs = _runs(g)
    return pa.table({"g": pa.array([g[a] for a, _ in runs], pa.int32()), "hashes": pa.array([values[a:b].tobytes() for a, b in runs], pa.binary())})


def _shared_anchors(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
    values, g = np.concatenate(parts), np.repeat(table["g"].to_numpy(), [len(x) for x in parts])
    order = np.argsort(values, kind="stable")
    v = values[order]
    same = v[1:] == v[:-1]
    keep = order[np.r_[same, False] | np.r_[False, same]]
    keep = keep[np.argsort(g[keep], kind="stable")]
    return _by_group(g[keep], values[keep])


def _windows(window: int, period: int, cover: tuple[int, ...], buckets: int):
    k = window - period + 1

    def run(docs: pa.Table, shared: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _blocks(np.zeros(0, np.int32), {n: np.zeros(0, np.uint64) for n in ("hi", "lo", "d")}, 0, ("hi", "lo", "d"))
        known, parts, local = _flagged(shared), [], []
        for part, _, _, rows, hashes in _chunks(docs, window):
            at, values = _anchors(rows, hashes, window, period, cover)
            parts.append((part["d"].to_numpy(), rows, hashes, at, values))
            # once per text, to count texts
            order = np.lexsort((values, rows[at]))
            v, r = values[order], rows[at][order]
            local.append(v[np.r_[True, (v[1:] != v[:-1]) | (r[1:] != r[:-1])]] if len(v) else v)
        both = np.sort(np.concatenate(local))
        known = np.unique(np.concatenate([known, both[1:][both[1:] == both[:-1]]]))
        hi, lo, d = [], [], []
        for ids, rows, hashes, at, values in parts:
            n = len(rows) - window + 1
            if n <= 0:
                continue
            hit = np.zeros(len(rows) + 1, np.int64)
            hit[at[_isin(values, known)] + 1] = 1
            total = np.cumsum(hit)
            start = np.flatnonzero((total[period : period + n] - total[:n] > 0) & W.whole_windows(rows, window))
            for out, seed in ((hi, 1), (lo, 2)):
                value = np.zeros(len(start), np.uint64)
                for j, factor in enumerate(W._factors(window, seed)):
                    value += hashes[start + j] * factor
                out.append(W.mix(value))
            d.append(ids[rows[start]])
        hi, lo, d = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (hi, lo, d))
        order = np.lexsort((d, lo, hi))
        first = np.ones(len(order), bool)
        first[1:] = (hi[order][1:] != hi[order][:-1]) | (lo[order][1:] != lo[order][:-1])
        keep = np.sort(order[first])
        hi, lo, d = hi[keep], lo[keep], d[keep]
        return _blocks((hi % np.uint64(buckets)).astype(np.int32), {"hi": hi, "lo": lo, "d": d.astype(np.int64)}, docs["g"][0].as_py(), ("hi", "lo", "d"))

    assert k > 0
    return run


def _earlier(table: pa.Table) -> pa.Table:
    hi, lo = (np.concatenate([np.frombuffer(x, np.uint64) for x in table[n].to_pylist()]) for n in ("hi", "lo"))
    parts = [np.frombuffer(x, np.int64) for x in table["d"].to_pylist()]
    d, g = np.concatenate(parts), np.repeat(table["g"].to_numpy(), [len(x) for x in parts])
    order = np.lexsort((lo, hi))
    h, low = hi[order], lo[order]
    starts = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (low[1:] != low[:-1])])  # blocks are never empty
    least = np.repeat(np.minimum.reduceat(d[order], starts), np.diff(np.r_[starts, len(order)]))
    keep = order[least < d[order]]
    keep = keep[np.argsort(g[keep], kind="stable")]
    return _by_group(g[keep], lo[keep])


RESULT = "h1 long, h2 long, d long, n_words long, n_removed long, kept_sha256 string"


def _removal(window: int):
    def run(docs: pa.Table, earlier: pa.Table) -> pa.Table:
        known, parts, out = _flagged(earlier), [], {n: [] for n in ("h1", "h2", "d", "n_words", "n_removed", "kept_sha256")}
        for part, data, offsets, rows, hashes in _chunks(docs, window) if docs.num_rows else ():
            whole = np.flatnonzero(W.whole_windows(rows, window))
            value = np.zeros(len(whole), np.uint64)
            for j, factor in enumerate(W._factors(window, 2)):
                value += hashes[whole + j] * factor
            parts.append((part, data, offsets, rows, whole, W.mix(value)))
        if parts:
            values = np.concatenate([p[5] for p in parts])
            ids = np.concatenate([p[0]["d"].to_numpy()[p[3][p[4]]] for p in parts])
            order = np.lexsort((ids, values))
            v, i = values[order], ids[order]
            starts = np.flatnonzero(np.r_[True, v[1:] != v[:-1]]) if len(v) else np.zeros(0, int)
            least = np.empty(len(v), np.int64)
            least[order] = np.repeat(i[starts], np.diff(np.r_[starts, len(v)]))
            gone = _isin(values, known) | (least < ids)
        at = 0
        for part, data, offsets, rows, whole, value in parts:
            drop = W.covered(len(rows), whole[gone[at : at + len(value)]], window)
            at += len(value)
            bounds = np.searchsorted(rows, np.arange(part.num_rows + 1))
            total = np.r_[0, np.cumsum(drop)]
            removed = total[bounds[1:]] - total[bounds[:-1]]
            raw = data.tobytes()
            for r in range(part.num_rows):
                kept = raw[offsets[r] : offsets[r + 1]].split()
                if removed[r]:
                    kept = compress(kept, ~drop[bounds[r] : bounds[r + 1]])
                out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            for n in ("h1", "h2", "d"):
                out[n].append(part[n].to_numpy())
            out["n_words"].append(np.diff(bounds))
            out["n_removed"].append(removed)
        columns = {n: pa.array(np.concatenate(out[n]).astype(np.int64) if out[n] else [], pa.int64()) for n in ("h1", "h2", "d", "n_words", "n_removed")}
        return pa.table(columns | {"kept_sha256": pa.array(out["kept_sha256"], pa.string())})

    return run


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of equal texts in a batch, the one with the smallest d."""
    for batch in batches:
        h1, h2, d = (batch.column(n).to_numpy() for n in ("h1", "h2", "d"))
        order = np.lexsort((d, h2, h1))
        first = np.ones(len(order), bool)
        first[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
        yield batch if first.all() else batch.take(pa.array(np.sort(order[first])))


def remove_repeats(docs: DataFrame, window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, n_removed, kept_sha256.

    Words lie under removal if a window of `window` words covers them whose words also start in a row with a smaller
    doc_id; windows are judged on the input. A null text has no words, a null doc_id counts as larger than all others,
    rows of one doc_id don't remove each other, texts shorter than the window stay whole, and extra columns are not read.
    """
    if not is_cover(cover, period) or period > window:
        raise ValueError("cover must be a difference cover of a period not longer than the window")
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("d"), text.alias("text")).select("*", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), "text").alias("h2"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = total // GROUP_BYTES + 1
    anchor_buckets, window_buckets = total // (15 * BUCKET_VALUES) + 1, total // (15 * BUCKET_VALUES) + 1
    grouped = keyed.select(F.pmod("h1", F.lit(groups)).cast("int").alias("g"), "h1", "h2", "d", "text")
    texts = grouped.mapInArrow(_thin, grouped.schema).repartition("g")
    anchors = texts.groupBy("g").applyInArrow(_anchor_blocks(window, period, cover, anchor_buckets), "bucket int, g int, hashes binary")
    shared = anchors.groupBy("bucket").applyInArrow(_shared_anchors, "g int, hashes binary")
    blocks = texts.groupBy("g").cogroup(shared.groupBy("g")).applyInArrow(_windows(window, period, cover, window_buckets), "bucket int, g int, hi binary, lo binary, d binary")
    earlier = blocks.groupBy("bucket").applyInArrow(_earlier, "g int, hashes binary")
    results = texts.groupBy("g").cogroup(earlier.groupBy("g")).applyInArrow(_removal(window), RESULT)
    own = (F.col("d") == F.col("first_d")) | (F.col("n_words") < window)
    return (
        keyed.select("doc_id", "d", "h1", "h2")
        .join(results.withColumnRenamed("d", "first_d"), ["h1", "h2"], "left")
        .select("doc_id", "n_words", F.when(own, F.col("n_removed")).otherwise(F.col("n_words")).alias("n_removed"), F.when(own, F.col("kept_sha256")).otherwise(F.lit(EMPTY_SHA)).alias("kept_sha256"))
    )


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, i, array_to_string(w[i : i + 12], ' ') AS x FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT x, min(doc_id) AS least FROM s GROUP BY x),
g AS (SELECT r, i FROM s JOIN m USING (x) WHERE least < doc_id),
c AS (SELECT DISTINCT r, i + k AS i FROM g, range(0, 13) t(k)),
p AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT p.r, string_agg(word, ' ' ORDER BY p.i) FILTER (c.i IS NULL) AS kept, count(c.i) AS n_removed FROM p LEFT JOIN c ON p.r = c.r AND p.i = c.i GROUP BY p.r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r)
"""
