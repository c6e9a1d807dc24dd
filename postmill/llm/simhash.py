"""SimHash near-duplicates: fingerprints, a segment-popcount grid range-join, and components.

A 64-bit fingerprint maps to the bit counts of its 32 two-bit segments. The Manhattan distance of two such count vectors is
at most the Hamming distance of the fingerprints, so it is a lower bound. Written in unary (a segment's bits sorted), counts
have their Manhattan distance as the Hamming distance of the codes.

The grid: for distance d the segments are cut into B > d blocks, of which at least B - d agree, so two fingerprints within d
agree on the counts of one of the C(B, d) choices of blocks; the last coordinate is the sum of the counts of all segments, in
steps of d + 1, and sums within d lie in one step or two adjoining ones. A cell is a choice, its counts, and a step; each
distinct fingerprint joins the cells of its own step and of the next one. (Cells of a wider range on the chosen counts would
serve too, but to reach a like number of pairs they take many times the rows: 35 a fingerprint for one pair in 1,000 with
three blocks and neighbours at distance 1, against 15 for one in 4,400 with six blocks that agree.) Inside a cell, only pairs whose sums,
and then whose count vectors, are within d are compared exactly. B grows with the number of fingerprints to keep cells small.

Cells emit links, not pairs: runs of up to 64 rows emit their pairs, larger ones a spanning forest of their links. A cell of
more than CELL_ROWS fingerprints is more than a task should hold: its fingerprints go by midpoints instead, which gives the same
classes, since two fingerprints within an even d have a common value within d / 2 of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm import words as W
from postmill.llm.components import components
from postmill.llm.shared import materialize

SEED, SHINGLE, DISTANCE = 42, 4, 4
SEGMENTS = 32
PAIRWISE_ROWS, CELL_ROWS = 64, 20_000
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The XXH64 of all k-word shingles of the rows of one chunk, and their number in each row."""
    n_rows = len(offsets) - 1
    starts, ends, rows = W.spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n_rows, np.int64)
    data = LOWER[data]
    keep = ~W.IS_SEPARATOR[data]
    gaps = ends[:-1][rows[:-1] == rows[1:]]
    keep[gaps] = True
    data[gaps] = 0x20
    at = np.cumsum(keep)
    text = data[keep].tobytes()
    starts, ends = at[starts] - 1, at[ends - 1]
    bounds = np.searchsorted(rows, np.arange(n_rows + 1))
    n_words = np.diff(bounds)
    n_shingles = np.where(n_words > k, n_words - k + 1, np.minimum(n_words, 1))
    first = np.repeat(bounds[:-1] - np.r_[0, np.cumsum(n_shingles)[:-1]], n_shingles) + np.arange(n_shingles.sum())
    last = np.minimum(first + k - 1, np.repeat(bounds[1:], n_shingles) - 1)
    digest = xxhash.xxh64_intdigest
    values = np.fromiter((digest(text[a:b], SEED) for a, b in zip(starts[first].tolist(), ends[last].tolist(), strict=True)), np.uint64, len(first))
    return values, n_shingles


def signatures(values: np.ndarray, n_shingles: np.ndarray) -> np.ndarray:
    """The fingerprints of rows of shingles."""
    out = np.zeros(len(n_shingles), np.uint64)
    some = np.flatnonzero(n_shingles)
    cuts = np.r_[0, np.cumsum(n_shingles[some])]
    a = 0
    while a < len(some):  # few rows at a time: the bits take 64 bytes a shingle
        b = max(a + 1, int(np.searchsorted(cuts, cuts[a] + 100_000, side="right")) - 1)
        bits = np.unpackbits(values[cuts[a] : cuts[b]].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, cuts[a:b] - cuts[a], axis=0, dtype=np.int32)
        out[some[a:b]] = np.packbits(2 * ones > n_shingles[some[a:b], None], axis=1).view(">u8").ravel()
        a = b
    return out


def fingerprints(docs: DataFrame, id_column: str = "doc_id", k: int = SHINGLE) -> DataFrame:
    """id, fp (long): SimHash over the XXH64 of all k-word shingles of the whole text, A-Z in lower case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signatures(*shingles(data, offsets, k)) for _, data, offsets in W.chunks(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array(np.concatenate(found).view(np.int64) if found else [], pa.int64())], names=["id", "fp"])

    return docs.select(F.col(id_column).cast("long"), "text").mapInArrow(run, "id long, fp long")


def choose_blocks(n: int, distance: int) -> int:
    """The number of blocks that costs least: rows shuffled against pairs compared in cells of random fingerprints.

    At least distance + 2, so that small and middle-sized tables shuffle the same number of rows per fingerprint.
    """
    def cost(blocks: int) -> float:
        segments = SEGMENTS * (blocks - distance) / blocks
        return comb(blocks, distance) * (1 + 0.005 * n * 0.375**segments)

    return min(range(distance + 2, distance + 8), key=cost)


def unary(fp: Column) -> Column:
    """The bit counts of the two-bit segments in unary: each segment's bits sorted."""
    even = F.lit(0x5555555555555555)
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(even), fp.bitwiseAND(even)
    return high.bitwiseOR(low).bitwiseOR(F.shiftleft(high.bitwiseAND(low), 1))


def _unary(fp: np.ndarray) -> np.ndarray:
    even = np.uint64(0x5555555555555555)
    high, low = fp >> np.uint64(1) & even, fp & even
    return high | low | (high & low) << np.uint64(1)


def _cells(fps: DataFrame, blocks: int, distance: int) -> DataFrame:
    """cell, ones, fp: each fingerprint twice for each choice of blocks - distance blocks: in its step of the sum and the next."""
    edges = [SEGMENTS * i // blocks for i in range(blocks + 1)]
    masks = [sum(3 << (2 * s) for s in range(edges[i], edges[i + 1])) for i in range(blocks)]
    step, keys = F.floor(F.bit_count("fp") / (distance + 1)), []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        mask = sum(masks[i] for i in chosen)
        counts = F.col("code").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))
        keys += [F.xxhash64(F.lit(number), counts, step + i) for i in (0, 1)]
    return fps.withColumn("code", unary(F.col("fp"))).select(F.explode(F.array(*keys)).alias("cell"), F.bit_count("fp").alias("ones"), "fp")


def _within(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Whether fingerprints are within the distance: the bound first, the fingerprints where it holds."""
    out = np.bitwise_count(_unary(a) ^ _unary(b)) <= distance
    out[out] = np.bitwise_count((a ^ b)[out]) <= distance
    return out


def _forest(fp: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(from, to) of a spanning forest of the links among the fingerprints."""
    left = fp
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            one = front.pop()
            near = _within(left, one, distance)
            if near.any():
                found, left = left[near], left[~near]
                yield np.full(len(found), one), found
                front.extend(found)


def _links(distance: int):
    def whole_cells(cell: np.ndarray, ones: np.ndarray, fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        cuts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        sizes = np.diff(np.r_[cuts, len(cell)])
        for at in np.flatnonzero(sizes > PAIRWISE_ROWS):
            yield from _forest(fp[cuts[at] : cuts[at] + sizes[at]], distance)
        place = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= PAIRWISE_ROWS), sizes))
        for lag in range(1, PAIRWISE_ROWS):
            place = place[place + lag < len(cell)]
            place = place[(cell[place] == cell[place + lag]) & (ones[place + lag] - ones[place] <= distance)]
            if not len(place):
                break
            near = place[_within(fp[place], fp[place + lag], distance)]
            yield fp[near], fp[near + lag]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        held, full = [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint64)], None
        for batch in batches:
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)]
            if full is not None:  # the rest of a cell that is too large
                more = new[0] == full
                yield out(new[2][more], new[2][more])
                new = [x[~more] for x in new]
                if not len(new[0]):
                    continue
                full = None
            held = [np.concatenate(x) for x in zip(held, new, strict=True)]
            last = int(np.searchsorted(held[0], held[0][-1]))
            for pair in whole_cells(*(x[:last] for x in held)):
                yield out(*pair)
            held = [x[last:] for x in held]
            if len(held[0]) > CELL_ROWS:
                full = held[0][0]
                yield out(held[2], held[2])
                held = [x[:0] for x in held]
        for pair in whole_cells(*held) if len(held[0]) else ():
            yield out(*pair)

    return run


def _midpoint_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links of fingerprints that share a value within half the distance of each, led by the smallest; exact once verified.

    Only chains through a common value are made, so their number grows with the fingerprints, not with the pairs.
    """
    half = distance - distance // 2
    masks = [0] + [sum(1 << i for i in c) for r in range(1, half + 1) for c in combinations(range(64), r)]
    masks = [m - (1 << 64) if m >> 63 else m for m in masks]
    around = fps.select("fp", F.explode(F.array(*map(F.lit, masks))).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("mid"))
    least = around.groupBy("mid").agg(F.min("fp").alias("least"))
    return around.join(least, "mid").where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct()


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """a, b: links among distinct fingerprints (fp) whose closure is that of all pairs within the distance."""
    if distance % 2:
        raise ValueError("the distance must be even: an odd one has no midpoints")
    blocks = choose_blocks(fps.count(), distance)
    cells = _cells(fps, blocks, distance).repartition("cell").sortWithinPartitions("cell", "ones")
    found = materialize(cells.mapInArrow(_links(distance), "a long, b long"), "links")
    large = found.where("a = b").select(F.col("a").alias("fp")).distinct()
    near = found.where("a <> b")
    if large.isEmpty():
        return near
    return near.unionByName(_midpoint_links(large, distance))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", k: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hex digits), component_id.

    Fingerprints link at `distance` or fewer differing bits; component_id is the smallest id reachable over links. Null and
    empty texts have fingerprint zero and link like any other. Equal fingerprints are one node, so groups of copies cost
    one row. Null ids share in a component but don't name it (a component of null ids only has a null component_id).
    Repeated rows return as often as they occur; extra columns are not read; an empty table gives an empty table.
    """
    marked = materialize(fingerprints(docs, id_column, k), "fingerprints")
    return grouped(marked, links(materialize(marked.select("fp").distinct(), "distinct"), distance))


def grouped(marked: DataFrame, near: DataFrame) -> DataFrame:
    """near_duplicates() of rows (id, fp) in a table, given the links (a, b) of fingerprints."""
    distinct = materialize(marked.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    roots = components(near).withColumnRenamed("node", "fp")
    named = roots.join(distinct, "fp")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    reached = named.join(least, "root").select("fp", "component_id")
    # a table of its own, so that the join below is of two exchanges, of which Spark can split a skewed partition
    classes = materialize(distinct.join(reached, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id")), "classes")
    return marked.join(classes, "fp").select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", k: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of docs whose id names their component, with all their columns: one document of each group stays.

    Rows of one id and text are one document. Rows with a null id stay only if their component has no id.
    """
    return named_rows(docs, near_duplicates(docs, id_column, k, distance), id_column)


def named_rows(docs: DataFrame, found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows of docs whose id names their component in found (id, component_id)."""
    kept = found.where(F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("id").alias("_id")).distinct()
    key = [F.col(id_column).alias("_key"), F.xxhash64("text").alias("_text")]
    # rows of one id and text are one document; only such rows are shuffled to merge them
    again = materialize(docs.select(*key).groupBy("_key", "_text").count().where("count > 1").drop("count"), "again")
    rows = docs.select(F.struct("*").alias("_row"), *key).join(kept, F.col("_key").eqNullSafe(F.col("_id")), "left_semi")
    if again.isEmpty():
        return rows.select("_row.*")
    same = rows["_key"].eqNullSafe(again["_key"]) & rows["_text"].eqNullSafe(again["_text"])
    return rows.join(again, same, "left_anti").unionByName(rows.join(again, same, "left_semi").dropDuplicates(["_key", "_text"])).select("_row.*")
