"""Pattern packing by non-negative least squares.

Pieces of documents are packed into sequences of a fixed length. The plan depends only on the histogram of piece lengths, which
has at most as many entries as a sequence has tokens, however large the corpus:

1. lengths fall into bins; patterns of up to four bins that fill a sequence are enumerated;
2. non-negative least squares fit the patterns' repeat counts to the bins' counts; the counts are rounded down;
3. the patterns take pieces from their bins, longest first, which gives runs of equal sequences of exact lengths;
4. what is left goes, longest first, into the fullest sequence with room (best fit), and into new ones.

A plan is a list of runs (lengths, repeats). Each piece finds its run by its rank among the pieces of its length. Ranks come
from counts by length and hash bucket, so no length, however frequent, is numbered in one task.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.llm.encode import encoder
from postmill.llm.shared import materialize

SEQUENCE, END_ID = 4096, 1
BINS, MOST_DOCUMENTS = 64, 4
RANK_ROWS, CUT_ROWS = 2000, 500


@cache
def patterns(bins: int, most: int) -> np.ndarray:
    """Rows of counts by bin (1..bins) of the patterns of at most `most` bins that sum to exactly `bins`."""
    found = []

    def extend(parts: list[int], left: int, largest: int) -> None:
        if not left:
            found.append(np.bincount(parts, minlength=bins + 1)[1:])
        elif len(parts) < most:
            for part in range(min(left, largest), 0, -1):
                if part * (most - len(parts)) < left:
                    break
                extend([*parts, part], left - part, part)

    extend([], bins, bins)
    return np.array(found)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Least squares of a @ x = b with x >= 0, by accelerated projected gradients."""
    gram, right = a.T @ a, a.T @ b
    step = 1 / np.linalg.norm(gram, 2)
    x = y = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - step * (gram @ y - right), 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        if np.abs(new - x).max() <= 1e-9 * (1 + np.abs(new).max()):
            return new
        x, t = new, t_new
    return x


class _Stock:
    """Counts of pieces by length."""

    def __init__(self, histogram: dict[int, int]):
        self.count = {k: n for k, n in histogram.items() if n}
        self.lengths = sorted(self.count)

    def longest(self, most: int, least: int = 0) -> int | None:
        at = bisect.bisect_right(self.lengths, most) - 1
        return self.lengths[at] if at >= 0 and self.lengths[at] > least else None

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.lengths.pop(bisect.bisect_left(self.lengths, length))


def plan(histogram: dict[int, int], capacity: int = SEQUENCE, bins: int = BINS, most: int = MOST_DOCUMENTS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats): runs of sequences that hold each piece of the histogram once."""
    stock, width = _Stock(histogram), -(-capacity // bins)
    table = patterns(bins, most)
    wanted = np.zeros(bins)
    for length, n in stock.count.items():
        wanted[-(-length // width) - 1] += n
    repeats = np.floor(nnls(table.T.astype(float), wanted) + 1e-6).astype(np.int64) if stock.count else []
    runs: list[list] = []
    for pattern, times in sorted(zip(map(tuple, table), repeats, strict=False), key=lambda x: -x[1]):
        parts = [b for b in range(bins, 0, -1) for _ in range(pattern[b - 1])]
        while times > 0:
            chosen: dict[int, int] = {}
            lengths = []
            for b in parts:
                # pieces of this bin that the run hasn't used up yet
                length = next((k for k in _down(stock, b * width, (b - 1) * width) if stock.count[k] > chosen.get(k, 0)), None)
                if length is None:
                    break
                chosen[length] = chosen.get(length, 0) + 1
                lengths.append(length)
            if len(lengths) < len(parts):
                break
            n = min([int(times), *(stock.count[k] // c for k, c in chosen.items())])
            for k, c in chosen.items():
                stock.take(k, n * c)
            runs.append([tuple(lengths), n])
            times -= n
    # room -> runs with that room
    rooms: dict[int, list[int]] = {}
    for i, (lengths, _) in enumerate(runs):
        rooms.setdefault(capacity - sum(lengths), []).append(i)
    open_rooms = sorted(r for r in rooms if r)
    while stock.lengths:
        length = stock.lengths[-1]
        n = stock.count[length]
        at = bisect.bisect_left(open_rooms, length)
        if at == len(open_rooms):
            runs.append([(), capacity and max(1, n // max(1, capacity // length))])
            rooms.setdefault(capacity, []).append(len(runs) - 1)
            bisect.insort(open_rooms, capacity)
            continue
        room = open_rooms[at]
        i = rooms[room].pop()
        if not rooms[room]:
            open_rooms.pop(at)
        lengths, times = runs[i]
        put = min(times, n)
        stock.take(length, put)
        if put < times:
            runs.append([lengths, times - put])
            rooms[room].append(len(runs) - 1)
            if len(rooms[room]) == 1:
                bisect.insort(open_rooms, room)
        runs[i] = [(*lengths, length), put]
        left = room - length
        rooms.setdefault(left, []).append(i)
        if left and len(rooms[left]) == 1:
            bisect.insort(open_rooms, left)
    return [(lengths, n) for lengths, n in runs if lengths]


def _down(stock: _Stock, most: int, least: int) -> Iterator[int]:
    at = bisect.bisect_right(stock.lengths, most) - 1
    while at >= 0 and stock.lengths[at] > least:
        yield stock.lengths[at]
        at -= 1


def slots(runs: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each length and rank of its pieces, by (length, first rank): where the piece goes."""
    taken: dict[int, int] = {}
    rows, base = [], 0
    for lengths, n in runs:
        offset = 0
        for length in lengths:
            rank = taken.get(length, 0)
            rows.append((length, rank, base, offset))
            taken[length] = rank + n
            offset += length
        base += n
    rows.sort()
    return {k: np.array([r[i] for r in rows], np.int64) for i, k in enumerate(("length", "rank", "base", "offset"))}


def cut(docs: DataFrame, path: str, capacity: int = SEQUENCE, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """The pieces of docs (doc_id, text): doc_id, piece, start, length, ids_crc32, and ids (binary) on demand."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, size = encoder(path).encode_all, end_id.to_bytes(4, "little"), 4 * capacity
        for batch in (b.slice(a, CUT_ROWS) for b in batches for a in range(0, b.num_rows, CUT_ROWS)):
            rows = []
            for doc_id, found in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                data = found + end
                for a in range(0, len(data), size):
                    part = data[a : a + size]
                    rows.append((doc_id, a // size, a // 4, len(part) // 4, zlib.crc32(part), part))
            arrays = [pa.array([r[i] for r in rows], pa.binary() if c == "ids" else pa.int32() if c == "piece" else pa.int64()) for i, c in enumerate(columns)]
            yield pa.record_batch(arrays, names=columns)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids)


def place(pieces: DataFrame, capacity: int = SEQUENCE) -> DataFrame:
    """pieces with sequence_id and offset. The driver sees only the histogram of lengths (at most `capacity` entries)."""
    counts = pieces.groupBy("length").count().collect()
    buckets = sum(r["count"] for r in counts) // RANK_ROWS + 1
    where = slots(plan({r["length"]: r["count"] for r in counts}, capacity))
    keyed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    sums = keyed.groupBy("length", "_bucket").count()
    before = sums.select("length", "_bucket", (F.sum("count").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("count")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = keyed.withColumn("_within", within).join(before, ["length", "_bucket"]).withColumn("_rank", F.col("_before") + F.col("_within")).select(*pieces.columns, "_rank")
    step = max((r["count"] for r in counts), default=0) + 1
    keys, names = where["length"] * step + where["rank"], pieces.columns
    at_length = names.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, length = batch.column(batch.num_columns - 1).to_numpy(), batch.column(at_length).to_numpy()
            at = np.searchsorted(keys, length * step + rank, side="right") - 1
            found = [*batch.columns[:-1], pa.array(where["base"][at] + rank - where["rank"][at]), pa.array(where["offset"][at])]
            yield pa.record_batch(found, names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def pack(docs: DataFrame, path: str, capacity: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and an end id; longer ones than a sequence are cut into pieces of whole sequences and a rest. Null
    and empty texts are the end id alone; a null doc_id passes through; repeated rows are packed each; extra columns are not
    read; an empty table gives an empty table.
    """
    return place(materialize(cut(docs, path, capacity, end_id), "pieces"), capacity)


def sequences(docs: DataFrame, placed: DataFrame, path: str, capacity: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """sequence_id, ids (binary): the packed sequences themselves. doc_ids must be distinct and not null."""
    whole = cut(docs, path, capacity, end_id, ids=True).select("doc_id", "piece", "ids").join(placed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return whole.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x.ids)).alias("ids"))
