"""Documents whose sets of five-word shingles have a Jaccard similarity of at least 0.8, beside those that op9 links.

Fingerprints of 64 bits can't find such pairs: at 0.8 they differ in ten bits, where no grid is selective. So candidates come
from minimum hashes: a sketch holds VALUES of them, cut to 16 bits; four make a band, and texts that share one of the bands are
candidates (a pair at 0.8 shares none with probability (1 - 0.8 ** 4) ** 16 = 2e-4, a more similar one with less). Pairs whose
sketches agree in ESTIMATE of their values or more (three standard deviations below 0.8) are verified on the whole sets.

Texts that op9 links are one class from the start, and only pairs of different classes are looked at. In a band's cell of up to
PAIRWISE_ROWS texts all pairs are; a larger one is dealt into blocks, in which each text meets its neighbours in a random order,
in ROUNDS rounds with another order each, and classes grow by the links found. What is then still apart is certified: classes that
share a cell are a family, and each text outside its family's largest class is compared with all the family's texts, set by
set, in blocks of bounded size. So links that merge nothing are not looked for, and no group's pairs are listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm import simhash
from postmill.llm import words as W
from postmill.llm.components import components
from postmill.llm.shared import discard, materialize

SIMILARITY, ESTIMATE = 0.8, 0.65
VALUES, BAND = 64, 4
PAIRWISE_ROWS, NEIGHBOURS, CELL_ROWS, ROUNDS, BLOCK_ITEMS = 32, 2, 4096, 3, 1 << 20
_random = np.random.default_rng(8)
SEEDS, FACTORS = (_random.integers(0, 1 << 64, VALUES, np.uint64) | np.uint64(1) for _ in range(2))


def five_word(values: np.ndarray, n_shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of five-word shingles, and their number in each row, from those of four words: two neighbours make one."""
    if not len(values):
        return values, n_shingles
    row = np.repeat(np.arange(len(n_shingles)), n_shingles)
    mixed = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + np.roll(values, -1)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    pair = np.r_[row[1:] == row[:-1], False]
    single = n_shingles[row] == 1
    return np.where(single, values, mixed)[pair | single], np.where(n_shingles > 1, n_shingles - 1, n_shingles)


def _sketches(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sketches (VALUES numbers of 16 bits) of the rows that have shingles."""
    starts = np.r_[0, np.cumsum(counts[counts > 0])[:-1]]
    out = np.zeros((len(starts), VALUES), np.uint16)
    for number in range(VALUES):
        hashed = (values ^ SEEDS[number]) * FACTORS[number]
        least = np.minimum.reduceat(hashed ^ (hashed >> np.uint64(32)), starts)
        out[:, number] = W.mix(least).astype(np.uint16)
    return out


def sketches(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """id, h (hash of the text), fp (op9's fingerprint), sketch: a long for each band (none for a text without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, found, sizes = [], [], []
            for _, data, offsets in W.chunks(batch.column(2)):
                values, n = simhash.shingles(data, offsets, simhash.SHINGLE)
                fps.append(simhash.signatures(values, n))
                values, n = five_word(values, n)
                sizes.append(np.where(n > 0, VALUES // BAND, 0))
                if len(values):
                    found.append(_sketches(values, n).view(np.int64).ravel())
            if fps:
                cuts = np.r_[0, np.cumsum(np.concatenate(sizes))].astype(np.int32)
                flat = pa.array(np.concatenate(found) if found else [], pa.int64())
                columns = [batch.column(0), batch.column(1), pa.array(np.concatenate(fps).view(np.int64)), pa.ListArray.from_arrays(pa.array(cuts), flat)]
                yield pa.record_batch(columns, names=["id", "h", "fp", "sketch"])

    return docs.select(F.col(id_column).cast("long"), F.xxhash64("text"), "text").mapInArrow(run, "id long, h long, fp long, sketch array<long>")


def sets(texts: DataFrame) -> DataFrame:
    """h, items: the distinct five-word shingles of texts (h, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, data, offsets in W.chunks(batch.column(1)):
                values, n = five_word(*simhash.shingles(data, offsets, simhash.SHINGLE))
                found += [np.unique(v).view(np.int64) for v in np.split(values, np.cumsum(n)[:-1])]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["h", "items"])

    return texts.select("h", "text").mapInArrow(run, "h long, items array<long>")


PAIR = "a long, b long, ra long, rb long"


def _pairs(h: np.ndarray, root: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    i, j = np.where(h[i] < h[j], i, j), np.where(h[i] < h[j], j, i)
    return pa.record_batch([pa.array(x) for x in (h[i], h[j], root[i], root[j])], names=["a", "b", "ra", "rb"])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of whole units of rows (unit, h, root, sketch, probe) that are sorted by unit."""
    def arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
        sketch = batch.column(3).flatten().to_numpy(zero_copy_only=False)
        return [*(batch.column(i).to_numpy() for i in range(3)), np.ascontiguousarray(sketch).view(np.uint16).reshape(-1, VALUES), batch.column(4).to_numpy(zero_copy_only=False)]

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = arrays(batch)
        held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
        last = int(np.searchsorted(held[0], held[0][-1]))
        if last:
            yield tuple(x[:last] for x in held)
            held = [x[last:] for x in held]
    if held is not None:
        yield tuple(held)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of small units, and of each row of a larger one those with the rows before it; only likely ones of two classes."""
    for unit, h, root, sketch, _ in _units(batches):
        cuts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
        sizes = np.diff(np.r_[cuts, len(unit)])
        reach = np.repeat(np.where(sizes <= PAIRWISE_ROWS, sizes, NEIGHBOURS), sizes)
        at = np.arange(len(unit))
        for lag in range(1, PAIRWISE_ROWS):
            at = at[at + lag < len(unit)]
            at = at[(unit[at] == unit[at + lag]) & (lag <= reach[at])]
            if not len(at):
                break
            apart = at[root[at] != root[at + lag]]
            likely = apart[(sketch[apart] == sketch[apart + lag]).sum(1) >= ESTIMATE * VALUES]
            if len(likely):
                yield _pairs(h, root, likely, likely + lag)


def _probes(similarity: float):
    """Of rows (unit, root, probe, items) sorted by unit, the classes of the similar pairs of a probe and a row of another class."""
    def whole_units(unit: np.ndarray, root: np.ndarray, probe: np.ndarray, sizes: np.ndarray, items: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.r_[0, np.cumsum(sizes)]
        cuts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1], True])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = items[starts[a] : starts[b]]
            for i in a + np.flatnonzero(probe[a:b]):
                own = items[starts[i] : starts[i + 1]]
                known = own[np.minimum(np.searchsorted(own, part), len(own) - 1)] == part
                both = np.add.reduceat(known, starts[a:b] - starts[a], dtype=np.int64)
                near = root[a:b][(root[a:b] != root[i]) & ~probe[a:b] & (both >= similarity * (len(own) + sizes[a:b] - both) - 1e-9)]
                if len(near):
                    yield pa.record_batch([pa.array(np.full(len(near), root[i])), pa.array(near)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(3)
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy()]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            last = int(np.searchsorted(held[0], held[0][-1]))
            if last:
                cut = int(held[3][:last].sum())
                yield from whole_units(*(x[:last] for x in held[:4]), held[4][:cut])
                held = [*(x[last:] for x in held[:4]), held[4][cut:]]
        if held is not None:
            yield from whole_units(*held)

    return run


def _meet(rows: DataFrame, salt: int) -> DataFrame:
    # one order in all cells, so that two texts that share several are neighbours in most of them
    block = F.pmod(F.xxhash64("h", F.lit(salt)), F.ceil(F.col("n") / CELL_ROWS))
    dealt = rows.select(F.xxhash64("cell", block).alias("unit"), "h", "root", "sketch", F.lit(False).alias("probe"), F.xxhash64("h", F.lit(salt + 100)).alias("place"))
    return dealt.repartition("unit").sortWithinPartitions("unit", "place").drop("place").mapInArrow(_neighbours, PAIR).distinct()


def _items(ends: DataFrame, docs: DataFrame) -> DataFrame:
    """A table of the sets of some texts (h)."""
    ends = materialize(ends, "ends")  # of known size, so that Spark may broadcast it in place of dealing out all texts
    texts = docs.select(F.xxhash64("text").alias("h"), "text").join(ends, "h", "left_semi").groupBy("h").agg(F.first("text").alias("text"))
    items = materialize(sets(texts), "sets")
    discard(ends)
    return items


def _certify(rows: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """a, b: all links that are left among the classes of open cells."""
    tied = rows.groupBy("cell").agg(F.min("root").alias("least")).join(rows.select("cell", "root").distinct(), "cell").where("root <> least").select(F.col("root").alias("a"), F.col("least").alias("b"))
    family = materialize(components(materialize(tied.distinct(), "tied")).select(F.col("node").alias("root"), F.col("root").alias("family")), "families")
    texts = rows.select("h", "root").distinct().join(family, "root")
    items = _items(texts.select("h"), docs)
    texts = materialize(texts.join(items, "h").select("family", "root", "h", "items"), "members")
    sizes = texts.groupBy("family", "root").agg(F.count(F.lit(1)).alias("k"), F.sum(F.size("items")).alias("n"))
    tops = materialize(sizes.groupBy("family").agg(F.max_by("root", F.struct("k", "root")).alias("top"), F.ceil(F.sum("n") / BLOCK_ITEMS).alias("blocks")), "tops")
    dealt = texts.join(tops, "family").withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks")))
    unit = lambda b: F.xxhash64("family", b).alias("unit")
    homes = dealt.select(unit("block"), "root", F.lit(False).alias("probe"), "items")
    outer = dealt.where("root <> top").withColumn("each", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(unit("each"), "root", F.lit(True).alias("probe"), "items")
    found = homes.unionByName(outer).repartition("unit").sortWithinPartitions("unit").mapInArrow(_probes(similarity), "a long, b long").distinct()
    found = materialize(found, "similar")
    for table in (items, texts, tops, family):
        discard(table)
    return found


def _verified(pairs: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """a, b: the classes of the pairs whose whole sets are similar."""
    pairs = materialize(pairs, "pairs")
    items = _items(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), docs)
    a, b = (items.select(F.col("h").alias(x), F.col("items").alias(f"i{x}")) for x in "ab")
    both = F.size(F.array_intersect("ia", "ib"))
    near = pairs.join(a, "a").join(b, "b").where(F.least(F.size("ia"), F.size("ib")) >= similarity * F.greatest(F.size("ia"), F.size("ib")) - 1e-9).where(both >= similarity * (F.size("ia") + F.size("ib") - both) - 1e-9)
    found = materialize(near.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "similar")
    discard(items)
    discard(pairs)
    return found


def links(docs: DataFrame, marked: DataFrame, classes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """a, b: links among classes (fp, root: of fingerprints that op9 links; others are their own), whose closure is that of all
    similar pairs that share a band. marked is a table of sketches()."""
    texts = marked.groupBy("h").agg(F.first("fp").alias("fp"), F.first("sketch").alias("sketch")).where(F.size("sketch") > 0)
    texts = materialize(texts.join(classes, "fp", "left").select("h", F.coalesce("root", "fp").alias("root"), "sketch"), "texts")
    cells = texts.select("h", F.posexplode("sketch").alias("number", "value")).select(F.xxhash64("number", "value").alias("cell"), "h")
    shared = materialize(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    rows = materialize(cells.join(shared, "cell").join(texts, "h"), "rows")
    discard(shared)
    discard(texts)
    found = _verified(_meet(rows, 0), docs, similarity)
    open_ = materialize(rows.where(F.col("n") > PAIRWISE_ROWS), "open")
    discard(rows)
    for salt in range(1, ROUNDS + 1):
        now = components(found).withColumnRenamed("root", "new")
        named = open_.join(now, F.col("root") == F.col("node"), "left").withColumn("root", F.coalesce("new", "root")).select(*open_.columns)
        apart = named.groupBy("cell").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("cell")
        before, open_ = open_, materialize(named.join(apart, "cell", "left_semi"), "open")
        discard(before)
        if open_.isEmpty():
            break
        found = found.unionByName(_verified(_meet(open_, salt), docs, similarity) if salt < ROUNDS else _certify(open_, docs, similarity))
    discard(open_)
    return found


def one_of_each(docs: DataFrame, id_column: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group of documents that are similar or that op9 links; which rows stay is as in simhash.one_of_each().

    Null and empty texts have no shingles: they are alike to op9 and one of them stays. Texts of fewer than five words are one shingle.
    Null ids count as largest; of rows of one id and text one stays; very long texts count whole; extra columns pass, whatever
    their names; an empty table stays empty.
    """
    marked = materialize(sketches(docs, id_column), "sketches")
    near = materialize(simhash.links(materialize(marked.select("fp").distinct(), "distinct")), "near")
    more = links(docs, marked, components(near).withColumnRenamed("node", "fp"), similarity)
    return simhash.named_rows(docs, simhash.grouped(marked.select("id", "fp"), near.unionByName(more)), id_column)
