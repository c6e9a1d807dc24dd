"""Alignment of two tokenizers' tokens over the bytes of the same text, by galloping intersection of their ends.

A is a byte-level file of the tokenizers library, B a sentencepiece model, which puts a space before each text; so A encodes
the text with a space before it. Each token covers a range of bytes. Of the two lists of ends the shorter one drives: each of
its ends is looked for in the longer list by steps that double, from where it should be by its share, and then by halving.
Ends in both lists cut the tokens into groups; differences of ranks give the range of B tokens that each A token overlaps.
A link is a pair of tokens that end together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from postmill.llm import sparse
from postmill.llm import words as W
from postmill.llm.encode import encoder
from postmill.llm.pieces import pieces
from postmill.llm.shared import materialize

#: a chunk is one row of results; its texts are aligned in parts, so that the arrays per byte and per token stay small
CHUNK_BYTES, PART_BYTES, KNOWN = 4 << 20, 1 << 20, 400_000


def gallop(values: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each value, the first place from low to high in the ascending ends whose end is not below it; all values step together.

    guess, in low..high - 1, is where the search begins: probes at distances 1, 3, 7, 15 ... bracket the place, halving finds it.
    """
    below = ends[guess] < values
    left, right = np.where(below, guess + 1, low), np.where(below, high, guess)
    for up in (True, False):
        active, step = np.flatnonzero(below if up else ~below), 1
        while len(active):
            active = active[left[active] < right[active]]
            probe = np.minimum(left[active] + step - 1, right[active] - 1) if up else np.maximum(right[active] - step, left[active])
            less = ends[probe] < values[active]
            left[active[less]] = probe[less] + 1
            right[active[~less]] = probe[~less]
            active, step = active[less if up else ~less], 2 * step
    active = np.flatnonzero(left < right)
    while len(active):
        middle = (left[active] + right[active]) >> 1
        less = ends[middle] < values[active]
        left[active[less]] = middle[less] + 1
        right[active[~less]] = middle[~less]
        active = active[left[active] < right[active]]
    return left


class Alignment(NamedTuple):
    """Tokens of some documents, one after another; a_start and b_start have where each document's begin, and the end."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_start: np.ndarray
    b_start: np.ndarray
    #: of each A token, the number of the B token in which it ends, and whether they end together
    ends_in: np.ndarray
    together: np.ndarray

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the A and B tokens that end together."""
        a = np.flatnonzero(self.together)
        return a, self.ends_in[a]

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each A token, the first and last B token whose bytes it shares."""
        after = self.ends_in + self.together
        first = np.r_[0, after[:-1]] if len(after) else after
        return first, self.ends_in


def align(a_ids: np.ndarray, b_ids: np.ndarray, a_start: np.ndarray, b_start: np.ndarray, a_size: np.ndarray, b_size: np.ndarray) -> Alignment:
    """Aligns documents whose A and B tokens have equally many bytes; sizes has the bytes of each id, at least 1."""
    a_ends, b_ends = np.cumsum(a_size[a_ids], dtype=np.int64), np.cumsum(b_size[b_ids], dtype=np.int64)
    n_a, n_b = np.diff(a_start), np.diff(b_start)
    by_a = n_a <= n_b
    rank, together = np.zeros(len(a_ids), np.int64), np.zeros(len(a_ids), bool)

    def search(docs, n, start, values, m, other, ends):
        doc = np.repeat(docs, n[docs])
        here = np.arange(len(doc)) - np.repeat(np.cumsum(n[docs]) - n[docs], n[docs])
        token = start[doc] + here
        return token, gallop(values[token], ends, other[doc], other[doc + 1], other[doc] + here * m[doc] // n[doc])

    token, found = search(np.flatnonzero(by_a), n_a, a_start, a_ends, n_b, b_start, b_ends)
    rank[token], together[token] = found, b_ends[found] == a_ends[token]
    token, found = search(np.flatnonzero(~by_a), n_b, b_start, b_ends, n_a, a_start, a_ends)
    hit = a_ends[found] == b_ends[token]
    # B tokens that end before an A token does: those found in A tokens before, and those that end inside it
    inside = np.bincount(found[~hit], minlength=len(a_ids))
    closing = np.zeros(len(a_ids), bool)
    closing[found[hit]] = True
    own = np.repeat(~by_a, n_a)
    per_doc = np.cumsum(inside + closing) - closing
    base = np.repeat(b_start[:-1] - np.r_[0, np.cumsum((inside + closing))][a_start[:-1]], n_a)
    rank[own], together[own] = (per_doc + base)[own], closing[own]
    return Alignment(a_ids, b_ids, a_start, b_start, rank, together)


def group_texts(x: Alignment) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where each document's begin and the end) of `a1,a2|b1;a3|b2,b3;`: decimal ids of A and B by group."""
    a, b = x.links()
    groups_before = np.cumsum(x.together) - x.together
    a_place = np.arange(len(x.a_ids)) + np.r_[0, b + 1][groups_before]
    b_last = np.zeros(len(x.b_ids), bool)
    b_last[b] = True
    b_group = np.cumsum(b_last) - b_last
    b_place = np.arange(len(x.b_ids)) + (a + 1)[b_group]
    ids, sign = np.empty(len(a_place) + len(b_place), np.int64), np.full(len(a_place) + len(b_place), ord(","), np.uint8)
    ids[a_place], ids[b_place] = x.a_ids, x.b_ids
    sign[a_place[x.together]], sign[b_place[b_last]] = ord("|"), ord(";")
    digits = np.ones(len(ids), np.int64)
    power = 10
    while len(ids) and power <= ids.max():
        digits += ids >= power
        power *= 10
    ends = np.cumsum(digits + 1)
    out = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    out[ends - 1] = sign
    at, rest = ends - 2, ids
    while len(at):
        rest, digit = np.divmod(rest, 10)
        out[at] = digit + 48
        digits = digits - 1
        more = digits > 0
        at, rest, digits = at[more] - 1, rest[more], digits[more]
    return out, np.r_[0, ends][x.a_start + x.b_start]


class _Pair:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = encoder(path_a, plain=True), pieces(path_b)
        letters = {code: byte for byte, code in self.a.letters.items()}
        tokens = [self.a.tokenizer.id_to_token(i) or "" for i in range(self.a.tokenizer.get_vocab_size())]
        self.tables = [self._table([bytes(letters.get(ord(c), ord(c) & 255) for c in t) for t in tokens]), self._table(self.b.texts)]
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _table(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size, size

    def joined(self, side: int, ids: np.ndarray) -> np.ndarray:
        """The bytes of tokens, one after another."""
        flat, start, size = self.tables[side]
        n = size[ids]
        ends = np.cumsum(n)
        return flat[np.repeat(start[ids] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]

    def b_ids(self, prepared: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where each row's begin and the end) of prepared rows."""
        data, offsets = next(((d, o) for _, d, o in W.chunks(prepared, 1 << 62)), (np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)))
        found, keys, rows = self.b.pre_tokens(data, offsets)
        texts = found.to_pylist()
        new = [t for t in texts if t not in self.known]
        if len(self.known) + len(new) > KNOWN:
            self.known, new = {}, texts
        self.known.update(zip(new, (np.array(x, "<u4").tobytes() for x in self.b.ids(new)), strict=True))
        parts = [self.known[t] for t in texts]
        if len(self.known) > KNOWN:
            self.known = {}
        flat, sizes = np.frombuffer(b"".join(parts), "<u4"), np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        starts, m = (np.cumsum(sizes) - sizes)[keys], sizes[keys]
        ends = np.cumsum(m)
        ids = flat[np.repeat(starts - ends + m, m) + np.arange(ends[-1] if len(ends) else 0)]
        return ids.astype(np.int64), np.r_[0, ends][np.searchsorted(rows, np.arange(n + 1))]

    def a_ids(self, spaced: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = list(self.a.encode_all(spaced))
        return np.frombuffer(b"".join(found), "<u4").astype(np.int64), np.r_[0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)]

    def aligned(self, texts: pa.Array) -> Alignment:
        """Texts that are null, empty, or not the bytes of their tokens with a space before have no tokens."""
        n = len(texts)
        texts = pc.fill_null(texts, "")
        spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(pa.scalar(""), texts, " "))
        sides = [self.a_ids(spaced), self.b_ids(self.b.prepared(texts), n)]
        data, offsets = next(((d, o) for _, d, o in W.chunks(spaced, 1 << 62)), (np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)))
        good = np.ones(n, bool)
        for side, (ids, starts) in enumerate(sides):
            joined = self.joined(side, ids)
            ends = np.r_[0, np.cumsum(self.tables[side][2][ids])][starts]
            if len(joined) != len(data) or not np.array_equal(ends, offsets) or not np.array_equal(joined, data):
                raw, own = data.tobytes(), joined.tobytes()
                good &= [own[ends[i] : ends[i + 1]] == raw[offsets[i] : offsets[i + 1]] for i in range(n)]
        if not good.all():
            sides = [(ids[np.repeat(good, np.diff(starts))], np.r_[0, np.cumsum(np.diff(starts) * good)]) for ids, starts in sides]
        (a_ids, a_start), (b_ids, b_start) = sides
        return align(a_ids, b_ids, a_start, b_start, self.tables[0][2], self.tables[1][2])


@cache
def _pair(path_a: str, path_b: str) -> _Pair:
    """One per worker process and pair of files."""
    return _Pair(path_a, path_b)


def _parts(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs of texts of bounded bytes."""
    for row, _, offsets in W.chunks(texts, most):
        yield row, len(offsets) - 1


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values.astype(np.int32)))


def align_tokens(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, a_ids, b_ids, group_a, group_b, first_b, last_b (arrays of int).

    group_a and group_b have how many A and B tokens of the document come before the end of each group; first_b and last_b,
    for each A token, the first and last B token that share bytes with it, numbered from 0 in the document. Cases as in
    link_statistics().
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(path_a, path_b)
        for batch in batches:
            for row, n in _parts(batch.column(1), PART_BYTES):
                x = pair.aligned(batch.column(1).slice(row, n))
                a, b = x.links()
                first, last = x.overlaps()
                doc = np.repeat(np.arange(n), np.diff(x.a_start))
                groups = np.r_[0, np.cumsum(np.bincount(doc[a], minlength=n))]
                yield pa.record_batch([
                    batch.column(0).slice(row, n), _lists(x.a_ids, x.a_start), _lists(x.b_ids, x.b_start), _lists(a + 1 - x.a_start[doc[a]], groups), _lists(b + 1 - x.b_start[doc[a]], groups),
                    _lists(first - x.b_start[doc], x.a_start), _lists(last - x.b_start[doc], x.a_start),
                ], names=names)

    names = ["doc_id", "a_ids", "b_ids", "group_a", "group_b", "first_b", "last_b"]
    out = StructType().add("doc_id", docs.schema["doc_id"].dataType)
    for name in names[1:]:
        out = out.add(name, ArrayType(IntegerType()))
    return docs.select("doc_id", "text").mapInArrow(run, out)


def _linked(pair: _Pair, texts: pa.Array) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray]:
    """(numbers of A tokens, B tokens and links of each text, digest of its groups, and of each link its text and its pair of ids)."""
    n, x = len(texts), pair.aligned(texts)
    a, b = x.links()
    rows = np.repeat(np.arange(n, dtype=np.int32), np.diff(x.a_start))[a]
    text, starts = group_texts(x)
    raw = memoryview(text)
    digests = ["" if starts[i] == starts[i + 1] else hashlib.sha256(raw[starts[i] : starts[i + 1] - 1]).hexdigest() for i in range(n)]
    return [np.diff(x.a_start), np.diff(x.b_start), np.bincount(rows, minlength=n)], digests, rows, x.a_ids[a] << 32 | x.b_ids[b]


def _chunks(path_a: str, path_b: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(path_a, path_b)
        for batch in batches:
            for row, n in _parts(batch.column(1), CHUNK_BYTES):
                texts, columns, digests, rows, ids = batch.column(1).slice(row, n), [], [], [], []
                for first, m in _parts(texts, PART_BYTES):
                    numbers, found, own, pairs = _linked(pair, texts.slice(first, m))
                    columns.append(numbers)
                    digests += found
                    rows.append(own + np.int32(first))
                    ids.append(pairs)
                columns = [np.concatenate(c) for c in zip(*columns, strict=True)]
                found, keys = np.unique(np.concatenate(ids), return_inverse=True)
                documents = pa.StructArray.from_arrays([batch.column(0).slice(row, n), *map(pa.array, columns), pa.array(digests, pa.string())], names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"])
                yield sparse.chunk_row(documents, np.concatenate(rows), keys, W.mix(found.astype(np.uint64)), buckets, lambda order, found=found: sparse.squeeze(found[order], "<i8"))

    return run


def _pair_counts(blocks: pa.Table) -> pa.Table:
    """How often each id pair of a bucket is linked, over all chunks."""
    keys = np.concatenate([sparse.expand(x, "<i8") for x in blocks["keys"].to_pylist()])
    found, at = np.unique(keys, return_inverse=True)
    times = np.concatenate([sparse.expand(x) for x in blocks["times"].to_pylist()])
    count = np.zeros(len(found), np.int64)
    np.add.at(count, at, times)
    return pa.table({"bucket": np.full(len(found), blocks["bucket"][0].as_py(), np.int32), "key": found, "count": count})


def _pair_values(blocks: pa.Table, pairs: pa.Table) -> pa.Table:
    order = np.argsort(pairs["key"].to_numpy())
    known, count, best = (pairs[n].to_numpy()[order].astype(np.int64) for n in ("key", "count", "best"))
    at = [np.searchsorted(known, sparse.expand(x, "<i8")) for x in blocks["keys"].to_pylist()]
    return pa.table({"chunk": blocks["chunk"], "bucket": blocks["bucket"]} | {n: pa.array([sparse.squeeze(v[i], "<i8") for i in at], pa.binary()) for n, v in (("count", count), ("best", best))})


def link_statistics(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link is a pair of an A and a B token that end at the same byte; the count of an id pair is the number of its links in
    all rows. n_best counts the links whose pair has the highest count of all pairs with its B id, ties included;
    count_sum sums the counts over the links. Null and empty texts, and texts whose tokens' bytes differ from them with
    a space before (those with U+2581), have zeros and an empty digest. A text longer than CHUNK_BYTES is a chunk of its own.
    Null doc_ids and repeated rows are rows like any other; an empty table has no rows; extra columns are not read.
    """
    document = StructType().add("doc_id", docs.schema["doc_id"].dataType).add("n_a", "long").add("n_b", "long").add("n_groups", "long").add("groups_sha256", "string")
    out = StructType().add(document["doc_id"]).add("n_a", "long").add("n_b", "long").add("n_groups", "long").add("n_links", "long").add("n_best", "long").add("count_sum", "long").add("groups_sha256", "string")
    chunks = materialize(docs.select("doc_id", "text").mapInArrow(_chunks(path_a, path_b, sparse.buckets_of(docs)), sparse.chunk_schema(document)), "alignments")
    blocks = sparse.blocks_of(chunks)
    counts = materialize(blocks.groupBy("bucket").applyInArrow(_pair_counts, "bucket int, key long, count long"), "pairs")
    b = F.col("key").bitwiseAND(0xFFFFFFFF)
    # a row per id of B at most: the vocabulary bounds it
    highest = F.broadcast(counts.groupBy(b.alias("b")).agg(F.max("count").alias("most")))
    pairs = counts.join(highest, b == F.col("b")).select("bucket", "key", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))
    values = blocks.drop("times").groupBy("bucket").cogroup(pairs.groupBy("bucket")).applyInArrow(_pair_values, "chunk string, bucket int, count binary, best binary")

    def derive(documents: pa.RecordBatch, sums: list[np.ndarray]) -> Iterator[pa.Array]:
        # tokens that end together close a group, so there are as many links as groups
        yield from (*(documents[n] for n in ("doc_id", "n_a", "n_b", "n_groups", "n_groups")), pa.array(sums[1]), pa.array(sums[0]), documents["groups_sha256"])

    return sparse.document_sums(chunks, values, ["count", "best"], derive, out)
