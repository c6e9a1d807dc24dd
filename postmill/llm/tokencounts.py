"""Token counts of texts, from the pieces of each distinct pre-token and the pre-tokens of each document.

The texts are cut into pre-tokens (pieces.py), each document's distinct pre-tokens are counted, the pieces of every distinct
pre-token are counted once (per hash bucket, over all chunks), and the two are joined and summed (sparse.py). No document's
ids are ever made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from postmill.llm import sparse
from postmill.llm import words as W
from postmill.llm.pieces import pieces
from postmill.llm.shared import materialize

CHUNK_BYTES, LIMIT = 8 << 20, 4096


def _packed(column: pa.Array) -> bytes:
    """Some pre-tokens as their lengths and bytes. No length is 0."""
    lengths = pc.binary_length(column).to_numpy().astype("<i4")
    return len(column).to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(lengths.tobytes() + "".join(column.to_pylist()).encode())


def _unpacked(data: bytes) -> pa.StringArray:
    n = int.from_bytes(data[:4], "little")
    raw = zstandard.ZstdDecompressor().decompress(data[4:])
    offsets = np.r_[0, np.cumsum(np.frombuffer(raw, "<i4", n))].astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(raw[4 * n :]))


def _chunks(path: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            n_bytes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            for row, data, offsets in W.chunks(model.prepared(batch.column(1)), CHUNK_BYTES):
                found, keys, rows = model.pre_tokens(data, offsets)
                ends = np.cumsum(pc.binary_length(found).to_numpy(), dtype=np.int64)
                hashes = W.word_hashes(np.frombuffer(found.buffers()[2], np.uint8)[: ends[-1]] if len(ends) else np.zeros(0, np.uint8), np.r_[0, ends][:-1], ends)
                n = len(offsets) - 1
                documents = pa.StructArray.from_arrays([batch.column(0).slice(row, n), n_bytes.slice(row, n)], names=["doc_id", "n_bytes"])
                yield sparse.chunk_row(documents, rows, keys, hashes, buckets, lambda order, found=found: _packed(found.take(pa.array(order))))

    return run


def _piece_counts(path: str):
    """Counts the pieces of each distinct pre-token of a bucket once, for all chunks that have it."""

    def run(blocks: pa.Table) -> pa.Table:
        parts = [_unpacked(x) for x in blocks["keys"].to_pylist()]
        found = pa.chunked_array(parts).combine_chunks().dictionary_encode()
        counts = np.fromiter(map(len, pieces(path).ids(found.dictionary.to_pylist())), np.int64, len(found.dictionary))[found.indices.to_numpy()]
        ends = np.cumsum([len(x) for x in parts])[:-1]
        values = [sparse.squeeze(x, "<i8") for x in np.split(counts, ends)]
        return pa.table({"chunk": blocks["chunk"], "bucket": blocks["bucket"], "n": pa.array(values, pa.binary())})

    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    n_tokens is the length of the sentencepiece model's ids of the whole text. Null and empty texts have no tokens; a text longer
    than CHUNK_BYTES is a chunk of its own; null doc_ids and repeated rows are rows like any other, so there are no ties;
    an empty table has no rows; extra columns are not read.
    """
    document = StructType().add("doc_id", docs.schema["doc_id"].dataType).add("n_bytes", "long")
    out = StructType().add(document["doc_id"]).add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")
    chunks = materialize(docs.select("doc_id", "text").mapInArrow(_chunks(path, sparse.buckets_of(docs)), sparse.chunk_schema(document)), "pre-tokens")
    values = sparse.blocks_of(chunks).select("chunk", "bucket", "keys").groupBy("bucket").applyInArrow(_piece_counts(path), "chunk string, bucket int, n binary")

    def derive(documents: pa.RecordBatch, sums: list[np.ndarray]) -> Iterator[pa.Array]:
        yield from (documents["doc_id"], documents["n_bytes"], pa.array(sums[0]), pa.array(sums[0] > limit))

    return sparse.document_sums(chunks, values, ["n"], derive, out)
