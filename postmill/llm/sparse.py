"""Documents as sparse counts of keys, whose values are found once per distinct key and come back by a join.

Texts are taken in chunks of bounded bytes. A chunk is one row: its documents, their counts as a sparse matrix over the
chunk's distinct keys, and those keys in blocks by a hash, so that what is shuffled by key is each chunk's distinct keys and
not those of every document. The rows of a hash bucket meet in one task; the number of buckets follows from the bytes of all
texts, so a bucket has a bounded share, and a key that is everywhere is in it once per chunk. The buckets' values go back to the
chunks, and each document's sums are products of its counts with them. Chunks are written as a table before use, so
their names and orders are the same for all that read them, whatever executors are lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

BUCKET_BYTES = 4 << 20


def squeeze(values: np.ndarray, kind: str = "<i4") -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, kind).tobytes())


def expand(data: bytes, kind: str = "<i4") -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def buckets_of(docs: DataFrame, column: str = "text") -> int:
    """How many hash buckets all texts ask for."""
    return (docs.agg(F.sum(F.octet_length(column))).first()[0] or 0) // BUCKET_BYTES + 1


def chunk_schema(document: StructType) -> StructType:
    blocks = "chunk string, starts binary, places binary, times binary, blocks array<struct<bucket: int, keys: binary, times: binary>>"
    return StructType.fromDDL(blocks).add("documents", ArrayType(document))


def chunk_row(documents: pa.StructArray, rows: np.ndarray, keys: np.ndarray, hashes: np.ndarray, buckets: int, pack: Callable[[np.ndarray], bytes]) -> pa.RecordBatch:
    """One chunk: its documents, and for each occurrence its row and the number of its key.

    hashes has the hash of each distinct key; pack() gives the bytes of some distinct keys, in the order of their numbers.
    """
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    pairs, times = np.unique(rows.astype(np.int64) * max(len(order), 1) + place[keys], return_counts=True)
    row, at = np.divmod(pairs, max(len(order), 1))
    total = np.bincount(keys, minlength=len(order))[order]
    cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) > 0]) if len(order) else np.zeros(0, int)
    blocks = [{"bucket": int(bucket[order[a]]), "keys": pack(order[a:b]), "times": squeeze(total[a:b])} for a, b in zip(cuts, np.r_[cuts[1:], len(order)], strict=True)]
    starts = np.searchsorted(row, np.arange(len(documents) + 1))
    block_type = pa.list_(pa.struct([("bucket", pa.int32()), ("keys", pa.binary()), ("times", pa.binary())]))
    # within a row places ascend, so their steps are small
    steps = np.diff(at, prepend=0)
    steps[starts[:-1][starts[:-1] < len(at)]] = at[starts[:-1][starts[:-1] < len(at)]]
    arrays = [pa.array([uuid.uuid4().hex]), *(pa.array([squeeze(x)], pa.binary()) for x in (starts, steps, times)), pa.array([blocks], block_type)]
    whole = pa.ListArray.from_arrays(pa.array([0, len(documents)], pa.int32()), documents)
    return pa.record_batch([*arrays, whole], names=["chunk", "starts", "places", "times", "blocks", "documents"])


def blocks_of(chunks: DataFrame) -> DataFrame:
    """chunk, bucket, keys, times: a row per chunk and bucket; times has how often each key occurs in the chunk."""
    return chunks.select("chunk", F.explode("blocks").alias("b")).select("chunk", "b.*")


def document_sums(chunks: DataFrame, values: DataFrame, names: list[str], derive: Callable[[pa.RecordBatch, list[np.ndarray]], Iterator[pa.Array]], out: StructType) -> DataFrame:
    """One row per document: its columns and what derive() makes of the sums of the values over its counts.

    values: chunk, bucket, and one binary column of int64 per name, with a value of each key of the block.
    """

    def run(chunk: pa.Table, blocks: pa.Table) -> pa.Table:
        if not chunk.num_rows:  # no document has these keys: blocks come from chunks, so this can't be
            raise RuntimeError("values of an unknown chunk")
        order = np.argsort(blocks["bucket"].to_numpy(), kind="stable")
        starts, steps, times = (expand(chunk[n][0].as_py()) for n in ("starts", "places", "times"))
        rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        total = np.cumsum(steps, dtype=np.int64)
        before = np.where(starts[:-1] > 0, total[np.maximum(starts[:-1] - 1, 0)], 0) if len(total) else np.zeros(len(starts) - 1, np.int64)
        places = total - before[rows]
        sums = []
        for name in names:
            parts = blocks[name].to_pylist()
            value = np.concatenate([expand(parts[i], "<i8") for i in order]) if parts else np.zeros(0, np.int64)
            product = np.r_[0, np.cumsum(value[places] * times)] if len(places) else np.zeros(1, np.int64)
            sums.append(product[starts[1:]] - product[starts[:-1]])
        documents = pa.RecordBatch.from_struct_array(chunk["documents"].combine_chunks().flatten())
        return pa.Table.from_arrays([pa.chunked_array([x]) for x in derive(documents, sums)], names=out.names)

    return chunks.select("chunk", "starts", "places", "times", "documents").groupBy("chunk").cogroup(values.groupBy("chunk")).applyInArrow(run, out)
