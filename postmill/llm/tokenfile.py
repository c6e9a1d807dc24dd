"""Token-id files: documents compressed one by one with a shared zstandard dictionary.

A file holds, after a header (magic, version, SHA-256 of the dictionary), one zstandard frame of little-endian unsigned 32-bit
ids per document, then an index (doc_id with a null flag, place and length of the frame, number of ids) and a tail (place of
the index, number of documents, magic). A document is read by its index entry alone. The dictionary is a file of its own
beside them, named by its hash; a reader checks the hash before it decompresses.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.encode import encoder
from postmill.llm.shared import materialize, open_fs, shared_path

MAGIC, VERSION = b"TOKZ", 1
HEADER, TAIL = "<4sI32s", "<QQ4s"
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("place", "<u8"), ("length", "<u4"), ("n_tokens", "<u4")])
SAMPLE_DOCUMENTS, SAMPLE_TOKENS, DICTIONARY_BYTES, LEVEL = 1000, 2048, 64 << 10, 3
READ_BYTES = 8 << 20


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; of too few samples, their own bytes."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return (b"".join(samples)[:size] or b"\0").ljust(8, b"\0")


def sample_ids(docs: DataFrame, path: str, end_id: int, documents: int = SAMPLE_DOCUMENTS) -> list[bytes]:
    """Ids of about `documents` random texts, of which those of at most SAMPLE_TOKENS count (so the driver gets some 8 MB).

    The share is set by the number of rows; texts are drawn where they are read and never shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = struct.pack("<I", end_id)
        for batch in batches:
            found = [x + end for x in encoder(path).encode_all(batch.column(0))]
            yield pa.record_batch([pa.array([x for x in found if len(x) <= 4 * SAMPLE_TOKENS], pa.binary())], names=["ids"])

    chosen = docs.select("text").sample(min(1.0, documents / max(1, docs.count())), seed=5)
    return sorted(bytes(r.ids) for r in chosen.mapInArrow(run, "ids binary").collect())


def write_files(docs: DataFrame, path: str, end_id: int, folder: str, dictionary: bytes) -> DataFrame:
    """Writes the documents in ascending doc_id order (nulls last, then by text); a table of files: part, path, documents, tokens.

    Each attempt of a task writes a file of its own name, and only files in the returned table count, so a lost executor
    or a repeated task leaves no wrong data.
    """
    name = hashlib.sha256(dictionary).digest()
    fs, root = open_fs(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{name.hex()}.dictionary") as out:
        out.write(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, file = context.partitionId(), f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}.tokz"
        fs, root = open_fs(file)
        encode, end = encoder(path).encode_all, struct.pack("<I", end_id)
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary)).compress
        place, index, tokens = struct.calcsize(HEADER), [], 0
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        with fs.open_output_stream(root) as out:
            out.write(struct.pack(HEADER, MAGIC, VERSION, name))
            while first is not None:
                for doc_id, found in zip(first.column(0).to_pylist(), encode(first.column(1)), strict=True):
                    ids = found + end
                    frame = compress(ids)
                    out.write(frame)
                    index.append((doc_id or 0, doc_id is None, place, len(frame), len(ids) // 4))
                    place, tokens = place + len(frame), tokens + len(ids) // 4
                first = next(batches, None)
            out.write(np.array(index, INDEX).tobytes())
            out.write(struct.pack(TAIL, place, len(index), MAGIC))
        yield pa.record_batch([pa.array([part]), pa.array([file]), pa.array([len(index)]), pa.array([tokens])], names=["part", "path", "documents", "tokens"])

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(F.col("doc_id").asc_nulls_last(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), "text")
    return materialize(ordered.mapInArrow(run, "part long, path string, documents long, tokens long"), "files")


def read_index(file: str) -> tuple[str, np.ndarray]:
    """(hash of the dictionary, index entries) of a file, by three range reads."""
    fs, path = open_fs(file)
    with fs.open_input_file(path) as f:
        magic, version, name = struct.unpack(HEADER, f.read_at(struct.calcsize(HEADER), 0))
        place, n, end = struct.unpack(TAIL, f.read_at(struct.calcsize(TAIL), f.size() - struct.calcsize(TAIL)))
        if magic != MAGIC or end != MAGIC or version != VERSION:
            raise ValueError(f"not a token file: {file}")
        return name.hex(), np.frombuffer(f.read_at(n * INDEX.itemsize, place), INDEX)


def load_dictionary(file: str, name: str) -> bytes:
    fs, path = open_fs(f"{file.rpartition('/')[0]}/{name}.dictionary")
    with fs.open_input_file(path) as f:
        found = f.read()
    if hashlib.sha256(found).hexdigest() != name:
        raise ValueError(f"the dictionary of {file} has another hash")
    return found


def read_document(file: str, number: int) -> np.ndarray:
    """The ids of one document of a file, by its place in the index."""
    name, index = read_index(file)
    fs, path = open_fs(file)
    with fs.open_input_file(path) as f:
        frame = f.read_at(int(index[number]["length"]), int(index[number]["place"]))
    return np.frombuffer(zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(load_dictionary(file, name))).decompress(frame), "<u4")


def read_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids (binary) of the files of write_files(); start counts the ids of all documents before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                name, index = read_index(file)
                decompress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(load_dictionary(file, name))).decompress
                starts = start + np.r_[0, np.cumsum(index["n_tokens"].astype(np.int64))[:-1]]
                fs, path = open_fs(file)
                with fs.open_input_file(path) as f:
                    a = 0
                    while a < len(index):
                        b = max(int(np.searchsorted(index["place"], index["place"][a] + READ_BYTES)), a + 1)
                        base = int(index["place"][a])
                        block = f.read_at(int(index["place"][b - 1]) + int(index["length"][b - 1]) - base, base)
                        part = index[a:b]
                        ids = [decompress(block[int(p) - base : int(p) - base + int(n)]) for p, n in zip(part["place"], part["length"], strict=True)]
                        yield pa.record_batch([pa.array(part["doc_id"], mask=part["null"].astype(bool)), pa.array(starts[a:b]), pa.array(part["n_tokens"].astype(np.int64)), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
                        a = b

    # a row a file: few enough for one running sum
    begun = files.select("path", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("start"))
    # by number, since the rows are so small that all files would else be read by one task
    return begun.repartition(max(1, files.count())).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def token_digests(documents: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of read_files()' rows."""
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def round_trip(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Writes docs (doc_id, text) as token files in the shared folder and reads all documents back from them.

    A null or empty text has the end id only; null doc_ids come last; repeated rows stand side by side; any length of text
    is one document; extra columns are not read; an empty table writes no file and gives no rows.
    """
    dictionary = train_dictionary(sample_ids(docs, path, end_id))
    return read_files(write_files(docs, path, end_id, shared_path(docs.sparkSession, "tokens"), dictionary))


