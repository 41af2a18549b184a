"""Token-id files with fixed-width bit packing.

Every id takes the minimum number of bits that the vocabulary needs. Ids are stored in blocks of
``BLOCK_IDS`` (a multiple of eight, so that each block starts on a byte); a table of block offsets
gives random access, and a block is unpacked by a few vectorised numpy operations.

File layout (little endian): blocks | doc ids int64 | null flags uint8 | document ends uint64
(cumulative ids in this file) | block offsets uint64 (one more than blocks) | trailer.

``write`` range-partitions the documents by id, so shard files in name order hold the documents in
ascending id order (null ids first; equal ids in text order). Each task streams its sorted rows into
one file that appears by an atomic rename, so a task run again replaces its own file only. The
manifest has one row per shard; it alone comes to the driver, to turn shard sizes into offsets.

Defined cases: null or empty text -> the end id alone; empty table -> no file, no rows; repeated
rows -> one entry each; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import AtomicFile, bound_batches, fresh_path, make_folder, open_input, parallelism
from .tokenize import encoded

MAGIC, VERSION = b"CUMBITS1", 1
TRAILER = struct.Struct("<8sIIIIQQQ")  # magic, version, bits, ids per block, vocabulary, ids, docs, table position
BLOCK_IDS = 4096
#: Blocks unpacked at a time when a file is read from end to end.
BLOCKS_PER_READ = 256


def width(vocabulary: int) -> int:
    """Least number of bits that holds every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Pack ids, least significant bit first; the last group of eight is padded with zeros."""
    lanes = np.zeros(-(-len(ids) // 8) * 8, dtype=np.uint64)
    lanes[: len(ids)] = ids
    lanes = lanes.reshape(-1, 8)
    out = np.zeros((len(lanes), bits), dtype=np.uint8)
    for j in range(8):
        first = j * bits
        for k in range(first // 8, (first + bits - 1) // 8 + 1):
            shift = 8 * k - first
            part = lanes[:, j] >> np.uint64(shift) if shift >= 0 else lanes[:, j] << np.uint64(-shift)
            out[:, k] |= part.astype(np.uint8)
    return out.tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed data, as unsigned 32-bit integers."""
    groups = np.frombuffer(data, dtype=np.uint8).reshape(-1, bits)
    out = np.zeros((len(groups), 8), dtype=np.uint64)
    for j in range(8):
        first = j * bits
        for k in range(first // 8, (first + bits - 1) // 8 + 1):
            shift = 8 * k - first
            part = groups[:, k].astype(np.uint64)
            out[:, j] |= part << np.uint64(shift) if shift >= 0 else part >> np.uint64(-shift)
    out &= np.uint64((1 << bits) - 1)
    return out.reshape(-1)[:count].astype("<u4")


class ShardWriter:
    """Streams documents into one file; memory holds one block and the table of documents, in typed arrays."""

    def __init__(self, uri: str, vocabulary: int):
        self.file, self.vocabulary, self.bits = AtomicFile(uri), vocabulary, width(vocabulary)
        self.pending: list[np.ndarray] = []
        self.waiting = self.total = self.position = 0
        # 17 bytes a document, 8 a block
        self.doc_ids, self.nulls, self.ends, self.offsets = array("q"), bytearray(), array("Q"), array("Q", [0])

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.pending.append(ids)
        self.waiting += len(ids)
        self.total += len(ids)
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.ends.append(self.total)
        if self.waiting >= 16 * BLOCK_IDS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.empty(0, "<u4")
        if len(ids) and int(ids.max()) >= 1 << self.bits:
            raise ValueError("an id does not fit the vocabulary's width")
        full = len(ids) if last else len(ids) // BLOCK_IDS * BLOCK_IDS
        if full:
            data = pack(ids[:full], self.bits)
            self.file.write(data)
            step = BLOCK_IDS * self.bits // 8
            self.offsets.extend(self.position + min(at + step, len(data)) for at in range(0, len(data), step))
            self.position += len(data)
        self.pending, self.waiting = [ids[full:]], len(ids) - full

    def close(self) -> int:
        self._flush(True)
        for part, kind in ((self.doc_ids, "<i8"), (self.nulls, "u1"), (self.ends, "<u8"), (self.offsets, "<u8")):
            self.file.write(memoryview(np.asarray(part, kind)))
        self.file.write(TRAILER.pack(MAGIC, VERSION, self.bits, BLOCK_IDS, self.vocabulary, self.total, len(self.ends), self.position))
        self.file.commit()
        return self.position


class ShardReader:
    def __init__(self, uri: str):
        self.stream = open_input(uri)
        size = self.stream.seek(0, 2)
        size = self.stream.tell() if size is None else size
        self.stream.seek(size - TRAILER.size)
        magic, version, self.bits, self.block_ids, self.vocabulary, self.total, docs, self.table = TRAILER.unpack(self.stream.read(TRAILER.size))
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"{uri} is not a token-id file of this format")
        self.stream.seek(self.table)
        rest = self.stream.read(size - TRAILER.size - self.table)
        self.doc_ids = np.frombuffer(rest, "<i8", docs)
        self.nulls = np.frombuffer(rest, "u1", docs, 8 * docs).astype(bool)
        self.ends = np.frombuffer(rest, "<u8", docs, 9 * docs).astype(np.int64)
        self.offsets = np.frombuffer(rest, "<u8", offset=17 * docs).astype(np.int64)

    def _blocks(self, first: int, last: int) -> np.ndarray:
        self.stream.seek(int(self.offsets[first]))
        data = self.stream.read(int(self.offsets[last] - self.offsets[first]))
        return unpack(data, self.bits, min(self.total, last * self.block_ids) - first * self.block_ids)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Random access: ids start..stop of this file."""
        if stop <= start:
            return np.empty(0, "<u4")
        first, last = start // self.block_ids, -(-stop // self.block_ids)
        return self._blocks(first, last)[start - first * self.block_ids : stop - first * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))

    def checksums(self) -> Iterator[int]:
        """crc32 of each document's ids (little-endian unsigned 32-bit), in one pass over the file."""
        ends, k, crc = self.ends, 0, 0
        for first in range(0, len(self.offsets) - 1, BLOCKS_PER_READ):
            ids = self._blocks(first, min(first + BLOCKS_PER_READ, len(self.offsets) - 1))
            data, begin, at = memoryview(ids.tobytes()), first * self.block_ids, 0
            while k < len(ends) and ends[k] - begin <= len(ids):
                stop = int(ends[k] - begin)
                yield zlib.crc32(data[4 * at : 4 * stop], crc)
                k, crc, at = k + 1, 0, stop
            crc = zlib.crc32(data[4 * at :], crc)
        while k < len(ends):  # only documents without ids can be left
            yield 0
            k += 1

    def close(self) -> None:
        self.stream.close()


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, vocabulary: int, id_column: str = "doc_id", text_column: str = "text") -> list[dict]:
    """Encode ``docs`` into shard files below ``folder``; the manifest, a row per shard, in order."""
    make_folder(folder)

    def shard(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, out = TaskContext.get().partitionId(), None
        path, end = f"{folder}/shard-{number:06d}.bits", np.array([end_id], "<u4").tobytes()
        for ids, tokens in encoded(rows, tokenizer_path):
            for doc_id, data in zip(ids, tokens):
                out = out or ShardWriter(path, vocabulary)
                out.add(doc_id, np.frombuffer(data + end, "<u4"))
        if out:
            size = out.close()
            yield pa.RecordBatch.from_pydict({"shard": [number], "path": [path], "n_ids": [out.total], "n_docs": [len(out.ends)], "bytes": [size]})

    rows = bound_batches(docs).select(F.col(id_column).cast("bigint").alias("__id"), F.coalesce(F.col(text_column), F.lit("")).alias("__text"))
    ordered = rows.repartitionByRange(parallelism(docs.sparkSession), "__id").sortWithinPartitions("__id", "__text")
    written = ordered.mapInArrow(shard, "shard long, path string, n_ids long, n_docs long, bytes long").collect()
    return [r.asDict() for r in sorted(written, key=lambda r: r.shard)]


def read_index(spark: SparkSession, manifest: list[dict]) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32, shard path."""
    base, plan = 0, []
    for m in manifest:
        plan.append((m["path"], base))
        base += m["n_ids"]

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = ShardReader(path)
                sums = np.fromiter(reader.checksums(), np.int64, len(reader.ends))
                starts = np.concatenate([[0], reader.ends[:-1]]) if len(reader.ends) else reader.ends
                for a in range(0, len(sums), 50_000):
                    cut = slice(a, a + 50_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(reader.doc_ids[cut], mask=reader.nulls[cut]), pa.array(starts[cut] + start), pa.array(reader.ends[cut] - starts[cut]), pa.array(sums[cut]), pa.array([path] * len(sums[cut]))],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", "path"],
                    )
                reader.close()

    files = spark.createDataFrame(plan, "path string, base long").repartition(max(1, len(plan)))
    return files.mapInArrow(scan, "doc_id long, start long, n_tokens long, ids_crc32 long, path string")


def encode_and_read_back(docs: DataFrame, tokenizer_path: str, end_id: int, vocabulary: int, folder: str | None = None) -> DataFrame:
    spark = docs.sparkSession
    manifest = write(docs, folder or fresh_path(spark, "token-ids"), tokenizer_path, end_id, vocabulary)
    return read_index(spark, manifest)
