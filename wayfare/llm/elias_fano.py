"""Token-id files with Elias-Fano document boundaries.

A shard file is one little-endian array of the ids of all its documents, without gaps, then an
index, then a footer. The index holds two monotone sequences in Elias-Fano form: where each
document ends, and the document ids themselves. A value's low bits are stored as they are; its
high bits are a unary bitmap with one set bit per value, and a select directory gives the place
of every 512th set bit, so that any offset is found by looking at a few hundred bits. No table
of 64-bit offsets exists.

    ids       n_tokens x width bytes          width 2 or 4
    index     ends: low bits, high bitmap, directory; documents: the same
    footer    64-bit numbers (see FOOTER), then MAGIC
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import bounded_batches, file_place, text_of, texts_in
from wayfare.llm.tokens import default_path, library_coder
from wayfare.operators.joins import BUCKET
from wayfare.operators.numbering import bucket_starts
from wayfare.session import materialise, planned_bytes, shared_dir

MAGIC = b"WFIDS001"
# n_docs, n_without_doc_id, n_tokens, width, lowest doc_id, then bytes of the six index parts.
FOOTER = struct.Struct("<qqqqq6q")
DIRECTORY_STEP = 512
# Input bytes per shard.
SHARD_BYTES = 64 << 20
# Up to so many shards their counts are summed in one window, beyond that by levels of bits.
ONE_WINDOW = 1 << 16
LEVELS = (14,)
# Documents whose ids a reader holds at once.
READ_DOCS = 512

MANIFEST = "shard int, path string, n_docs long, n_tokens long"
_BITS = np.arange(8, dtype=np.uint8)


# -- Elias-Fano ------------------------------------------------------------------------------


@dataclass
class EliasFano:
    """A monotone sequence of unsigned integers below 2**64."""

    count: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    directory: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.ascontiguousarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        mask = np.uint64((1 << low_bits) - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        bits = ((values & mask)[:, None] >> shifts) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bitmap = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bitmap[ones] = 1
        high = np.packbits(bitmap, bitorder="little")
        kind = np.uint32 if len(bitmap) < 1 << 32 else np.uint64
        return cls(n, low_bits, low, high, ones[::DIRECTORY_STEP].astype(kind))

    def parts(self) -> list[bytes]:
        header = struct.pack("<qq", self.count, self.low_bits)
        return [header + self.low.tobytes(), self.high.tobytes(), self.directory.tobytes()]

    @classmethod
    def from_parts(cls, low: bytes, high: bytes, directory: bytes) -> EliasFano:
        count, low_bits = struct.unpack_from("<qq", low)
        kind = np.uint32 if len(high) * 8 < 1 << 32 else np.uint64
        return cls(
            count, low_bits, np.frombuffer(low, np.uint8, offset=16),
            np.frombuffer(high, np.uint8), np.frombuffer(directory, kind),
        )

    def _ones(self, first: int, last: int) -> np.ndarray:
        """Bit positions of set bits number `first` to `last` - 1 of the high bitmap."""
        start = int(self.directory[first // DIRECTORY_STEP])
        skipped = first % DIRECTORY_STEP
        wanted = skipped + last - first
        step = last // DIRECTORY_STEP + 1
        stop = int(self.directory[step]) if step < len(self.directory) else 8 * len(self.high)
        byte = start // 8
        bits = np.unpackbits(self.high[byte : stop // 8 + 1], bitorder="little")
        found = np.flatnonzero(bits) + 8 * byte
        found = found[found >= start]
        return found[skipped:wanted]

    def select(self, first: int, last: int) -> np.ndarray:
        """Values number `first` to `last` - 1."""
        if last <= first:
            return np.zeros(0, np.uint64)
        high = (self._ones(first, last) - np.arange(first, last)).astype(np.uint64)
        if not self.low_bits:
            return high
        begin, end = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(self.low[begin // 8 : (end + 7) // 8], bitorder="little")
        bits = bits[begin % 8 :][: end - begin].reshape(-1, self.low_bits).astype(np.uint64)
        low = (bits << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return (high << np.uint64(self.low_bits)) | low


# -- shard files -----------------------------------------------------------------------------


def _index(ends: list[int], doc_ids: list[int], without: int, width: int) -> bytes:
    """Index and footer of a shard; documents without an id stand first."""
    lowest = doc_ids[0] if doc_ids else 0
    documents = np.array([d - lowest for d in doc_ids], np.uint64)
    parts = EliasFano.of(np.array(ends, np.uint64)).parts() + EliasFano.of(documents).parts()
    total = ends[-1] if ends else 0
    sizes = [len(part) for part in parts]
    return b"".join(parts) + FOOTER.pack(len(ends), without, total, width, lowest, *sizes) + MAGIC


class Shard:
    """Reads one shard file by document number."""

    def __init__(self, uri: str):
        files, path = file_place(uri)
        self._file = files.open_input_file(path)
        tail = FOOTER.size + len(MAGIC)
        size = self._file.size()
        footer = self._file.read_at(tail, size - tail)
        if footer[-len(MAGIC) :] != MAGIC:
            raise ValueError(f"not a token-id file: {uri}")
        self.docs, self.without, self.tokens, self.width, self._lowest, *sizes = FOOTER.unpack(
            footer[: FOOTER.size]
        )
        index = self._file.read_at(sum(sizes), size - tail - sum(sizes))
        cuts = np.cumsum([0, *sizes])
        parts = [index[a:b] for a, b in zip(cuts, cuts[1:])]
        self.ends = EliasFano.from_parts(*parts[:3])
        self.documents = EliasFano.from_parts(*parts[3:])

    def offsets(self, first: int, last: int) -> np.ndarray:
        """Where documents `first` to `last` - 1 start, and where the last one ends."""
        before = self.ends.select(first - 1, first) if first else np.zeros(1, np.uint64)
        return np.concatenate([before, self.ends.select(first, last)]).astype(np.int64)

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        nulls = max(0, min(last, self.without) - first)
        known = self.documents.select(max(first, self.without) - self.without, last - self.without)
        return [None] * nulls + [int(v) + self._lowest for v in known]

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids of a range of places, as unsigned 32-bit integers."""
        data = self._file.read_at((end - start) * self.width, start * self.width)
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")


# -- Spark jobs ------------------------------------------------------------------------------


def write_shards(
    docs: DataFrame,
    folder: str,
    path: str | None = None,
    end_id: int = 0,
    shards: int | None = None,
) -> DataFrame:
    """Write the ids of whole texts in ascending doc_id order; returns the manifest of shards.

    Rows without a doc_id come first, equal doc_ids follow each other in any order, a null text
    counts as empty and has the end id alone. Without a number of `shards` there is at least one
    for each SHARD_BYTES of input. An attempt of a task writes a file of its own, and
    only the committed attempt's file is in the manifest, so lost executors leave no wrong
    data. No rows give no shards. Other columns are not read.
    """
    spark = bounded_batches(docs.sparkSession)
    path = path or default_path()
    if shards is None:
        # Fewer than the session's partitions are left to it: adaptive execution merges small ones.
        needed = math.ceil(planned_bytes(docs) / SHARD_BYTES)
        session = int(spark.conf.get("spark.sql.shuffle.partitions"))
        shards = needed if needed > session else None

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library_coder(path)
        ends: list[int] = []
        doc_ids: list[int] = []
        without = total = 0
        stream, uri, shard, width = None, "", 0, 4
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            if stream is None:
                shard = batch.column("_shard")[0].as_py()
                uri = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.ids"
                files, place = file_place(uri)
                files.create_dir(place.rpartition("/")[0], recursive=True)
                stream = files.open_output_stream(place)
                width = 2 if coder.largest_id < 1 << 16 else 4
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(texts_in(batch))):
                ids += end
                numbers = np.frombuffer(ids, "<u4")
                stream.write(numbers.astype(f"<u{width}").tobytes() if width < 4 else ids)
                total += len(numbers)
                ends.append(total)
                if doc_id is None:
                    without += 1
                else:
                    doc_ids.append(doc_id)
        if stream is not None:
            stream.write(_index(ends, doc_ids, without, width))
            stream.close()
            rows = [[shard], [uri], [len(ends)], [total]]
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, kind) for row, kind in zip(rows, kinds)],
                ["shard", "path", "n_docs", "n_tokens"],
            )

    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(1024)).alias("_tie"),
    )
    order = [F.asc_nulls_first("doc_id"), F.asc("_tie")]
    ranged = read.repartitionByRange(shards, *order) if shards else read.repartitionByRange(*order)
    placed = ranged.sortWithinPartitions(*order).withColumn("_shard", F.spark_partition_id())
    return materialise(placed.select("doc_id", "text", "_shard").mapInArrow(write, MANIFEST))


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with the number of ids in all earlier shards, a task for each shard.

    The sums are windows over the counts of shards, taken level by level if they are many.
    """
    counts = manifest.select(F.col("shard").cast("long").alias(BUCKET), F.col("n_tokens").alias("_rows"))
    last, number = manifest.agg(F.max("shard"), F.count(F.lit(1))).first()
    starts = bucket_starts(counts, () if number <= ONE_WINDOW else LEVELS)
    found = manifest.join(starts, manifest["shard"] == starts[BUCKET]).drop(BUCKET)
    dealt = found.withColumnRenamed("_start", "start").repartitionById((last or 0) + 1, F.col("shard"))
    return dealt.select(*manifest.columns, "start")


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, before in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                shard = Shard(uri)
                for first in range(0, shard.docs, READ_DOCS):
                    last = min(first + READ_DOCS, shard.docs)
                    offsets = shard.offsets(first, last)
                    crcs = []
                    for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
                        crcs.append(zlib.crc32(shard.ids(a, b).tobytes()))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids(first, last), pa.int64()),
                            pa.array(offsets[:-1] + before),
                            pa.array(np.diff(offsets)),
                            pa.array(crcs, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return manifest.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(spark: SparkSession, docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write all documents to a new shared folder and read the files back."""
    return read_shards(with_starts(write_shards(docs, shared_dir(spark), path)))
