"""Token ids in a succinct file per shard: a wavelet matrix with rank and select.

A wavelet matrix stores a sequence of ids as one plane of bits for each binary digit, the highest first. After each
plane the sequence is parted by that bit, zeros first, so that the positions of a value are followed down the planes by
counting bits (rank) and back up by finding them (select). Access, counting and occurrence lookup each take as many
steps as ids have bits, from the file alone.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tickloom.llm.common import documents_of, id_and_text
from tickloom.llm.tokens import BYTE_BPE, encoder

MAGIC = b"WVM1"
END_ID = 0
BLOCK_TOKENS = 1 << 21  # ids in one matrix: what bounds the memory of a task; a longer document has one of its own
WORD = 512  # bits between entries of the rank directory
FILES = "first_doc long, block long, docs long, tokens long, data binary"


class WaveletMatrix:
    """Ids of a run of documents. ``len``, ``tokens``, ``access``, ``rank``, ``count``, ``select``, ``occurrences``."""

    def __init__(self, planes: list[np.ndarray], zeros: list[int], length: int, docs: list[tuple]) -> None:
        self._planes = planes  # packed bits, most significant digit first
        self._zeros = zeros  # zero bits of each plane
        self._length = length
        self.docs = docs  # (doc_id, ids) in order
        self._ranks: dict[int, np.ndarray] = {}

    def __len__(self) -> int:
        return self._length

    @classmethod
    def build(cls, ids: np.ndarray, docs: list[tuple]) -> WaveletMatrix:
        width = max(1, int(ids.max(initial=0)).bit_length())
        sequence = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes, zeros = [], []
        for digit in reversed(range(width)):
            ones = (sequence >> digit & 1).astype(bool)
            planes.append(np.packbits(ones))
            low = np.compress(~ones, sequence)
            zeros.append(len(low))
            sequence = np.concatenate([low, np.compress(ones, sequence)])
        return cls(planes, zeros, len(ids), docs)

    def to_bytes(self) -> bytes:
        """Header (JSON) and compressed planes; the rank directory is rebuilt from the planes by one pass of counting."""
        packed = [zstandard.compress(plane.tobytes(), 1) for plane in self._planes]
        header = json.dumps(
            {"length": self._length, "zeros": self._zeros, "sizes": [len(p) for p in packed], "docs": self.docs}
        ).encode()
        return b"".join([MAGIC, len(header).to_bytes(8, "little"), header, *packed])

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        at = 12 + int.from_bytes(data[4:12], "little")
        header = json.loads(data[12:at])
        planes = []
        for size in header["sizes"]:
            planes.append(np.frombuffer(zstandard.decompress(data[at : at + size]), np.uint8))
            at += size
        return cls(planes, header["zeros"], header["length"], [tuple(d) for d in header["docs"]])

    def _bits(self, level: int, start: int = 0, end: int | None = None) -> np.ndarray:
        end = self._length if end is None else end
        bits = np.unpackbits(self._planes[level][start // 8 : -(-end // 8)])
        return bits[start % 8 : start % 8 + end - start]

    def _ones_before(self, level: int, position: int) -> int:
        """Rank: one bits of a plane before a position, from the directory and at most one word of bits."""
        if level not in self._ranks:
            plane = self._planes[level]
            padded = np.zeros(-(-len(plane) // (WORD // 8)) * (WORD // 8), np.uint8)
            padded[: len(plane)] = plane
            counts = np.bitwise_count(padded).reshape(-1, WORD // 8).sum(axis=1, dtype=np.int64)
            self._ranks[level] = np.concatenate([[0], np.cumsum(counts)])
        word = position // WORD
        return int(self._ranks[level][word]) + int(self._bits(level, word * WORD, position).sum())

    def _position_of(self, level: int, bit: int, k: int) -> int:
        """Select: the position of the k-th (from 0) such bit of a plane, by bisection over ranks."""
        low, high = 0, self._length
        while high - low > 1:
            middle = (low + high) // 2
            ones = self._ones_before(level, middle)
            low, high = (middle, high) if (ones if bit else middle - ones) <= k else (low, middle)
        return low

    def access(self, position: int) -> int:
        if not 0 <= position < self._length:
            raise IndexError(position)
        value = 0
        for level, zeros in enumerate(self._zeros):
            ones = self._ones_before(level, position)
            bit = self._ones_before(level, position + 1) - ones
            value = value << 1 | bit
            position = zeros + ones if bit else position - ones
        return value

    def _interval(self, value: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a value before ``end`` lie below the last plane."""
        start = 0
        if value < 0 or value >> len(self._planes):
            return 0, 0
        for level, zeros in enumerate(self._zeros):
            before, until = self._ones_before(level, start), self._ones_before(level, end)
            if value >> (len(self._planes) - 1 - level) & 1:
                start, end = zeros + before, zeros + until
            else:
                start, end = start - before, end - until
        return start, end

    def rank(self, value: int, position: int) -> int:
        """Occurrences of a value before a position."""
        start, end = self._interval(value, position)
        return end - start

    def count(self, value: int) -> int:
        return self.rank(value, self._length)

    def select(self, value: int, k: int) -> int:
        """The position of the k-th occurrence (from 0) of a value."""
        start, end = self._interval(value, self._length)
        if not 0 <= k < end - start:
            raise IndexError(k)
        position = start + k
        for level in reversed(range(len(self._planes))):
            bit = value >> (len(self._planes) - 1 - level) & 1
            position = self._position_of(level, bit, position - self._zeros[level] if bit else position)
        return position

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]

    def tokens(self) -> np.ndarray:
        """All ids in order: the planes from the last to the first, each undoing one parting."""
        values = np.zeros(self._length, np.uint16 if len(self._planes) <= 16 else np.uint32)
        for level in reversed(range(len(self._planes))):
            ones = self._bits(level).astype(bool)
            above = np.empty_like(values)
            digit = values.dtype.type(1 << (len(self._planes) - 1 - level))
            above[np.flatnonzero(~ones)] = values[: self._zeros[level]]
            above[np.flatnonzero(ones)] = values[self._zeros[level] :] | digit
            values = above
        return values


def write_tokens(
    docs: DataFrame, path: str, end_id: int = END_ID, tokenizer: str = BYTE_BPE, tokenizer_path: str | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Write the ids of all documents, each with ``end_id`` after it, in ascending doc_id order as shard files.

    One shuffle deals the texts by ranges of doc_id; each task then writes one shard, a file of Spark's own writer that
    holds its matrices as rows, so any store that Spark reaches will do. Rows without doc_id come first, rows with one
    doc_id by their text. A null text counts as empty; no rows write no matrix.
    """

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, tokenizer_path).encode
        end = int(end_id).to_bytes(4, "little")
        held: list[bytes] = []
        table: list[tuple] = []
        block = size = 0

        def matrix() -> pa.RecordBatch:
            data = WaveletMatrix.build(np.frombuffer(b"".join(held), "<u4"), table).to_bytes()
            first = next((d for d, _ in table if d is not None), None)
            row = {"first_doc": first, "block": block, "docs": len(table), "tokens": size, "data": data}
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], list(row))

        for doc_ids, texts in documents_of(batches):
            for doc_id, ids in zip(doc_ids, encode(texts), strict=True):
                if table and size + len(ids) // 4 >= block_tokens:
                    yield matrix()
                    held, table, block, size = [], [], block + 1, 0
                held.append(ids + end)
                table.append((doc_id, len(ids) // 4 + 1))
                size += len(ids) // 4 + 1
        if table:
            yield matrix()

    dealt = id_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(build, FILES).write.parquet(path)


def read_matrices(spark: SparkSession, path: str) -> DataFrame:
    """The stored matrices; ``WaveletMatrix.from_bytes(row.data)`` opens one."""
    return spark.read.schema(FILES).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    stored = read_matrices(spark, path).withColumn("shard", F.input_file_name())
    schema = "shard string, block long, doc_id long, within long, n_tokens long, ids_crc32 long"

    def open_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                matrix = WaveletMatrix.from_bytes(batch.column("data")[row].as_py())
                ids = matrix.tokens().astype("<u4")
                lengths = np.array([n for _, n in matrix.docs], np.int64)
                starts = np.cumsum(lengths) - lengths
                view = memoryview(ids).cast("B")
                sums = [zlib.crc32(view[4 * s : 4 * (s + n)]) for s, n in zip(starts.tolist(), lengths.tolist())]
                shard, block = batch.column("shard")[row].as_py(), batch.column("block")[row].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * len(lengths), pa.string()),
                        pa.array(np.full(len(lengths), block)),
                        pa.array([d for d, _ in matrix.docs], pa.int64()),
                        pa.array(starts),
                        pa.array(lengths),
                        pa.array(sums, pa.int64()),
                    ],
                    ["shard", "block", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    # one row per shard meets in one task, and the blocks of a shard in one: both far fewer than documents
    blocks = stored.select("shard", "block", "first_doc", "tokens")
    shards = blocks.groupBy("shard").agg(F.sum("tokens").alias("all"), F.min("first_doc").alias("first"))
    in_order = W.orderBy(F.asc_nulls_first("first"), "shard")
    bases = shards.select("shard", (F.sum("all").over(in_order) - F.col("all")).alias("base"))
    by_block = W.partitionBy("shard").orderBy("block")
    starts = blocks.join(bases, "shard").select(
        "shard", "block", (F.col("base") + F.sum("tokens").over(by_block) - F.col("tokens")).alias("base")
    )
    opened = stored.select("shard", "block", "data").mapInArrow(open_all, schema)
    placed = opened.join(starts, ["shard", "block"])
    return placed.select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
