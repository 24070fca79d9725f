"""Byte-level BPE encoding and decoding with a hierarchical-bitmap queue of merge ranks.

Within a piece of text the pair of lowest rank is merged first, of equal ones the leftmost. The bytes of a piece form a
linked list; every pair that the vocabulary holds is put into the bucket of its rank as the position of its left part.
A bitmap marks the ranks whose buckets are not empty, and one above it marks the words that are not zero, so that the
next rank is found by one find-first-set per level. A merge leaves the entries of its old neighbours
where they are: an entry whose rank is no longer that of its position is skipped when met. A piece of n bytes costs
O(n log n) steps at worst, also when it is very long.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from tickloom.llm.common import documents_of, id_and_text
from tickloom.llm.tokens import PieceEncoder

RANKS = "byte_bpe_multi_50k.tiktoken"
_SHIFT = 8  # of a rank to its word of the bitmap: words of 256 bits, and one whose bits stand for the words
_MASK = (1 << _SHIFT) - 1


class RankQueue:
    """Positions by rank: ``push(rank, position)``; ``pop()`` gives the lowest rank and its leftmost position."""

    __slots__ = ("_buckets", "_marks", "top")

    def __init__(self, ranks: int) -> None:
        self._buckets: dict[int, list[int]] = {}  # heaps
        self._marks = [0] * ((ranks >> _SHIFT) + 1)  # a bit per rank whose bucket is not empty
        self.top = 0  # a bit per word of marks that is not zero

    def __bool__(self) -> bool:
        return self.top != 0

    def push(self, rank: int, position: int) -> None:
        bucket = self._buckets.get(rank)
        if bucket is not None:
            heappush(bucket, position)
            return
        self._buckets[rank] = [position]
        word = rank >> _SHIFT
        self._marks[word] |= 1 << (rank & _MASK)
        self.top |= 1 << word

    def start(self, pair: list[int | None]) -> None:
        """Push every position that has a rank, into a queue that is empty."""
        buckets, marks, top = self._buckets, self._marks, 0
        for position, rank in enumerate(pair):
            if rank is None:
                continue
            if rank in buckets:
                buckets[rank].append(position)  # positions ascend: still a heap
            else:
                buckets[rank] = [position]
                word = rank >> _SHIFT
                marks[word] |= 1 << (rank & _MASK)
                top |= 1 << word
        self.top = top

    def pop(self) -> tuple[int, int]:
        lowest = self.top & -self.top
        word = lowest.bit_length() - 1
        mark = self._marks[word]
        bit = mark & -mark
        rank = word << _SHIFT | bit.bit_length() - 1
        bucket = self._buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        del self._buckets[rank]
        self._marks[word] = mark = mark ^ bit
        if not mark:
            self.top ^= lowest
        return rank, bucket[0]


class BytePairEncoder(PieceEncoder):
    """Encoding by a file of ranks, and its inverse."""

    def __init__(self, path: str, pattern: str) -> None:
        super().__init__(by_words=False)
        with open(path, "rb") as file:
            entries = [line.split() for line in file if line.strip()]
        self._ranks = {base64.b64decode(token): int(rank) for token, rank in entries}
        self._tokens = {rank: token for token, rank in self._ranks.items()}
        self._queue = RankQueue(max(self._tokens) + 1)
        self._matches = regex.compile(pattern).findall
        self._merged: dict[str, list[int]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        ranks = self._ranks
        known = ranks.get(data)
        if known is not None or not data:
            return [known] if data else []
        queue, size, rank_of = self._queue, len(data), ranks.get
        push, pop = queue.push, queue.pop
        following = list(range(1, size + 1))  # start of the next part, the end of this one
        before = list(range(-1, size))
        pair = [rank_of(data[left : left + 2]) for left in range(size)]  # rank of a part with the next one
        pair[size - 1] = None
        queue.start(pair)
        while queue.top:
            rank, left = pop()
            if pair[left] != rank:
                continue  # stale
            right = following[left]
            end = following[left] = following[right]
            before[end] = left
            pair[right] = None
            rank = pair[left] = rank_of(data[left : following[end]]) if end < size else None
            if rank is not None:
                push(rank, left)
            earlier = before[left]
            if earlier >= 0:
                rank = pair[earlier] = rank_of(data[earlier:end])
                if rank is not None:
                    push(rank, earlier)
        ids, at = [], 0
        while at < size:
            ids.append(ranks[data[at : following[at]]])
            at = following[at]
        return ids

    def whole(self, text: str) -> bytes:
        ids = array("I")
        for match in self._matches(text):
            ids.extend(self.merge(match.encode()))
        return ids.tobytes()

    def pieces(self, texts: list[str]) -> list[bytes]:
        """One search of the pattern for all: a new line between pieces is a match by itself, see ``PieceEncoder``."""
        found = []
        if len(self._merged) > self.PIECES:
            self._merged.clear()
        merged = self._merged
        matches = iter(self._matches("\n".join([text.removeprefix("\n") for text in texts]) + "\n"))
        line = array("I", self.merge(b"\n"))
        for text in texts:
            ids = line[:] if text.startswith("\n") else array("I")
            for match in matches:
                if match == "\n":
                    break
                ids_of = merged.get(match)
                if ids_of is None:
                    ids_of = merged[match] = self.merge(match.encode())
                ids.extend(ids_of)
            found.append(ids.tobytes())
        return found

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._tokens.__getitem__, memoryview(ids).cast("I")))


@functools.lru_cache(maxsize=2)
def byte_pair_encoder(path: str, pattern: str) -> BytePairEncoder:
    return BytePairEncoder(path, pattern)


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, digests: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids (array of int) and the decoded text; or with ``digests`` their SHA-256 instead.

    Narrow. Null and empty texts have no ids; repeated rows repeat. Ids are those of each match of ``pattern`` by itself.
    """
    names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
    schema = "doc_id long, n_tokens long, " + (
        "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_pair_encoder(
            path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN
        )
        for doc_ids, texts in documents_of(batches):
            encoded = codec.encode(texts)
            decoded = [codec.decode(ids) for ids in encoded]
            if digests:
                columns = [pa.array([hashlib.sha256(x).hexdigest() for x in xs]) for xs in (encoded, decoded)]
            else:
                ids = pa.array([memoryview(x).cast("I").tolist() for x in encoded], pa.list_(pa.int32()))
                columns = [ids, pa.array([x.decode() for x in decoded], pa.string())]
            sizes = pa.array([len(x) // 4 for x in encoded], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), sizes, *columns], names)

    return id_and_text(docs).mapInArrow(run, schema)
