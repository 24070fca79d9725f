"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two, at most ``max_length``: as many of the
longest as fit, then the binary digits of the rest from the highest to the lowest. Pieces of one length make a bucket,
each piece is a sequence of its own, so no sequence crosses documents and none is padded: batches are drawn from one
bucket at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import documents_of, global_index, id_and_text
from tickloom.llm.tokens import WORD_BPE, encoder
from tickloom.session import materialize

MAX_LENGTH = 2048
END_ID = 1
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def piece_lengths(n: int, max_length: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens, in document order."""
    rest = n % max_length
    return [max_length] * (n // max_length) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def decompose(
    docs: DataFrame, max_length: int = MAX_LENGTH, end_id: int = END_ID, tokenizer: str = WORD_BPE,
    path: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """Pieces of every document: doc_id, start, length, checksum, tokens of the document, and the ids if asked for.

    A null or empty text has the end id only. A row without doc_id is packed as well. Narrow: no shuffle.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError(f"max_length must be a power of two, not {max_length}")
    schema = PIECES + (", ids array<int>" if with_ids else "")
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, path).encode
        for doc_ids, texts in documents_of(batches):
            out: dict[str, list] = {name: [] for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            slices = []
            for doc_id, data in zip(doc_ids, encode(texts), strict=True):
                data += end
                at = 0
                for length in piece_lengths(len(data) // 4, max_length):
                    piece = data[4 * at : 4 * (at + length)]
                    for name, value in zip(out, (doc_id, at, length, zlib.crc32(piece), len(data) // 4), strict=True):
                        out[name].append(value)
                    if with_ids:
                        slices.append(memoryview(piece).cast("I").tolist())
                    at += length
            columns = [pa.array(values, pa.int64()) for values in out.values()]
            names = list(out)
            if with_ids:
                columns.append(pa.array(slices, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return id_and_text(docs).mapInArrow(cut, schema)


def pack(docs: DataFrame, max_length: int = MAX_LENGTH, **how) -> DataFrame:
    """Pieces with the sequence each of them fills: sequence_id counts from 0, longest bucket first.

    Every sequence is full (``offset`` is 0 and its length a power of two); ``bucket`` is the length's exponent.
    Pieces are stored once, since the numbering reads them twice. No rows give no sequences; repeated rows give their
    pieces again.
    """
    pieces = materialize(decompose(docs, max_length, **how), "pieces")
    order = [F.desc("length"), F.asc("doc_id"), F.asc("start"), F.asc("ids_crc32")]
    numbered = global_index(pieces, order, "sequence_id")
    bucket = F.log2("length").cast("int").alias("bucket")
    return numbered.select("*", F.lit(0).cast("long").alias("offset"), bucket)
