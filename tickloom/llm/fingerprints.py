"""Document fingerprints by a threshold-scaled sketch.

Every shingle of eight bytes is hashed to 48 bits, and a sketch keeps all hashes below a fixed fraction of that range.
So a sketch grows with its document, the sketch of a union is the union of sketches, and both resemblance and
containment are estimated without bias, also between documents of very different length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import id_and_text

SHINGLE = 8  # bytes, one machine word
HASH_BITS = 48
ONE_IN = 16  # the fraction kept
_DIGITS = HASH_BITS // 4  # hexadecimal


def sketch(text: str, one_in: int = ONE_IN) -> np.ndarray:
    """Sorted distinct hashes below the threshold. A text with shingles but none below it keeps its smallest one."""
    data = text.encode()
    if not data:
        return np.empty(0, np.uint64)
    if len(data) < SHINGLE:
        words = np.frombuffer(data.ljust(SHINGLE, b"\0"), "<u8")
    else:
        windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), SHINGLE)
        words = np.ascontiguousarray(windows).view("<u8").ravel()
    hashes = words ^ words >> np.uint64(32)
    for factor in (0xD6E8FEB86659FD93, 0xD6E8FEB86659FD93):  # two rounds of multiply and shift
        hashes = hashes * np.uint64(factor)
        hashes ^= hashes >> np.uint64(32)
    hashes >>= np.uint64(64 - HASH_BITS)
    kept = hashes[hashes < np.uint64((1 << HASH_BITS) // one_in)]
    return np.unique(kept) if len(kept) else hashes.min(keepdims=True)


def spelt(hashes: np.ndarray) -> str:
    return "".join([f"{h:0{_DIGITS}x}" for h in hashes.tolist()])


def read(fingerprint: str) -> np.ndarray:
    starts = range(0, len(fingerprint), _DIGITS)
    return np.array([int(fingerprint[i : i + _DIGITS], 16) for i in starts], np.uint64)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity; two empty texts are alike."""
    common = shared(a, b)
    union = len(a) + len(b) - common
    return common / union if union else 1.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the smaller one's shingles that the other one has too."""
    smaller = min(len(a), len(b))
    return shared(a, b) / smaller if smaller else float(len(a) == len(b))


def merge(a: np.ndarray, b: np.ndarray, one_in: int = ONE_IN) -> np.ndarray:
    """The sketch of two documents together."""
    both = np.union1d(a, b)
    below = both[both < (1 << HASH_BITS) // one_in]
    return below if len(below) else both[:1]


def fingerprints(docs: DataFrame, one_in: int = ONE_IN) -> DataFrame:
    """Per row: doc_id and its fingerprint. Narrow; an empty or null text has an empty one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = pa.array([spelt(sketch(text.as_py(), one_in)) for text in batch.column("text")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), marks], ["doc_id", "fingerprint"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, fingerprint string")


_REPORT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, contained_edited double, contained_next double"
)
_INSIDE, _HALO, _ALONE = 0, 1, 2


def compare_with_next(docs: DataFrame, one_in: int = ONE_IN) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document by descending doc_id.

    The edited text has its last half replaced by the beginning of the next document; after the last document comes the
    first. Texts are dealt once by ranges of doc_id, and the first document of a range is also sent to the range before
    it, so that every task has the successors of its rows. Rows with one doc_id follow each other by text; a row
    without doc_id has no successor, that is, an empty one. Ranges are cut at quantiles of doc_id.
    """
    spark = docs.sparkSession
    source = id_and_text(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = source.select("doc_id").where("doc_id is not null")
    shares = [i / parts for i in range(1, parts)]
    cuts = ids.agg(F.percentile_approx("doc_id", shares, 10 * parts)).first()[0] or []
    edges = np.unique(np.array(cuts, np.int64))
    count = len(edges) + 1

    def part_of(doc_ids: np.ndarray) -> np.ndarray:
        """0 for the largest ids."""
        return (len(edges) - np.searchsorted(edges, doc_ids, side="left")).astype(np.int32)

    def parts_only(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays([pa.array(part_of(held.to_numpy())), held], ["part", "doc_id"])

    first_rows = ids.mapInArrow(parts_only, "part int, doc_id long").groupBy("part").agg(F.max("doc_id")).collect()
    firsts = sorted(tuple(row) for row in first_rows)  # one row per range
    before = {doc_id: firsts[i - 1][0] for i, (_, doc_id) in enumerate(firsts)}
    halo_ids = pa.array(sorted(before), pa.int64())

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        names = ["part", "place", "doc_id", "text"]
        for batch in batches:
            known = batch.filter(pc.is_valid(batch.column("doc_id")))
            doc_ids = known.column("doc_id").to_numpy(zero_copy_only=False)
            place = np.full(len(doc_ids), _INSIDE, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part_of(doc_ids)), pa.array(place), *known.columns], names)
            halo = known.filter(pc.is_in(known.column("doc_id"), value_set=halo_ids))
            if halo.num_rows:
                to = [before[d] for d in halo.column("doc_id").to_pylist()]
                place = np.full(len(to), _HALO, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(place), *halo.columns], names)
            alone = batch.filter(pc.is_null(batch.column("doc_id")))
            if alone.num_rows:
                to = (np.arange(alone.num_rows) % count).astype(np.int32)
                place = np.full(len(to), _ALONE, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(place), *alone.columns], names)

    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [name for name, *_ in (field.split() for field in _REPORT.split(", "))]
        out: list[tuple] = []

        def compared(doc_id, text, own, next_text, next_own) -> tuple:
            half = len(text) // 2
            edited = text[: len(text) - half] + next_text[:half]
            marks = sketch(edited, one_in)
            return (
                doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), spelt(own), spelt(marks),
                resemblance(own, marks), resemblance(own, next_own),
                containment(own, marks), containment(own, next_own),
            )

        def flushed() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out), types)], columns
            )

        waiting: tuple | None = None  # the row whose successor comes next: part, doc_id, text, sketch
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256).to_pydict()
                for part, place, doc_id, text in zip(*(rows[c] for c in ("part", "place", "doc_id", "text"))):
                    own = sketch(text, one_in)
                    if place == _ALONE:
                        out.append(compared(doc_id, text, own, "", sketch("", one_in)))
                        continue
                    if waiting is not None and waiting[0] == part:
                        out.append(compared(*waiting[1:], text, own))
                        waiting = None
                    if place == _INSIDE:
                        waiting = (part, doc_id, text, own)
                if out:
                    yield flushed()
                    out = []

    dealt = source.mapInArrow(deal, "part int, place int, doc_id long, text string")
    ordered = dealt.repartition(max(1, parts // 4), "part").sortWithinPartitions(
        "part", "place", F.desc("doc_id"), "text"
    )
    return ordered.mapInArrow(report, _REPORT)
