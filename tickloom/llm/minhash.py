"""MinHash near-duplicates with sequential Bayesian verification.

A document is the set of its distinct five-word shingles. Equal sets are folded into one first. Signatures of minima are
cut into bands; documents with an equal band share a bucket. A pair from a bucket is compared by batches of its
signatures: after each batch it is dropped if the posterior probability that its similarity reaches the threshold is
below the chosen miss probability. What survives is confirmed on the full sets.

A bucket is never paired with itself. In each round some members of a bucket lead: the others are compared with them,
unless they are known to be of one component by then. The member that meets most others leads first, since near copies
have it from their original. Leaders grow eightfold by round and leave the bucket after it, so that all pairs of a bucket
are decided or lie within one component at the end, while near copies of one text, however many, are joined in the first
rounds.

Two exact bounds keep apart what only looks alike: the shingles that no other document has cannot be in an intersection,
which rules out most texts with a common passage; and after two rounds the undecided pairs meet by their rarest shingles
instead (prefix filter), which rules out most texts that were edited from one original, each too much.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.llm.common import id_and_text, keep_ids
from tickloom.llm.components import components
from tickloom.session import materialize

WORDS = 5
PERCENT = 75  # similarity that links, as 100 * intersection >= PERCENT * union
BANDS, ROWS = 40, 5  # a pair at the threshold shares no band with probability (1 - 0.75^5)^40 = 2e-5
FIRST_BANDS = 4  # bands of the first round, which joins most near copies
LABELLED_ROUNDS = 2  # that update what is known of components; later rounds add few links, older labels only test more
BATCH = 40  # signatures compared at a time
MISS = 1e-6  # posterior probability below which a pair is dropped

_MASK = (1 << 64) - 1


class _WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    WORDS = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _WordHashes()


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words in order: A-Z lower-cased, cut at ASCII white space (as bytes.split does)."""
    words = text.encode().lower().split()
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def shingles_in_order(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """One hash per run of ``size`` words; of all words together if there are fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    rolled = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - size + 1 + i]
    return mixed(rolled + np.uint64(size))


def shingle_set(text: str) -> np.ndarray:
    return np.unique(shingles_in_order(word_hashes(text)))


@functools.cache
def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240229)
    return (
        random.integers(0, 1 << 31, count, dtype=np.uint32) << np.uint32(1) | np.uint32(1),
        random.integers(0, 1 << 32, count, dtype=np.uint32),
    )


def signature(hashes: np.ndarray, count: int) -> np.ndarray:
    """Minima of ``count`` permutations of the upper 32 bits of the hashes."""
    factors, offsets = _permutations(count)
    keys = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(count, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(keys), 2048):  # bounded memory for very long texts
        part = keys[start : start + 2048]
        least = np.minimum(least, (factors[:, None] * part[None, :] + offsets[:, None]).min(axis=1))
    return least


@functools.cache
def least_matches(count: int, batch: int = BATCH, percent: int = PERCENT, miss: float = MISS) -> tuple[int, ...]:
    """For each number of batches compared, the matches below which a pair is dropped.

    One byte of each signature is compared, so signatures of similarity s agree with probability s + (1 - s) / 256.
    The prior of s is uniform; the posterior is summed over a grid.
    """
    grid = (np.arange(20000) + 0.5) / 20000
    agree = np.log(grid + (1 - grid) / 256)
    differ = np.log((1 - grid) * 255 / 256)
    above = grid >= percent / 100
    bounds = []
    for seen in range(batch, count + 1, batch):
        for matches in range(seen + 1):
            likelihood = matches * agree + (seen - matches) * differ
            posterior = np.exp(likelihood - likelihood.max())
            if posterior[above].sum() / posterior.sum() >= miss:
                bounds.append(matches)
                break
    return tuple(bounds)


def survives(a: bytes, b: bytes, bounds: tuple[int, ...], batch: int = BATCH) -> bool:
    """Compare two signatures batch by batch."""
    same = np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)
    matches = 0
    for index, bound in enumerate(bounds):
        matches += int(same[index * batch : (index + 1) * batch].sum())
        if matches < bound:
            return False
    return True


def low_bytes(least: np.ndarray) -> bytes:
    """What of a signature is compared."""
    return (least & np.uint32(255)).astype(np.uint8).tobytes()


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row: doc_id, n_shingles, two hashes of the set, and the bands. Narrow."""
    count = bands * rows
    schema = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(rows)], np.uint64)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sizes, set_a, set_b, cut = [], [], [], []
                for text in part.column("text"):
                    hashes = shingle_set(text.as_py())
                    digest = xxhash.xxh3_128_intdigest(hashes.tobytes())
                    sizes.append(len(hashes))
                    set_a.append(digest >> 64)
                    set_b.append(digest & _MASK)
                    least = signature(hashes, count)
                    keys = (least.astype(np.uint64).reshape(bands, rows) * powers).sum(axis=1, dtype=np.uint64)
                    cut.append(mixed(keys + np.arange(bands, dtype=np.uint64)))
                signed = [pa.array(np.array(v, np.uint64).view(np.int64)) for v in (set_a, set_b)]
                flat = pa.array(np.concatenate(cut).view(np.int64))
                offsets = pa.array(np.arange(len(cut) + 1, dtype=np.int32) * bands)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(sizes, pa.int64()), *signed,
                        pa.ListArray.from_arrays(offsets, flat),
                    ],
                    ["doc_id", "n_shingles", "set_a", "set_b", "bands"],
                )

    return id_and_text(docs).mapInArrow(run, schema)


def signed_sets(docs: DataFrame, count: int) -> DataFrame:
    """Per row: its doc_id as node, its sorted shingle hashes and a byte of each signature. Narrow."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sets = [shingle_set(text.as_py()) for text in part.column("text")]
                low = [low_bytes(signature(s, count)) for s in sets]
                columns = [part.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(low, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["node", "set", "bytes"])

    return id_and_text(docs).mapInArrow(run, "node long, set binary, bytes binary")


def linked(a: bytes, b: bytes, percent: int = PERCENT) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(x) + len(y) - common)


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int, count: int, miss: float) -> DataFrame:
    """Pairs (a, b) that no batch of signatures rules out and whose full sets are similar enough.

    Sets and signatures are made anew from the texts of the documents in question.
    """
    nodes = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = signed_sets(keep_ids(docs, materialize(nodes, "paired")), count)
    mine = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"), F.col("bytes").alias("bytes_a"))
    other = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"), F.col("bytes").alias("bytes_b"))
    bounds = least_matches(count, BATCH, percent, miss)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = zip(*(part.column(name) for name in ("set_a", "set_b", "bytes_a", "bytes_b")))
            kept = [
                survives(p.as_py(), q.as_py(), bounds) and linked(x.as_py(), y.as_py(), percent) for x, y, p, q in rows
            ]
            yield part.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    both = pairs.join(mine, "a").join(other, "b").select("a", "b", "set_a", "set_b", "bytes_a", "bytes_b")
    return both.mapInArrow(run, "a long, b long")


def _feasible(common: Column, n: Column, other_n: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough if they share no more than ``common`` shingles."""
    return (100 + percent) * common >= percent * (n + other_n)


def _in_common(docs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per node: n, the size of its set, and common, how many of its shingles any other of these documents has too.

    What a shingle that only one document has cannot do is link it; so ``common`` bounds the intersection with any
    other, exactly. Of a node with several texts the bounds hold for each of them.
    """
    shingled = _shingle_rows(docs)
    once = shingled.groupBy("shingle").agg(F.count("*").alias("times"), F.min("node").alias("node")).where("times = 1")
    alone = once.groupBy("node").agg(F.count("*").alias("alone"))
    per_node = sizes.groupBy("node").agg(
        F.min("n_shingles").alias("n"), F.max("n_shingles").alias("most"), F.count("*").alias("texts")
    )
    common = F.when(F.col("texts") > 1, F.col("most")).otherwise(F.col("n") - F.coalesce("alone", F.lit(0)))
    return per_node.join(alone, "node", "left").select("node", "n", common.alias("common"), "texts")


def _shingle_rows(docs: DataFrame) -> DataFrame:
    """A row per document and distinct shingle. Narrow."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sets = [shingle_set(text.as_py()) for text in part.column("text")]
                ids = np.repeat(part.column("doc_id").to_numpy(), [len(s) for s in sets])
                flat = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(ids)], ["shingle", "node"])

    return id_and_text(docs).mapInArrow(run, "shingle long, node long")


def _by_rare_shingles(members: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The same undecided pairs in smaller buckets: documents meet by shingles that few of them have.

    Two sets of which at least ``o`` elements are common share one of the first ``size - o + 1`` elements of either, in
    any order of all elements; rare shingles come first here. ``o`` follows from the sizes of a node and of the smallest
    one that it shares a bucket with. Texts that were edited from one original, but each too much to be linked, share
    nearly all bands, yet few of their rarest shingles.

    ``common`` is bounded by what follows the shingle of the bucket, itself included (positional filter): all that a pair
    shares comes from its first common shingle on. In the bucket of that one each linked pair meets; in those of its later
    shingles it is looked at again only where the bound still allows it.
    """
    size, other = F.first("n"), F.min("least")
    overlap = F.ceil(percent * (size + other) / (100 + percent))
    nodes = members.groupBy("node").agg(
        F.first("weight").alias("weight"), size.alias("n"), F.first("common").alias("common"), other.alias("least"),
        F.when(F.first("texts") == 1, size - overlap + 1).alias("first"),  # of several texts: all
    )
    nodes = materialize(nodes, "undecided")
    rows = _shingle_rows(keep_ids(docs, materialize(nodes.select(F.col("node").alias("doc_id")), "undecided-ids")))
    rows = materialize(rows.distinct(), "undecided-shingles")
    times = rows.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1")
    alone = rows.groupBy("shingle").agg(F.count("*").alias("times"), F.min("node").alias("node")).where("times = 1")
    before = alone.groupBy("node").agg(F.count("*").alias("before"))  # the rarest, which no other has
    rank = F.row_number().over(W.partitionBy("node").orderBy("times", "shingle")) + F.coalesce("before", F.lit(0))
    ranked = rows.join(times, "shingle").join(before, "node", "left").withColumn("rank", rank)
    kept = ranked.join(nodes, "node").where(F.col("first").isNull() | (F.col("rank") <= F.col("first")))
    # of several texts there is no rank in each of them; ``least`` skips nulls
    follows = F.when(F.col("first").isNotNull(), F.col("n") - F.col("rank") + 1)
    return kept.select(
        F.col("shingle").alias("bucket"), F.lit(FIRST_BANDS).alias("band"), "node", "weight", "n",
        F.least("common", follows).alias("common"), F.lit(1).cast("long").alias("texts"), "least",
    )


def _centres(links: DataFrame) -> DataFrame:
    """Per linked node the one with most links among itself and its neighbours: node, component.

    Nodes with the same centre are of one component. Those of one component may have several, which costs tests but no
    links; near copies mostly share their original as centre.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degrees = both.groupBy("a").agg(F.count("*").alias("degree"))
    near = both.join(degrees.select(F.col("a").alias("b"), "degree"), "b").select(
        "a", F.struct("degree", F.col("b").alias("node")).alias("centre")
    )
    own = degrees.select("a", F.struct("degree", F.col("a").alias("node")).alias("centre"))
    return near.unionByName(own).groupBy(F.col("a").alias("node")).agg(F.max("centre")["node"].alias("component"))


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, miss: float = MISS
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least doc_id reachable by links), kept (doc_id = component_id).

    Null and empty texts have no shingles and no links. Rows that share a doc_id are one node, whose links are those of
    all its texts. A row without doc_id is linked with nothing: its component_id is null and it is kept. No rows give
    no rows; repeated rows repeat.
    """
    sketched = materialize(sketches(docs, bands, rows), "sketches")
    shingled = sketched.where("doc_id is not null and n_shingles > 0")
    # equal sets: one representative, the least doc_id
    leaders = shingled.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"))
    same = shingled.select("set_a", "set_b", "doc_id").join(leaders.where("copies > 1"), ["set_a", "set_b"])
    equal = materialize(same.where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b")), "equal")
    # a doc_id may have several texts: only rows whose very set another one stands for leave
    distinct = shingled.select("set_a", "set_b", F.col("doc_id").alias("node"), "n_shingles", "bands")
    copies = same.where("doc_id <> node").select("set_a", "set_b", F.col("doc_id").alias("node")).distinct()
    apart = distinct.join(copies, ["set_a", "set_b", "node"], "left_anti").select("node", "n_shingles", "bands")

    # buckets that more than one document shares
    members = apart.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = members.groupBy("bucket").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("met")
    )
    met = materialize(members.join(shared.where("low < high").drop("low", "high"), "bucket"), "buckets")
    nodes = materialize(met.select(F.col("node").alias("doc_id")).distinct(), "nodes")
    # of all texts of a node, also folded ones: the bounds count their shingles, too
    sizes = shingled.select(F.col("doc_id").alias("node"), "n_shingles").join(nodes.withColumnRenamed("doc_id", "node"), "node", "left_semi")

    # the text that most others were made from meets most of them: it leads first
    weights = met.groupBy("node").agg(F.sum("met").alias("weight"))
    sized = met.select("bucket", "band", "node").join(weights, "node").join(
        _in_common(keep_ids(docs, nodes), sizes), "node"
    )
    sized = materialize(sized, "sized")
    least = sized.groupBy("bucket").agg(F.min("n").alias("least"))
    fit = sized.join(least, "bucket").where(_feasible(F.col("common"), F.col("n"), F.col("least"), percent))
    two = fit.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = materialize(fit.join(two.select("bucket"), "bucket", "left_semi"), "members")
    links, tested, known, leaders_per_bucket, turn_number = None, None, None, 1, 0
    while not members.isEmpty():
        first = turn_number == 0
        if known is None:
            labelled = members.withColumn("component", F.col("node"))
        else:
            labelled = members.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
        turn = labelled.where(F.col("band") < FIRST_BANDS) if first else labelled
        slot = F.pmod(F.xxhash64("node", F.lit(leaders_per_bucket)), F.lit(leaders_per_bucket))
        best = turn.groupBy("bucket", slot.alias("slot")).agg(
            F.max(F.struct("weight", "node", "component", "n", "common")).alias("best")
        )
        lead = best.select("bucket", *[F.col(f"best.{c}").alias(f"leader_{c}") for c in ("node", "component", "n", "common")])
        lead = materialize(lead, "leaders")
        pairs = (
            turn.join(lead, "bucket")
            .where("component <> leader_component")
            .where(_feasible(F.least("common", "leader_common"), F.col("n"), F.col("leader_n"), percent))
            .select(F.least("node", "leader_node").alias("a"), F.greatest("node", "leader_node").alias("b"))
            .distinct()
        )
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        confirmed = materialize(_confirmed(pairs, docs, percent, bands * rows, miss).distinct(), "links")
        links = confirmed if first else links.unionByName(confirmed)
        tested = pairs if first else tested.unionByName(pairs)
        if turn_number < LABELLED_ROUNDS:
            known = materialize(_centres(links), "centres")
        # those who led are done; a bucket whose others are known to be of one component is, too
        led = lead.select("bucket", F.col("leader_node").alias("node"))
        rest = members.join(led, ["bucket", "node"], "left_anti").join(known, "node", "left")
        component = F.coalesce("component", "node")
        undecided = (
            rest.groupBy("bucket")
            .agg(F.min(component).alias("low"), F.max(component).alias("high"))
            .where("low < high")
        )
        open_again = rest.drop("component").join(undecided.select("bucket"), "bucket", "left_semi")
        members = materialize(open_again, "members")
        leaders_per_bucket *= 8
        turn_number += 1
        if turn_number == LABELLED_ROUNDS:
            members = materialize(_by_rare_shingles(members, docs, percent), "members")

    if links is not None:
        equal = equal.unionByName(links)
    by_node = components(equal)
    joined = sketched.select("doc_id", "n_shingles").join(by_node, F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("component", "doc_id")
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs``, with all their columns, but for documents whose group has one of smaller doc_id.

    Rows without doc_id stay, and so do rows that repeat a kept doc_id.
    """
    found = near_duplicates(docs, percent)
    dropped = materialize(found.where("not kept").select("doc_id").distinct(), "dropped")
    return keep_ids(docs, dropped, "left_anti").select(*docs.columns)
