"""SimHash near-duplicates by BK-trees.

A fingerprint has a bit where more than half of a text's shingle hashes have it. Two fingerprints within the radius differ
in few of the parts that a fingerprint is cut into, so they agree on all others: distinct fingerprints meet in buckets by
each choice of equal parts. Each bucket has a BK-tree of its members: a child is kept under its Hamming distance to the
parent, and a search follows only edges within the radius of its own distance. By the triangle inequality that loses
nothing. The trees of a task are built and searched together, level by level.

A bucket of many members is cut again, by choices of equal parts among the bits that are left, so no tree holds more than
2^16 fingerprints whatever the corpus is like. Only links that join what was apart are passed on, at most one per member.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import id_and_text
from tickloom.llm.components import components
from tickloom.session import materialize

WORDS = 3
SEED = 42
RADIUS = 2
PART_BITS = 16  # four parts of a fingerprint; two of them are equal within the radius
SPLIT = 4096  # members of a bucket beyond which it is cut again
HOT = 1024  # a fingerprint of more than this share of all rows is joined apart; there are no more than this many
_BLOCK = 1 << 15  # words hashed, and fingerprints searched, at a time
_VISITS = 1 << 21  # nodes that one level of a search may meet at a time
_BITS = 64


def fingerprint(text: str, size: int = WORDS) -> int:
    """The 64 bits of a text: A-Z lower-cased, words cut at ASCII white space, repeated shingles counted."""
    words = text.encode().lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    total, counts = len(words) - size + 1, np.zeros(_BITS, np.int64)
    for start in range(0, total, _BLOCK):  # bounded memory for very long texts
        part = words[start : start + _BLOCK + size - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(size))))
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """Per row: doc_id and print, the fingerprint as a signed long; zero without words. Narrow."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(text.as_py(), size) for text in batch.column("text")], np.uint64)
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "print"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, print long")


class Forest:
    """BK-trees of many buckets, which are numbered from 0 and stand one after another."""

    def __init__(self, prints: np.ndarray, buckets: np.ndarray) -> None:
        self._prints = prints
        self._children: list[tuple[np.ndarray, np.ndarray]] = []  # per level: (parent, distance) as a key; child
        members, groups = np.arange(len(prints)), buckets
        self.roots = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])[buckets]
        while True:
            first = np.r_[True, groups[1:] != groups[:-1]]
            nodes = members[first]
            parents = nodes[np.cumsum(first) - 1][~first]
            members = members[~first]
            if not len(members):
                break
            distances = np.bitwise_count(prints[members] ^ prints[parents]).astype(np.int64)
            groups = parents * (_BITS + 1) + distances
            order = np.argsort(groups, kind="stable")  # insertion order within a group: its first is the child
            members, groups = members[order], groups[order]
            first = np.r_[True, groups[1:] != groups[:-1]]
            self._children.append((groups[first], members[first]))

    def search(self, queries: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
        """Of the given members the (member, other) within the radius in the same tree, each pair from both ends."""
        pairs, asked, nodes = [], queries, self.roots[queries]
        for keys, children in [*self._children, (np.zeros(0, np.int64), np.zeros(0, np.int64))]:
            distances = np.bitwise_count(self._prints[asked] ^ self._prints[nodes]).astype(np.int64)
            near = (distances <= radius) & (asked != nodes)
            pairs.append((asked[near], nodes[near]))
            if not len(keys):
                break
            onward = []
            for edge in range(-radius, radius + 1):
                label = distances + edge
                wanted = nodes * (_BITS + 1) + label
                place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                there = (keys[place] == wanted) & (label > 0) & (label <= _BITS)
                onward.append((asked[there], children[place[there]]))
            asked, nodes = (np.concatenate(x) for x in zip(*onward))
        return tuple(np.concatenate(x) for x in zip(*pairs))


def joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking a and b: each member has the least number of its component."""
    while True:
        before = labels
        labels = labels.copy()
        x, y = before[a], before[b]
        np.minimum.at(labels, x, y)
        np.minimum.at(labels, y, x)
        while not np.array_equal(labels, labels[labels]):
            labels = labels[labels]
        if np.array_equal(labels, before):
            return labels


def links_of(prints: np.ndarray, buckets: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, least member of its component) that say which members of a bucket the radius joins."""
    forest, labels = Forest(prints, buckets), np.arange(len(prints))
    block = max(1, min(_BLOCK, _VISITS // max(1, np.bincount(buckets).max(initial=0))))
    for start in range(0, len(prints), block):
        a, b = forest.search(np.arange(start, min(start + block, len(prints))), radius)
        if len(a):
            labels = joined(labels, a, b)
    members = np.flatnonzero(labels != np.arange(len(labels)))
    return members, labels[members]


def _masks(bits: list[int], part: int, radius: int) -> list[int]:
    """Masks of the bits that two fingerprints can agree on: all parts but ``radius`` of them, each choice once."""
    parts = [bits[i : i + part] for i in range(0, len(bits), part)]
    return [sum(1 << bit for p in parts if p not in left for bit in p) for left in combinations(parts, radius)]


def _signed(mask: int) -> int:
    return mask - (1 << _BITS) if mask >> (_BITS - 1) else mask


def _keyed(prints: DataFrame, masks: dict[int, list[int]], choice: str) -> DataFrame:
    """Each row once per mask of its ``choice``: the number of the mask is added to the bucket, and the bits it keeps."""
    cases = []
    for at, options in masks.items():
        structs = [f"named_struct('choice', {number}, 'key', print & ({_signed(mask)}L))" for number, mask in options]
        cases.append(f"WHEN {choice} = {at} THEN array({', '.join(structs)})")
    rows = F.expr(f"CASE {' '.join(cases)} END")
    exploded = prints.select("print", "node", F.explode(rows).alias("bucket"))
    return exploded.select("print", "node", "bucket.choice", "bucket.key")


def near_links(prints: DataFrame, radius: int = RADIUS, split: int = SPLIT) -> DataFrame:
    """Links (a, b) between the nodes of distinct fingerprints (print, node) that differ in at most ``radius`` bits.

    They join the same nodes as all pairs would, with one link per member of a bucket at most.
    """
    firsts = _masks(list(range(_BITS)), PART_BITS, radius)
    coarse = {0: list(enumerate(firsts))}
    fine: dict[int, list[tuple[int, int]]] = {}
    number = len(firsts)
    for at, mask in enumerate(firsts):  # of the bits left over, again all parts but ``radius``
        left = [bit for bit in range(_BITS) if not mask >> bit & 1]
        options = _masks(left, PART_BITS // 2, radius)
        fine[at] = [(number + i, mask | option) for i, option in enumerate(options)]
        number += len(options)
    members = materialize(_keyed(prints.withColumn("whole", F.lit(0)), coarse, "whole"), "simhash-members")
    sizes = members.groupBy("choice", "key").agg(F.count("*").alias("size")).where("size > 1")
    sizes = materialize(sizes, "simhash-buckets")
    small = members.join(sizes.where(F.col("size") <= split), ["choice", "key"], "left_semi")
    large = members.join(sizes.where(F.col("size") > split), ["choice", "key"], "left_semi")
    dealt = small.select("print", "node", "choice", "key").unionByName(_keyed(large, fine, "choice"))
    placed = dealt.repartition("choice", "key").sortWithinPartitions("choice", "key")

    def solve(columns: list[np.ndarray]) -> pa.RecordBatch:
        choices, keys, prints, nodes = columns
        new = np.r_[True, (choices[1:] != choices[:-1]) | (keys[1:] != keys[:-1])]
        a, b = links_of(prints.view(np.uint64), np.cumsum(new) - 1, radius)
        return pa.RecordBatch.from_arrays([pa.array(nodes[a]), pa.array(nodes[b])], ["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            fresh = [batch.column(name).to_numpy() for name in ("choice", "key", "print", "node")]
            held = fresh if held is None else [np.concatenate(pair) for pair in zip(held, fresh)]
            if len(held[0]) < 2 * _BLOCK:
                continue
            # the last bucket may go on in the next batch
            last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield solve([column[:cut] for column in held])
                held = [column[cut:] for column in held]
        if held is not None and len(held[0]):
            yield solve(held)

    return placed.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, size: int = WORDS) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hexadecimal digits) and component_id, the least doc_id that links reach.

    Texts whose fingerprints differ in at most ``radius`` bits are linked, also texts without words (fingerprint zero;
    null counts as empty). Rows that share a doc_id are one node with the links of all its texts. A row without doc_id
    has its fingerprint, but no links and no component_id. Repeated rows repeat, no rows give no rows.
    """
    printed = materialize(fingerprints(docs, size), "simhash-prints")
    known = printed.where("doc_id is not null")
    copies = F.count("*").alias("copies")
    prints = materialize(known.groupBy("print").agg(F.min("doc_id").alias("node"), copies), "simhash-distinct")
    several = known.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low < high")
    texts = known.join(several, "doc_id", "left_semi").distinct()
    same = texts.join(prints, "print").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    by_node = components(near_links(prints.select("print", "node"), radius).unionByName(same))
    placed = prints.join(by_node, "node", "left").select(
        "print", "copies", F.coalesce("component", "node").alias("component_id")
    )
    placed = materialize(placed, "simhash-components")
    # of fingerprints with more than 1/HOT of all rows there are fewer than HOT: these go to the rows, others meet them
    rows = printed.count()
    often = F.col("copies") * HOT > rows
    hot = F.broadcast(placed.where(often).select("print", F.col("component_id").alias("hot_id")))
    marked = printed.join(hot, "print", "left")
    many = marked.where("hot_id is not null").select("doc_id", "print", F.col("hot_id").alias("component_id"))
    few = marked.where("hot_id is null").join(placed.where(~often), "print", "left").select("doc_id", "print", "component_id")
    return many.unionByName(few).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
