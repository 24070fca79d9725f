"""Periodic runs of words, by a suffix automaton and link-cut access.

The words of a stretch make a suffix automaton, whose links form a tree: the path from the state of a prefix to the root
holds all suffixes of that prefix. The words are then appended one after another. Each append is an access of the
link-cut tree: it walks that path, segment by segment, and gives it the new end. A segment is a part of the path with
one last occurrence so far, and its deepest state tells how long a suffix occurs there. Where the distance of the new end
from the old one is no more than that length, the words end in a square of this period; the roots of these squares are
primitive, and every primitive square is met. Squares of one period with ends side by side are one run, which begins as
far left as the segment is long.

Most words of a text are in no run. Within a run of ``shortest`` words or more any ``ceil(shortest / 2)`` words occur
again a period away, so words that no repeated group of this size covers are left out beforehand, exactly.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.common import documents_of, id_and_text

SHORTEST = 12  # words of a run; it also holds its period twice
_PASSES = 4  # that narrow a stretch; what is left then goes to the automaton as it is
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]  # start, length, period


def stretches(words: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Parts (start, end) of the words outside of which no word is in a run. ``words`` are numbers."""
    size = -(-shortest // 2)
    if len(words) < shortest:
        return []
    groups = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):  # equal groups have equal hashes; a collision costs work only
        groups = groups * _FACTOR + words[i : i + len(groups)].astype(np.uint64)
    found, waiting = [], [(0, len(words), 0)]
    while waiting:
        start, end, passes = waiting.pop()
        own = groups[start : end - size + 1]
        order = np.argsort(own, kind="stable")
        near = (np.diff(order) <= (end - start) // 2) & (own[order[1:]] == own[order[:-1]])
        edges = np.zeros(end - start + 2, np.int64)
        for places in (order[1:][near], order[:-1][near]):
            np.add.at(edges, places + 1, 1)
            np.add.at(edges, places + size + 1, -1)
        turns = np.flatnonzero(np.diff(np.cumsum(edges) > 0))
        parts = [(start + a, start + b) for a, b in turns.reshape(-1, 2).tolist() if b - a >= shortest]
        if passes == _PASSES or parts == [(start, end)]:
            found += parts
        else:
            waiting += [(a, b, passes + 1) for a, b in parts]
    return sorted(found)


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Lengths and links of the states, 1 is the empty string and 0 none; and the state of each prefix."""
    lengths, links, after = [0, 0], [0, 0], [{}, {}]
    prefixes, last = [], 1
    for word in words:
        new = len(lengths)
        lengths.append(lengths[last] + 1)
        links.append(1)
        after.append({})
        at, last = last, new
        prefixes.append(new)
        while at and word not in after[at]:
            after[at][word] = new
            at = links[at]
        if not at:
            continue
        target = after[at][word]
        if lengths[target] == lengths[at] + 1:
            links[new] = target
            continue
        split = len(lengths)
        lengths.append(lengths[at] + 1)
        links.append(links[target])
        after.append(after[target].copy())
        while at and after[at].get(word) == target:
            after[at][word] = split
            at = links[at]
        links[target] = links[new] = split
    return lengths, links, prefixes


class Paths:
    """A link-cut tree over fixed parents whose preferred paths carry the end that was last given to them."""

    def __init__(self, parents: list[int]) -> None:
        self._up = list(parents)  # in the splay tree of a path; of its root: the node that the path hangs on
        self._left = [0] * len(parents)
        self._right = [0] * len(parents)
        self._end = [-1] * len(parents)  # of the root of a splay tree

    def _rotate(self, node: int, above: int) -> None:
        up, left, right = self._up, self._left, self._right
        top = up[above]
        if left[top] == above:
            left[top] = node
        elif right[top] == above:
            right[top] = node
        if left[above] == node:
            moved = left[above] = right[node]
            right[node] = above
        else:
            moved = right[above] = left[node]
            left[node] = above
        if moved:
            up[moved] = above
        up[above] = node
        up[node] = top

    def _splay(self, node: int) -> None:
        up, left, right, end = self._up, self._left, self._right, self._end
        while True:
            above = up[node]
            if not above or left[above] != node and right[above] != node:
                return
            top = up[above]
            if not top or left[top] != above and right[top] != above:
                end[node] = end[above]
                self._rotate(node, above)
                return
            end[node] = end[top]  # holds if ``top`` is the root, else a later turn puts it right
            if (left[top] == above) == (left[above] == node):
                self._rotate(above, top)
                self._rotate(node, above)
            else:
                self._rotate(node, above)
                self._rotate(node, top)

    def access(self, node: int, end: int) -> list[tuple[int, int]]:
        """Give ``end`` to the path from ``node`` to the root; its segments before: (their end, their deepest node)."""
        up, right, ends = self._up, self._right, self._end
        segments, below, at = [], 0, node
        while at:
            self._splay(at)
            before, cut = ends[at], right[at]
            if cut:
                ends[cut] = before
            right[at] = below
            if before >= 0:
                segments.append((before, at))
            below, at = at, up[at]
        self._splay(node)
        ends[node] = end
        return segments


def runs_of_stretch(words: list[int], shortest: int = SHORTEST) -> list[Run]:
    """All runs of these words, in no order."""
    lengths, links, prefixes = suffix_automaton(words)
    paths = Paths(links)
    found: list[Run] = []
    running: dict[int, tuple[int, int]] = {}  # by period: start and end so far

    def close(period: int) -> None:
        start, end = running[period]
        if end - start + 1 >= shortest:
            found.append((start, end - start + 1, period))

    for end, state in enumerate(prefixes):
        for before, deepest in paths.access(state, end):
            period = end - before
            if period > lengths[deepest]:
                continue
            start = before - lengths[deepest] + 1
            if period in running and running[period][0] != start:
                close(period)
            running[period] = start, end
    for period in running:
        close(period)
    return found


def runs_of(words: list, shortest: int = SHORTEST) -> list[Run]:
    """The runs (start, length, period) of a sequence, by start, then period."""
    numbers: dict = defaultdict(count().__next__)
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    found = []
    for start, end in stretches(ids, shortest):
        found += [(start + at, n, period) for at, n, period in runs_of_stretch(ids[start:end].tolist(), shortest)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by one space, without those that follow the first period of any run."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[at] for at in np.flatnonzero(kept).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Per row: doc_id, runs (array of start, length, period; by start, then period) and the collapsed text.

    A run is a stretch of words (cut at ASCII white space) with smallest period q and at least max(``shortest``, 2q)
    words that no neighbour extends. Narrow: a text is one task's, with memory in proportion to its longest stretch of
    repeated words, in time n log n. Null and empty texts, and such without words, have no runs and an empty collapsed
    text; repeated rows repeat, a row without doc_id is treated like any other, no rows give no rows.
    """
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    schema = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in documents_of(batches):
            found, left = [], []
            for text in texts:
                words = text.encode().split()
                runs = runs_of(words, shortest)
                found.append([{"start": a, "length": b, "period": c} for a, b, c in runs])
                left.append(collapsed(words, runs).decode())
            columns = [pa.array(ids, pa.int64()), pa.array(found, pa.list_(run)), pa.array(left, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

    return id_and_text(docs).mapInArrow(search, schema)
