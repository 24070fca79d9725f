"""Spelling variants of words: pairs of a vocabulary that one edit apart, by composition of finite-state machines.

The words of a partition make a minimal deterministic acceptor. It is composed with a transducer that copies letters and
makes one edit (a letter inserted, deleted or replaced), and with the acceptor again. Before the edit both acceptors are
in one state, after it the two must accept the same rest: what two states have in common is worked out once per pair of
states. Accepted pairs are enumerated from the initial state.

An initial state is an affix: with one edit, two words agree on the first half of the shorter one or on as many letters
as are left at their ends, so each word goes to the states of its halves. A state that too many words reach is
left by the halves of what is left of the words, again and again if need be, down to one letter: then it holds no more
words than the alphabet has letters and pairs of letters. A pair belongs to exactly one state, by the place where the
two words part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import documents_of, id_and_text
from tickloom.session import materialize

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS = 6
LEAST_TIMES = 5
FACTOR = 5  # how many times as frequent a form is
SPLIT = 2048  # words of a state beyond which it is left by halves
_HELD = 100_000  # words counted in a task before they are passed on


def lowered(word: str) -> str:
    """Only A-Z lower-cased."""
    return word.lower() if word.isascii() else re.sub("[A-Z]+", lambda found: found[0].lower(), word)


def word_counts(docs: DataFrame, letters: str = LETTERS, divisor: int | None = None) -> DataFrame:
    """word and n, its occurrences in all texts: maximal runs of ``letters``, A-Z lower-cased. Counted before the shuffle.

    With ``divisor``, words of a document whose crc32 of "doc_id:word" it divides lose the letter at crc32 % length, which
    plants misspellings; rows without doc_id are left as they are.
    """
    pattern = re.compile(f"[{letters}]+")

    def flush(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        spelt: dict[str, str] = {}
        for ids, texts in documents_of(batches):
            for doc_id, text in zip(ids, texts):
                found: Counter = Counter()
                for word, n in Counter(pattern.findall(text)).items():
                    known = spelt.get(word)
                    if known is None:
                        known = spelt[word] = lowered(word)
                    found[known] += n
                if divisor and doc_id is not None:
                    start = zlib.crc32(f"{doc_id}:".encode())
                    for word in [w for w in found if zlib.crc32(w.encode(), start) % divisor == 0]:
                        at = zlib.crc32(word.encode(), start) % len(word)
                        total[word[:at] + word[at + 1 :]] += found.pop(word)
                total.update(found)
                if len(total) > _HELD:
                    yield flush(total)
                    total.clear()
                if len(spelt) > _HELD:
                    spelt.clear()
        if total:
            yield flush(total)

    partial = id_and_text(docs).mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where("word <> ''")


class Acceptor:
    """The minimal deterministic acceptor of sorted distinct words. State 0 is the last one of every word's."""

    def __init__(self, words: list[str]) -> None:
        self.edges: list[dict[str, int]] = [{}]
        self.final = [True]
        self._register: dict = {(True, ()): 0}
        path: list[tuple[dict[str, int], list[bool]]] = [({}, [False])]  # of the last word: edges and finality, unfrozen
        before = ""
        for word in words:
            shared = 0
            while shared < min(len(word), len(before)) and word[shared] == before[shared]:
                shared += 1
            self._freeze(path, before, shared)
            path += [({}, [False]) for _ in word[shared:]]
            path[-1][1][0] = True
            before = word
        self._freeze(path, before, 0)
        self.initial = self._state(*path[0])

    def _state(self, edges: dict[str, int], final: list[bool]) -> int:
        key = final[0], tuple(edges.items())
        state = self._register.get(key)
        if state is None:
            state = self._register[key] = len(self.edges)
            self.edges.append(edges)
            self.final.append(final[0])
        return state

    def _freeze(self, path: list, word: str, down_to: int) -> None:
        while len(path) > down_to + 1:
            letter = word[len(path) - 2]
            state = self._state(*path.pop())
            path[-1][0][letter] = state


class Composition:
    """An acceptor, a transducer of one edit, and the acceptor again."""

    def __init__(self, acceptor: Acceptor) -> None:
        self._edges, self._final = acceptor.edges, acceptor.final
        self._initial = acceptor.initial
        self._common: dict[tuple[int, int], list[str]] = {}

    def common(self, a: int, b: int) -> list[str]:
        """The rests that both states accept."""
        key = (a, b) if a < b else (b, a)
        found = self._common.get(key)
        if found is None:
            found, path = [], []
            waiting = [(*key, 0, "")]
            while waiting:
                x, y, depth, letter = waiting.pop()
                path[depth:] = [letter]
                if self._final[x] and self._final[y]:
                    found.append("".join(path))
                others = self._edges[y]
                waiting += [(s, others[c], depth + 1, c) for c, s in self._edges[x].items() if c in others]
            self._common[key] = found
        return found

    def pairs(self) -> Iterator[tuple[int, str, str]]:
        """(letters before they part, shorter word, other word): all pairs one edit apart, each once. Of words of one
        length the smaller is the first."""
        waiting, path = [(self._initial, 0, "")], []
        while waiting:
            state, depth, letter = waiting.pop()
            path[depth:] = [letter]
            found = list(self._edit(state))
            if found:
                before = "".join(path)
                for short, long in found:
                    yield depth, before + short, before + long
            waiting += [(s, depth + 1, c) for c, s in self._edges[state].items()]

    def _edit(self, state: int) -> Iterator[tuple[str, str]]:
        """Rests of pairs that part in this state."""
        edges = self._edges[state]
        for at, (letter, onward) in enumerate(edges.items()):
            for other, s in list(edges.items())[at + 1 :]:  # replaced
                for rest in self.common(onward, s):
                    yield letter + rest, other + rest
            # inserted: they part here only if the shorter rest does not begin with that letter
            if self._final[state] and self._final[onward]:
                yield "", letter
            for second, s in self._edges[onward].items():
                if second != letter and second in edges:
                    for rest in self.common(edges[second], s):
                        yield second + rest, letter + second + rest


def _state(word: Column, length: Column, first: Column, last: Column) -> Column:
    """The state that a word reaches by its first and last letters, for pairs whose shorter word has this length."""
    end = F.substring(word, F.char_length(word) - last + 1, last)
    return F.concat_ws(":", length, first, last, F.concat(F.substring(word, F.lit(1), first), end))


def _left(words: DataFrame) -> DataFrame:
    """Rows (word, n, length, first, last) by the halves of the letters that no affix holds yet."""
    half = F.floor((F.col("length") - F.col("first") - F.col("last")) / 2).cast("int")
    rest = F.col("length") - F.col("first") - F.col("last") - half
    ways = F.array(
        F.struct((F.col("first") + half).alias("first"), F.col("last").alias("last")),
        F.struct(F.col("first").alias("first"), (F.col("last") + rest).alias("last")),
    )
    return words.select("word", "n", "length", F.explode(ways).alias("way")).select("word", "n", "length", "way.*")


def near_words(words: DataFrame, split: int = SPLIT) -> DataFrame:
    """Rows (word, near, near_n) of a stored frame of distinct words (word, n): all pairs one edit apart, both ways."""
    sized = words.select("word", "n", F.char_length("word").alias("size"))
    lengths = F.array(F.col("size"), F.col("size") - 1)
    starts = sized.select("word", "n", F.explode(lengths).alias("length")).where("length > 0")
    open_words = _left(starts.withColumns({"first": F.lit(0), "last": F.lit(0)}))
    state = _state(F.col("word"), F.col("length"), F.col("first"), F.col("last"))
    found = None
    while open_words is not None:
        reached = materialize(open_words.withColumn("state", state), "spelling-states")
        sizes = reached.groupBy("state").agg(F.count("*").alias("words")).where("words > 1")
        sizes = materialize(sizes, "spelling-sizes")
        # with one letter left there is nothing to halve
        full = (F.col("words") > split) & (F.col("length") - F.col("first") - F.col("last") > 1)
        placed = reached.join(sizes, "state")
        small = placed.where(~full).drop("words")
        found = small if found is None else found.unionByName(small)
        open_words = None
        if not sizes.where(F.col("words") > split).isEmpty():
            large = placed.where(full)
            open_words = None if large.isEmpty() else _left(large)
    grouped = found.repartition("state").sortWithinPartitions("state", "word")

    def solve(rows: list[tuple[str, int]], length: int, first: int, last: int) -> Iterator[tuple[str, str, int]]:
        if len(rows) < 2:
            return
        counts = dict(rows)
        for parted, word, other in Composition(Acceptor(list(counts))).pairs():
            # the other words of this state part elsewhere, or belong to another length
            if len(word) == length and parted >= first and (not last or parted < length - last):
                yield word, other, counts[other]
                yield other, word, counts[word]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "near", "near_n"]
        types = [pa.string(), pa.string(), pa.int64()]
        key, rows, out = None, [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("state", "word", "n", "length", "first", "last")]
            for state, word, n, *place in zip(*columns):
                if key is None or key[0] != state:
                    if key is not None:
                        out += solve(rows, *key[1:])
                    key, rows = (state, *place), []
                rows.append((word, n))
                if len(out) > _HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out = []
        if key is not None:
            out += solve(rows, *key[1:])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return grouped.mapInArrow(run, "word string, near string, near_n long")


def spelling_groups(
    counts: DataFrame, least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES, factor: int = FACTOR,
    split: int = SPLIT,
) -> DataFrame:
    """Per word of ``counts`` (word, n) that is long and frequent enough: word, form, root, n, n_near and form_n.

    ``n_near`` counts the words one edit apart; ``form`` is the one of largest n (ties: the smallest in code-point order)
    if it is ``factor`` times as frequent, else null; ``root`` is where forms lead to, the word itself without one. Rows
    that share a word are added up; null and empty words are left out; no rows give no rows.
    """
    if least_letters < 1 or factor < 2:
        raise ValueError("words need letters, and forms must grow")
    known = counts.where("word is not null and word <> ''").groupBy("word").agg(F.sum("n").alias("n"))
    words = known.where((F.char_length("word") >= least_letters) & (F.col("n") >= least_times))
    words = materialize(words, "spelling-words")
    # the largest n first; of equal ones the smallest word, as the lists are ordered by their first entry
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    nearest = near_words(words, split).groupBy("word").agg(F.count("*").alias("n_near"), best)
    form_n = -F.col("best.less")
    is_form = form_n >= factor * F.col("n")
    formed = words.join(nearest, "word", "left").select(
        "word", F.when(is_form, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, form_n).alias("form_n"),
    )
    formed = materialize(formed, "spelling-forms")
    # paths double in each round; a form is ``factor`` times as frequent, so there are few
    steps = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        steps = materialize(steps, "spelling-roots")
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        onward = steps.join(further, "root", "left")
        if onward.where("next is not null").isEmpty():
            break
        steps = onward.select("word", F.coalesce("next", "root").alias("root"))
    return formed.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
