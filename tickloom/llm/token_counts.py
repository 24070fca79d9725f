"""Token counts by a compiled finite-state transducer.

The byte-level tokenizer is a regular cut into pieces followed by ordered merges within each piece. Both are compiled
into one deterministic transducer whose states are made when first met:

* Within a piece, the tokens of a prefix end with one token, and the tokens before it are those of the shorter prefix.
  That last token is the one whose merge with what stands before it is stable, that is, merging the pair of both
  tokens' bytes from scratch gives the pair again. What later bytes can change depends only on those prefixes from
  which some entry of the vocabulary could still begin. A state is the list of these: the bytes since, the last token,
  and how many tokens fewer there were. So states are finite, and the transition of a byte is annotated with the tokens
  it adds, which may be negative when a byte completes a longer token.
* Between pieces, a small machine over classes of characters (letters, digits, white space, apostrophe, others) says
  where a piece ends; white space and contractions are decided one or two characters late.

A text is cut into chunks, which are run in sequence: each has a map from the state before it to the state after it and
the tokens in between, and only the state that the chunk before left is looked up. A chunk that follows a character that
is no white space, and itself begins with white space, starts afresh whatever was before: its map is constant, and is
remembered.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import documents_of, id_and_text
from tickloom.llm.tokens import BYTE_BPE

LIMIT = 1024
CHUNK = 256  # characters; longer stretches without a fresh start are cut there

# ---- fixed values of the tokenizer's format ---------------------------------------------------------------------
_LETTER, _DIGIT, _SPACE, _WHITE, _QUOTE, _OTHER = range(6)
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")  # contractions after an apostrophe
_WHITE_CHARS = "\t\n\v\f\r \x85\xa0                　"
# ------------------------------------------------------------------------------------------------------------------

_IS_LETTER = regex.compile(r"\p{L}")
_IS_DIGIT = regex.compile(r"\p{N}")
_STRETCH = re.compile(f"[{_WHITE_CHARS}]*[^{_WHITE_CHARS}]+|[{_WHITE_CHARS}]+")


def char_class(char: str) -> int:
    if char == " ":
        return _SPACE
    if char == "'":
        return _QUOTE
    if char in _WHITE_CHARS:
        return _WHITE
    if _IS_LETTER.match(char):
        return _LETTER
    return _DIGIT if _IS_DIGIT.match(char) else _OTHER


def printable_bytes() -> dict[str, int]:
    """The byte for each character by which byte-level vocabularies spell it: itself if printable, else from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class PieceMachine:
    """The transducer within a piece: ``step(state, byte)`` gives the next state and the tokens added."""

    START = 0

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self._ranks = ranks  # token to its rank; single bytes first, then by merge
        self._prefixes = {token[:n] for token in ranks for n in range(1, len(token))}
        self._stable: dict[tuple[bytes, bytes], bool] = {}
        # what a state knows of each prefix still open: (bytes since it, its last token, tokens since it)
        self._states: list[tuple[tuple[bytes, bytes, int], ...]] = [((b"", b"", 0),)]
        self._numbers = {self._states[0]: 0}
        self._steps: list[dict[int, tuple[int, int]]] = [{}]

    def merge(self, data: bytes) -> list[bytes]:
        """Ordered merges over a short run of bytes."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            pairs = [self._ranks.get(a + b, len(self._ranks)) for a, b in zip(parts, parts[1:])]
            rank = min(pairs)
            if rank == len(self._ranks):
                break
            at = pairs.index(rank)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _follows(self, before: bytes, token: bytes) -> bool:
        """Whether ``token`` can be the last token after ``before`` (empty: at the start of the piece)."""
        key = (before, token)
        found = self._stable.get(key)
        if found is None:
            if len(self._stable) > 2_000_000:
                self._stable.clear()
            want = [token] if not before else [before, token]
            found = self._stable[key] = self.merge(before + token) == want
        return found

    def step(self, state: int, byte: int) -> tuple[int, int]:
        done = self._steps[state].get(byte)
        if done is None:
            done = self._steps[state][byte] = self._compile(state, byte)
        return done

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        grown = [(since + bytes([byte]), last, count) for since, last, count in self._states[state]]
        for token, before, count in grown:  # exactly one last token is right for each prefix
            if token in self._ranks and self._follows(before, token):
                break
        else:
            raise ValueError("the vocabulary lacks a byte")
        added = 1 - count
        # open prefixes: those after which the bytes since begin some longer token, and the new end itself
        kept = tuple((since, last, n + added) for since, last, n in grown if since in self._prefixes)
        key = (*kept, (b"", token, 0))
        number = self._numbers.get(key)
        if number is None:
            number = self._numbers[key] = len(self._states)
            self._states.append(key)
            self._steps.append({})
        return number, added


class Transducer:
    """Both machines in one: a state is (what stands open, state within the piece, characters not yet decided)."""

    STATES = 400_000  # compiled states are dropped beyond this many
    CHUNKS = 1_000_000

    START = ("start", PieceMachine.START, "")

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        spelt = printable_bytes()
        vocabulary = {bytes(spelt[c] for c in token): i for token, i in model["model"]["vocab"].items()}
        merges = model["model"]["merges"]
        ranks = {bytes([b]): b for b in range(256)}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            ranks.setdefault(bytes(spelt[c] for c in left + right), 256 + rank)
        self._ranks = {token: rank for token, rank in ranks.items() if token in vocabulary}
        self._special = [t["content"] for t in model["added_tokens"]]
        self._cut_special = regex.compile("|".join(map(regex.escape, self._special))) if self._special else None
        self._classes: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        self._piece = PieceMachine(self._ranks)
        self._moves: dict[tuple, dict[str, tuple]] = {}
        self._fresh: dict[str, int] = {}  # constant maps: tokens of a chunk that starts afresh and is ended

    def _push(self, state: int, text: str) -> tuple[int, int]:
        added = 0
        for byte in text.encode():
            state, more = self._piece.step(state, byte)
            added += more
        return state, added

    def _open(self, char: str) -> tuple[tuple, int]:
        """A new piece that begins with a character."""
        kind = self._classes.get(char)
        if kind is None:
            kind = self._classes[char] = char_class(char)
        if kind in (_SPACE, _WHITE):
            return ("white", PieceMachine.START, char), 0
        state, added = self._push(PieceMachine.START, char)
        return ("quote" if kind == _QUOTE else kind, state, ""), added

    def _move(self, at: tuple, char: str) -> tuple[tuple, int]:
        """One transition: the state after a character and the tokens it adds."""
        mode, state, waiting = at
        kind = char_class(char)
        if mode == "start":
            return self._open(char)
        if mode == "white":
            # ``state`` holds the run but for its last character, which joins a word if it is a plain space
            if kind in (_SPACE, _WHITE):
                state, added = self._push(state, waiting)
                return ("white", state, char), added
            if waiting == " ":
                state, added = self._push(PieceMachine.START, " " + char)
                return (_OTHER if kind == _QUOTE else kind, state, ""), added
            _, alone = self._push(PieceMachine.START, waiting)
            after, added = self._open(char)
            return after, alone + added
        if mode == "quote":
            spelt = waiting + char
            if spelt in _ENDINGS:
                _, added = self._push(state, spelt)
                return self.START, added
            if any(ending.startswith(spelt) for ending in _ENDINGS):
                return ("quote", state, spelt), 0
            if waiting:  # the apostrophe stood alone, and the letters after it are a piece of their own
                after, first = self._open(waiting)
                after, more = self._move(after, char)
                return after, first + more
            mode = _OTHER
        if kind == mode or mode == _OTHER and kind == _QUOTE:
            state, added = self._push(state, char)
            return (mode, state, ""), added
        return self._open(char)

    def _end(self, at: tuple) -> int:
        """Tokens that what is not yet decided adds at the end of the text."""
        mode, state, waiting = at
        if mode == "white":
            return self._push(state, waiting)[1]
        return self._open(waiting)[1] if mode == "quote" and waiting else 0

    def run(self, at: tuple, chunk: str) -> tuple[tuple, int]:
        """The map of a chunk, at one state: the state after it and the tokens in between."""
        total = 0
        for char in chunk:
            moves = self._moves.get(at)
            if moves is None:
                moves = self._moves[at] = {}
            step = moves.get(char)
            if step is None:
                step = moves[char] = self._move(at, char)
            at, added = step
            total += added
        return at, total

    def _constant(self, chunk: str) -> int:
        """Tokens of a chunk that starts afresh and ends where one does."""
        maps = [functools.partial(self.run, chunk=chunk[i : i + CHUNK]) for i in range(0, len(chunk), CHUNK)]
        at, found = scan(maps, compose)[-1](self.START)
        found += self._end(at)
        if len(chunk) <= CHUNK:
            self._fresh[chunk] = found
        return found

    def count(self, text: str) -> int:
        """Tokens of a whole text; special strings in it are one token each, as the library takes them by default."""
        if len(self._moves) > self.STATES or len(self._fresh) > self.CHUNKS:
            self._reset()
        if self._cut_special and "<|" in text:
            parts = self._cut_special.split(text)
            return sum(map(self.count_plain, parts)) + len(parts) - 1
        return self.count_plain(text)

    def count_plain(self, text: str) -> int:
        known, total, new = self._fresh.get, 0, self._constant
        for stretch in _STRETCH.findall(text):
            found = known(stretch)
            total += new(stretch) if found is None else found
        return total


def compose(first, second):
    """The map of two chunks in a row: each maps a state to the state after it and the tokens in between."""

    def both(at: tuple) -> tuple[tuple, int]:
        middle, added = first(at)
        after, more = second(middle)
        return after, added + more

    return both


def scan(maps: list, compose) -> list:
    """Inclusive prefix scan of an associative operation in a logarithmic number of rounds."""
    done, gap = list(maps), 1
    while gap < len(done):
        done = [compose(done[i - gap], m) if i >= gap else m for i, m in enumerate(done)]
        gap *= 2
    return done


@functools.lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def count_tokens(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit. Narrow; null and empty texts have none; repeated rows repeat."""
    schema = "doc_id long, n_bytes long, n_tokens long"

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path or public_tokenizers.path(BYTE_BPE))
        for doc_ids, texts in documents_of(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array([len(text.encode()) for text in texts], pa.int64()),
                    pa.array([machine.count(text) for text in texts], pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    counted = id_and_text(docs).mapInArrow(count, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
