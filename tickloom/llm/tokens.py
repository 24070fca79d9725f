"""Token ids of whole texts by tokenizer files, with a bounded memory of pieces that were encoded before.

Both tokenizer files cut a text before they merge. The byte-level one never joins a letter or digit with a comma, a
full stop or white space after it; the word-level one drops white space. So a text can be cut there, each piece be
encoded by itself, and most pieces of a corpus have been met before. A text where such a cut could matter (runs of
white space, runs of punctuation, special strings) goes to the library whole.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata

import numpy as np
import public_tokenizers

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

_WHITE = re.compile(r"\s")  # holds all that the tokenizers take for white space, and four controls more
_PYTHON_ONLY_WHITE = re.compile("[\x1c-\x1f]")
_LATIN = re.compile("[^\x00-į]")  # no letter below lower-cases in a way of its own or composes with another
_SPECIAL = "<|"
_BARE = "<|"  # marks a piece that no space goes before; texts that hold this string are not cut
_MARKS = (", ", ". ", ".\n")


class _Ends(dict):
    """Whether a text may be cut after a character and before a mark: if it still ends in a letter or digit, as the
    tokenizers see it. A dotted capital I, and letters that only exist decomposed, end in a mark of their own then."""

    def __missing__(self, char: str) -> bool:
        spelt = unicodedata.normalize("NFC", char).lower()
        value = self[char] = spelt != "" and unicodedata.category(spelt[-1])[0] in "LN"
        return value


_ENDS = _Ends()


class PieceEncoder:
    """Texts to ids as little-endian unsigned 32-bit bytes, equal to ``whole`` of each text."""

    PIECES = 1_000_000  # the memory of pieces is emptied beyond this many
    WORDS = 500_000  # the same where case and punctuation are taken off, which leaves fewer pieces

    def __init__(self, by_words: bool) -> None:
        self._by_words = by_words
        if by_words:
            self.PIECES = self.WORDS
        self._known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        raise NotImplementedError

    def pieces(self, texts: list[str]) -> list[bytes]:
        """Each of many short texts by itself."""
        return [self.whole(text) for text in texts]

    def _pieces(self, text: str) -> list[str] | None:
        if _SPECIAL in text or self._by_words and _PYTHON_ONLY_WHITE.search(text):
            return None
        before = " " if self._by_words else " " + _BARE
        for mark in _MARKS:
            parts = text.split(mark)
            if not all([_ENDS[part[-1:]] for part in parts[:-1]]):
                return None
            text = (before + mark).join(parts)
        if self._by_words:
            return (text if _LATIN.search(text) else text.lower()).split()
        return (_BARE + text.replace("\n", f" {_BARE}\n")).split(" ")

    def _safe(self, piece: str) -> bool:
        """Whether a piece keeps clear of runs of white space; it may only begin with one new line."""
        if self._by_words:
            return True
        if not piece.startswith(_BARE):
            return piece != "" and not _WHITE.search(piece)
        return piece != _BARE + "\n" and not _WHITE.search(piece.removeprefix(_BARE).removeprefix("\n"))

    def _learn(self, fresh: list[str]) -> None:
        spelt = fresh
        if not self._by_words:
            if _BARE in fresh:  # nothing before the first space
                self._known[_BARE] = b""
                fresh.remove(_BARE)
            spelt = [p[len(_BARE):] if p.startswith(_BARE) else " " + p for p in fresh]
        if fresh:
            self._known.update(zip(fresh, self.pieces(spelt), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self._pieces(text) for text in texts]
        if len(self._known) > self.PIECES:  # the shorter pieces come again more often
            self._known = {piece: ids for piece, ids in self._known.items() if len(piece) < 8}
            if len(self._known) > self.PIECES // 2:
                self._known.clear()
        fresh = set().union(*(pieces for pieces in cut if pieces)).difference(self._known)
        unsafe = {piece for piece in fresh if not self._safe(piece)}
        if unsafe:
            fresh -= unsafe
            cut = [None if pieces and not unsafe.isdisjoint(pieces) else pieces for pieces in cut]
        if fresh:
            self._learn(list(fresh))
        known = self._known.__getitem__
        return [
            self.whole(text) if pieces is None else b"".join(map(known, pieces))
            for text, pieces in zip(texts, cut, strict=True)
        ]


class LibraryEncoder(PieceEncoder):
    """Ids by the tokenizers library."""

    def __init__(self, path: str, by_words: bool) -> None:
        super().__init__(by_words)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # between pieces: a token that no piece has. A byte-level piece may only begin with a new line, see ``pieces``
        self._separator = "<|endoftext|>" if by_words else "\n"
        self._separator_ids = self._ids(self._separator)

    def _ids(self, text: str) -> np.ndarray:
        """Ids by the call that leaves out the places of the tokens in the text, which takes half the time."""
        (encoding,) = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(encoding.ids, dtype="<u4")

    def whole(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def pieces(self, texts: list[str]) -> list[bytes]:
        """One call for all, which the separator keeps apart."""
        (separator,) = self._separator_ids
        joined = self._separator.join([text.removeprefix(self._separator) for text in texts])
        ids = self._ids(joined)
        cuts = np.flatnonzero(ids == separator).tolist()
        data = ids.tobytes()
        mark = int(separator).to_bytes(4, "little")
        return [
            (mark if text.startswith(self._separator) else b"") + data[4 * (start + 1) : 4 * end]
            for text, start, end in zip(texts, [-1, *cuts], [*cuts, len(ids)], strict=True)
        ]


@functools.lru_cache(maxsize=4)
def encoder(name: str = BYTE_BPE, path: str | None = None) -> LibraryEncoder:
    """One encoder per Python worker and file. ``path`` names the file where it is not in the installed package."""
    return LibraryEncoder(path or public_tokenizers.path(name), by_words=name == WORD_BPE)
