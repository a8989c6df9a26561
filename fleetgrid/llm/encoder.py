"""Whole texts to token ids in Python tasks, encoding each distinct piece of text once."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np

# A run of white space is cut before its last space only; any other space in a run would
# be a false cut. Python's \s holds all that the tokenizers' \s holds.
_UNSAFE_SPACE = re.compile(r" (?=\s|\Z)")
_SPECIAL = "<|"
_WORD_AND_SIGNS = re.compile(r"([^\W\d_]+)([^\w\s]+)")
_LATIN_END = "\u0250"  # letters before it are letters in all Unicode versions


def _spelled() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: visible Latin-1 characters as they are,
    the others by the characters from U+0100 on, in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in visible]
    return {b: chr(0x100 + i) for i, b in enumerate(others)}


_SPELLED = _spelled()


class _Memo(dict):
    """Ids of the pieces met so far; `_find` gets those of a new one."""

    def __init__(self, find: Callable[[str], bytes], limit: int):
        self._find, self._limit = find, limit

    def __missing__(self, piece: str) -> bytes:
        found = self._find(piece)
        if len(self) < self._limit:
            self[piece] = found
        return found


class PieceEncoder:
    """Ids of texts by the tokenizers library, with a memo of pieces.

    The byte-level vocabulary's own splitter always cuts before a space that a word
    follows. So the ids of a text are the ids of its pieces, cut at such spaces, and
    frequent pieces are looked up. A text with other runs of spaces, or with what may
    be a special token, goes to the library whole.

    `limit` bounds the pieces that are kept. The ids never depend on it.
    """

    def __init__(self, path: str, limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._bytes = [i.to_bytes(4, "little") for i in range(self._tokenizer.get_vocab_size())]
        self._after_space = _Memo(lambda piece: self._new(piece, " "), limit)
        self._after_none = _Memo(lambda piece: self._new(piece, ""), limit)
        self._space = " ".translate(_SPELLED)

    def _library(self, texts: list[str]) -> list[bytes]:
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in encoded]

    def _new(self, piece: str, lead: str) -> bytes:
        """Letters are one word to the splitter, and so are the signs after them."""
        if piece.isalpha():
            if piece.isascii():
                word = self._space + piece if lead else piece
            elif max(piece) < _LATIN_END:
                word = (lead + piece).encode().decode("latin-1").translate(_SPELLED)
            else:
                return self._library([lead + piece])[0]
            return b"".join([self._bytes[x.id] for x in self._model.tokenize(word)])
        same = self._after_space if lead else self._after_none
        parts = _WORD_AND_SIGNS.fullmatch(piece)
        if parts and parts[1].isalpha():
            return same[parts[1]] + self._after_none[parts[2]]
        above, line_end, below = piece.partition("\n")
        if above and below and not above[-1].isspace() and not below[0].isspace():
            return same[above] + self._after_none[line_end] + self._after_none[below]
        return self._library([lead + piece])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        find, out = self._after_space.__getitem__, []
        for text in texts:
            if _SPECIAL in text or _UNSAFE_SPACE.search(text):
                out += self._library([text])
            else:
                head, *pieces = text.split(" ")
                out.append(self._after_none[head] + b"".join(map(find, pieces)))
        return out


class WordCounter:
    """Token counts of texts for a vocabulary that drops white space.

    No token spans white space, so a text's count is the sum over its words, each of
    which is encoded once while `limit` has room.
    """

    def __init__(self, path: str, limit: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._limit = limit
        self._words = {"": 0}

    def count(self, texts: list[str]) -> list[int]:
        split = [x.replace("\n", " ").split(" ") for x in texts]
        words = self._words
        new = [x for x in set().union(*split) if x not in words]
        room = len(words) < self._limit
        encoded = self._tokenizer.encode_batch_fast(new, add_special_tokens=False)
        words.update((x, len(e.ids)) for x, e in zip(new, encoded, strict=True))
        counts = [sum(map(words.__getitem__, x)) for x in split]
        if not room:
            for x in new:
                del words[x]
        return counts


_LOADED: dict[tuple[type, str], object] = {}


def loaded(kind: type, path: str):
    """One encoder per Python worker, which later tasks of the worker use again."""
    key = (kind, path)
    if key not in _LOADED:
        _LOADED[key] = kind(path)
    return _LOADED[key]


def slices(texts: list[str], characters: int = 1_000_000) -> Iterator[slice]:
    """Cuts a batch so that each part has about so many characters, or a single text."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > characters:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))
