"""Token ids of whole texts with a public tokenizer file, cached by word.

The tokenizer's pre-tokens never span white space, so a text's ids are the
ids of its space-separated chunks one after another.  Chunks repeat, their
ids are kept in a cache of bounded size; a new chunk of plain Latin-1 text is
split by the tokenizer's own pattern, its pieces share the cache, and only the
tokenizer's model is called; any other chunk goes through the whole tokenizer.
"""

from __future__ import annotations

import os
from array import array

import regex

#: Entries the cache holds before it starts anew (about 200 bytes each).
CACHE_ENTRIES = 350_000
#: Characters tokenized at once: bounds the memory for a very long text.
SLICE_CHARS = 1 << 20

_PRE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[int, str]:
    """The visible letter that byte-level vocabularies use for each byte."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in seen}
    table.update({b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in table)})
    return table


class _Cache(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[key] = self.make(key)
        return value


class WordTokenizer:
    """``ids(text)``: little-endian unsigned 32-bit ids as bytes, the same as
    ``Tokenizer.encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        letters = byte_letters()
        self.letters = {chr(b): letters[b] for b in range(128)}
        self.letters.update({chr(c): "".join(letters[b] for b in chr(c).encode()) for c in range(128, 256)})
        self.table = str.maketrans(self.letters)
        self.chunks = _Cache(self._chunk)

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():  # visible ASCII letters stand for themselves
            piece = piece.translate(self.table)
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        # Printable Latin-1 has no control characters, other spaces or marks;
        # a "<" may begin a special token.
        if chunk.isprintable() and "<" not in chunk and (chunk.isascii() or max(chunk) < "Ā"):
            low = chunk.lower()
            pieces = [low] if low.isalpha() else _PRE.findall(low)
            if pieces == [chunk]:
                return self._piece(chunk)
            return b"".join([self.chunks[p] for p in pieces])
        return array("I", self.full.encode(chunk, add_special_tokens=False).ids).tobytes()

    def forget(self) -> None:
        """Free the cache; a worker outlives the tasks that filled it."""
        self.chunks.clear()

    def _ids(self, text: str) -> bytes:
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.chunks.__getitem__, words))

    def ids(self, text: str) -> bytes:
        if len(text) <= SLICE_CHARS:
            return self._ids(text)
        out, at = [], 0
        while at < len(text):
            to = at + SLICE_CHARS
            while to < len(text) and text[to] not in " \n\t\r":
                to += 1
            out.append(self._ids(text[at:to]))
            at = to
        return b"".join(out)


_LOADED: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for a Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
