"""Token counts by a linear longest-match automaton.

Greedy word pieces: a word is cut from the left, each time at the longest
piece of the vocabulary.  The pieces are counted without being built: the
vocabulary's trie gets failure links, and each node the number of pieces that
are popped (known to be final) when no child fits and its link is followed.
Every character is read once, and a link is followed at most once for each
character read, so a word takes time linear in its length.

Pieces that end a word carry the suffix of the vocabulary file; a word is read
with one end symbol after it, so such pieces match at its end only.  A word
that no sequence of pieces reaches counts as one unknown piece, as in greedy
word-piece models.

Words are split like the vocabulary's tokenizer splits them, and are
lower-cased; a worker keeps the counts of recent words.

Defined cases: null and empty texts, and texts of white space, have no words
and no pieces; repeated rows and null ids are counted row by row; an empty
table gives an empty result; very long texts are read slice by slice; further
columns are ignored.
"""

from __future__ import annotations

import json
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.llm import tokens
from ranklight.llm.common import prepare, table
from ranklight.llm.registry import register

#: Words whose counts a worker keeps before it starts anew.
CACHE_WORDS = 250_000
#: Stands after the last character of a word; no word has white space.
END = "\n"

_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class Automaton:
    """Counts greedy longest-match pieces of a word."""

    def __init__(self, pieces):
        """``pieces``: strings; END in one marks the end of a word."""
        self.next: list[dict] = [{}]
        final = [False]
        parents = [(0, "")]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    final.append(False)
                    parents.append((node, c))
                node = self.next[node][c]
            if piece:
                final[node] = True
        # Breadth first: a node's link and pops follow from shorter strings'.
        self.link, self.pops = [-1] * len(self.next), [0] * len(self.next)
        level = list(self.next[0].values())
        while level:
            for v in level:
                if final[v]:
                    self.link[v], self.pops[v] = 0, 1
                    continue
                up, c = parents[v]
                z, popped = self.link[up], self.pops[up]
                while z >= 0 and c not in self.next[z]:
                    popped += self.pops[z]
                    z = self.link[z]
                if z >= 0:
                    self.link[v], self.pops[v] = self.next[z][c], popped
            level = [w for v in level for w in self.next[v].values()]

    def count(self, word: str) -> int | None:
        """Pieces of a word (0 if empty), None if it cannot be cut."""
        nexts, links, pops = self.next, self.link, self.pops
        node = total = 0
        for c in word:
            while c not in nexts[node]:
                if links[node] < 0:
                    return None
                total += pops[node]
                node = links[node]
            node = nexts[node][c]
        while node:
            if links[node] < 0:
                return None
            total += pops[node]
            node = links[node]
        return total


def vocabulary(path: str) -> list[str]:
    """The pieces of a byte-level vocabulary file, ends of words as END."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    suffix = model.get("end_of_word_suffix") or ""
    return [p[:-len(suffix)] + END if suffix and p.endswith(suffix) else p for p in model["vocab"]]


class Counts:
    """Words and pieces of texts, for one Python worker."""

    def __init__(self, path: str):
        self.automaton = Automaton(vocabulary(path))
        letters = tokens.byte_letters()
        self.letters = [letters[b] for b in range(256)]
        self.known: dict[str, tuple[int, int]] = {}

    def word(self, word: str) -> int:
        visible = word if word.isascii() and word.isprintable() else "".join([self.letters[b] for b in word.encode("utf-8", "surrogatepass")])
        n = self.automaton.count(visible + END)
        return 1 if n is None else n

    def _chunk(self, chunk: str) -> tuple[int, int]:
        words = _WORD.findall(chunk.lower())
        return len(words), sum([self.word(w) for w in words])

    def text(self, text: str) -> tuple[int, int]:
        """(words, pieces)."""
        known, words, pieces, at = self.known, 0, 0, 0
        while at < len(text):
            to = at + tokens.SLICE_CHARS
            while to < len(text) and not text[to].isspace():
                to += 1
            for chunk, n in Counter(text[at:to].split()).items():
                got = known.get(chunk)
                if got is None:
                    if len(known) >= CACHE_WORDS:
                        known.clear()
                    got = known[chunk] = self._chunk(chunk)
                words += got[0] * n
                pieces += got[1] * n
            at = to
        return words, pieces


_LOADED: dict[str, Counts] = {}


def _counter(path: str):
    def run(batches):
        if path not in _LOADED:
            _LOADED[path] = Counts(path)
        counts = _LOADED[path]
        for batch in batches:
            got = [counts.text(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64())],
                names=["doc_id", "n_words", "n_tokens"])
        counts.known.clear()  # a worker outlives its tasks
    return run


def token_counts(documents: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens."""
    prepare(documents, "doc_id", "text")
    path = vocabulary_path or tokens.default_path()
    d = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return d.mapInArrow(_counter(path), "doc_id long, n_words long, n_tokens long")


@register("op8_longest_match_counts")
def op8_longest_match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every document."""
    return token_counts(table(spark, sf_dir, "documents"))
