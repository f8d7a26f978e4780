"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits, lower-cased.  A document and a
benchmark item that share a seed (``MIN_MATCH`` consecutive words, found by a
rolling Karp-Rabin hash) are compared: of all matches between unmarked words
the longest are marked, again and again, until none of MIN_MATCH words is
left.  The marked tiles do not overlap in either text and may come in any
order, so a passage with its parts moved around is still covered.  The item
is found if tiles cover at least ``COVERAGE`` of its words.

The benchmark is dealt into blocks of about ``BLOCK_WORDS`` words; each block
goes to all tasks and meets every document where it lies, so documents are
never shuffled, and the result does not depend on the number of blocks.

Defined cases: null and empty texts match nothing; an item with fewer words
than MIN_MATCH must occur as a whole, one with fewer than ``MIN_ITEM`` never
matches; repeated items and rows each give their rows; an empty table on
either side gives an empty result; of equally long matches the one on the
smaller diagonal (place in document - place in item), then the earlier one, is
marked first; very long texts are read slice by slice and tiled as a whole,
their matches kept as runs, so that memory grows with the text and not with
its product with an item of the same repeated words; further columns are kept by ``decontaminate``.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.llm.common import prepare, table, written
from ranklight.llm.registry import register

MIN_MATCH = 5
MIN_ITEM = 3
COVERAGE = 0.5
BLOCK_WORDS = 400_000
#: Characters split into words at once.
SLICE_CHARS = 1 << 20
#: Pairs of equal seeds, and words of broken matches, looked at together.
SEED_PAIRS = 1 << 20
CELLS = 1 << 22

_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

FOUND = "doc_id long, item_id long, matched long, item_words long, coverage double, tiles long"


def word_ids(text: str | None, vocabulary: dict[str, int]) -> np.ndarray:
    """Numbers of the words of a text; 0 for a word no item has."""
    out, at, text = [], 0, text or ""
    while at < len(text):
        to = at + SLICE_CHARS
        while to < len(text) and not text[to].isspace():
            to += 1
        words = _WORD.findall(text[at:to].lower())
        out.append(np.fromiter((vocabulary.get(w, 0) for w in words), np.int64, len(words)))
        at = to
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def seed_hashes(ids: np.ndarray, m: int) -> np.ndarray:
    """Karp-Rabin hash (modulo 2**64) of every run of m words."""
    n = len(ids) - m + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(m):
        out = out * _BASE + ids[i:i + n].astype(np.uint64)
    return out ^ (out >> np.uint64(31))


def _cut(free_doc, free_item, d, i, length: int, m: int):
    """What marks leave of matches of one length: parts of at least m words."""
    out = []
    step = max(1, CELLS // length)
    for k in range(0, len(d), step):  # bounds the table of words
        a, b = d[k:k + step], i[k:k + step]
        free = np.zeros((len(a), length + 2), bool)
        free[:, 1:-1] = free_doc[a[:, None] + np.arange(length)] & free_item[b[:, None] + np.arange(length)]
        row, at = np.nonzero(free[:, 1:] != free[:, :-1])
        row, first, n = row[::2], at[::2], at[1::2] - at[::2]
        keep = n >= m
        row, first, n = row[keep], first[keep], n[keep]
        out.append((a[row] + first, b[row] + first, n))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def tile(doc_words: int, item_words: int, matches, m: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in doc, place in item, words).  ``matches``: arrays
    of the maximal matches of at least m words, as such triples.  Of equally
    long ones the smaller (place in doc - place in item, place in doc) is first."""
    free_doc, free_item = np.ones(doc_words, bool), np.ones(item_words, bool)
    tiles: list[tuple[int, int, int]] = []
    d, i, n = matches
    while len(n):
        longest = int(n.max())
        top = n == longest
        a, b, d, i, n = d[top], i[top], d[~top], i[~top], n[~top]
        order = np.lexsort((a, a - b))
        broken = []
        for k in order:
            x, y = int(a[k]), int(b[k])
            if free_item[y:y + longest].all() and free_doc[x:x + longest].all():
                free_doc[x:x + longest] = free_item[y:y + longest] = False
                tiles.append((x, y, longest))
                edges = np.flatnonzero(np.diff(np.r_[False, free_item, False]))
                if not len(edges) or (edges[1::2] - edges[::2]).max() < m:
                    return tiles  # no room in the item
            else:
                broken.append(k)
        if broken:
            parts = _cut(free_doc, free_item, a[broken], b[broken], longest, m)
            d, i, n = (np.concatenate(x) for x in zip((d, i, n), parts, strict=True))
    return tiles


def _runs(item, d, i, n):
    """Matches that touch on one diagonal of an item, put together."""
    order = np.lexsort((d, d - i, item))
    item, d, i, n = item[order], d[order], i[order], n[order]
    new = np.r_[True, (item[1:] != item[:-1]) | (d[1:] - i[1:] != d[:-1] - i[:-1]) | (d[1:] != d[:-1] + n[:-1])]
    first = np.flatnonzero(new)
    return item[first], d[first], i[first], np.add.reduceat(n, first)


class Benchmark:
    """A block of items, ready to meet documents."""

    def __init__(self, items: list[tuple], min_match: int = MIN_MATCH, coverage: float = COVERAGE):
        self.coverage, self.vocabulary = coverage, {}
        self.items: list[tuple] = []
        lengths: dict[int, list] = defaultdict(list)
        texts: list[np.ndarray] = []
        for item_id, text in items:
            words = _WORD.findall((text or "").lower())
            if len(words) < MIN_ITEM:
                continue
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64)
            m = min(min_match, len(ids))
            h = seed_hashes(ids, m)
            lengths[m].append((h, np.full(len(h), len(self.items)), np.arange(len(h))))
            self.items.append((item_id, len(ids), m))
            texts.append(ids)
        self.words = np.concatenate([*texts, np.zeros(0, np.int64)])  # of all items, item k from base[k] on
        self.base = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
        self.seeds = {}  # seed words: (sorted hashes, their items, their places)
        for m, parts in lengths.items():
            h, item, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            self.seeds[m] = h[order], item[order], at[order]

    def _matches(self, ids: np.ndarray):
        """Maximal matches (item, place in doc, place in item, words), by item.
        Seeds are met SEED_PAIRS at a time and kept as runs on their diagonals,
        so words that repeat in text and item cost no memory of their product."""
        found = []
        known = np.r_[0, np.cumsum(ids != 0)]
        for m, (h, item, at) in self.seeds.items():
            if len(ids) < m:
                continue
            start = np.flatnonzero(known[m:] - known[:-m] == m)  # every word is an item's
            hashes = seed_hashes(ids, m)[start]
            lo, hi = np.searchsorted(h, hashes, "left"), np.searchsorted(h, hashes, "right")
            start, lo, hits = start[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            if not len(start):
                continue
            part = np.cumsum(hits) // SEED_PAIRS
            for idx in np.split(np.arange(len(start)), np.flatnonzero(np.diff(part)) + 1):
                n = hits[idx]
                d = np.repeat(start[idx], n)
                k = np.repeat(lo[idx], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                w = self.base[item[k]] + at[k]
                same = np.ones(len(k), bool)
                for j in range(m):  # equal hashes are confirmed word by word
                    same &= ids[d + j] == self.words[w + j]
                k, d = k[same], d[same]
                if len(k):
                    found.append((*_runs(item[k], d, at[k], np.ones(len(k), np.int64)), m))
        if not found:
            return []
        extra = np.concatenate([np.full(len(f[0]), f[4] - 1) for f in found])
        which, d, i, seeds = (np.concatenate([f[c] for f in found]) for c in range(4))
        shortest = np.zeros(len(self.items), np.int64)
        shortest[which] = extra  # an item's seeds all have the same words
        which, d, i, seeds = _runs(which, d, i, seeds)
        n = seeds + shortest[which]
        cuts = np.r_[0, np.flatnonzero(np.diff(which)) + 1, len(which)]
        return [(int(which[a]), d[a:b], i[a:b], n[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def find(self, text: str | None) -> list[tuple]:
        """(item_id, matched words, item words, tiles) of the items found."""
        ids, out = word_ids(text, self.vocabulary), []
        for k, d, i, n in self._matches(ids):
            item_id, words, m = self.items[k]
            # Words of the item that any match reaches bound what tiles can cover.
            reach = np.bincount(i, minlength=words + 1) - np.bincount(i + n, minlength=words + 1)
            if (np.cumsum(reach[:-1]) > 0).sum() < self.coverage * words:
                continue
            tiles = tile(len(ids), words, (d, i, n), m)
            matched = sum(t[2] for t in tiles)
            if matched >= self.coverage * words and tiles:
                out.append((item_id, matched, words, len(tiles)))
        return out


def blocks(benchmark: DataFrame, min_match: int, coverage: float):
    """The benchmark as broadcast blocks of about BLOCK_WORDS words."""
    prepare(benchmark, "item_id", "text")
    spark = benchmark.sparkSession
    b = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    words = b.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = max(1, -(-int(words) // BLOCK_WORDS))
    dealt = written(b.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), "benchmark") if n > 1 else b.withColumn("block", F.lit(0))
    for i in range(n):
        rows = [(r.item_id, r.text) for r in dealt.where(F.col("block") == i).collect()]
        yield spark.sparkContext.broadcast(Benchmark(rows, min_match, coverage))


def _finder(block):
    def run(batches):
        bench = block.value
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                out += [(doc.as_py(), item, matched, n, matched / n, tiles)
                        for item, matched, n, tiles in bench.find(text.as_py())]
            cols = list(zip(*out)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["doc_id", "item_id", "matched", "item_words", "coverage", "tiles"])
    return run


def _clean(block):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        bench = block.value
        return pd.Series([not bench.find(t) for t in texts], dtype=bool)
    return clean


def contaminations(documents: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
                   coverage: float = COVERAGE) -> DataFrame:
    """One row per document and benchmark item found in it (see FOUND)."""
    prepare(documents, "doc_id", "text")
    d = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for block in blocks(benchmark, min_match, coverage):
        part = d.mapInArrow(_finder(block), FOUND)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(documents: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
                  coverage: float = COVERAGE) -> DataFrame:
    """The documents in which no benchmark item is found, all columns kept."""
    for block in blocks(benchmark, min_match, coverage):
        documents = documents.where(_clean(block)(F.col("text")))
    return documents


@register("op5_string_tiling")
def op5_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with the words their tiles cover."""
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
