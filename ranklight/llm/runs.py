"""Periodic runs of words by suffix-tree longest common extensions.

A run is a stretch of words with smallest period q (words q apart are equal)
that no neighbouring word extends.  Every run with two periods or more has a
Lyndon root: for one of the two orders (of words by number, and reversed) the
longest Lyndon word that begins at some position of it is as long as q.  So
each position gives one candidate per order, and extending it to both sides by
longest common extensions gives the run:

* Ukkonen's suffix tree of the words, and of the words reversed;
* its Euler tour between leaves (the depth of the common ancestor of
  neighbouring leaves) with a sparse table of minima: the depth of the lowest
  common ancestor of two leaves, which is their suffixes' longest common
  extension, takes two look-ups;
* leaves in order give the suffixes' ranks, with symbols reversed those of the
  other order; the next smaller rank ends the longest Lyndon word.

Trees are built where a run can be.  A run of ``min_length`` words or more and
``min_exponent`` periods or more holds, q apart, two equal stretches of
``seed`` words (16 for 24 words and 3 periods), and such stretches cover all of
it.  So texts are cut, exactly, to the stretches covered by repeated seeds
(their hashes may only add to them), and most texts need no tree.

Distribution: texts are read where they lie, one at a time; nothing is
shuffled.  Memory follows the longest covered stretch, about 0.5 kB a word.

Defined cases: a null or empty text, or one of white space, has no words, no
runs and an empty collapsed text; ties of exponent go to the smallest start,
then period; rows repeat with their results; null ids are kept; an empty table
gives an empty result; very long texts are read whole; further columns are
ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.llm.common import prepare, table
from ranklight.llm.registry import register

MIN_LENGTH = 24
MIN_EXPONENT = 3

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_TOUR = 1 << 40


class SuffixTree:
    """Ukkonen's tree of ``symbols`` (1 and up, below ``width``), an end mark 0 added.

    Inner nodes are numbered from 0 (the root); leaf k stands as ~k and is the
    suffix that begins at k."""

    def __init__(self, symbols: list[int], width: int):
        s = [*symbols, 0]
        n = self.n = len(s)
        edges: dict[int, int] = {}
        begin, end, link, depth, leaf = [0], [0], [0], [0], []
        get = edges.get
        node = at = length = pending = 0
        for i, c in enumerate(s):
            pending += 1
            last = 0
            while pending:
                if not length:
                    at = i
                key = node * width + s[at]
                to = get(key)
                if to is None:
                    edges[key] = ~len(leaf)
                    leaf.append(i)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    first = begin[to] if to >= 0 else leaf[~to]
                    if to >= 0 and length >= (span := end[to] - first):
                        at += span
                        length -= span
                        node = to
                        continue
                    if s[first + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    split = len(begin)
                    begin.append(first)
                    end.append(first + length)
                    link.append(0)
                    depth.append(pending - 1)  # the suffix read so far, without c
                    edges[key] = split
                    edges[split * width + c] = ~len(leaf)
                    leaf.append(i)
                    edges[split * width + s[first + length]] = to
                    if to >= 0:
                        begin[to] = first + length
                    else:
                        leaf[~to] = first + length
                    if last:
                        link[last] = split
                    last = split
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = i - pending + 1
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.kids = np.fromiter(edges.values(), np.int64, len(edges))
        self.parent, self.symbol = np.divmod(keys, width)
        self.depth = depth

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order, and between every two neighbours the depth of
        their common ancestor.  ``reverse`` turns the symbols' order around;
        the end mark stays first."""
        symbol = np.where(self.symbol > 0, -self.symbol, np.iinfo(np.int64).min) if reverse else self.symbol
        order = np.lexsort((symbol, self.parent))
        kids = self.kids[order].tolist()
        at = np.searchsorted(self.parent[order], np.arange(len(self.depth) + 1)).tolist()
        depth, leaves, between, stack = self.depth, [], [], [0]
        pop, push = stack.pop, stack.append
        while stack:
            v = pop()
            if v < 0:
                leaves.append(~v)
            elif v >= _TOUR:
                between.append(v - _TOUR)
            else:
                mark = depth[v] + _TOUR
                a = at[v]
                for k in range(at[v + 1] - 1, a, -1):
                    push(kids[k])
                    push(mark)
                push(kids[a])
        return np.array(leaves, np.int64), np.array(between, np.int32)


class Extensions:
    """Longest common extensions of pairs of suffixes."""

    def __init__(self, leaves: np.ndarray, between: np.ndarray):
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        self.minima = [between]
        step = 1
        while 2 * step <= len(between):
            low = self.minima[-1]
            self.minima.append(np.minimum(low[:-step], low[step:]))
            step *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """``i`` and ``j`` differ in every place."""
        a, b = self.rank[i], self.rank[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level):
            at = level == k
            m = self.minima[k]
            out[at] = np.minimum(m[lo[at]], m[hi[at] - (1 << int(k))])
        return out


def _next_smaller(rank: list[int], n: int) -> np.ndarray:
    """For each of the first n places the next one of smaller rank."""
    out, stack = [0] * n, [n]
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while rank[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return np.array(out, np.int64)


def all_runs(symbols: np.ndarray) -> np.ndarray:
    """Every run of two periods or more: rows (start, length, period), sorted."""
    n = len(symbols)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    values, numbers = np.unique(symbols, return_inverse=True)
    s, width = (numbers.ravel() + 1).tolist(), len(values) + 1
    tree = SuffixTree(s, width)
    leaves, between = tree.tour()
    forward = Extensions(leaves, between)
    other = np.empty(n + 1, np.int64)
    other[tree.tour(reverse=True)[0]] = np.arange(n + 1)
    del tree
    begin = np.arange(n)
    # From each position to the end of its longest Lyndon word, in either order.
    i = np.concatenate([begin, begin])
    j = np.concatenate([_next_smaller(forward.rank.tolist(), n), _next_smaller(other.tolist(), n)])
    right = forward(i, j)
    del forward
    backward = Extensions(*SuffixTree(s[::-1], width).tour())
    left = backward(n - i, n - j)
    start, length, period = i - left, left + (j - i) + right, j - i
    found = length >= 2 * period
    return np.unique(np.stack([start[found], length[found], period[found]], axis=1), axis=0)


def seed_length(min_length: int, min_exponent: int) -> int:
    """Words that a run, at least, has in common with itself a period on."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))


def _stretches(ids: np.ndarray, seed: int) -> list[tuple[int, int]]:
    """The maximal stretches covered by seeds that occur twice or more."""
    n = len(ids) - seed + 1
    if n < 2:
        return []
    h, size, at = ids.astype(np.uint64), 1, 0
    whole = np.zeros(n, np.uint64)
    rest = seed
    while rest:  # by powers of two
        if rest & 1:
            whole = (whole + h[at:at + n]) * _M1
            whole ^= whole >> np.uint64(29)
            at += size
        rest >>= 1
        if rest:
            h = h[:-size] * _M1 + (h[size:] ^ np.uint64(size)) * _M2
            h ^= h >> np.uint64(31)
            size *= 2
    order = np.argsort(whole, kind="stable")
    same = whole[order[1:]] == whole[order[:-1]]
    if not same.any():
        return []
    cover = np.zeros(len(ids) + 1, np.int64)
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    places = np.flatnonzero(twice)
    cover[places] += 1
    cover[places + seed] -= 1
    inside = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def find_runs(words: list, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of ``min_length`` words or more and
    ``min_exponent`` (2 or more) periods or more, by start, then period."""
    if len(words) < min_length:
        return []
    known: dict = {}
    ids = np.fromiter([known.setdefault(w, len(known)) for w in words], np.int64, len(words))
    out = []
    for a, b in _stretches(ids + 1, seed_length(min_length, min_exponent)):
        runs = all_runs(ids[a:b])
        for start, length, period in runs.tolist():
            if length >= max(min_length, min_exponent * period):
                out.append((start + a, length, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exponent; exact."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def _collapsed(words: list[bytes], runs) -> bytes:
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g])


def text_words(doc_id: int | None, text: bytes | None) -> list[bytes]:
    """Runs without ASCII white space."""
    return (text or b"").split()


def planted_words(doc_id: int | None, text: bytes | None) -> list[bytes]:
    """The words of a document; in about one of ten, chosen by doc_id, the rest
    of the text from some word on repeats with a period."""
    words = text_words(doc_id, text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


_RUN = "struct<start: bigint, length: bigint, period: bigint>"
_ARROW_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _periodic(words_of, min_length: int, min_exponent: int):
    row = lambda r: {"start": r[0], "length": r[1], "period": r[2]}

    def run(batches):
        for batch in batches:
            ids, runs, best, text = batch.column(0).to_pylist(), [], [], []
            for doc_id, data in zip(ids, batch.column(1).cast(pa.binary()), strict=True):
                words = words_of(doc_id, data.as_py())
                found = find_runs(words, min_length, min_exponent)
                top = best_run(found)
                runs.append([row(r) for r in found])
                best.append(top and row(top))
                text.append(_collapsed(words, found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(runs, pa.list_(_ARROW_RUN)), pa.array(best, _ARROW_RUN),
                 pa.array(text, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "best", "collapsed"])
    return run


def periodic_runs(documents: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
                  words_of=text_words) -> DataFrame:
    """One row per document: doc_id, runs (start, length, period; word numbers
    from 0), best (the run of the greatest exponent), collapsed (the words left
    when every run keeps its first period, joined by one space).

    ``words_of`` takes (doc_id, text as UTF-8) and returns the words."""
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")
    prepare(documents, "doc_id", "text")
    d = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return d.mapInArrow(_periodic(words_of, min_length, min_exponent),
                        f"doc_id long, runs array<{_RUN}>, best {_RUN}, collapsed string")


@register("op13_suffix_tree_runs")
def op13_suffix_tree_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, some made periodic by its id."""
    found = periodic_runs(table(spark, sf_dir, "documents"), words_of=planted_words)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
