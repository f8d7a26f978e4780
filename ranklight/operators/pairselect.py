"""Exact order statistics over all pairs of rows without listing the pairs.

The similarities of all pairs i < j are never written.  Equal rows are one
class with a count; classes are packed into blocks, and every pair of blocks is
one product in a task; groups of blocks travel.  A pass over the products counts the values in BINS
equal intervals; the interval that holds the wanted rank is split by the next
pass, until it holds few enough values (or can be split no further), and the
last pass returns those values with their counts.  Each pass returns one small
array a task, and no value is rounded.

A product is exact up to the order of its sums, so equal similarities may
differ in their last bits; the result is that of a full sort of such values.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.functions.index import global_row_number
from ranklight.operators.blocktopk import Sparse, sparse_rows

BLOCK = 1024
#: Groups that blocks are dealt to, up to MOST blocks in a group (bounds a task's memory).
GROUPS, MOST = 32, 16
BINS = 1 << 16
#: Pairs in an interval whose values the last pass returns, each once a product.
FEW = 100_000
_COUNTS = "at long, n long"


def _pack(rows: DataFrame, path: str) -> DataFrame:
    """One packed row per block: b, m (members of each class), terms, w."""
    spark = rows.sparkSession
    rounded = F.transform("w", lambda x: F.round(x, 12))
    c = (rows.groupBy(F.xxhash64("terms", rounded).alias("h1"), F.xxhash64(F.lit(1), "terms", rounded).alias("h2"))
         .agg(F.count(F.lit(1)).alias("m"), F.first("terms").alias("terms"), F.first("w").alias("w")))
    c = c.select("h1", "h2", "m", F.transform("terms", lambda t: F.xxhash64(t)).alias("codes"), "w")  # a term travels as its hash
    numbered = global_row_number(c, ["h1", "h2"], "pos", start=0)
    (numbered.groupBy(F.floor(F.col("pos") / BLOCK).alias("b")).agg(F.collect_list(F.struct("m", "codes", "w")).alias("r"))
     .select("b", F.col("r.m").alias("m"), F.col("r.codes").alias("terms"), F.col("r.w").alias("w")).write.parquet(path))
    return spark.read.parquet(path)


def _values(a, x, b, y):
    """Similarities of block x of ``a`` with block y of ``b``, and the pairs that each stands for."""
    v = lambda blocks, n, i: blocks.field(n)[i].values
    m, k = (v(*s).to_numpy(zero_copy_only=False) for s in ((a, "m", x), (b, "m", y)))
    s = Sparse().scores(v(a, "terms", x), v(a, "w", x), v(b, "terms", y), v(b, "w", y))
    pairs = np.multiply.outer(m, k)
    if a.field("b")[x].as_py() == b.field("b")[y].as_py():
        upper = np.triu_indices(len(m), 1)
        own = m * (m - 1) // 2
        return np.concatenate([s[upper], s.diagonal()]), np.concatenate([pairs[upper], own])
    return s.ravel(), pairs.ravel()


def _products(batches):
    for batch in batches:
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            a, b = col["blocks"][i].values, col["blocks2"][i].values
            own = col["g"][i].as_py() == col["g2"][i].as_py()
            for x in range(len(a)):
                for y in range(x if own else 0, len(b)):
                    s, n = _values(a, x, b, y)
                    yield s[n > 0], n[n > 0]


def _sums(at: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Sums of n by place; in two halves, each exact in a double."""
    half = 26
    high, low = (np.bincount(at, weights=x, minlength=size).astype(np.int64) for x in (n >> half, n & ((1 << half) - 1)))
    return (high << half) + low


def _binned(low: float, high: float):
    """Counts below ``low`` (-1), in each interval of [low, high), and from ``high`` up (BINS)."""
    def run(batches):
        total = np.zeros(BINS + 2, np.int64)
        for s, n in _products(batches):
            at = np.clip(np.floor((s - low) * (BINS / (high - low))), -1, BINS).astype(np.int64)
            total += _sums(at + 1, n, BINS + 2)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at - 1, pa.int64()), pa.array(total[at], pa.int64())], names=["at", "n"])
    return run


def _listed(low: float, high: float, first: int, last: int):
    """Values in the intervals ``first`` to ``last`` of [low, high), each with its pairs."""
    def run(batches):
        for s, n in _products(batches):
            at = np.clip(np.floor((s - low) * (BINS / (high - low))), -1, BINS)
            keep = (at >= first) & (at <= last)
            value, one, place = np.unique(s[keep], return_index=True, return_inverse=True)
            count = _sums(place.ravel(), n[keep], len(value))
            yield pa.RecordBatch.from_arrays([pa.array(at[keep][one].astype(np.int64)), pa.array(value, pa.float64()),
                                              pa.array(count, pa.int64())], names=["at", "value", "n"])
    return run


def _products_of(blocks: DataFrame) -> DataFrame:
    """(g, blocks, g2, blocks2): groups of blocks, each with those from itself on.

    A block travels once per group that it meets: GROUPS times at most while a
    group holds up to MOST of them (524,288 classes in all), so what travels
    grows with the blocks; beyond, with their square / MOST."""
    n = blocks.agg(F.max("b")).first()[0]
    size = min(MOST, max(1, math.ceil(((n or 0) + 1) / GROUPS)))
    # The order of blocks within a group is stated: own products take each pair once.
    groups = blocks.groupBy(F.floor(F.col("b") / size).alias("g")).agg(
        F.array_sort(F.collect_list(F.struct("b", "m", "terms", "w"))).alias("blocks"))
    last = F.lit((n or 0) // size).cast("long")
    # Dealt by both numbers, or the last group would meet all others in one task.
    left = groups.withColumn("g2", F.explode(F.sequence("g", last)))
    right = groups.select(F.col("g").alias("g2"), F.col("blocks").alias("blocks2")).withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), "g2")))
    return left.join(right, ["g", "g2"]).select("g", "blocks", "g2", "blocks2")


def pair_percentile(weights: DataFrame, p: float, path: str) -> tuple[float | None, int]:
    """(the p-th percentile, linearly interpolated, of the similarities of all
    pairs i < j of unit rows; the number of pairs).  None without a pair."""
    blocks = _pack(sparse_rows(weights), path)
    products = _products_of(blocks)
    low, high, before = -1.0 - 1e-6, 1.0 + 1e-6, 0
    total = want = None
    while True:
        counts = sorted(products.mapInArrow(_binned(low, high), _COUNTS).groupBy("at").agg(F.sum("n").alias("n")).collect())
        if total is None:
            total = sum(r.n for r in counts)
            if not total:
                return None, 0
            rank = (total - 1) * (p / 100.0)
            want = (math.floor(rank), math.ceil(rank))
        ends, run = {}, 0
        for r in counts:
            ends[r["at"]] = (run, run + r.n)
            run += r.n
        first, final = (next(at for at, (a, b) in ends.items() if a <= r < b) for r in want)
        before, inside = ends[first][0], ends[final][1] - ends[first][0]
        step = (high - low) / BINS
        if inside <= FEW or first != final or step < 1e-14:
            break
        low, high = low + first * step, low + (first + 1) * step
    listed = products.mapInArrow(_listed(low, high, first, final), "at long, value double, n long")
    if first != final:  # the last value of one interval and the first of another
        at = listed.agg(F.max(F.when(F.col("at") == first, F.col("value"))), F.min(F.when(F.col("at") == final, F.col("value")))).first()
    else:
        found = sorted(listed.groupBy("value").agg(F.sum("n").alias("n")).collect())
        ends, run = [], before
        for r in found:
            run += r.n
            ends.append(run)
        at = [found[next(i for i, e in enumerate(ends) if e > r)].value for r in want]
    return at[0] + (at[1] - at[0]) * (rank - want[0]), total
