"""Scores of (user, item) pairs on factors, in cells of user and item parts.

A pair travels once, to the cell of its user's and its item's part; a user's
vector travels once per item part and an item's once per user part, never once
per pair.  A cell holds CELL_BYTES of vectors at most, whatever the tables, and
its pairs stream past them.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of vectors in a cell; pairs scored at a time.
CELL_BYTES = 192 << 20
AT_ONCE = 4096

_USER, _ITEM, _PAIR = 0, 1, 2
KINDS = 3


class _Side:
    """One side's vectors in a mapped file without a name, ids and biases in memory."""

    def __init__(self, rank: int):
        self.rank, self.rows, self.ids, self.vec = rank, [], None, None
        self.file = tempfile.TemporaryFile()

    def add(self, ids: pa.Array, bias: pa.Array, vec: pa.Array) -> None:
        self.rows.append((ids.to_numpy().copy(), bias.to_numpy().copy()))
        self.file.write(vec.flatten().to_numpy(zero_copy_only=False).astype(np.float32, copy=False).tobytes())
        self.ids = None

    def at(self, wanted: np.ndarray):
        """Known or not, bias (0 if unknown) and place of the vector."""
        if self.ids is None and self.rows:
            ids, self.bias = (np.concatenate(x) for x in zip(*self.rows, strict=True))
            self.order = np.argsort(ids)
            self.ids = ids[self.order]
            self.file.flush()
            self.vec = np.memmap(self.file, np.float32, "r", shape=(len(ids), self.rank))
        if self.ids is None:
            return np.zeros(len(wanted), bool), np.zeros(len(wanted)), np.zeros(len(wanted), np.int64)
        place = np.minimum(np.searchsorted(self.ids, wanted), len(self.ids) - 1)
        known, place = self.ids[place] == wanted, self.order[place]
        return known, np.where(known, self.bias[place], 0.0), place


def _score(rank: int):
    """A cell's vectors, then its pairs, to pairs with both biases and the product."""
    def run(batches):
        cell, sides = None, None
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            cells, kinds = key // KINDS, key % KINDS
            edges = [0, *(np.flatnonzero(np.diff(key) != 0) + 1), len(key)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                if cells[lo] != cell:
                    cell, sides = cells[lo], (_Side(rank), _Side(rank))
                if kinds[lo] != _PAIR:
                    sides[kinds[lo]].add(*(batch.column(c).slice(lo, hi - lo) for c in (1 + int(kinds[lo]), 3, 4)))
                    continue
                for a in range(lo, hi, AT_ONCE):
                    part = batch.slice(a, min(AT_ONCE, hi - a))
                    (ku, bu, pu), (ki, bi, pi) = (side.at(part.column(c).to_numpy(zero_copy_only=False)) for side, c in zip(sides, (1, 2), strict=True))
                    both, dot = ku & ki, np.zeros(len(ku), np.float32)
                    if both.any():
                        x, y = (side.vec[place[both]].astype(np.float64) for side, place in zip(sides, (pu, pi), strict=True))
                        dot[both] = np.einsum("ij,ij->i", x, y)
                    dot[np.isnan(dot)] = 0
                    yield pa.RecordBatch.from_arrays([part.column(5), *(pa.array(v) for v in (bu, bi, dot))], names=["pair", "b_u", "b_i", "factor"])
    return run


def cells(n_users: int, n_items: int, rank: int, cores: int) -> tuple[int, int]:
    """Parts of the users and of the items: the fewest copies of vectors for cells of CELL_BYTES, a cell for each core."""
    most = max(1, CELL_BYTES // (rank * 4))
    if n_users + n_items <= most:
        return max(1, cores), 1
    a, b = max(1, -(-2 * n_users // most)), max(1, -(-2 * n_items // most))
    return max(a, -(-cores // b)), b


def score(pairs: DataFrame, users: DataFrame, items: DataFrame, rank: int) -> DataFrame:
    """``pairs`` (user_id, item_id, ...) with ``b_u``, ``b_i`` and ``factor``, 0
    where a user or item is unknown; sides are (id, bias, vec), an id once."""
    a, b = cells(users.count(), items.count(), rank, pairs.sparkSession.sparkContext.defaultParallelism)
    # A null id is unknown: no side has the least long.
    u, i = (F.coalesce(F.col(c).cast("long"), F.lit(-(1 << 63))) for c in ("user_id", "item_id"))
    pair = F.struct(*[F.col(c) for c in pairs.columns]).alias("pair")
    one = pairs.select(u.alias("u"), i.alias("i"), pair)
    kind = one.schema["pair"].dataType

    def part(name, parts):
        return F.pmod(F.xxhash64(name), F.lit(parts)).cast("int")

    def none(t):
        return F.lit(None).cast(t)

    def side(df, parts, others, number):
        ids = df.where("id is not null").select(F.col("id").cast("long").alias("id"), F.col("bias").cast("double").alias("bias"), "vec")
        ids = ids.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        cell = part("id", parts) * b + F.col("copy") if number == _USER else F.col("copy") * b + part("id", parts)
        keys = [F.col("id"), none("long")] if number == _USER else [none("long"), F.col("id")]
        return ids.select((cell * KINDS + number).alias("key"), keys[0].alias("u"), keys[1].alias("i"), "bias", "vec", none(kind).alias("pair"))

    # One int orders cells and kinds: sorted by its bytes, without looking at rows.
    met = one.select(((part("u", a) * b + part("i", b)) * KINDS + _PAIR).alias("key"), "u", "i", none("double").alias("bias"),
                     none("array<float>").alias("vec"), "pair")
    met = side(users, a, b, _USER).unionByName(side(items, b, a, _ITEM)).unionByName(met)
    schema = T.StructType([T.StructField("pair", kind), *[T.StructField(c, t) for c, t in (("b_u", T.DoubleType()), ("b_i", T.DoubleType()), ("factor", T.FloatType()))]])
    found = met.repartitionById(a * b, F.expr(f"cast(key div {KINDS} as int)")).sortWithinPartitions("key").mapInArrow(_score(rank), schema)
    return found.select("pair.*", "b_u", "b_i", "factor")
