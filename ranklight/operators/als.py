"""Alternating least squares in a few large blocks (M3).

The model is Spark ML's: its start (``ALS`` with no iteration), its normal
equations, lambda = reg * ratings of the row, factors kept as floats and sums
in doubles.  What differs is how a step is run:

* Factors travel once to each block of the other side, so a step shuffles
  (BLOCKS - 1) times the factors, whatever the number of cores.
* A row with n ratings and n <= rank is solved in its n ratings: with Y the
  n x rank factors met, (Y'Y + l I)^-1 Y'r = Y'(YY' + l I)^-1 r.  That is the
  same solution for n x n instead of rank x rank equations.  Rows with equally
  many ratings are solved together.

A row with more ratings than fit is summed in parts.  A task holds the factors
of one side (rank floats a row; from MAPPED bytes on in a mapped file without a
name) and meets its ratings in pieces of PIECE.  What a step has shuffled is
deleted as soon as its result is kept, so disk holds one step and not all; every
CUT iterations the users' factors are checkpointed, so that a lost executor
costs the steps since then.
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.session import stage_path

#: Least number of blocks, and bytes of factors that one more block is for.
BLOCKS = 3
BLOCK_BYTES = 1 << 30
#: Numbers gathered at a time by one thread; rows of factors in one record.
CELLS = 1 << 18
CHUNK = 8192
#: Ratings that are sorted and solved together; bytes of factors from which a file holds them.
PIECE = 1 << 22
MAPPED = 1 << 28
#: Iterations from one checkpoint to the next.
CUT = 10
#: Batches solved side by side in a task: few blocks leave cores idle.
THREADS = 4

_LINKS = "b int, dst binary, src binary, r binary"
_FACTORS = "b int, ids binary, features binary"


def _pack_links(n_blocks: int):
    """(dst, src, r) rows to one record per batch and block."""
    def run(batches):
        for batch in batches:
            dst, src, r = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for b in range(n_blocks):
                own = dst % n_blocks == b
                if own.any():
                    yield _record(b, dst[own].astype(np.int32), src[own].astype(np.int32), r[own].astype(np.float32), names=["b", "dst", "src", "r"])
    return run


def _pack_factors(n_blocks: int):
    """(id, features) rows to one record per batch and block."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int32)
                m = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(ids), -1)
                for b in range(n_blocks):
                    own = ids % n_blocks == b
                    if own.any():
                        yield _record(b, ids[own], m[own], names=["b", "ids", "features"])
    return run


def _record(b: int, *arrays, names):
    return pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in arrays]], names=names)


def _unpack_factors(rank: int):
    def run(batches):
        for batch in batches:
            for ids, features in zip(batch.column(0), batch.column(1), strict=True):
                n = np.frombuffer(ids.as_py(), np.int32)
                flat = np.frombuffer(features.as_py(), np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(n), pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * rank), pa.array(flat))],
                    names=["id", "features"])
    return run


class Links:
    """The ratings of one block: rows in order of how many they have."""

    def __init__(self, dst: np.ndarray, src: np.ndarray, r: np.ndarray):
        ids, row, count = np.unique(dst, return_inverse=True, return_counts=True)
        by_count = np.argsort(count, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[by_count] = np.arange(len(ids))
        # Within a row in order of the other side, so that sums do not depend on how rows arrived.
        order = np.lexsort((r, src, place[row]))
        self.ids, self.count = ids[by_count], count[by_count]
        self.src, self.r = src[order], r[order]
        self.ptr = np.concatenate([[0], np.cumsum(self.count)])

    def batches(self, rank: int):
        """(first row, end, ratings of each) of rows that are solved together."""
        edges = np.concatenate([np.flatnonzero(np.diff(self.count, prepend=-1)), [len(self.ids)]])
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            n = int(self.count[lo])
            step = max(1, CELLS // (n * rank))
            for a in range(lo, hi, step):
                yield a, min(a + step, hi), n


def solve(links: Links, y: np.ndarray, reg: float) -> np.ndarray:
    """Factors of the rows of ``links`` against ``y`` (one row an id)."""
    rank = y.shape[1]
    out = np.empty((len(links.ids), rank), np.float32)

    def batch(job):
        a, z, n = job
        span = slice(links.ptr[a], links.ptr[z])
        src, r = links.src[span].reshape(z - a, n), links.r[span].astype(np.float64).reshape(z - a, n, 1)
        if n <= rank and reg > 0:
            g = y[src].astype(np.float64)
            k = g @ g.transpose(0, 2, 1)
            k[:, np.arange(n), np.arange(n)] += reg * n
            out[a:z] = (g.transpose(0, 2, 1) @ np.linalg.solve(k, r))[:, :, 0]
            return
        k, t = np.zeros((z - a, rank, rank)), np.zeros((z - a, rank, 1))
        part = max(1, CELLS // rank)
        for c in range(0, n, part):
            g = y[src[:, c:c + part]].astype(np.float64)
            k += g.transpose(0, 2, 1) @ g
            t += g.transpose(0, 2, 1) @ r[:, c:c + part]
        k[:, np.arange(rank), np.arange(rank)] += reg * n
        out[a:z] = np.linalg.solve(k, t)[:, :, 0]

    with ThreadPoolExecutor(THREADS) as pool:
        for _ in pool.map(batch, links.batches(rank)):
            pass
    return out


def _build_links(records):
    parts, b = [], None
    for b, (dst, src, r) in records:
        parts.append((np.frombuffer(dst, np.int32), np.frombuffer(src, np.int32), np.frombuffer(r, np.float32)))
    if not parts:
        return
    # A row's ratings lie in one piece.
    n = -(-sum(len(p[0]) for p in parts) // PIECE)
    for k in range(n):
        own = [_mix(dst) % n == k for dst, _, _ in parts]
        piece = [np.concatenate([p[c][at] for p, at in zip(parts, own, strict=True)]) for c in range(3)]
        if len(piece[0]):
            yield b, Links(*piece)


def _mix(ids: np.ndarray) -> np.ndarray:
    """A hash of ids that does not follow the blocks, which are ids modulo their number."""
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)


def _space(n_rows: int, rank: int) -> np.ndarray:
    if n_rows * rank * 4 <= MAPPED:
        return np.zeros((n_rows, rank), np.float32)
    with tempfile.TemporaryFile() as f:  # the mapping outlives the file
        f.truncate(n_rows * rank * 4)
        return np.memmap(f, np.float32, "r+", shape=(n_rows, rank))


def _step(n_rows: int, rank: int, reg: float):
    """The other side's factors, then a block's ratings, to the block's factors."""
    def run(records):
        y = _space(n_rows, rank)
        for b, value in records:
            if isinstance(value, Links):
                out = solve(value, y, reg)
                for a in range(0, len(out), CHUNK):
                    yield b, (value.ids[a:a + CHUNK], out[a:a + CHUNK])
            else:
                y[value[0]] = value[1]
    return run


def _to_others(n_blocks: int):
    def run(record):
        own, value = record
        return [(b, value) for b in range(n_blocks) if b != own]
    return run


def _drop_shuffle(dealt) -> None:
    """Delete the files behind ``dealt``, which a partitionBy returned.  If a
    block that was made from them is lost, Spark makes them again."""
    cleaner, rdd = dealt.ctx._jsc.sc().cleaner(), dealt._jrdd.rdd()
    while cleaner.isDefined() and not rdd.dependencies().isEmpty():
        link = rdd.dependencies().head()
        if link.getClass().getSimpleName() == "ShuffleDependency":
            return cleaner.get().doCleanupShuffle(link.shuffleId(), True)
        rdd = link.rdd()


def _delete(sc, path: str) -> None:
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def _drop_checkpoint(rdd) -> None:
    if rdd is not None and (path := rdd.getCheckpointFile()):
        _delete(rdd.ctx, path)


def fit(ratings: DataFrame, user: str, item: str, target: str, rank: int, max_iter: int, reg: float, seed: int):
    """An ``ALSModel`` of (user, item, target); ids are small dense ints."""
    from pyspark.ml.recommendation import ALS, ALSModel
    spark = ratings.sparkSession
    path = stage_path(spark, f"als-{uuid.uuid4().hex[:12]}")
    ratings.select(user, item, F.col(target).cast("float").alias(target)).write.parquet(f"{path}/ratings")  # read by the start and for both sides
    rows = spark.read.parquet(f"{path}/ratings")
    als = ALS(userCol=user, itemCol=item, ratingCol=target, rank=rank, maxIter=0, regParam=reg, seed=seed, coldStartStrategy="nan")
    if max_iter == 0:
        return als.fit(rows)
    # A start depends on the ids of its own side alone, and the items' is not used: the users are enough.
    start = als.fit(rows.select(user).distinct().select(user, F.col(user).alias(item), F.lit(0.0).cast("float").alias(target)))
    top = rows.agg(F.max(user).alias("u"), F.max(item).alias("i")).first()
    n_users, n_items = top.u + 1, top.i + 1
    n = max(BLOCKS, -(-max(n_users, n_items) * rank * 4 // BLOCK_BYTES))

    def links(dst, src):
        packed = rows.select(dst, src, target).mapInArrow(_pack_links(n), _LINKS)
        dealt = packed.rdd.map(lambda x: (x.b, (bytes(x.dst), bytes(x.src), bytes(x.r)))).partitionBy(n)
        kept = dealt.mapPartitions(_build_links, True).persist(StorageLevel.MEMORY_AND_DISK)
        kept.count()
        _drop_shuffle(dealt)
        return kept

    def step(mine, factors, n_rows, cut=False):
        dealt = factors.flatMap(_to_others(n)).partitionBy(n)
        new = factors.union(dealt).union(mine).mapPartitions(_step(n_rows, rank, reg), True).persist(StorageLevel.MEMORY_AND_DISK)
        if cut:
            new.checkpoint()
        new.count()
        _drop_shuffle(dealt)
        return new

    by_user, by_item = links(user, item), links(item, user)
    first = users = (start.userFactors.select("id", "features").mapInArrow(_pack_factors(n), _FACTORS).rdd
                     .map(lambda x: (x.b, (np.frombuffer(bytes(x.ids), np.int32), np.frombuffer(bytes(x.features), np.float32).reshape(-1, rank)))).partitionBy(n))
    items, last_cut = None, None
    for k in range(max_iter):
        old = items
        items = step(by_item, users, n_users)
        if k == 0:
            _drop_shuffle(first)
        users.unpersist()
        if old is not None:
            old.unpersist()
        cut = k % CUT == CUT - 1 and k < max_iter - 1
        users = step(by_user, items, n_items, cut)
        if cut:
            _drop_checkpoint(last_cut)
            last_cut = users
    start.write().overwrite().save(f"{path}/model")
    for name, factors in (("userFactors", users), ("itemFactors", items)):
        plain = factors.map(lambda x: (x[1][0].astype(np.int32).tobytes(), np.ascontiguousarray(x[1][1]).tobytes()))
        spark.createDataFrame(plain, "ids binary, features binary").mapInArrow(_unpack_factors(rank), "id int, features array<float>") \
            .write.mode("overwrite").parquet(f"{path}/model/{name}")
    for kept in (users, items, by_user, by_item):
        kept.unpersist()
    _drop_checkpoint(last_cut)
    _delete(spark.sparkContext, f"{path}/ratings")
    return ALSModel.load(f"{path}/model")
