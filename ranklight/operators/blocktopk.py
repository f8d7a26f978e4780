"""Exact top-k neighbours by blocks of like rows and upper bounds.

Rows are vectors, sparse (terms and weights) or dense.  For every query row
the k best candidates are found without scoring all pairs:

1. Equal vectors are one class; of its members only the k + 1 lowest ids can
   appear in a list.  A vector that a third of all items share is scored once.
2. Classes are dealt by range of a key that puts like rows side by side (the
   leading terms, or the nearest pivot) and cut into blocks of BLOCK rows.  A
   block is one packed row.  The product of a block with itself gives every
   query a first k-th best score, a lower limit for what is still wanted.
3. A block's summary bounds what any of its rows can score: the greatest
   weight per term, or centre and radius.  Queries meet summaries, CHUNK of
   them at a time, and keep the blocks whose bound reaches their limit.
4. Only those queries travel, once to each group of blocks, and are scored in
   the blocks that they still need; k results a query leave a group.

Scores order by their value rounded to 1e-9, then by id, so limits and bounds
give way by more than that.  Nothing is approximate: where bounds do not prune
(vectors without likeness) every query meets every block.

Rows travel once per summary chunk and once per group of blocks that may hold
one of their neighbours, whatever the number of blocks in it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.functions.topk import top_k_per_group

BLOCK = 128
#: A block also ends at so many entries; bounds the memory of a product.
BLOCK_ENTRIES = 1 << 16
#: Summaries that a row of queries meets at a time.
CHUNK = 256
#: Scores closer than this may be equal.
SLACK = 2e-9

_BLOCKS = ("block long, rep array<long>, cand array<boolean>, query array<boolean>, tau array<double>, "
           "h1 array<long>, h2 array<long>, members array<array<long>>, terms array<array<string>>, w array<array<double>>, "
           "s_terms array<string>, s_max array<double>, f_query array<long>, f_other array<long>, f_sim array<double>")


class Sparse:
    """Inner products of sparse rows (cosine of unit rows), above 0."""

    least = 5e-10  # what rounds to 0 is no neighbour
    group = 16  # blocks that queries meet together

    def _codes(self, known: pa.Array, terms: pa.ListArray, w: pa.ListArray) -> np.ndarray:
        """Rows as a matrix over the known terms; others are left out."""
        out = np.zeros((len(terms), len(known)))
        code = pc.index_in(terms.flatten(), value_set=known)
        row = np.repeat(np.arange(len(terms)), pc.list_value_length(terms).to_numpy(zero_copy_only=False))
        ok = pc.is_valid(code).to_numpy(zero_copy_only=False)
        at = code.fill_null(0).to_numpy(zero_copy_only=False)[ok]
        out[row[ok], at] = w.flatten().to_numpy(zero_copy_only=False)[ok]
        return out

    def summary(self, terms, w):
        flat = terms.flatten().dictionary_encode()
        top = np.zeros(len(flat.dictionary))
        np.maximum.at(top, flat.indices.to_numpy(zero_copy_only=False), np.abs(w.flatten().to_numpy(zero_copy_only=False)))
        return flat.dictionary, top

    def bounds(self, terms, w, summaries):
        known = terms.flatten().unique()
        q = np.abs(self._codes(known, terms, w))
        out = np.empty((len(terms), len(summaries)))
        for i in range(0, len(summaries), 64):  # 64 at a time bound the matrix
            part = summaries[i:i + 64]
            s_terms = pa.array([s[0] for s in part], pa.list_(pa.string()))
            s_max = pa.array([s[1] for s in part], pa.list_(pa.float64()))
            out[:, i:i + 64] = q @ self._codes(known, s_terms, s_max).T
        return out

    def scores(self, q_terms, q_w, terms, w):
        known = terms.flatten().unique()
        return self._codes(known, q_terms, q_w) @ self._codes(known, terms, w).T


class Dense:
    """``euclidean``: 1 / (1 + distance); ``cosine_eps``: cosine with 1e-10
    added to the product of the lengths.  Bounds by the triangle inequality."""

    least = -np.inf
    group = 64

    def __init__(self, metric: str):
        self.metric = metric

    @staticmethod
    def _matrix(w: pa.ListArray) -> np.ndarray:
        return w.flatten().to_numpy(zero_copy_only=False).reshape(len(w), -1)

    def _points(self, w):
        m = self._matrix(w)
        if self.metric == "cosine_eps":
            n = np.sqrt((m * m).sum(1, keepdims=True))
            m = np.divide(m, n, out=np.zeros_like(m), where=n > 0)
        return m

    def summary(self, terms, w):
        p = self._points(w)
        centre = p.mean(0)
        radius = np.sqrt(((p - centre) ** 2).sum(1)).max()
        return pa.array([], pa.string()), np.append(centre, radius)

    def bounds(self, terms, w, summaries):
        p = self._points(w)
        s = np.array([x[1] for x in summaries])
        centre, radius = s[:, :-1], s[:, -1]
        square = (p * p).sum(1)[:, None] + (centre * centre).sum(1)[None, :] - 2 * (p @ centre.T)
        # Differences of large squares lose digits; the loss is taken off the distance.
        loss = 1e-13 * ((p * p).sum(1)[:, None] + (centre * centre).sum(1)[None, :])
        near = np.maximum(np.sqrt(np.maximum(square - loss, 0)) - radius[None, :], 0)
        near = np.maximum(near - 1e-9, 0)
        return 1 / (1 + near) if self.metric == "euclidean" else np.maximum(1 - near * near / 2, 0)

    def scores(self, q_terms, q_w, terms, w):
        a, b = self._matrix(q_w), self._matrix(w)
        an, bn = (a * a).sum(1), (b * b).sum(1)
        x = a @ b.T
        if self.metric == "euclidean":
            return 1.0 / (1.0 + np.sqrt(np.maximum(an[:, None] + bn[None, :] - 2 * x, 0.0)))
        return x / (np.sqrt(an)[:, None] * np.sqrt(bn)[None, :] + 1e-10)


def top_k_columns(scores, k: int):
    """Per row of ``scores`` (columns in ascending id order), the column
    positions of the k best by (score rounded to 1e-9 desc, id asc), best
    first.  Exact with ties: score and position form one unique int64 key,
    so an O(n) argpartition finds the set and only k entries are sorted.
    Non-finite scores (masked pairs) sort last."""
    n_cols = scores.shape[1]
    kk = min(k, n_cols)
    if kk <= 0:
        return np.zeros((scores.shape[0], 0), dtype=np.int64)
    q = np.rint(scores * 1e9)
    q = np.where(np.isfinite(q), q, -4e18 / (1 << 20))
    width = 1 << int(np.ceil(np.log2(n_cols + 1)))
    key = q.astype(np.int64) * width - np.arange(n_cols, dtype=np.int64)[None, :]
    part = np.argpartition(-key, kk - 1, axis=1)[:, :kk]
    order = np.argsort(-np.take_along_axis(key, part, 1), axis=1)
    return np.take_along_axis(part, order, 1)


def _best(scores: np.ndarray, rep: np.ndarray, k: int, least) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, rep, score) of each row's k best columns from ``least`` up (one limit, or one a row)."""
    order = np.argsort(rep, kind="stable")
    scores = scores[:, order]
    at = top_k_columns(scores, k)
    value = np.take_along_axis(scores, at, 1)
    ok = value >= (least[:, None] if isinstance(least, np.ndarray) else least)
    row = np.repeat(np.arange(len(scores)), at.shape[1]).reshape(at.shape)
    return row[ok], rep[order][at][ok], value[ok]


def _lists(values, kind):
    return pa.array([values], pa.list_(kind))


def _cut(kind, k: int):
    """Sorted classes to blocks, with the block's own products."""
    def block(t: pa.Table):
        c = {n: t.column(n).combine_chunks() for n in t.column_names}
        rep, cand, query = (c[n].to_numpy(zero_copy_only=False) for n in ("rep", "cand", "query"))
        tau = np.full(len(rep), kind.least)
        take = lambda n, mask: c[n].take(pa.array(np.flatnonzero(mask)))
        s_terms, s_max = kind.summary(take("terms", cand), take("w", cand)) if cand.any() else (pa.array([], pa.string()), np.zeros(0))
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if cand.any() and query.any():
            scores = kind.scores(take("terms", query), take("w", query), take("terms", cand), take("w", cand))
            row, other, value = _best(scores, rep[cand], k, kind.least)
            found = (rep[query][row], other, value)
            kth = np.full(int(query.sum()), np.inf)
            np.minimum.at(kth, row, value)
            tau[query] = np.where(np.bincount(row, minlength=len(kth)) == k, kth, kind.least)
        return pa.RecordBatch.from_arrays(
            [pa.array([int(rep[0])], pa.int64()), _lists(rep, pa.int64()), _lists(cand, pa.bool_()), _lists(query, pa.bool_()),
             _lists(tau, pa.float64()), _lists(c["h1"].to_numpy(), pa.int64()), _lists(c["h2"].to_numpy(), pa.int64()),
             *[pa.ListArray.from_arrays(pa.array([0, len(rep)], pa.int32()), c[n]) for n in ("members", "terms", "w")],
             pa.ListArray.from_arrays(pa.array([0, len(s_terms)], pa.int32()), s_terms), _lists(s_max, pa.float64()),
             _lists(found[0], pa.int64()), _lists(found[1], pa.int64()), _lists(found[2], pa.float64())],
            names=[x.split()[0] for x in _BLOCKS.split(", ")])

    def run(batches):
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            rest = t if rest is None else pa.concat_tables([rest, t])
            while True:
                sizes = np.cumsum(np.concatenate([pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in rest.column("w").chunks]
                                                 or [np.zeros(0)]))
                n = max(1, min(BLOCK, int(np.searchsorted(sizes, BLOCK_ENTRIES))))
                if rest.num_rows <= n:
                    break
                yield block(rest.slice(0, n))
                rest = rest.slice(n)
        if rest is not None and rest.num_rows:
            yield block(rest)
    return run


_PROBES = ("target long, q_rep array<long>, q_tau array<double>, q_terms array<array<string>>, q_w array<array<double>>, "
           "q_blocks array<array<long>>")


def _probe(kind):
    """(block, rep, tau, terms, w of queries; chunk of summaries) to the blocks that each may still need, by group."""
    def run(batches):
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                own, rep, tau = col["block"][i].as_py(), col["q_rep"][i].values, col["q_tau"][i].values.to_numpy(zero_copy_only=False)
                terms, w = col["q_terms"][i].values, col["q_w"][i].values
                chunk = col["summaries"][i].values
                target, group = (chunk.field(f).to_numpy(zero_copy_only=False) for f in ("block", "grp"))
                s_terms, s_max = chunk.field("s_terms"), chunk.field("s_max")
                bound = kind.bounds(terms, w, [(s_terms[j].values if len(s_terms[j].values) else [], s_max[j].values.to_numpy(zero_copy_only=False))
                                               for j in range(len(target))])
                alive = (bound >= tau[:, None] - SLACK) & (bound >= kind.least) & (target != own)[None, :]
                out = []
                for g in np.unique(group[alive.any(axis=0)]):
                    cols = np.flatnonzero(group == g)
                    rows = np.flatnonzero(alive[:, cols].any(axis=1))
                    some = alive[np.ix_(rows, cols)]
                    ends = np.concatenate([[0], np.cumsum(some.sum(1))]).astype(np.int32)
                    wanted = pa.ListArray.from_arrays(pa.array(ends), pa.array(target[cols][np.nonzero(some)[1]], pa.int64()))
                    at = pa.array(rows)
                    out.append((int(g), rep.take(at), pa.array(tau).take(at), terms.take(at), w.take(at), wanted))
                if out:
                    ends = np.cumsum([0, *[len(o[1]) for o in out]]).astype(np.int32)
                    flat = [pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays([o[f] for o in out])) for f in (1, 2, 3, 4, 5)]
                    yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), *flat],
                                                     names=["target", "q_rep", "q_tau", "q_terms", "q_w", "q_blocks"])
    return run


def _score(kind, k: int):
    """Queries that reached a group of blocks to (query, other, similarity), k each."""
    def run(batches):
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                v = lambda n: col[n][i].values  # noqa: B023, E731
                terms, w, rep = v("q_terms"), v("q_w"), v("q_rep").to_numpy(zero_copy_only=False)
                least = np.maximum(v("q_tau").to_numpy(zero_copy_only=False) - SLACK, kind.least)
                wanted = v("q_blocks")
                asker = np.repeat(np.arange(len(rep)), pc.list_value_length(wanted).to_numpy(zero_copy_only=False))
                wanted = wanted.flatten().to_numpy(zero_copy_only=False)
                blocks, found = v("blocks"), []
                part = lambda n, j: blocks.field(n)[j].values  # noqa: B023, E731
                for j, block in enumerate(blocks.field("block").to_numpy(zero_copy_only=False)):
                    at = asker[wanted == block]
                    if len(at):
                        cand = pa.array(np.flatnonzero(part("cand", j).to_numpy(zero_copy_only=False)))
                        scores = kind.scores(terms.take(pa.array(at)), w.take(pa.array(at)), part("terms", j).take(cand), part("w", j).take(cand))
                        row, other, value = _best(scores, part("rep", j).take(cand).to_numpy(zero_copy_only=False), k, least[at])
                        found.append((at[row], other, value))
                if not found:
                    continue
                row, other, value = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.lexsort((other, -np.rint(value * 1e9), row))
                row, other, value = row[order], other[order], value[order]
                first = np.arange(len(row)) - np.searchsorted(row, row) < k
                yield pa.RecordBatch.from_arrays([pa.array(rep[row[first]], pa.int64()), pa.array(other[first], pa.int64()), pa.array(value[first], pa.float64())],
                                                 names=["query", "other", "similarity"])
    return run


def _classes(rows: DataFrame, k: int, queries: DataFrame | None) -> DataFrame:
    """Equal vectors as one row: its k lowest candidates, whether it is asked for."""
    cut = top_k_per_group(rows, ["h1", "h2"], [F.desc("cand"), "id"], k)
    c = cut.groupBy("h1", "h2").agg(
        F.first("key").alias("key"), F.first("terms").alias("terms"), F.first("w").alias("w"), F.max("cand").alias("cand"),
        F.min(F.struct((~F.col("cand")).alias("no"), "id")).alias("low"),
        F.array_sort(F.collect_list(F.when(F.col("cand"), F.col("id")))).alias("members"))
    if queries is None:
        c = c.withColumn("query", F.lit(True))
    else:
        asked = rows.join(queries, "id", "left_semi").select("h1", "h2").distinct().withColumn("query", F.lit(True))
        c = c.join(asked, ["h1", "h2"], "left").withColumn("query", F.coalesce("query", F.lit(False)))
    return (c.where(F.col("query") | F.col("cand"))
            .select("key", F.col("low.id").alias("rep"), "cand", "query", "h1", "h2", "members", "terms", "w"))


def build_blocks(rows: DataFrame, kind, k: int, queries: DataFrame | None, path: str) -> DataFrame:
    """The written block table of ``rows`` (id, key, terms, w, cand)."""
    spark = rows.sparkSession
    hashed = rows.withColumn("h1", F.xxhash64("terms", F.transform("w", lambda x: F.round(x, 12)))) \
        .withColumn("h2", F.xxhash64(F.lit(1), "terms", F.transform("w", lambda x: F.round(x, 12))))
    classes = _classes(hashed, k, queries)
    dealt = classes.repartitionByRange("key", "rep").sortWithinPartitions("key", "rep").drop("key")
    dealt.mapInArrow(_cut(kind, k), _BLOCKS).write.parquet(path)
    return spark.read.schema(_BLOCKS).parquet(path)


def _grouped(blocks: DataFrame, kind) -> tuple[DataFrame, Column]:
    """``blocks`` with their chunk of summaries and, within it, their group; the number of chunks."""
    n = F.greatest(F.ceil(blocks.select(F.count(F.lit(1))).scalar() / CHUNK), F.lit(1)).cast("long")
    per = max(1, CHUNK // kind.group)
    dealt = blocks.withColumn("chunk", F.pmod(F.xxhash64("block"), n))
    return dealt.withColumn("grp", F.col("chunk") * per + F.pmod(F.xxhash64(F.lit(1), "block"), F.lit(per))), n


def surviving_pairs(blocks: DataFrame, kind) -> DataFrame:
    """(target, queries): which queries still need which blocks of a group."""
    asks = F.transform(F.filter(F.arrays_zip("rep", "query", "tau", "terms", "w"), lambda x: x["query"]),
                       lambda x: F.struct(x["rep"].alias("rep"), x["tau"].alias("tau"), x["terms"].alias("terms"), x["w"].alias("w")))
    dealt, n = _grouped(blocks, kind)
    probes = (blocks.select("block", asks.alias("q"), F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("chunk"))
              .where("size(q) > 0")
              .select("block", "chunk", F.col("q.rep").alias("q_rep"), F.col("q.tau").alias("q_tau"),
                      F.col("q.terms").alias("q_terms"), F.col("q.w").alias("q_w")))
    summaries = (dealt.where("size(s_max) > 0")
                 .groupBy("chunk").agg(F.collect_list(F.struct("block", "grp", "s_terms", "s_max")).alias("summaries")))
    return probes.join(summaries, "chunk").mapInArrow(_probe(kind), _PROBES)


def top_k(rows: DataFrame, kind, k: int, path: str, queries: DataFrame | None = None, exclude_self: bool = True) -> DataFrame:
    """The k best candidates of every query: doc_id, other, similarity, rank.

    ``rows``: id, key (sorts like rows together), terms, w, cand (may be
    returned).  ``queries`` (id): the ids asked for; all if None.
    """
    kk = k + 1  # the item itself may stand in the list
    blocks = build_blocks(rows, kind, kk, queries, path)
    groups = (_grouped(blocks, kind)[0].groupBy(F.col("grp").alias("target"))
              .agg(F.collect_list(F.struct("block", "rep", "cand", "terms", "w")).alias("blocks")))
    scored = (surviving_pairs(blocks, kind).join(groups, "target")
              .mapInArrow(_score(kind, kk), "query long, other long, similarity double"))
    within = blocks.select(F.explode(F.arrays_zip("f_query", "f_other", "f_sim")).alias("f")) \
        .select(F.col("f.f_query").alias("query"), F.col("f.f_other").alias("other"), F.col("f.f_sim").alias("similarity"))
    best = top_k_per_group(within.unionByName(scored), ["query"], [F.round("similarity", 9).desc(), F.col("other")], kk)
    one = blocks.select(F.explode(F.arrays_zip("rep", "members", "h1", "h2", "query")).alias("c")).select("c.*")
    entry = F.transform("members", lambda m: F.struct((-F.round("similarity", 9)).alias("order"), m.alias("other"), F.col("similarity")))
    lists = (best.join(one.select(F.col("rep").alias("other"), "members"), "other")
             .groupBy("query").agg(F.slice(F.array_sort(F.flatten(F.collect_list(entry))), 1, kk).alias("found")))
    asked = one.where("query").select("h1", "h2", F.col("rep").alias("query")).join(lists, "query")
    ids = rows if queries is None else rows.join(queries, "id", "left_semi")
    ids = ids.select("id", F.xxhash64("terms", F.transform("w", lambda x: F.round(x, 12))).alias("h1"),
                     F.xxhash64(F.lit(1), "terms", F.transform("w", lambda x: F.round(x, 12))).alias("h2"))
    found = F.col("found") if not exclude_self else F.filter("found", lambda x: x["other"] != F.col("id"))
    return (ids.join(asked, ["h1", "h2"]).select("id", F.posexplode(F.slice(found, 1, k)).alias("at", "e"))
            .select(F.col("id").alias("doc_id"), "e.other", "e.similarity", (F.col("at") + 1).cast("int").alias("rank")))


def sparse_rows(weights: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """(doc_id, term, w) to rows; like rows share their leading terms."""
    e = F.array_sort(F.collect_list(F.struct((-F.round("w", 12)).alias("order"), F.col("term").cast("string").alias("term"), F.col("w"))))
    rows = weights.where("w != 0").groupBy(F.col("doc_id").alias("id")).agg(e.alias("e"))
    rows = rows.select("id", F.slice("e.term", 1, 6).alias("key"), F.col("e.term").alias("terms"), F.col("e.w").alias("w"))
    return _with_candidates(rows, candidates)


#: Pivots, drawn as the rows of least hash; their vectors stand in the plan.
PIVOTS = 64


def dense_rows(vectors: DataFrame, id_col: str, vec_col: str, metric: str, candidates: DataFrame | None = None) -> DataFrame:
    """Array column to rows; like rows have the same nearest pivot and lie at
    a like distance from it."""
    v = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("w")).where("w is not null")
    norm = F.sqrt(F.aggregate("w", F.lit(0.0), lambda a, x: a + x * x))
    point = F.transform("w", lambda x: F.when(F.col("n") > 0, x / F.col("n")).otherwise(0.0)) if metric == "cosine_eps" else F.col("w")
    v = v.withColumn("n", norm).withColumn("p", point)
    pivots = (v.orderBy(F.xxhash64("id"), "id").limit(PIVOTS)
              .select(F.array_sort(F.collect_list(F.struct("id", "p")))).scalar())
    far = lambda q: F.aggregate(F.zip_with("p", q, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x)
    near = F.array_min(F.transform("pivots", lambda q: F.struct(far(q["p"]).alias("d"), q["id"].alias("id"))))
    rows = (v.withColumn("pivots", pivots).withColumn("near", near)
            .select("id", F.struct(F.col("near.id").alias("pivot"), F.col("near.d").alias("d")).alias("key"),
                    F.array().cast("array<string>").alias("terms"), "w"))
    return _with_candidates(rows, candidates)


def _with_candidates(rows: DataFrame, candidates: DataFrame | None) -> DataFrame:
    if candidates is None:
        return rows.withColumn("cand", F.lit(True))
    c: Column = F.coalesce("cand", F.lit(False)).alias("cand")
    some = candidates.select(F.col(candidates.columns[0]).alias("id")).distinct().withColumn("cand", F.lit(True))
    return rows.join(some, "id", "left").select("id", "key", "terms", "w", c)
