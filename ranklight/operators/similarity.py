"""Similarity between items.

Vectors are long tables ``(doc_id, term, w)`` (sparse TF-IDF) or array columns
(embeddings).

* One query item (``neighbours_of_item``): its terms meet the postings of
  those terms (an equi-join on term), and the products are summed per
  candidate.  Work = sum over its terms of their document frequency.

* Any number of query items, or all (``neighbours``, ``all_pairs_top_k``,
  ``vector_top_k``): blocks of like rows with upper bounds (``blocktopk``); a
  pair is scored only if it may enter the query's list.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.functions.topk import top_k_per_group
from ranklight.operators import blocktopk
from ranklight.session import stage_path

METRICS = ("cosine", "euclidean", "cosine_eps")


def check_metric(metric: str) -> None:
    """Unknown metric names fail while the plan is built."""
    if metric not in METRICS:
        raise ValueError(f"unknown similarity metric {metric!r}; use one of {METRICS}")


def dense_to_long(df: DataFrame, id_col: str, vec_col: str, normalize: bool = True) -> DataFrame:
    """Array column to (doc_id, term, w); optionally scaled to unit length
    (zero vectors stay zero)."""
    v = F.col(vec_col).cast("array<double>")
    if normalize:
        n = F.sqrt(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), lambda a, b: a + b))
        v = F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0)))
    return df.select(F.col(id_col).alias("doc_id"), F.posexplode(v).alias("term", "w")).filter(F.col("w") != 0)


def neighbours_of_item(weights: DataFrame, item: DataFrame, k: int = 10, exclude_self: bool = True,
                       candidates: DataFrame | None = None) -> DataFrame:
    """Top-k cosine neighbours (dot products of unit vectors) of one item
    (``item``: one row, column doc_id).  ``candidates`` (doc_id) optionally
    limits which items may be returned (filters run before the cut).

    Output: query_id, doc_id, similarity, rank (positive similarity only).
    """
    q = (weights.join(F.broadcast(item.select("doc_id")), "doc_id", "left_semi")
         .select(F.col("doc_id").alias("query_id"), "term", F.col("w").alias("wq")))
    cand = weights if candidates is None else weights.join(candidates.select("doc_id"), "doc_id", "left_semi")
    # One item's terms go to the postings; these do not travel.
    prod = cand.join(F.broadcast(q), "term").groupBy("query_id", "doc_id").agg(F.sum(F.col("wq") * F.col("w")).alias("similarity"))
    if exclude_self:
        prod = prod.filter(F.col("query_id") != F.col("doc_id"))
    # Order on the value rounded to 1e-9 so float noise cannot reorder ties.
    prod = prod.filter(F.round("similarity", 9) > 0)
    return top_k_per_group(prod, ["query_id"], [F.round("similarity", 9).desc(), F.col("doc_id")], k)


def _blocks_path(spark) -> str:
    return stage_path(spark, f"similarity-blocks-{uuid.uuid4().hex[:12]}")


def neighbours(weights: DataFrame, queries: DataFrame, k: int = 10, exclude_self: bool = True,
               candidates: DataFrame | None = None) -> DataFrame:
    """The same for every item of ``queries`` (column doc_id), however many.

    Output: query_id, doc_id, similarity, rank (positive similarity only).
    """
    rows = blocktopk.sparse_rows(weights, candidates)
    ids = queries.select(F.col("doc_id").alias("id")).distinct()
    top = blocktopk.top_k(rows, blocktopk.Sparse(), k, _blocks_path(weights.sparkSession), ids, exclude_self)
    return top.select(F.col("doc_id").alias("query_id"), F.col("other").alias("doc_id"), "similarity", "rank")


def all_pairs_top_k(weights: DataFrame, k: int = 10, exclude_self: bool = True) -> DataFrame:
    """T8 for every item: top-k neighbours of positive cosine (unit rows).
    Output: doc_id, other, similarity, rank."""
    return blocktopk.top_k(blocktopk.sparse_rows(weights), blocktopk.Sparse(), k,
                           _blocks_path(weights.sparkSession), None, exclude_self)


def vector_top_k(vectors: DataFrame, id_col: str, vec_col: str, k: int = 10, metric: str = "cosine_eps",
                 exclude_self: bool = True) -> DataFrame:
    """T9 / E3 for every vector of an array column.  ``euclidean``: 1 / (1 +
    distance); ``cosine_eps`` and ``cosine``: cosine with 1e-10 added to the
    product of the lengths.  Output: doc_id, other, similarity, rank."""
    check_metric(metric)
    kind = "euclidean" if metric == "euclidean" else "cosine_eps"
    return blocktopk.top_k(blocktopk.dense_rows(vectors, id_col, vec_col, kind), blocktopk.Dense(kind), k,
                           _blocks_path(vectors.sparkSession), None, exclude_self)


def pair_similarity(weights: DataFrame, pairs: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Cosine of given pairs (unit rows) that share a term.  A vector travels
    as one row (a map from the term's hash), once per pair; products are summed
    in the row."""
    packed = (weights.where("doc_id is not null and term is not null and w is not null").repartition("doc_id")
              .groupBy("doc_id", F.xxhash64("term").alias("t")).agg(F.sum("w").alias("w"))
              .groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("t", "w"))).alias("v")))
    own = lambda c, v: packed.select(F.col("doc_id").alias(c), F.col("v").alias(v))
    both = pairs.select(left, right).distinct().join(own(left, "vl"), left).join(own(right, "vr"), right)
    shared = F.filter(F.map_keys("vl"), lambda t: F.map_contains_key("vr", t))
    products = F.transform(shared, lambda t: F.element_at("vl", t) * F.element_at("vr", t))
    return (both.select(left, right, products.alias("x")).where("size(x) > 0")
            .select(left, right, F.aggregate("x", F.lit(0.0), lambda a, b: a + b).alias("similarity")))


def similarity_sample(weights: DataFrame, ids: DataFrame) -> DataFrame:
    """The similarity sub-matrix of a small id set, zeros included."""
    grid = _pairs_of(ids)
    sims = pair_similarity(weights, grid, "a", "b")
    return grid.join(sims, ["a", "b"], "left").fillna({"similarity": 0.0})


def _pairs_of(ids: DataFrame) -> DataFrame:
    """All ordered pairs of a small id set (the caller bounds its size, e.g.
    the first 20 items): the set reaches every task as one scalar array."""
    arr = ids.select(F.sort_array(F.collect_list("doc_id"))).scalar()
    return ids.select(F.col("doc_id").alias("a"), F.explode(arr).alias("b"))


def similarity_percentile(weights: DataFrame, p: float = 75.0) -> DataFrame:
    """P-th percentile (linear interpolation) of all similarities i < j,
    zeros of pairs without a shared term included: threshold, n_pairs."""
    from ranklight.operators.pairselect import pair_percentile
    spark = weights.sparkSession
    value, n = pair_percentile(weights, p, stage_path(spark, f"similarity-pairs-{uuid.uuid4().hex[:12]}"))
    return spark.range(1).select(F.lit(value).cast("double").alias("threshold"), F.lit(n).cast("long").alias("n_pairs"))
