"""Content-based recommendation.

The model is a table of unit TF-IDF weights per item (no N x N matrix).
Neighbours of one item or a set of items come from joining the query items'
terms with the postings of the same terms; filters (minimum score, the item
itself) run before the per-query top-n (D7).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.functions.columns import r6
from ranklight.functions.topk import top_k_per_group
from ranklight.operators import features, similarity, tfidf

RESULT_COLUMNS = ("item_id", "name", "genres", "score", "type", "episodes")


@dataclass
class ContentModel:
    weights: DataFrame        # doc_id (= item_id), term, w
    items: DataFrame          # catalogue columns shown with results
    tfidf: tfidf.TfidfModel


def fit(cat: DataFrame, max_features: int = 5000, ngram_range=(1, 2)) -> ContentModel:
    """Content text (F2) -> TF-IDF."""
    text = features.text_features_content(cat)
    model, w = tfidf.fit(text, "item_id", "content_text", max_features, ngram_range)
    items = cat.select(*[c for c in RESULT_COLUMNS if c in cat.columns])
    return ContentModel(w, items, model)


def _candidates(model: ContentModel, min_score: float):
    if min_score and min_score > 0:
        return model.items.filter(F.col("score") >= min_score).select(F.col("item_id").alias("doc_id"))
    return None


def recommend_batch(model: ContentModel, query_ids: DataFrame, top_n: int = 10, min_score: float = 0.0,
                    exclude_self: bool = True, overfetch: int | None = None, zero_fill: bool = False,
                    find=similarity.neighbours) -> DataFrame:
    """R3 (and R2 for one id): top-n similar items per query item, found by
    ``find``: blocks with bounds for any number of items.

    Default: filters (self, min_score) run before the cut (D7 fixed).
    ``overfetch=5`` reproduces the reference's cut: take the 5 x top_n most
    similar items (the item itself included) first, filter after, so fewer
    than top_n may remain.  ``zero_fill=True`` tops a short list up with
    similarity-0 items, lowest ids first (the reference fills from the
    unordered tail of a full sort).

    Output: query_id, rank, item columns, similarity.  Unknown ids give no
    rows.
    """
    q = query_ids.select(F.col(query_ids.columns[0]).alias("doc_id"))
    if overfetch:
        nb = find(model.weights, q, top_n * overfetch, False, None).drop("rank")
        if exclude_self:
            nb = nb.filter(F.col("query_id") != F.col("doc_id"))
        if min_score and min_score > 0:
            ok = model.items.filter(F.col("score") >= min_score).select(F.col("item_id").alias("doc_id"))
            nb = nb.join(ok, "doc_id", "left_semi")
        nb = top_k_per_group(nb, ["query_id"], [F.round("similarity", 9).desc(), F.col("doc_id")], top_n)
    else:
        nb = find(model.weights, q, top_n, exclude_self, _candidates(model, min_score))
    if zero_fill:
        nb = _zero_fill(model, q, nb, top_n, min_score, exclude_self)
    return (nb.join(model.items, nb.doc_id == model.items.item_id)
            .select("query_id", "rank", *[c for c in model.items.columns],
                    r6("similarity").alias("similarity")))


def _zero_fill(model: ContentModel, q: DataFrame, nb: DataFrame, top_n: int, min_score: float,
               exclude_self: bool) -> DataFrame:
    """Append similarity-0 items (lowest ids first) to lists shorter than
    top_n.  Only the 2 * top_n + 1 lowest eligible ids can be needed, so each
    query meets that bounded set, never the whole catalogue."""
    items = model.items if not (min_score and min_score > 0) else model.items.filter(F.col("score") >= min_score)
    low = items.select("item_id").orderBy("item_id").limit(2 * top_n + 1)
    low_arr = low.select(F.sort_array(F.collect_list("item_id"))).scalar()
    known = q.join(model.weights.select("doc_id").distinct(), "doc_id", "left_semi")
    fill = known.select(F.col("doc_id").alias("query_id"), F.posexplode(low_arr).alias("pos", "doc_id"))
    if exclude_self:
        fill = fill.filter(F.col("query_id") != F.col("doc_id"))
    fill = fill.join(nb.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
    n_pos = nb.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_pos"))
    fill = (top_k_per_group(fill, ["query_id"], [F.col("pos")], top_n, "fill_rank")
            .join(n_pos, "query_id", "left").fillna({"n_pos": 0})
            .withColumn("rank", (F.col("n_pos") + F.col("fill_rank")).cast("int"))
            .filter(F.col("rank") <= top_n)
            .select("query_id", "doc_id", F.lit(0.0).alias("similarity"), "rank"))
    return nb.select("query_id", "doc_id", "similarity", F.col("rank").cast("int").alias("rank")).unionByName(fill)


def recommend(model: ContentModel, item_id: int, top_n: int = 10, min_score: float = 0.0,
              exclude_self: bool = True, overfetch: int | None = None, zero_fill: bool = False) -> DataFrame:
    """Top-n similar items of one item, by a join of its terms."""
    q = model.items.sparkSession.range(1).select(F.lit(item_id).cast("long").alias("doc_id"))
    return recommend_batch(model, q, top_n, min_score, exclude_self, overfetch, zero_fill,
                           similarity.neighbours_of_item).drop("query_id")


def all_neighbours(model: ContentModel, k: int = 10) -> DataFrame:
    """T8 for every item: exact top-k by blocks with bounds."""
    return similarity.all_pairs_top_k(model.weights, k)
