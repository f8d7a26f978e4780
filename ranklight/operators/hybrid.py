"""Hybrid recommendation.

Both sides are ranked sub-plans (content neighbours of an item, CF picks
for a user); the blend is a full outer join on the item, a few column
expressions and a top-n.  Every branch is a lazy DataFrame; nothing is
merged in Python dictionaries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.functions.columns import r6
from ranklight.operators import collab, content

STRATEGIES = ("weighted", "switching", "mixed")
ITEM_COLUMNS = ("item_id", "name", "genres", "score", "type", "episodes")


def hybrid_weights(content_weight: float = 0.4, collaborative_weight: float = 0.6) -> tuple[float, float]:
    """H1: both weights divided by their sum; both zero is an error."""
    total = content_weight + collaborative_weight
    if total <= 0:
        raise ValueError("content_weight + collaborative_weight must be > 0")
    return content_weight / total, collaborative_weight / total


def reweight(content_weight: float) -> tuple[float, float]:
    """H6: a slider sets the content weight, the other is 1 - w."""
    return hybrid_weights(content_weight, 1.0 - content_weight)


class CFSide:
    """The collaborative side: a bias model or a trained factor model, its
    training ratings, the catalogue."""

    def __init__(self, model: collab.Baseline | collab.FactorModel, train: DataFrame, catalogue: DataFrame):
        self.model, self.train, self.catalogue = model, train, catalogue

    def recommend(self, user_id: int, top_n: int, min_score: float) -> DataFrame:
        return collab.recommend_user(self.model, self.train, self.catalogue, user_id, top_n, min_score)

    def n_ratings(self, user_id: int) -> F.Column:
        """Number of training ratings of the user (raw ids, D2) as a scalar."""
        return self.train.filter(F.col("user_id") == user_id).select(F.count(F.lit(1))).scalar()


def _items(cat: DataFrame) -> DataFrame:
    return cat.select(*[c for c in ITEM_COLUMNS if c in cat.columns])


def weighted(cb: content.ContentModel | None, cf: CFSide | None, item_id: int | None = None,
             user_id: int | None = None, top_n: int = 10, min_score: float = 0.0,
             content_weight: float = 0.4, collaborative_weight: float = 0.6) -> DataFrame:
    """H2: top 2n from each side; CF predictions min-max scaled within their
    list (range 1 if all equal); weighted sum, a missing side counts 0;
    top-n by the blend, ties by item id."""
    cw, fw = hybrid_weights(content_weight, collaborative_weight)
    return blended(scored(cb, cf, item_id, user_id, top_n, min_score), cb.items if cb is not None else _items(cf.catalogue), top_n, cw, fw)


def scored(cb: content.ContentModel | None, cf: CFSide | None, item_id: int | None = None, user_id: int | None = None,
           top_n: int = 10, min_score: float = 0.0) -> DataFrame:
    """Both sides of H2 before the blend: item_id, cb_score, cf_score; at most 4n rows."""
    if item_id is None and user_id is None:
        raise ValueError("either item_id or user_id must be given")
    parts = []
    if item_id is not None and cb is not None:
        c = content.recommend(cb, item_id, top_n * 2, min_score)
        parts.append(c.select("item_id", F.col("similarity").alias("cb_score")))
    if user_id is not None and cf is not None:
        f = cf.recommend(user_id, top_n * 2, min_score)
        mm = f.select(F.struct(F.min("prediction").alias("lo"), F.max("prediction").alias("hi"))).scalar()
        rng = F.when(mm.getField("hi") > mm.getField("lo"), mm.getField("hi") - mm.getField("lo")).otherwise(F.lit(1.0))
        parts.append(f.select("item_id", ((F.col("prediction") - mm.getField("lo")) / rng).alias("cf_score")))
    if len(parts) == 2:
        both = parts[0].join(parts[1], "item_id", "full_outer")
    else:
        both = parts[0]
    for col in ("cb_score", "cf_score"):
        both = both.withColumn(col, F.coalesce(F.col(col), F.lit(0.0))) if col in both.columns \
            else both.withColumn(col, F.lit(0.0))
    return both


def blended(both: DataFrame, items: DataFrame, top_n: int, cw: float, fw: float) -> DataFrame:
    """The top-n of ``scored`` rows under normalised weights, with the items' columns."""
    blend = both.withColumn("hybrid_score", cw * F.col("cb_score") + fw * F.col("cf_score"))
    top = blend.orderBy(F.round("hybrid_score", 9).desc(), "item_id").limit(top_n)
    return (F.broadcast(top).join(items, "item_id")
            .select(*[c for c in ITEM_COLUMNS], r6("cb_score").alias("cb_score"), r6("cf_score").alias("cf_score"),
                    r6("hybrid_score").alias("hybrid_score")))


def switching(cb: content.ContentModel | None, cf: CFSide | None, item_id: int | None = None,
              user_id: int | None = None, top_n: int = 10, min_score: float = 0.0,
              user_rating_threshold: int = 10) -> DataFrame:
    """H3: content-based when an item is given or the user has fewer than
    `threshold` training ratings, else CF.  A cold user without an item gets
    an empty result with the schema kept (D16).

    The routing predicate is a scalar subquery, so both branches sit in one
    plan and only the chosen one yields rows."""
    cols = [F.col("item_id"), F.col("score_value"), F.col("source")]
    if cb is not None and item_id is not None:
        cb_rows = (content.recommend(cb, item_id, top_n, min_score)
                   .select("item_id", F.col("similarity").alias("score_value"), F.lit("content").alias("source")))
    else:
        base = cb.items if cb is not None else cf.catalogue
        cb_rows = base.select("item_id", F.lit(0.0).alias("score_value"), F.lit("content").alias("source")).limit(0)
    if user_id is None or cf is None:
        return cb_rows.select(*cols)
    use_cf = F.lit(item_id is None) & (cf.n_ratings(user_id) >= user_rating_threshold)
    cf_rows = (cf.recommend(user_id, top_n, min_score)
               .select("item_id", F.col("prediction").alias("score_value"), F.lit("collaborative").alias("source")))
    return cb_rows.filter(~use_cf).unionByName(cf_rows.filter(use_cf)).select(*cols)


def mixed(cb: content.ContentModel | None, cf: CFSide | None, item_id: int | None = None,
          user_id: int | None = None, top_n: int = 10, min_score: float = 0.0,
          mix_ratio: float = 0.5) -> DataFrame:
    """H4: int(n * ratio) content picks first, then up to the rest from the
    CF list fetched at twice that size, without items already picked; no
    refill.  Output: position, item_id, source."""
    n_cb = int(top_n * mix_ratio)
    n_cf = top_n - n_cb
    base = cb.items if cb is not None else cf.catalogue
    picks = base.select("item_id", F.lit(0).cast("int").alias("pos")).limit(0)
    if item_id is not None and cb is not None and n_cb > 0:
        picks = content.recommend(cb, item_id, n_cb, min_score).select("item_id", F.col("rank").cast("int").alias("pos"))
    out = picks.select(F.col("pos").alias("position"), "item_id", F.lit("content").alias("source"))
    if user_id is not None and cf is not None and n_cf > 0:
        fetched = cf.recommend(user_id, n_cf * 2, min_score)
        kept = fetched.join(picks.select("item_id"), "item_id", "left_anti")
        n_picks = picks.select(F.count(F.lit(1))).scalar()
        top = kept.orderBy("rank").limit(n_cf)
        # Lists here hold at most n_cf rows: numbering them needs no partition key.
        from pyspark.sql import Window
        cf_part = top.select((n_picks + F.row_number().over(Window.orderBy("rank"))).cast("int").alias("position"),
                             "item_id", F.lit("collaborative").alias("source"))
        out = out.unionByName(cf_part)
    return out


def recommend(strategy: str, cb, cf, item_id=None, user_id=None, top_n=10, min_score=0.0, **kw) -> DataFrame:
    """H5: dispatch on the strategy name; unknown names raise."""
    if strategy == "weighted":
        return weighted(cb, cf, item_id, user_id, top_n, min_score, **kw)
    if strategy == "switching":
        return switching(cb, cf, item_id, user_id, top_n, min_score, **kw)
    if strategy == "mixed":
        return mixed(cb, cf, item_id, user_id, top_n, min_score, **kw)
    raise ValueError(f"unknown strategy {strategy!r}; use one of {STRATEGIES}")


def recommend_any(models: dict, model_type: str, item_id: int | None = None, user_id: int | None = None,
                  top_n: int = 10, min_score: float = 0.0) -> DataFrame:
    """H8 (D15): one entry over model types: 'content' needs an item,
    'collaborative' a user, 'hybrid' either (weighted blend)."""
    cb, cf = models.get("content"), models.get("collaborative")
    if model_type == "content":
        return content.recommend(cb, item_id, top_n, min_score)
    if model_type == "collaborative":
        return cf.recommend(user_id, top_n, min_score)
    if model_type == "hybrid":
        return weighted(cb, cf, item_id, user_id, top_n, min_score)
    raise ValueError(f"unknown model type {model_type!r}")


def evaluate_on_held_out(pred: DataFrame, train: DataFrame, weights: DataFrame, k: int = 10,
                         threshold: float = 7.0, content_weight: float = 0.4,
                         collaborative_weight: float = 0.6) -> DataFrame:
    """V18 (D8: measured, not estimated): every test user's held-out items
    ranked by the weighted blend.

    Query item of a user = their highest-rated training item (ties: lowest
    id).  cb = cosine(query item, item); cf = the baseline prediction
    min-max scaled within the user's held-out list (range 1 if all equal).
    Relevant = held-out rating >= threshold.  All joins and grouped
    aggregates; per-user lists are cut to k with a group limit.
    """
    from ranklight.functions.topk import SKEW_SALT, top_k_per_group
    from ranklight.operators.metrics import per_user_at_k
    from ranklight.operators.similarity import pair_similarity
    cw, fw = hybrid_weights(content_weight, collaborative_weight)
    q = top_k_per_group(train, ["user_id"], [F.col("rating").desc(), F.col("item_id")], 1, salt=SKEW_SALT) \
        .select("user_id", F.col("item_id").alias("q_item"))
    p = pred.join(q, "user_id", "left")
    sims = pair_similarity(weights, p.select(F.col("q_item").alias("a"), F.col("item_id").alias("b")), "a", "b")
    mm = p.groupBy("user_id").agg(F.min("prediction").alias("lo"), F.max("prediction").alias("hi"))
    scored = (p.join(mm, "user_id")
              .join(sims, (p.q_item == sims.a) & (p.item_id == sims.b), "left")
              .withColumn("cb", F.coalesce("similarity", F.lit(0.0)))
              .withColumn("cf", (F.col("prediction") - F.col("lo")) /
                          F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(F.lit(1.0)))
              .withColumn("hybrid_score", cw * F.col("cb") + fw * F.col("cf")))
    ranked = top_k_per_group(scored, ["user_id"], [F.round("hybrid_score", 9).desc(), F.col("item_id")], k,
                             salt=SKEW_SALT)
    relevant = pred.filter(F.col("rating") >= threshold).select("user_id", "item_id")
    per = per_user_at_k(ranked.select("user_id", "item_id", "rank"), relevant, (k,))
    return per.agg(r6(F.avg("precision")).alias(f"precision_at_{k}"), r6(F.avg("recall")).alias(f"recall_at_{k}"),
                   r6(F.avg("f1")).alias(f"f1_macro_at_{k}"), F.count(F.lit(1)).alias("users"))


def weighted_batch(cb: content.ContentModel, model: collab.Baseline | collab.FactorModel, train: DataFrame, catalogue: DataFrame,
                   queries: DataFrame, top_n: int = 10, min_score: float = 0.0, content_weight: float = 0.4,
                   collaborative_weight: float = 0.6) -> DataFrame:
    """H2 for many (user_id, item_id) queries in one plan, keyed by user.

    Content lists for the distinct query items (blocks with bounds), CF lists
    for the distinct query users (the exact all-users top-n), each cut to
    2n; CF min-max per user list; a full outer join on (user, item); a
    per-user top-n.  Output: user_id, rank, item_id, cb_score, cf_score,
    hybrid_score.
    """
    from ranklight.functions.topk import top_k_per_group
    from ranklight.operators.similarity import neighbours
    cw, fw = hybrid_weights(content_weight, collaborative_weight)
    qs = queries.select("user_id", F.col("item_id").alias("q_item"))
    cand = None
    if min_score and min_score > 0:
        cand = catalogue.filter(F.col("score") >= min_score).select(F.col("item_id").alias("doc_id"))
    nb = neighbours(cb.weights, qs.select(F.col("q_item").alias("doc_id")), 2 * top_n, True, cand)
    cbs = (qs.join(nb, qs.q_item == nb.query_id)
           .select("user_id", F.col("doc_id").alias("item_id"), r6("similarity").alias("cb_score")))
    cf = collab.recommend_all(model, train, catalogue, qs.select("user_id"), 2 * top_n, min_score)
    mm = cf.groupBy("user_id").agg(F.min("prediction").alias("lo"), F.max("prediction").alias("hi"))
    cfs = (cf.join(mm, "user_id")
           .select("user_id", "item_id", ((F.col("prediction") - F.col("lo")) /
                                          F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo"))
                                          .otherwise(F.lit(1.0))).alias("cf_score")))
    both = (cbs.join(cfs, ["user_id", "item_id"], "full_outer")
            .fillna({"cb_score": 0.0, "cf_score": 0.0})
            .withColumn("hybrid_score", cw * F.col("cb_score") + fw * F.col("cf_score")))
    top = top_k_per_group(both, ["user_id"], [F.round("hybrid_score", 9).desc(), F.col("item_id")], top_n)
    return top.select("user_id", F.col("rank").cast("int").alias("rank"), "item_id", r6("cb_score").alias("cb_score"),
                      r6("cf_score").alias("cf_score"), r6("hybrid_score").alias("hybrid_score"))


def switching_batch(cb: content.ContentModel, model: collab.Baseline | collab.FactorModel, train: DataFrame, catalogue: DataFrame,
                    queries: DataFrame, top_n: int = 10, min_score: float = 0.0,
                    user_rating_threshold: int = 10) -> DataFrame:
    """H3 for many (user_id, item_id-or-null) queries in one plan: the
    routing predicate is a column (training ratings per user joined in), the
    content branch serves queries with an item or a cold user, the CF branch
    the rest, and the two are unioned.  A cold user without an item gets no
    rows (D16).  Output: user_id, source, rank, item_id, score_value."""
    from ranklight.operators.similarity import neighbours
    n = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_train"))
    q = (queries.select("user_id", F.col("item_id").alias("q_item")).join(n, "user_id", "left")
         .withColumn("use_cf", F.col("q_item").isNull() & (F.coalesce("n_train", F.lit(0)) >= user_rating_threshold)))
    cq = q.filter(~F.col("use_cf") & F.col("q_item").isNotNull())
    cand = None
    if min_score and min_score > 0:
        cand = catalogue.filter(F.col("score") >= min_score).select(F.col("item_id").alias("doc_id"))
    nb = neighbours(cb.weights, cq.select(F.col("q_item").alias("doc_id")), top_n, True, cand)
    cb_rows = (cq.join(nb, cq.q_item == nb.query_id)
               .select("user_id", F.lit("content").alias("source"), F.col("rank").cast("int").alias("rank"),
                       F.col("doc_id").alias("item_id"), r6("similarity").alias("score_value")))
    cf_users = q.filter(F.col("use_cf")).select("user_id")
    cf_rows = (collab.recommend_all(model, train, catalogue, cf_users, top_n, min_score)
               .select("user_id", F.lit("collaborative").alias("source"), F.col("rank").cast("int").alias("rank"),
                       "item_id", F.col("prediction").alias("score_value")))
    return cb_rows.unionByName(cf_rows)


def mixed_batch(cb: content.ContentModel, model: collab.Baseline | collab.FactorModel, train: DataFrame, catalogue: DataFrame,
                queries: DataFrame, top_n: int = 10, min_score: float = 0.0, mix_ratio: float = 0.5) -> DataFrame:
    """H4 for many (user_id, item_id) queries in one plan: int(n * ratio)
    content picks per query first, then up to the rest from each user's CF
    list fetched at twice that size, without the query's content picks; no
    refill.  Output: user_id, position, item_id, source."""
    from ranklight.functions.topk import top_k_per_group
    from ranklight.operators.similarity import neighbours
    n_cb = int(top_n * mix_ratio)
    n_cf = top_n - n_cb
    qs = queries.select("user_id", F.col("item_id").alias("q_item"))
    cand = None
    if min_score and min_score > 0:
        cand = catalogue.filter(F.col("score") >= min_score).select(F.col("item_id").alias("doc_id"))
    picks = qs.limit(0).select("user_id", F.col("q_item").alias("item_id"), F.lit(0).alias("position"))
    if n_cb > 0:
        nb = neighbours(cb.weights, qs.select(F.col("q_item").alias("doc_id")), n_cb, True, cand)
        picks = (qs.join(nb, qs.q_item == nb.query_id)
                 .select("user_id", F.col("doc_id").alias("item_id"), F.col("rank").cast("int").alias("position")))
    out = picks.withColumn("source", F.lit("content"))
    if n_cf > 0:
        cf = collab.recommend_all(model, train, catalogue, qs.select("user_id"), 2 * n_cf, min_score)
        kept = cf.join(picks.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
        kept = top_k_per_group(kept.drop("prediction").withColumnRenamed("rank", "cf_rank"), ["user_id"],
                               [F.col("cf_rank")], n_cf, "r")
        n_p = picks.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_picks"))
        cf_rows = (kept.join(n_p, "user_id", "left").fillna({"n_picks": 0})
                   .select("user_id", "item_id", (F.col("n_picks") + F.col("r")).cast("int").alias("position"),
                           F.lit("collaborative").alias("source")))
        out = out.unionByName(cf_rows)
    return out.select("user_id", "position", "item_id", "source")
