"""Hybrid queries (H1-H8) with the bias baseline as the CF side."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ranklight.operators import collab, content, hybrid
from ranklight.plans import stages
from ranklight.plans.content_q import CONTENT_CTES
from ranklight.plans.registry import register
from ranklight.session import stage_path


def _all_ctes(extra: str) -> str:
    return CONTENT_CTES.rstrip() + ",\n" + ",\n".join(
        c for c in [stages.KEEP_LAST_SQL, stages.RATINGS_CLEAN_SQL, stages.SPLIT_SQL, stages.BASELINE_SQL]) + ",\n" + extra


def cb_sql(query_expr: str, k: int, min_score: float) -> str:
    cand = f" AND b.doc_id IN (SELECT item_id FROM catalogue WHERE score >= {min_score})" if min_score > 0 else ""
    return f"""cb_q AS (SELECT a.doc_id AS query_id, b.doc_id AS item_id, sum(a.w * b.w) AS sim
       FROM weights a JOIN weights b USING (term)
       WHERE a.doc_id = ({query_expr}) AND a.doc_id <> b.doc_id{cand} GROUP BY a.doc_id, b.doc_id),
cb_list AS (SELECT item_id, round(sim, 6) AS similarity, rank FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY round(sim, 9) DESC, item_id) AS INTEGER) AS rank FROM cb_q
  WHERE round(sim, 9) > 0) WHERE rank <= {k})"""


def cf_sql(user_expr: str, k: int, min_score: float) -> str:
    elig = f"WHERE score >= {min_score}" if min_score > 0 else ""
    return f"""cf_user AS (SELECT ({user_expr}) AS user_id),
cf_c AS (SELECT e.item_id, (SELECT mu FROM mu) + coalesce((SELECT b_u FROM bu WHERE user_id = (SELECT user_id FROM cf_user)), 0)
                + coalesce(bi.b_i, 0) AS raw
         FROM (SELECT item_id FROM catalogue {elig}) e LEFT JOIN bi USING (item_id)
         WHERE e.item_id NOT IN (SELECT item_id FROM train WHERE user_id = (SELECT user_id FROM cf_user))),
cf_list AS (SELECT item_id, round(least(greatest(raw, 1.0), 10.0), 6) AS prediction, rank FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY round(raw, 9) DESC, item_id) AS INTEGER) AS rank FROM cf_c) WHERE rank <= {k})"""


FIRST_ITEM = "SELECT min(item_id) FROM catalogue"
FIRST_USER = "SELECT min(user_id) FROM train"


def _weighted_sql(item: bool, user: bool, n: int = 10, cw: float = 0.4, fw: float = 0.6) -> str:
    cw, fw = hybrid.hybrid_weights(cw, fw)
    parts = []
    if item:
        parts.append(cb_sql(FIRST_ITEM, 2 * n, 0.0))
    if user:
        parts.append(cf_sql(FIRST_USER, 2 * n, 0.0))
        parts.append("""cf_mm AS (SELECT min(prediction) AS lo, CASE WHEN max(prediction) > min(prediction)
                                THEN max(prediction) - min(prediction) ELSE 1.0 END AS rng FROM cf_list),
cf_norm AS (SELECT item_id, (prediction - (SELECT lo FROM cf_mm)) / (SELECT rng FROM cf_mm) AS cf_score FROM cf_list)""")
    if item and user:
        parts.append("""both_ AS (SELECT coalesce(c.item_id, f.item_id) AS item_id, coalesce(c.similarity, 0.0) AS cb_score,
                 coalesce(f.cf_score, 0.0) AS cf_score FROM cb_list c FULL OUTER JOIN cf_norm f USING (item_id))""")
    elif item:
        parts.append("both_ AS (SELECT item_id, similarity AS cb_score, CAST(0.0 AS DOUBLE) AS cf_score FROM cb_list)")
    else:
        parts.append("both_ AS (SELECT item_id, CAST(0.0 AS DOUBLE) AS cb_score, cf_score FROM cf_norm)")
    parts.append(f"""blend AS (SELECT *, {cw!r} * cb_score + {fw!r} * cf_score AS hybrid_score FROM both_
                ORDER BY round({cw!r} * cb_score + {fw!r} * cf_score, 9) DESC, item_id LIMIT {n})""")
    return _all_ctes(",\n".join(parts)) + """
SELECT c.item_id, c.name, c.genres, c.score, c.type, c.episodes, round(b.cb_score, 6) AS cb_score,
       round(b.cf_score, 6) AS cf_score, round(b.hybrid_score, 6) AS hybrid_score
FROM blend b JOIN catalogue c USING (item_id)"""


def _sides(spark, sf):
    cat = stages.catalogue(spark, sf)
    cb = stages.content_model(spark, sf)
    model, split = stages.baseline_model(spark, sf)
    cf = hybrid.CFSide(model, collab.train_part(split), cat)
    return cb, cf, cat, split


def _first_ids(spark, sf, cat, split):
    item = cat.select(F.min("item_id")).first()[0]
    user = collab.train_part(split).select(F.min("user_id")).first()[0]
    return item, user


@register("hybrid_weighted", _weighted_sql(True, True), headline=True)
def hybrid_weighted(spark, sf):
    """H2: item and user given: 0.4 content + 0.6 min-max scaled CF."""
    cb, cf, cat, split = _sides(spark, sf)
    item, user = _first_ids(spark, sf, cat, split)
    return hybrid.weighted(cb, cf, item, user, 10)


@register("hybrid_weighted_item_only", _weighted_sql(True, False))
def hybrid_weighted_item_only(spark, sf):
    """H2 with only an item: the content side alone, weighted."""
    cb, cf, cat, split = _sides(spark, sf)
    item, _ = _first_ids(spark, sf, cat, split)
    return hybrid.weighted(cb, cf, item, None, 10)


@register("hybrid_weighted_user_only", _weighted_sql(False, True))
def hybrid_weighted_user_only(spark, sf):
    """H2 with only a user: the scaled CF side alone, weighted."""
    cb, cf, cat, split = _sides(spark, sf)
    _, user = _first_ids(spark, sf, cat, split)
    return hybrid.weighted(cb, cf, None, user, 10)


@register("hybrid_reweight", " UNION ALL ".join(
    f"SELECT CAST({w!r} AS DOUBLE) AS content_weight, * FROM ({_weighted_sql(True, True, 10, w, 1 - w)})" for w in (0.0, 0.5, 1.0)))
def hybrid_reweight(spark, sf):
    """H6: the weighted blend at content weights 0, 0.5 and 1."""
    cb, cf, cat, split = _sides(spark, sf)
    item, user = _first_ids(spark, sf, cat, split)
    # The slider moves the weights only: both lists are found once.
    path = stage_path(spark, f"hybrid-sides-{uuid.uuid4().hex[:12]}")
    both = hybrid.scored(cb, cf, item, user, 10, 0.0)
    both.write.parquet(path)
    both = spark.read.schema(both.schema).parquet(path)
    out = None
    for w in (0.0, 0.5, 1.0):
        r = hybrid.blended(both, cb.items, 10, *hybrid.reweight(w)).select(F.lit(w).alias("content_weight"), "*")
        out = r if out is None else out.unionByName(r)
    return out


SWITCH_WARM_SQL = _all_ctes(cf_sql(FIRST_USER, 10, 0.0)) + """
SELECT item_id, prediction AS score_value, 'collaborative' AS source FROM cf_list
WHERE (SELECT count(*) FROM train WHERE user_id = (SELECT min(user_id) FROM train)) >= 10"""


@register("hybrid_switching_warm", SWITCH_WARM_SQL)
def hybrid_switching_warm(spark, sf):
    """H3: a user with >= 10 training ratings and no item goes to CF."""
    cb, cf, cat, split = _sides(spark, sf)
    _, user = _first_ids(spark, sf, cat, split)
    return hybrid.switching(cb, cf, None, user, 10)


@register("hybrid_switching_item", _all_ctes(cb_sql(FIRST_ITEM, 10, 0.0)) + """
SELECT item_id, similarity AS score_value, 'content' AS source FROM cb_list""")
def hybrid_switching_item(spark, sf):
    """H3: an item given routes to content-based, even for a warm user."""
    cb, cf, cat, split = _sides(spark, sf)
    item, user = _first_ids(spark, sf, cat, split)
    return hybrid.switching(cb, cf, item, user, 10)


MIXED_SQL = _all_ctes(cb_sql(FIRST_ITEM, 5, 0.0) + ",\n" + cf_sql(FIRST_USER, 10, 0.0)) + """
SELECT rank AS position, item_id, 'content' AS source FROM cb_list
UNION ALL
SELECT CAST((SELECT count(*) FROM cb_list) + row_number() OVER (ORDER BY rank) AS INTEGER), item_id, 'collaborative'
FROM (SELECT * FROM cf_list WHERE item_id NOT IN (SELECT item_id FROM cb_list) ORDER BY rank LIMIT 5)"""


@register("hybrid_mixed", MIXED_SQL)
def hybrid_mixed(spark, sf):
    """H4: 5 content picks, then up to 5 CF picks from a list of 10, no repeats."""
    cb, cf, cat, split = _sides(spark, sf)
    item, user = _first_ids(spark, sf, cat, split)
    return hybrid.mixed(cb, cf, item, user, 10, 0.0, 0.5)


@register("compare_strategies", " UNION ALL ".join([
    "SELECT 'content' AS strategy, rank AS position, item_id FROM (" + _all_ctes(cb_sql(FIRST_ITEM, 10, 0.0)) + " SELECT * FROM cb_list)",
    "SELECT 'collaborative', rank, item_id FROM (" + _all_ctes(cf_sql(FIRST_USER, 10, 0.0)) + " SELECT * FROM cf_list)",
    "SELECT 'weighted', CAST(row_number() OVER (ORDER BY round(hybrid_score, 9) DESC, item_id) AS INTEGER), item_id FROM ("
    + _weighted_sql(True, True) + ")",
    "SELECT 'mixed', position, item_id FROM (" + MIXED_SQL + ")"]))
def compare_strategies(spark, sf):
    """H7: the lists of every strategy side by side (strategy, position, item)."""
    cb, cf, cat, split = _sides(spark, sf)
    item, user = _first_ids(spark, sf, cat, split)
    from pyspark.sql import Window
    c = content.recommend(cb, item, 10).select(F.lit("content").alias("strategy"), F.col("rank").cast("int").alias("position"), "item_id")
    f = cf.recommend(user, 10, 0.0).select(F.lit("collaborative").alias("strategy"), F.col("rank").cast("int").alias("position"), "item_id")
    w = hybrid.weighted(cb, cf, item, user, 10)
    w = w.select(F.lit("weighted").alias("strategy"),
                 F.row_number().over(Window.orderBy(F.col("hybrid_score").desc(), "item_id")).cast("int").alias("position"),
                 "item_id")
    m = hybrid.mixed(cb, cf, item, user, 10).select(F.lit("mixed").alias("strategy"), "position", "item_id")
    return c.unionByName(f).unionByName(w).unionByName(m)


@register("train_hybrid", _weighted_sql(True, False, 5))
def train_hybrid(spark, sf):
    """Hybrid weights and config, five picks for the first item."""
    from ranklight.plans import jobs
    return jobs.train_hybrid(spark, sf)


BATCH_SQL = _all_ctes("""qu AS (SELECT DISTINCT user_id FROM test),
qi AS (SELECT user_id, item_id AS q_item FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rn FROM train
         WHERE user_id IN (SELECT user_id FROM qu)) WHERE rn = 1),
cbq AS (SELECT a.doc_id AS q_item, b.doc_id AS item_id, sum(a.w * b.w) AS sim FROM weights a JOIN weights b USING (term)
        WHERE a.doc_id IN (SELECT q_item FROM qi) AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
cbl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_item ORDER BY round(sim, 9) DESC, item_id) AS r
                       FROM cbq WHERE round(sim, 9) > 0) WHERE r <= 20),
cbs AS (SELECT qi.user_id, cbl.item_id, round(cbl.sim, 6) AS cb_score FROM qi JOIN cbl USING (q_item)),
cfc AS (SELECT u.user_id, e.item_id, (SELECT mu FROM mu) + coalesce(bu.b_u, 0) + coalesce(bi.b_i, 0) AS raw,
               coalesce(bi.b_i, 0) AS b
        FROM qu u JOIN (SELECT item_id FROM catalogue) e ON TRUE LEFT JOIN bi ON bi.item_id = e.item_id
        LEFT JOIN bu ON bu.user_id = u.user_id
        WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = e.item_id)),
cfl AS (SELECT user_id, item_id, round(least(greatest(raw, 1.0), 10.0), 6) AS prediction FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(b, 9) DESC, item_id) AS r FROM cfc) WHERE r <= 20),
mmx AS (SELECT user_id, min(prediction) AS lo, max(prediction) AS hi FROM cfl GROUP BY user_id),
cfs AS (SELECT cfl.user_id, cfl.item_id,
               (prediction - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END AS cf_score FROM cfl JOIN mmx USING (user_id)),
bothx AS (SELECT coalesce(cbs.user_id, cfs.user_id) AS user_id, coalesce(cbs.item_id, cfs.item_id) AS item_id,
                 coalesce(cb_score, 0.0) AS cb_score, coalesce(cf_score, 0.0) AS cf_score
          FROM cbs FULL OUTER JOIN cfs ON cbs.user_id = cfs.user_id AND cbs.item_id = cfs.item_id),
hx AS (SELECT *, 0.4 * cb_score + 0.6 * cf_score AS hybrid_score FROM bothx),
rkx AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(hybrid_score, 9) DESC, item_id) AS INTEGER) AS rank
        FROM hx)""") + """
SELECT user_id, rank, item_id, round(cb_score, 6) AS cb_score, round(cf_score, 6) AS cf_score,
       round(hybrid_score, 6) AS hybrid_score FROM rkx WHERE rank <= 10"""


@register("hybrid_weighted_batch", BATCH_SQL, headline=True)
def hybrid_weighted_batch(spark, sf):
    """H2 for all test users at once, each with their top-rated training item:
    one plan keyed by user, no loop over queries."""
    from ranklight.functions.topk import SKEW_SALT, top_k_per_group
    cat = stages.catalogue(spark, sf)
    cb = stages.content_model(spark, sf)
    model, split = stages.baseline_model(spark, sf)
    train, test = collab.train_part(split), collab.test_part(split)
    users = test.select("user_id").distinct()
    q = top_k_per_group(train.join(users, "user_id", "left_semi"), ["user_id"],
                        [F.col("rating").desc(), F.col("item_id")], 1, salt=SKEW_SALT).select("user_id", "item_id")
    return hybrid.weighted_batch(cb, model, train, cat, q, 10, 0.0)


SWITCH_BATCH_SQL = _all_ctes("""qu AS (SELECT DISTINCT user_id FROM test),
top_item AS (SELECT user_id, item_id FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rn FROM train) WHERE rn = 1),
qs AS (SELECT qu.user_id, CASE WHEN substr(md5(CAST(qu.user_id AS VARCHAR)), 1, 1) < '8' THEN t.item_id END AS q_item
       FROM qu LEFT JOIN top_item t USING (user_id)),
ntr AS (SELECT user_id, count(*) AS n_train FROM train GROUP BY user_id),
route AS (SELECT qs.*, q_item IS NULL AND coalesce(n_train, 0) >= 10 AS use_cf FROM qs LEFT JOIN ntr USING (user_id)),
cbq AS (SELECT a.doc_id AS q_item, b.doc_id AS item_id, sum(a.w * b.w) AS sim FROM weights a JOIN weights b USING (term)
        WHERE a.doc_id IN (SELECT q_item FROM route WHERE NOT use_cf AND q_item IS NOT NULL) AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id),
cbl AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY q_item ORDER BY round(sim, 9) DESC, item_id) AS INTEGER) AS r
                       FROM cbq WHERE round(sim, 9) > 0) WHERE r <= 10),
cfu AS (SELECT user_id FROM route WHERE use_cf),
cfc AS (SELECT u.user_id, e.item_id, (SELECT mu FROM mu) + coalesce(bu.b_u, 0) + coalesce(bi.b_i, 0) AS raw,
               coalesce(bi.b_i, 0) AS b
        FROM cfu u JOIN (SELECT item_id FROM catalogue) e ON TRUE LEFT JOIN bi ON bi.item_id = e.item_id
        LEFT JOIN bu ON bu.user_id = u.user_id
        WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = e.item_id)),
cfl AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(b, 9) DESC, item_id) AS INTEGER) AS r
                       FROM cfc) WHERE r <= 10)""") + """
SELECT route.user_id, 'content' AS source, cbl.r AS rank, cbl.item_id, round(cbl.sim, 6) AS score_value
FROM route JOIN cbl ON cbl.q_item = route.q_item WHERE NOT route.use_cf
UNION ALL
SELECT user_id, 'collaborative', r, item_id, round(least(greatest(raw, 1.0), 10.0), 6) FROM cfl"""


@register("hybrid_switching_batch", SWITCH_BATCH_SQL)
def hybrid_switching_batch(spark, sf):
    """H3 for all test users at once: about half come with their top-rated
    training item (routed to content), the others go to CF when warm."""
    from ranklight.functions.topk import SKEW_SALT, top_k_per_group
    cat = stages.catalogue(spark, sf)
    cb = stages.content_model(spark, sf)
    model, split = stages.baseline_model(spark, sf)
    train, test = collab.train_part(split), collab.test_part(split)
    users = test.select("user_id").distinct()
    top = top_k_per_group(train, ["user_id"], [F.col("rating").desc(), F.col("item_id")], 1, salt=SKEW_SALT) \
        .select("user_id", F.col("item_id").alias("top_item"))
    q = users.join(top, "user_id", "left").select(
        "user_id", F.when(F.substring(F.md5(F.col("user_id").cast("string")), 1, 1) < F.lit("8"),
                          F.col("top_item")).alias("item_id"))
    return hybrid.switching_batch(cb, model, train, cat, q, 10, 0.0)


MIXED_BATCH_SQL = _all_ctes("""qu AS (SELECT DISTINCT user_id FROM test),
qi AS (SELECT user_id, item_id AS q_item FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rn FROM train
         WHERE user_id IN (SELECT user_id FROM qu)) WHERE rn = 1),
cbq AS (SELECT a.doc_id AS q_item, b.doc_id AS item_id, sum(a.w * b.w) AS sim FROM weights a JOIN weights b USING (term)
        WHERE a.doc_id IN (SELECT q_item FROM qi) AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
cbl AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY q_item ORDER BY round(sim, 9) DESC, item_id) AS INTEGER) AS r
                       FROM cbq WHERE round(sim, 9) > 0) WHERE r <= 5),
picks AS (SELECT qi.user_id, cbl.item_id, cbl.r AS position FROM qi JOIN cbl USING (q_item)),
cfc AS (SELECT u.user_id, e.item_id, coalesce(bi.b_i, 0) AS b
        FROM qu u JOIN (SELECT item_id FROM catalogue) e ON TRUE LEFT JOIN bi ON bi.item_id = e.item_id
        WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = e.item_id)),
cfl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(b, 9) DESC, item_id) AS r
                       FROM cfc) WHERE r <= 10),
kept AS (SELECT * FROM (
  SELECT cfl.*, row_number() OVER (PARTITION BY user_id ORDER BY r) AS r2 FROM cfl
  WHERE NOT EXISTS (SELECT 1 FROM picks p WHERE p.user_id = cfl.user_id AND p.item_id = cfl.item_id)) WHERE r2 <= 5),
np AS (SELECT user_id, count(*) AS n_picks FROM picks GROUP BY user_id)""") + """
SELECT user_id, position, item_id, 'content' AS source FROM picks
UNION ALL
SELECT k.user_id, CAST(coalesce(np.n_picks, 0) + k.r2 AS INTEGER), k.item_id, 'collaborative'
FROM kept k LEFT JOIN np USING (user_id)"""


@register("hybrid_mixed_batch", MIXED_BATCH_SQL)
def hybrid_mixed_batch(spark, sf):
    """H4 for all test users at once (5 content picks from their top-rated
    training item, then up to 5 CF picks from a list of 10)."""
    from ranklight.functions.topk import SKEW_SALT, top_k_per_group
    cat = stages.catalogue(spark, sf)
    cb = stages.content_model(spark, sf)
    model, split = stages.baseline_model(spark, sf)
    train, test = collab.train_part(split), collab.test_part(split)
    users = test.select("user_id").distinct()
    q = top_k_per_group(train.join(users, "user_id", "left_semi"), ["user_id"],
                        [F.col("rating").desc(), F.col("item_id")], 1, salt=SKEW_SALT).select("user_id", "item_id")
    return hybrid.mixed_batch(cb, model, train, cat, q, 10, 0.0, 0.5)
