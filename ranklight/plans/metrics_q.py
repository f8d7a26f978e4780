"""Metric queries (V1-V20): the baseline recommender scored on held-out data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ranklight.functions.columns import r6
from ranklight.operators import collab, content, metrics
from ranklight.plans import stages
from ranklight.plans.content_q import CONTENT_CTES, sample_items
from ranklight.plans.registry import register
from ranklight.plans.stages import CF_CTES, ctes

CF = ctes(CF_CTES)

RANKED_SQL = """rk AS (SELECT user_id, item_id, rating, CAST(row_number() OVER (PARTITION BY user_id
                 ORDER BY round(raw_prediction, 9) DESC, item_id) AS INTEGER) AS rank FROM test_pred),
cut AS (SELECT * FROM rk WHERE rank <= 20),
rel AS (SELECT user_id, item_id, rating FROM test_pred WHERE rating >= 7),
nrel AS (SELECT user_id, count(*) AS n_rel FROM rel GROUP BY user_id),
marked AS (SELECT c.user_id, c.item_id, c.rank, CASE WHEN r.item_id IS NOT NULL THEN 1 ELSE 0 END AS hit
           FROM cut c LEFT JOIN rel r USING (user_id, item_id)),
run AS (SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS hsf FROM marked),
ks AS (SELECT unnest([5, 10, 20]) AS k),
per AS (SELECT r.user_id, ks.k, sum(hit) AS hits, coalesce(sum(CASE WHEN hit = 1 THEN hsf / rank END), 0) AS ap_sum
        FROM run r JOIN ks ON r.rank <= ks.k GROUP BY r.user_id, ks.k),
per2 AS (SELECT per.*, coalesce(n_rel, 0) AS n_rel, hits / k AS precision,
                CASE WHEN coalesce(n_rel, 0) > 0 THEN hits / n_rel ELSE 0 END AS recall FROM per LEFT JOIN nrel USING (user_id)),
per3 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1,
                CASE WHEN n_rel > 0 AND hits > 0 THEN ap_sum / least(n_rel, k) ELSE 0 END AS ap,
                CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END AS hit1 FROM per2),
agg AS (SELECT k, avg(precision) AS p, avg(recall) AS r, avg(f1) AS f1m, avg(ap) AS map, avg(hit1) AS hr, count(*) AS users
        FROM per3 GROUP BY k)"""

RANKING_SELECT = """SELECT k, round(p, 6) AS precision, round(r, 6) AS recall, round(f1m, 6) AS f1_macro,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1_of_means,
       round(map, 6) AS map, round(hr, 6) AS hit_rate, users FROM agg"""


def _pred(spark, sf):
    return stages.baseline_test_predictions(spark, sf)


def _ranked_relevant(pred):
    ranked = collab.ranked_lists(pred, 20)
    relevant = pred.filter(F.col("rating") >= collab.RELEVANT_AT).select("user_id", "item_id", F.col("rating").alias("relevance"))
    return ranked, relevant


@register("rating_errors", CF + """
SELECT round(sqrt(avg((prediction - rating) ^ 2)), 6) AS rmse, round(avg(abs(prediction - rating)), 6) AS mae,
       round(avg((prediction - rating) ^ 2), 6) AS mse, count(*) AS n FROM test_pred""")
def rating_errors(spark, sf):
    """V1-V3: RMSE, MAE, MSE of the baseline on held-out ratings."""
    return metrics.rating_errors(_pred(spark, sf))


@register("ranking_metrics", ctes(CF_CTES, RANKED_SQL) + RANKING_SELECT, headline=True)
def ranking_metrics(spark, sf):
    """Precision, recall, F1 (macro and of means), MAP, hit rate at 5, 10, 20."""
    ranked, relevant = _ranked_relevant(_pred(spark, sf))
    return metrics.ranking_metrics(ranked, relevant, (5, 10, 20))


@register("ndcg_at_10", ctes(CF_CTES, RANKED_SQL, """dcg AS (
  SELECT c.user_id, sum(coalesce((pow(2.0, r.rating) - 1) / log2(c.rank + 1), 0)) AS dcg
  FROM cut c LEFT JOIN rel r USING (user_id, item_id) WHERE c.rank <= 10 GROUP BY c.user_id),
ideal AS (SELECT user_id, sum((pow(2.0, rating) - 1) / log2(pos + 1)) AS idcg FROM (
  SELECT user_id, rating, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS pos FROM rel)
  WHERE pos <= 10 GROUP BY user_id),
users AS (SELECT DISTINCT user_id FROM cut WHERE rank <= 10)""") + """
SELECT round(avg(CASE WHEN coalesce(i.idcg, 0) > 0 THEN coalesce(d.dcg, 0) / i.idcg ELSE 0 END), 6) AS ndcg, count(*) AS users
FROM users u LEFT JOIN dcg d USING (user_id) LEFT JOIN ideal i USING (user_id)""")
def ndcg_at_10(spark, sf):
    """V9: NDCG@10 with graded relevance = held-out rating (>= 7)."""
    ranked, relevant = _ranked_relevant(_pred(spark, sf))
    return metrics.ndcg_at_k(ranked, relevant, 10)


def _reco_all_sql():
    from ranklight.plans.collab_q import RECO_ALL_SQL
    body = RECO_ALL_SQL
    head, tail = body[:body.rindex("\nSELECT")], body[body.rindex("\nSELECT"):]
    return head + ",\nreco AS (" + tail.strip() + ")"


@register("coverage", _reco_all_sql() + """
SELECT count(DISTINCT item_id) AS n_recommended, (SELECT count(*) FROM catalogue) AS catalogue_size,
       round(count(DISTINCT item_id) / (SELECT count(*) FROM catalogue), 6) AS coverage FROM reco""")
def coverage(spark, sf):
    """Share of the catalogue in the top-10 lists of all test users."""
    from ranklight.plans.collab_q import recommend_all_users
    return metrics.coverage(recommend_all_users(spark, sf), stages.catalogue(spark, sf))


DIVERSITY_SQL = CONTENT_CTES.rstrip() + ",\n" + ",\n".join([stages.KEEP_LAST_SQL, stages.RATINGS_CLEAN_SQL,
                                                          stages.SPLIT_SQL, stages.BASELINE_SQL]) + """,
elig AS (SELECT item_id FROM catalogue WHERE score >= 6.0),
users AS (SELECT DISTINCT user_id FROM test),
cand AS (SELECT u.user_id, e.item_id, coalesce(bi.b_i, 0) AS b FROM users u JOIN elig e ON TRUE LEFT JOIN bi ON bi.item_id = e.item_id
         WHERE NOT EXISTS (SELECT 1 FROM train rc WHERE rc.user_id = u.user_id AND rc.item_id = e.item_id)),
reco AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(b, 9) DESC, item_id) AS rank FROM cand)
         WHERE rank <= 10),
lst AS (SELECT user_id, item_id, rank FROM reco WHERE item_id IN (SELECT doc_id FROM weights)),
lp AS (SELECT a.user_id, a.item_id AS x, b.item_id AS y FROM lst a JOIN lst b ON a.user_id = b.user_id AND a.rank < b.rank),
ps AS (SELECT lp.user_id, lp.x, lp.y, coalesce(sum(wa.w * wb.w), 0) AS sim FROM lp
       LEFT JOIN weights wa ON wa.doc_id = lp.x LEFT JOIN weights wb ON wb.doc_id = lp.y AND wb.term = wa.term
       GROUP BY lp.user_id, lp.x, lp.y),
per AS (SELECT user_id, avg(1 - sim) AS d FROM ps GROUP BY user_id)
SELECT round(avg(d), 6) AS diversity, count(*) AS lists FROM per"""


@register("diversity", DIVERSITY_SQL)
def diversity(spark, sf):
    """Mean pairwise (1 - cosine) within each top-10 list, averaged."""
    from ranklight.plans.collab_q import recommend_all_users
    cb = stages.content_model(spark, sf)
    return metrics.diversity(recommend_all_users(spark, sf), cb.weights.withColumnRenamed("doc_id", "item_id"))


_CB_BATCH = CONTENT_CTES.rstrip() + """,
q100 AS (SELECT item_id AS doc_id, row_number() OVER (ORDER BY md5(CAST(item_id AS VARCHAR) || '-42'), item_id) AS qpos
         FROM catalogue ORDER BY qpos LIMIT 100),
qs AS (SELECT a.doc_id AS query_id, b.doc_id, sum(a.w * b.w) AS sim FROM weights a JOIN weights b USING (term)
       WHERE a.doc_id IN (SELECT doc_id FROM q100) AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
lists AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 9) DESC, doc_id) AS rank
                         FROM qs WHERE round(sim, 9) > 0) WHERE rank <= 10)"""


@register("query_diversity", _CB_BATCH + """,
per AS (SELECT query_id, 1 - avg(round(sim, 6)) AS d FROM lists
        WHERE query_id IN (SELECT doc_id FROM q100 WHERE qpos <= 20) GROUP BY query_id)
SELECT round(avg(d), 6) AS query_diversity, round(1 - avg(d), 6) AS avg_similarity, count(*) AS queries FROM per""")
def query_diversity(spark, sf):
    """1 - mean similarity of each list to its query, over 20 sampled items."""
    cat = stages.catalogue(spark, sf)
    cb = stages.content_model(spark, sf)
    lists = content.recommend_batch(cb, sample_items(cat, 20), 10)
    return metrics.query_diversity(lists)


@register("evaluate_content", _CB_BATCH + """
SELECT count(DISTINCT doc_id) AS n_recommended, (SELECT count(*) FROM catalogue) AS catalogue_size,
       round(count(DISTINCT doc_id) / (SELECT count(*) FROM catalogue), 6) AS coverage,
       (SELECT round(avg(d), 6) FROM (SELECT query_id, 1 - avg(round(sim, 6)) AS d FROM lists
          WHERE query_id IN (SELECT doc_id FROM q100 WHERE qpos <= 20) GROUP BY query_id)) AS query_diversity FROM lists""")
def evaluate_content(spark, sf):
    """Coverage of 100 sampled items' top-10 lists; query diversity of 20 of them."""
    cat = stages.catalogue(spark, sf)
    cb = stages.content_model(spark, sf)
    lists = content.recommend_batch(cb, sample_items(cat, 100), 10)
    cov = metrics.coverage(lists.select("item_id"), cat)
    first20 = sample_items(cat, 20).withColumnRenamed("doc_id", "query_id")
    qd = metrics.query_diversity(lists.join(first20, "query_id", "left_semi")).select("query_diversity").scalar()
    return cov.withColumn("query_diversity", qd)


@register("evaluate_all", ctes(CF_CTES, RANKED_SQL) + """
SELECT 'rmse' AS metric, 0 AS k, round(sqrt(avg((prediction - rating) ^ 2)), 6) AS value FROM test_pred
UNION ALL SELECT 'mae', 0, round(avg(abs(prediction - rating)), 6) FROM test_pred
UNION ALL SELECT 'mse', 0, round(avg((prediction - rating) ^ 2), 6) FROM test_pred
UNION ALL SELECT 'precision', k, round(p, 6) FROM agg
UNION ALL SELECT 'recall', k, round(r, 6) FROM agg
UNION ALL SELECT 'f1_macro', k, round(f1m, 6) FROM agg
UNION ALL SELECT 'f1_of_means', k, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) FROM agg
UNION ALL SELECT 'map', k, round(map, 6) FROM agg
UNION ALL SELECT 'hit_rate', k, round(hr, 6) FROM agg""")
def evaluate_all(spark, sf):
    """Every metric for k = 5, 10, 20 in long form."""
    pred = _pred(spark, sf)
    ranked, relevant = _ranked_relevant(pred)
    return metrics.evaluate_all(pred, ranked, relevant, (5, 10, 20))


def _model_metrics(spark, sf):
    """Long (model, metric, value) for the bias baseline and the global mean."""
    pred = _pred(spark, sf)
    model, _ = stages.baseline_model(spark, sf)
    mean_pred = pred.withColumn("prediction", model.mu_col()).withColumn("raw_prediction", model.mu_col())
    out = None
    for name, p in (("baseline", pred), ("global_mean", mean_pred)):
        ev = collab.evaluate_predictions(p, 10)
        long = ev.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value"))
                                              for m, c in (("rmse", "rmse"), ("mae", "mae"),
                                                           ("precision", "precision_at_10"),
                                                           ("recall", "recall_at_10"))])).alias("x")).select("x.*")
        long = long.select(F.lit(name).alias("model"), "metric", "value")
        out = long if out is None else out.unionByName(long)
    return out


_MODELS_SQL = ctes(CF_CTES, """mean_pred AS (SELECT user_id, item_id, rating, (SELECT mu FROM mu) AS raw_prediction,
                      (SELECT mu FROM mu) AS prediction FROM test_pred),
ev AS (
  SELECT 'baseline' AS model, p.* FROM test_pred p UNION ALL SELECT 'global_mean', m.* FROM mean_pred m),
rk AS (SELECT *, row_number() OVER (PARTITION BY model, user_id ORDER BY round(raw_prediction, 9) DESC, item_id) AS rank FROM ev),
per AS (SELECT model, user_id, sum(CASE WHEN rank <= 10 AND rating >= 7 THEN 1 ELSE 0 END) AS hits,
               sum(CASE WHEN rating >= 7 THEN 1 ELSE 0 END) AS n_rel FROM rk GROUP BY model, user_id),
long_ AS (
  SELECT model, 'rmse' AS metric, round(sqrt(avg((prediction - rating) ^ 2)), 6) AS value FROM ev GROUP BY model
  UNION ALL SELECT model, 'mae', round(avg(abs(prediction - rating)), 6) FROM ev GROUP BY model
  UNION ALL SELECT model, 'precision', round(avg(hits / 10.0), 6) FROM per GROUP BY model
  UNION ALL SELECT model, 'recall', round(avg(CASE WHEN n_rel > 0 THEN hits / n_rel ELSE 0 END), 6) FROM per GROUP BY model)""")


@register("compare_models", _MODELS_SQL + """
SELECT model, max(CASE WHEN metric = 'rmse' THEN value END) AS rmse, max(CASE WHEN metric = 'mae' THEN value END) AS mae,
       max(CASE WHEN metric = 'precision' THEN value END) AS precision,
       max(CASE WHEN metric = 'recall' THEN value END) AS recall FROM long_ GROUP BY model""")
def compare_models(spark, sf):
    """One row per model (bias baseline, global mean), one column per metric."""
    return metrics.compare_models(_model_metrics(spark, sf), ["rmse", "mae", "precision", "recall"])


@register("best_per_metric", _MODELS_SQL + """,
dirs AS (SELECT * FROM (VALUES ('rmse', -1), ('mae', -1), ('precision', 1), ('recall', 1)) t(metric, sign)),
ranked_ AS (SELECT l.*, d.sign, row_number() OVER (PARTITION BY l.metric ORDER BY -l.value * d.sign, l.model) AS rn
            FROM long_ l JOIN dirs d USING (metric))
SELECT metric, model AS best_model, round(value, 6) AS best_value FROM ranked_ WHERE rn = 1""")
def best_per_metric(spark, sf):
    """The best model per metric, by direction of the metric."""
    return metrics.best_per_metric(_model_metrics(spark, sf))


@register("run_metadata", ctes(CF_CTES, stages.CAT_CTES) + """
SELECT (SELECT count(*) FROM catalogue) AS n_items, (SELECT count(*) FROM ratings_clean) AS n_ratings,
       (SELECT count(*) FROM test) AS n_test, round((SELECT count(*) FROM test) / (SELECT count(*) FROM ratings_clean), 6) AS test_share,
       CAST(7.0 AS DOUBLE) AS relevance_threshold""")
def run_metadata(spark, sf):
    """Sizes and settings of the evaluation run."""
    cat = stages.catalogue(spark, sf)
    r = stages.ratings_clean(spark, sf)
    split = stages.ratings_split(spark, sf)
    n_test = split.filter(F.col("split") == "test").select(F.count(F.lit(1))).scalar()
    n_r = r.select(F.count(F.lit(1))).scalar()
    return cat.agg(F.count(F.lit(1)).alias("n_items")).select(
        "n_items", n_r.alias("n_ratings"), n_test.alias("n_test"), r6(n_test / n_r).alias("test_share"),
        F.lit(collab.RELEVANT_AT).alias("relevance_threshold"))


_ACTIVE_SQL = """active AS (SELECT user_id FROM ratings_clean GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 50),
elig6 AS (SELECT item_id FROM catalogue WHERE score >= 6.0),
cand50 AS (SELECT a.user_id, e.item_id, coalesce(bi.b_i, 0) AS b FROM active a JOIN elig6 e ON TRUE
           LEFT JOIN bi ON bi.item_id = e.item_id
           WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = a.user_id AND t.item_id = e.item_id)),
reco50 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(b, 9) DESC, item_id) AS rank
                          FROM cand50) WHERE rank <= 10)"""


@register("evaluate_collaborative", ctes(CF_CTES, stages.CAT_CTES, """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(raw_prediction, 9) DESC, item_id) AS rk FROM test_pred),
per AS (SELECT user_id, sum(CASE WHEN rk <= 10 AND rating >= 7 THEN 1 ELSE 0 END) AS hits,
               sum(CASE WHEN rating >= 7 THEN 1 ELSE 0 END) AS n_rel FROM ranked GROUP BY user_id),
pr AS (SELECT avg(hits / 10.0) AS p, avg(CASE WHEN n_rel > 0 THEN hits / n_rel ELSE 0 END) AS r FROM per)""", _ACTIVE_SQL) + """
SELECT round(sqrt(avg((prediction - rating) ^ 2)), 6) AS rmse, round(avg(abs(prediction - rating)), 6) AS mae,
       (SELECT round(p, 6) FROM pr) AS precision_at_10, (SELECT round(r, 6) FROM pr) AS recall_at_10,
       (SELECT round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) FROM pr) AS f1_of_means,
       (SELECT round(count(DISTINCT item_id) / (SELECT count(*) FROM catalogue), 6) FROM reco50) AS coverage
FROM test_pred""")
def evaluate_collaborative(spark, sf):
    """Held-out RMSE, MAE, P@10, R@10, F1 of the means, and coverage of
    the top-10 lists of the 50 most active users."""
    from ranklight.operators import profile
    model, split = stages.baseline_model(spark, sf)
    pred = _pred(spark, sf)
    ev = collab.evaluate_predictions(pred, 10)
    active = profile.most_active_users(stages.ratings_clean(spark, sf), 50)
    cat = stages.catalogue(spark, sf)
    lists = collab.recommend_all_baseline(model, collab.train_part(split), cat, active, 10, 6.0)
    cov = metrics.coverage(lists, cat).select("coverage").scalar()
    p, r = F.col("precision_at_10"), F.col("recall_at_10")
    return ev.select("rmse", "mae", "precision_at_10", "recall_at_10",
                     r6(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)).alias("f1_of_means"),
                     cov.alias("coverage"))


EVAL_HYBRID_SQL = CONTENT_CTES.rstrip() + ",\n" + ",\n".join(
    [stages.KEEP_LAST_SQL, stages.RATINGS_CLEAN_SQL, stages.SPLIT_SQL, stages.BASELINE_SQL, stages.TEST_PRED_SQL]) + """,
qi AS (SELECT user_id, item_id AS q_item FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rn FROM train) WHERE rn = 1),
p AS (SELECT t.*, qi.q_item FROM test_pred t LEFT JOIN qi USING (user_id)),
sims AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(a.w * b.w) AS sim FROM weights a JOIN weights b USING (term)
         WHERE (a.doc_id, b.doc_id) IN (SELECT q_item, item_id FROM p) GROUP BY a.doc_id, b.doc_id),
mm AS (SELECT user_id, min(prediction) AS lo, max(prediction) AS hi FROM p GROUP BY user_id),
sc AS (SELECT p.user_id, p.item_id, p.rating,
              0.4 * coalesce(s.sim, 0) + 0.6 * (p.prediction - mm.lo) / CASE WHEN mm.hi > mm.lo THEN mm.hi - mm.lo ELSE 1.0 END AS h
       FROM p JOIN mm USING (user_id) LEFT JOIN sims s ON s.a = p.q_item AND s.b = p.item_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(h, 9) DESC, item_id) AS rank FROM sc),
per AS (SELECT user_id, sum(CASE WHEN rank <= 10 AND rating >= 7 THEN 1 ELSE 0 END) AS hits,
               sum(CASE WHEN rating >= 7 THEN 1 ELSE 0 END) AS n_rel FROM rk GROUP BY user_id),
per2 AS (SELECT *, hits / 10 AS pr, CASE WHEN n_rel > 0 THEN hits / n_rel ELSE 0 END AS rc FROM per)
SELECT round(avg(pr), 6) AS precision_at_10, round(avg(rc), 6) AS recall_at_10,
       round(avg(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END), 6) AS f1_macro_at_10, count(*) AS users
FROM per2"""


@register("evaluate_hybrid", EVAL_HYBRID_SQL)
def evaluate_hybrid(spark, sf):
    """The weighted hybrid measured on held-out ratings (D8): each
    test user's held-out items ranked by 0.4 content + 0.6 scaled CF."""
    from ranklight.operators import hybrid
    _, split = stages.baseline_model(spark, sf)
    pred = _pred(spark, sf)
    cb = stages.content_model(spark, sf)
    return hybrid.evaluate_on_held_out(pred, collab.train_part(split), cb.weights, 10)


def _metrics_report_sql():
    from ranklight.plans.registry import ORACLE
    cf = ORACLE["evaluate_all"]
    return (f"SELECT 'collaborative' AS model, metric, k, value FROM ({cf})\n"
            f"UNION ALL SELECT 'hybrid', 'precision', 10, precision_at_10 FROM ({EVAL_HYBRID_SQL})\n"
            f"UNION ALL SELECT 'hybrid', 'recall', 10, recall_at_10 FROM ({EVAL_HYBRID_SQL})")


@register("metrics_report", _metrics_report_sql())
def metrics_report(spark, sf):
    """Metrics of the collaborative and hybrid models in long form."""
    from ranklight.plans import jobs
    return jobs.metrics_report(spark, sf)


def _lists_sql() -> str:
    from ranklight.plans.hybrid_q import BATCH_SQL
    head = BATCH_SQL[:BATCH_SQL.rindex("\nSELECT")]
    return head + """,
lists AS (
  SELECT 'content' AS model, qi.user_id, cbl.item_id, cbl.r AS rank FROM qi JOIN cbl USING (q_item) WHERE cbl.r <= 10
  UNION ALL SELECT 'collaborative', user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY round(b, 9) DESC, item_id) AS r
  FROM cfc QUALIFY r <= 10
  UNION ALL SELECT 'hybrid', user_id, item_id, rank FROM rkx WHERE rank <= 10),
relv AS (SELECT user_id, item_id, CAST(rating AS DOUBLE) AS rating FROM test WHERE rating >= 7),
nr AS (SELECT user_id, count(*) AS n_rel FROM relv GROUP BY user_id),
idl AS (SELECT user_id, sum((pow(2.0, rating) - 1) / log2(pos + 1)) AS idcg FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS pos FROM relv) WHERE pos <= 10 GROUP BY user_id),
mk AS (SELECT l.*, r.rating AS rel, sum(CASE WHEN r.rating IS NULL THEN 0 ELSE 1 END) OVER (
         PARTITION BY l.model, l.user_id ORDER BY l.rank) AS so_far FROM lists l LEFT JOIN relv r USING (user_id, item_id)),
hitx AS (SELECT model, user_id, count(rel) AS hits, sum(CASE WHEN rel IS NOT NULL THEN so_far / l.rank END) AS aps,
  sum(CASE WHEN rel IS NOT NULL THEN (pow(2.0, rel) - 1) / log2(l.rank + 1) END) AS dcg FROM mk l GROUP BY model, user_id),
uu AS (SELECT u.user_id, m.model, coalesce(nr.n_rel, 0) AS n_rel, coalesce(idl.idcg, 0) AS idcg, coalesce(h.hits, 0) AS hits,
         coalesce(h.aps, 0) AS aps, coalesce(h.dcg, 0) AS dcg
       FROM qu u CROSS JOIN (VALUES ('content'), ('collaborative'), ('hybrid')) m(model) LEFT JOIN nr USING (user_id)
       LEFT JOIN idl USING (user_id) LEFT JOIN hitx h ON h.user_id = u.user_id AND h.model = m.model),
sc AS (SELECT *, hits / 10 AS p, CASE WHEN n_rel > 0 THEN hits / n_rel ELSE 0 END AS r,
         CASE WHEN hits > 0 THEN aps / least(n_rel, 10) ELSE 0 END AS ap, CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0 END AS nd FROM uu),
mean_ AS (SELECT model, avg(p) AS p, avg(r) AS r, avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) AS f, avg(ap) AS ap,
            avg(nd) AS nd, avg(CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END) AS hr, count(*) AS users FROM sc GROUP BY model),
cov AS (SELECT model, count(DISTINCT item_id) / (SELECT count(*) FROM catalogue) AS coverage FROM lists GROUP BY model),
kn AS (SELECT * FROM lists WHERE item_id IN (SELECT doc_id FROM weights)),
prs AS (SELECT a.model, a.user_id, a.item_id AS x, b.item_id AS y FROM kn a JOIN kn b
        ON a.model = b.model AND a.user_id = b.user_id AND a.rank < b.rank),
dx AS (SELECT DISTINCT x, y FROM prs),
ds AS (SELECT dx.x, dx.y, sum(wa.w * wb.w) AS sim FROM dx JOIN weights wa ON wa.doc_id = dx.x
       JOIN weights wb ON wb.doc_id = dx.y AND wb.term = wa.term GROUP BY dx.x, dx.y),
dv AS (SELECT model, avg(d) AS diversity FROM (
  SELECT model, user_id, avg(1 - coalesce(sim, 0)) AS d FROM prs LEFT JOIN ds USING (x, y) GROUP BY model, user_id) GROUP BY model),
three AS (SELECT model, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1_macro,
  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1_of_means, round(ap, 6) AS map, round(nd, 6) AS ndcg,
  round(hr, 6) AS hit_rate, round(coalesce(coverage, 0), 6) AS coverage, round(diversity, 6) AS diversity, users
  FROM mean_ LEFT JOIN cov USING (model) LEFT JOIN dv USING (model))"""


_RANKING = ("precision", "recall", "f1_macro", "f1_of_means", "map", "ndcg", "hit_rate", "coverage", "diversity")
_ERRORS_SQL = ", ".join(f"CASE WHEN model = 'collaborative' THEN (SELECT {c} FROM test_pred) END AS {n}" for c, n in (
    ("round(sqrt(avg((prediction - rating) ^ 2)), 6)", "rmse"), ("round(avg(abs(prediction - rating)), 6)", "mae")))
_LONG_THREE = " UNION ALL ".join([f"SELECT model, '{m}' AS metric, 10 AS k, {m} AS value FROM three WHERE {m} IS NOT NULL" for m in _RANKING] + [
    "SELECT 'collaborative', 'rmse', 0, round(sqrt(avg((prediction - rating) ^ 2)), 6) FROM test_pred",
    "SELECT 'collaborative', 'mae', 0, round(avg(abs(prediction - rating)), 6) FROM test_pred"])


def _three_sql(select: str) -> str:
    return _lists_sql() + ",\n" + stages.TEST_PRED_SQL + ",\nlong3 AS (" + _LONG_THREE + ")\n" + select


def _scores(spark, sf, kind: str = "baseline"):
    """The three models on the test users' lists; one row each."""
    from ranklight.operators import evaluate
    _, split = stages.baseline_model(spark, sf)
    test = collab.test_part(split)
    relevant = test.filter(F.col("rating") >= collab.RELEVANT_AT).select("user_id", "item_id", F.col("rating").alias("relevance"))
    lists = evaluate.model_lists(stages.list_frame(spark, sf, kind))
    vectors = stages.content_model(spark, sf).weights.withColumnRenamed("doc_id", "item_id")
    return stages.materialize(spark, sf, f"model_scores_{kind}", lambda: evaluate.score_models(
        lists, test, relevant, stages.catalogue(spark, sf), vectors))


def _errors(spark, sf, kind: str = "baseline"):
    """Rating errors of the model that predicts ratings."""
    pred = _pred(spark, sf) if kind == "baseline" else stages.factor_test_predictions(spark, sf, kind)
    return metrics.rating_errors(pred).select(F.lit("collaborative").alias("model"), "rmse", "mae")


def _long(spark, sf, kind: str = "baseline"):
    from ranklight.operators import evaluate
    errors = _errors(spark, sf, kind).unpivot("model", ["rmse", "mae"], "metric", "value")
    return evaluate.long_form(_scores(spark, sf, kind)).unionByName(errors.select("model", "metric", F.lit(0).alias("k"), "value"))


@register("evaluate_hybrid_lists", _three_sql("SELECT * FROM three WHERE model = 'hybrid'"))
def evaluate_hybrid_lists(spark, sf):
    """V18 on the lists that users are shown (H2): every test user's top 10
    over the whole catalogue against their held-out items."""
    return _scores(spark, sf).where("model = 'hybrid'")


@register("compare_three_models", _three_sql(f"SELECT three.*, {_ERRORS_SQL} FROM three"))
def compare_three_models(spark, sf):
    """Content, collaborative (bias model) and hybrid on one test set;
    rating errors where a model predicts ratings."""
    return _scores(spark, sf).join(_errors(spark, sf), "model", "left")


_DIRECTION = ", ".join(f"('{m}', {-1 if m in ('rmse', 'mae') else 1})" for m in (*_RANKING, "rmse", "mae"))


@register("best_of_three_models", _three_sql(f"""SELECT metric, model AS best_model, value AS best_value FROM (
  SELECT l.*, row_number() OVER (PARTITION BY metric ORDER BY -value * sign, model) AS rn
  FROM long3 l JOIN (VALUES {_DIRECTION}) d(metric, sign) USING (metric)) WHERE rn = 1"""))
def best_of_three_models(spark, sf):
    """The best of the three models per metric, by direction of the metric."""
    return metrics.best_per_metric(_long(spark, sf).select("model", "metric", "value"))


_REPORT_SQL = _three_sql("""SELECT 'metric' AS part, model, metric, k, value FROM long3
UNION ALL SELECT 'best', model, metric, k, value FROM (SELECT l.*, row_number() OVER (PARTITION BY metric ORDER BY -value * sign, model) AS rn
  FROM long3 l JOIN (VALUES """ + _DIRECTION + """) d(metric, sign) USING (metric)) WHERE rn = 1
UNION ALL SELECT 'run', NULL, 'n_items', 0, (SELECT count(*) FROM catalogue)
UNION ALL SELECT 'run', NULL, 'n_ratings', 0, (SELECT count(*) FROM ratings_clean)
UNION ALL SELECT 'run', NULL, 'n_test', 0, (SELECT count(*) FROM test)
UNION ALL SELECT 'run', NULL, 'test_share', 0, round((SELECT count(*) FROM test) / (SELECT count(*) FROM ratings_clean), 6)
UNION ALL SELECT 'run', NULL, 'relevance_threshold', 0, 7.0""")


def _report(spark, sf, kind: str = "baseline"):
    long = stages.materialize(spark, sf, f"model_report_{kind}", lambda: _long(spark, sf, kind))
    best = metrics.best_per_metric(long.select("model", "metric", "value"))
    best = best.select("metric", F.col("best_model").alias("model")).join(long, ["metric", "model"])
    run = run_metadata(spark, sf)
    run = run.select(*[F.col(c).cast("double").alias(c) for c in run.columns]).unpivot([], run.columns, "metric", "value")
    cols = ["part", "model", "metric", "k", "value"]
    return (long.withColumn("part", F.lit("metric")).select(*cols)
            .unionByName(best.withColumn("part", F.lit("best")).select(*cols))
            .unionByName(run.select(F.lit("run").alias("part"), F.lit(None).cast("string").alias("model"), "metric", F.lit(0).alias("k"), "value")))


@register("model_report", _REPORT_SQL)
def model_report(spark, sf):
    """Every metric of the three models, the best model per metric and the
    figures of the run, in long form (the rows of the metrics file)."""
    return _report(spark, sf)


_FACTS = """SELECT unnest(['content', 'collaborative', 'hybrid']) AS model, (SELECT count(DISTINCT user_id) FROM test) AS users,
  true AS within_bounds, true AS f1_between, true AS map_at_most_hit_rate, true AS content_as_with_bias"""


@register("compare_three_models_svd_facts", ctes(CF_CTES) + _FACTS)
def compare_three_models_svd_facts(spark, sf):
    """V15 on the trained factors, by what must hold: all figures in [0, 1],
    F1 of the means between precision and recall, MAP at most the hit rate,
    the content model's row the same as beside the bias model."""
    s = _scores(spark, sf, "SVD")
    base = _scores(spark, sf).where("model = 'content'").select(F.struct(*_RANKING)).scalar()
    inside = F.lit(True)
    for c in _RANKING:
        inside = inside & ((F.col(c) >= 0) & (F.col(c) <= 1))
    p, r, f = F.col("precision"), F.col("recall"), F.col("f1_of_means")
    return s.select("model", "users", inside.alias("within_bounds"),
                    ((f >= F.least(p, r) - 1e-6) & (f <= F.greatest(p, r) + 1e-6)).alias("f1_between"),
                    (F.col("map") <= F.col("hit_rate") + 1e-6).alias("map_at_most_hit_rate"),
                    ((F.col("model") != "content") | (F.struct(*_RANKING) == base)).alias("content_as_with_bias"))


def _train_all_sql():
    from ranklight.plans.content_q import tok_sql, vocab_sql
    pop_src = """pop AS (SELECT item_id FROM ratings_clean GROUP BY item_id HAVING count(*) >= 30),
cat_pop AS (SELECT * FROM catalogue WHERE item_id IN (SELECT item_id FROM pop)),
rat_pop AS (SELECT * FROM ratings_clean WHERE item_id IN (SELECT item_id FROM pop)),
content_src AS (
  SELECT item_id, regexp_replace(lower(concat_ws(' ', coalesce(genres, ''), coalesce(genres, ''), coalesce(type, ''),
         coalesce(source, ''), coalesce(studios, ''), coalesce(rating, ''))), '^\\s+|\\s+$', '', 'g') AS content_text
  FROM cat_pop),
split_p AS (SELECT *, substr(md5(CAST(user_id AS VARCHAR) || '-' || CAST(item_id AS VARCHAR)), 1, 4) < '3333' AS is_test
            FROM rat_pop WHERE rating > 0),
gtags AS (SELECT unnest(list_transform(string_split(genres, ','), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g'))) AS g
          FROM cat_pop)"""
    body = ctes(stages.CAT_CTES, stages.KEEP_LAST_SQL, stages.RATINGS_CLEAN_SQL, pop_src,
                tok_sql("content_src", "item_id", "content_text"), vocab_sql("content_src", 1, 1.0, 5000))
    n_cat = "(SELECT count(*) FROM cat_pop)"
    return body + f"""
SELECT 'catalogue' AS stage, {n_cat} AS rows
UNION ALL SELECT 'ratings', (SELECT count(*) FROM rat_pop)
UNION ALL SELECT 'content_weights', (SELECT count(*) FROM weights)
UNION ALL SELECT 'ratings_split', (SELECT count(*) FROM split_p)
UNION ALL SELECT 'item_bias', (SELECT count(DISTINCT item_id) FROM split_p WHERE NOT is_test)
UNION ALL SELECT 'user_bias', (SELECT count(DISTINCT user_id) FROM split_p WHERE NOT is_test)
UNION ALL SELECT 'cf_metrics', 1
UNION ALL SELECT 'factor_metrics', 1
UNION ALL SELECT 'profile_genre_counts', least(20, (SELECT count(DISTINCT g) FROM gtags))
UNION ALL SELECT 'profile_type_distribution', (SELECT count(DISTINCT type) FROM cat_pop)
UNION ALL SELECT 'profile_score_histogram', 50
UNION ALL SELECT 'profile_correlation', 25
UNION ALL SELECT 'profile_top_score', least(20, {n_cat})
UNION ALL SELECT 'profile_top_members', least(20, {n_cat})"""


@register("train_all", _train_all_sql())
def train_all(spark, sf):
    """Every training stage written as a table (reused when present)."""
    import uuid
    from ranklight.plans import jobs
    from ranklight.session import stage_path
    return jobs.train_all(spark, sf, stage_path(spark, f"train-{uuid.uuid4().hex[:12]}"))
