"""Collaborative-filtering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ranklight.functions.columns import r6
from ranklight.operators import collab
from ranklight.plans import stages
from ranklight.plans.registry import register
from ranklight.plans.stages import CF_CTES, ctes

# ---- M9 on M2: the flagship slice
CF_EVAL_SQL = ctes(CF_CTES, """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(raw_prediction, 9) DESC, item_id) AS rk
  FROM test_pred),
per AS (SELECT user_id, sum(CASE WHEN rk <= 10 AND rating >= 7 THEN 1 ELSE 0 END) AS hits,
               sum(CASE WHEN rating >= 7 THEN 1 ELSE 0 END) AS n_rel FROM ranked GROUP BY user_id)""") + """
SELECT round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) AS rmse,
       round(avg(abs(prediction - rating)), 6) AS mae,
       count(*) AS n_test,
       (SELECT round(avg(hits / 10.0), 6) FROM per) AS precision_at_10,
       (SELECT round(avg(CASE WHEN n_rel > 0 THEN hits / n_rel ELSE 0 END), 6) FROM per) AS recall_at_10,
       (SELECT count(*) FROM per) AS users
FROM test_pred"""


@register("cf_baseline_eval", CF_EVAL_SQL, headline=True)
def cf_baseline_eval(spark, sf):
    """Keep-last ratings -> drop watching -> hash split -> bias baseline ->
    predict held-out rows -> RMSE, MAE, P@10, R@10."""
    return collab.evaluate_predictions(stages.baseline_test_predictions(spark, sf), k=10)


@register("split_train_test", ctes(CF_CTES) + """
SELECT split, count(*) AS n, round(avg(rating), 6) AS mean_rating FROM ratings_split GROUP BY split""")
def split_train_test(spark, sf):
    """M1: sizes of the hash split."""
    s = stages.ratings_split(spark, sf)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("rating")).alias("mean_rating"))


@register("baseline_biases", ctes(CF_CTES) + """
SELECT 'item' AS kind, item_id AS id, round(b_i, 6) AS bias FROM bi
UNION ALL SELECT 'user', user_id, round(b_u, 6) FROM bu""")
def baseline_biases(spark, sf):
    """M2: the fitted item and user biases."""
    m, _ = stages.baseline_model(spark, sf)
    return (m.item_bias.select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), r6("b_i").alias("bias"))
            .unionByName(m.user_bias.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"),
                                            r6("b_u").alias("bias"))))


@register("actual_vs_predicted", ctes(CF_CTES) + """
SELECT user_id, item_id, rating AS actual, round(prediction, 6) AS predicted FROM test_pred""")
def actual_vs_predicted(spark, sf):
    """M6 + M11: predicted rating for every held-out pair."""
    return collab.actual_vs_predicted(stages.baseline_test_predictions(spark, sf))


CV_SQL = ctes(CF_CTES[:3], """r AS (
  SELECT *, CAST((instr('0123456789abcdef', substr(md5(CAST(user_id AS VARCHAR) || '-' || CAST(item_id AS VARCHAR)), 1, 1)) - 1) % 5 AS INTEGER) AS fold
  FROM ratings_clean),
tr AS (SELECT r.user_id, r.item_id, r.rating, f.f FROM r JOIN (SELECT range AS f FROM range(5)) f ON r.fold <> f.f),
mu AS (SELECT f, avg(rating) AS mu FROM tr GROUP BY f),
bi AS (SELECT f, item_id, sum(rating - mu) / (count(*) + 10.0) AS b_i FROM tr JOIN mu USING (f) GROUP BY f, item_id),
bu AS (SELECT f, user_id, sum(rating - mu - b_i) / (count(*) + 15.0) AS b_u
       FROM tr JOIN mu USING (f) JOIN bi USING (f, item_id) GROUP BY f, user_id),
pred AS (SELECT r.fold AS f, r.rating,
                least(greatest(mu.mu + coalesce(bu.b_u, 0) + coalesce(bi.b_i, 0), 1.0), 10.0) AS prediction
         FROM r JOIN mu ON mu.f = r.fold LEFT JOIN bi ON bi.f = r.fold AND bi.item_id = r.item_id
         LEFT JOIN bu ON bu.f = r.fold AND bu.user_id = r.user_id),
per AS (SELECT f, sqrt(avg((prediction - rating) ^ 2)) AS rmse, avg(abs(prediction - rating)) AS mae, count(*) AS n
        FROM pred GROUP BY f)""") + """
SELECT CAST(f AS VARCHAR) AS fold, round(rmse, 6) AS rmse, round(mae, 6) AS mae, n FROM per
UNION ALL SELECT 'mean', round(avg(rmse), 6), round(avg(mae), 6), CAST(sum(n) AS BIGINT) FROM per"""


@register("cross_validate", CV_SQL)
def cross_validate(spark, sf):
    """5-fold cross-validated RMSE / MAE of the baseline."""
    return collab.cross_validate_baseline(stages.ratings_clean(spark, sf), 5)


RECO_ALL_SQL = ctes(CF_CTES, stages.CAT_CTES, """elig AS (SELECT item_id FROM catalogue WHERE score >= 6.0),
users AS (SELECT DISTINCT user_id FROM test),
cand AS (SELECT u.user_id, e.item_id, (SELECT mu FROM mu) + coalesce(bu.b_u, 0) + coalesce(bi.b_i, 0) AS raw
         FROM users u JOIN elig e ON TRUE LEFT JOIN bi ON bi.item_id = e.item_id LEFT JOIN bu ON bu.user_id = u.user_id
         WHERE NOT EXISTS (SELECT 1 FROM train rc WHERE rc.user_id = u.user_id AND rc.item_id = e.item_id)),
rk AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(coalesce(bi_only, 0), 9) DESC, item_id) AS rank
       FROM (SELECT cand.*, bi.b_i AS bi_only FROM cand LEFT JOIN bi USING (item_id)))""") + """
SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank, round(least(greatest(raw, 1.0), 10.0), 6) AS prediction
FROM rk WHERE rank <= 10"""


@register("recommend_all_users", RECO_ALL_SQL, headline=True)
def recommend_all_users(spark, sf):
    """M8 on M2: top-10 items with score >= 6 for every test user, those the
    user rated in training left out."""
    model, split = stages.baseline_model(spark, sf)
    users = collab.test_part(split).select("user_id")
    return collab.recommend_all_baseline(model, collab.train_part(split), stages.catalogue(spark, sf),
                                         users, top_n=10, min_score=6.0)


def _user_reco_sql():
    from ranklight.plans.hybrid_q import FIRST_USER, _all_ctes, cf_sql
    return _all_ctes(cf_sql(FIRST_USER, 10, 6.0)) + "\nSELECT item_id, prediction, rank FROM cf_list"


@register("recommend_user", _user_reco_sql())
def recommend_user(spark, sf):
    """M7: top-10 unseen items with score >= 6 for one user (the first training user)."""
    model, split = stages.baseline_model(spark, sf)
    train = collab.train_part(split)
    user = train.select(F.min("user_id")).first()[0]
    return collab.recommend_user_baseline(model, train, stages.catalogue(spark, sf), user, 10, 6.0) \
        .select("item_id", "prediction", F.col("rank").cast("int").alias("rank"))
