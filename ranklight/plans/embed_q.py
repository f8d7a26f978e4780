"""Embedding, factorisation and LSA queries.

Learned results (Word2Vec vectors, ALS factors, SVD components) have no SQL
twin; their deterministic parts do (vocabulary, item vectors and neighbours
over the given embedding table), and ``*_facts`` queries state what must hold
of a trained model, which SQL derives from the tables alone.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ranklight.functions.columns import norm, r6
from ranklight.functions.index import global_row_number
from ranklight.operators import collab, embed, metrics
from ranklight.plans import stages
from ranklight.plans.registry import register
from ranklight.plans.stages import CAT_CTES, ctes
from ranklight.sources import tables

VECTOR_SIZE = 100
STRIP = "'^\\s+|\\s+$', '', 'g'"


def _w2v(spark, sf):
    return stages.catalogue(spark, sf), stages.word_vectors(spark, sf, VECTOR_SIZE)


@register("word2vec_vocabulary", ctes(CAT_CTES) + f"""
SELECT word FROM (
  SELECT unnest(list_transform(string_split(genres, ','), lambda x: replace(lower(regexp_replace(x, {STRIP})), ' ', '_'))) AS word
  FROM catalogue WHERE genres IS NOT NULL) GROUP BY word HAVING count(*) >= 2""")
def word2vec_vocabulary(spark, sf):
    """The trained vocabulary = genre tokens seen at least twice."""
    _, vectors = _w2v(spark, sf)
    return vectors.select("word")


@register("item_embeddings")
def item_embeddings(spark, sf):
    """Mean word vector per item (known tokens only), with its length."""
    cat, vectors = _w2v(spark, sf)
    emb = embed.item_embeddings(cat, vectors, VECTOR_SIZE)
    return emb.select("item_id", F.size("embedding").alias("dims"), r6(norm("embedding")).alias("norm"))


EMB_SQL = """emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
emb_sims AS (SELECT a.vec_id AS doc_id, b.vec_id AS other,
                    list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)) + 1e-10) AS sim
             FROM emb a JOIN emb b ON a.vec_id <> b.vec_id)"""


@register("embedding_neighbours", ctes(EMB_SQL) + """
SELECT doc_id, other, round(sim, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(sim, 9) DESC, other) AS rank FROM emb_sims)
WHERE rank <= 5""")
def embedding_neighbours(spark, sf):
    """E3 for all vectors of the embedding table: top-5 by cosine (+1e-10)."""
    emb = tables.table(spark, sf, "embeddings")
    nb = embed.all_embedding_neighbours(emb, 5, "vec_id", "embedding")
    return nb.select("doc_id", "other", r6("similarity").alias("similarity"), "rank")


@register("similar_by_embedding", ctes(EMB_SQL) + """
SELECT other AS item_id, round(sim, 6) AS similarity FROM emb_sims WHERE doc_id = (SELECT min(vec_id) FROM embeddings)
ORDER BY round(sim, 9) DESC, other LIMIT 10""")
def similar_by_embedding(spark, sf):
    """E3 for one vector: its 10 nearest by cosine, itself excluded."""
    emb = tables.table(spark, sf, "embeddings")
    q = emb.select(F.min("vec_id")).first()[0]
    out = embed.similar_by_embedding(emb, q, 10, "vec_id", "embedding")
    return out.select("item_id", r6("similarity").alias("similarity"))


@register("neighbour_report")
def neighbour_report(spark, sf):
    """Word2Vec neighbours of the first item with name, genres, score."""
    cat, vectors = _w2v(spark, sf)
    emb = embed.item_embeddings(cat, vectors, VECTOR_SIZE)
    q = cat.select(F.min("item_id")).first()[0]
    return embed.neighbour_report(embed.similar_by_embedding(emb, q, 10), cat)


@register("embedding_2d")
def embedding_2d(spark, sf):
    """E5: two PCA coordinates per embedding vector (re-aimed from t-SNE)."""
    coords, _ = embed.embedding_2d(tables.table(spark, sf, "embeddings"), "vec_id", "embedding")
    return coords


@register("lsa_components")
def lsa_components(spark, sf):
    """Singular values and explained variance of the uncentred catalogue TF-IDF matrix (100 components)."""
    cb = stages.content_model(spark, sf)
    r = embed.lsa_report(cb.weights, 100)
    return r.select("component", r6("singular_value").alias("singular_value"),
                    r6("explained_variance").alias("explained_variance"),
                    r6("explained_variance_ratio").alias("explained_variance_ratio"))


def _lsa_facts_sql() -> str:
    from ranklight.plans.content_q import CONTENT_CTES
    return CONTENT_CTES.rstrip() + """
SELECT least(100, (SELECT count(DISTINCT term) FROM weights) - 1) AS components, (SELECT count(DISTINCT doc_id) FROM weights) AS documents,
       true AS falling, true AS energy_within_rows, true AS first_reaches_mean, true AS ratios_within_one"""


@register("lsa_facts", _lsa_facts_sql())
def lsa_facts(spark, sf):
    """T7 by what must hold: as many components as asked for, singular values
    falling, their squares within the squared length of all (unit) rows, the
    first at least the length that the mean row alone explains, variance
    ratios between 0 and 1 and together at most 1."""
    from pyspark.sql import Window
    w = stages.content_model(spark, sf).weights
    r = embed.lsa_report(w, 100)
    n = w.select(F.count_distinct("doc_id")).scalar()
    # |X m| / |m| for the mean row m: n |m|; the first singular value is at least that.
    mean = w.groupBy("term").agg((F.sum("w") / n).alias("m")).agg(F.sum(F.col("m") * F.col("m")).alias("s")).select(F.sqrt(F.col("s") * n)).scalar()
    before = F.lag("singular_value").over(Window.orderBy("component"))  # 100 rows
    r = r.withColumn("falls", F.coalesce(before >= F.col("singular_value") - 1e-9, F.lit(True)))
    ratio = F.col("explained_variance_ratio")
    return r.agg(F.count(F.lit(1)).alias("components"), F.min("falls").alias("falling"),
                 F.sum(F.col("singular_value") * F.col("singular_value")).alias("energy"), F.max("singular_value").alias("s1"),
                 F.min((ratio >= -1e-9) & (ratio <= 1 + 1e-9)).alias("each"), F.sum(ratio).alias("together")).select(
        "components", n.alias("documents"), "falling", (F.col("energy") <= n + 1e-6).alias("energy_within_rows"),
        (F.col("s1") >= mean - 1e-6).alias("first_reaches_mean"), (F.col("each") & (F.col("together") <= 1 + 1e-9)).alias("ratios_within_one"))


@register("embedding_2d_facts", """SELECT count(*) AS vectors, count(DISTINCT vec_id) AS ids, true AS first_is_widest, true AS uncorrelated,
       true AS reaches_every_dimension, true AS within_total FROM embeddings""")
def embedding_2d_facts(spark, sf):
    """E5 by what must hold of two principal coordinates: one row a vector,
    the first at least as wide as the second and as any single dimension, no
    correlation, both together within the total variance."""
    emb = tables.table(spark, sf, "embeddings")
    per = (emb.select(F.posexplode(F.col("embedding").cast("array<double>")).alias("d", "x")).groupBy("d").agg(F.var_samp("x").alias("v"))
           .select(F.struct(F.max("v").alias("most"), F.sum("v").alias("total"))).scalar())
    c = embedding_2d(spark, sf).agg(F.count(F.lit(1)).alias("vectors"), F.count_distinct("vec_id").alias("ids"), F.var_samp("x").alias("vx"),
                                    F.var_samp("y").alias("vy"), F.covar_samp("x", "y").alias("xy"))
    return c.select("vectors", "ids", (F.col("vx") >= F.col("vy") - 1e-9).alias("first_is_widest"),
                    (F.abs("xy") <= 1e-6 * F.sqrt(F.col("vx") * F.col("vy")) + 1e-12).alias("uncorrelated"),
                    (F.col("vx") >= per["most"] - 1e-9).alias("reaches_every_dimension"),
                    (F.col("vx") + F.col("vy") <= per["total"] + 1e-9).alias("within_total"))


@register("train_collaborative_facts", ctes(stages.CF_CTES, CAT_CTES, """elig AS (SELECT item_id FROM catalogue WHERE score >= 6.0),
first_user AS (SELECT min(user_id) AS user_id FROM train),
seen AS (SELECT item_id FROM train WHERE user_id = (SELECT user_id FROM first_user))""") + """
SELECT least(5, (SELECT count(*) FROM elig WHERE item_id NOT IN (SELECT item_id FROM seen))) AS picks, 0 AS seen, 0 AS not_eligible,
       true AS errors_in_range, true AS metrics_in_range""")
def train_collaborative_facts(spark, sf):
    """P3 by what must hold: the first user's picks are new to them and
    eligible, the errors fit the rating range, the list metrics lie in [0, 1]."""
    from ranklight.plans import jobs
    train = collab.train_part(stages.ratings_split(spark, sf))
    row = jobs.train_collaborative(spark, sf)
    user = train.select(F.min("user_id")).scalar()
    seen = train.where(F.col("user_id") == user).select(F.collect_set("item_id")).scalar()
    good = stages.catalogue(spark, sf).where("score >= 6.0").select("item_id")
    picks = row.select(F.explode("first_user_picks").alias("item_id")).distinct().join(good.withColumn("good", F.lit(1)), "item_id", "left")
    p = picks.agg(F.count(F.lit(1)).alias("picks"), F.sum(F.array_contains(seen, F.col("item_id")).cast("int")).cast("int").alias("seen"),
                  F.sum(F.col("good").isNull().cast("int")).cast("int").alias("not_eligible"))
    wide = F.lit(collab.RATING_MAX - collab.RATING_MIN)
    ok = row.select(F.struct(((F.col("rmse") >= F.col("mae")) & (F.col("mae") >= 0) & (F.col("rmse") <= wide)).alias("e"),
                             (F.col("precision_at_10").between(0, 1) & F.col("recall_at_10").between(0, 1)).alias("m"))).scalar()
    return p.select("picks", "seen", "not_eligible", ok["e"].alias("errors_in_range"), ok["m"].alias("metrics_in_range"))


@register("train_embeddings_facts", ctes(CAT_CTES) + """
SELECT least(10, count(*) - 1) AS neighbours, 0 AS unknown, 0 AS itself, true AS in_range,
       (SELECT count(*) FROM catalogue) AS item_vectors FROM catalogue""")
def train_embeddings_facts(spark, sf):
    """P5 by what must hold: ten neighbours of the first item, all other items
    of the catalogue, similarities in [-1, 1], a vector for every item."""
    from ranklight.plans import jobs
    cat, vectors = _w2v(spark, sf)
    report = jobs.train_embeddings(spark, sf).select("item_id", "similarity").join(cat.select("item_id", F.lit(1).alias("known")), "item_id", "left")
    first = cat.select(F.min("item_id")).scalar()
    n = embed.item_embeddings(cat, vectors, VECTOR_SIZE).select(F.count(F.lit(1))).scalar()
    return report.agg(F.count(F.lit(1)).alias("neighbours"), F.sum(F.col("known").isNull().cast("int")).cast("int").alias("unknown"),
                      F.sum((F.col("item_id") == first).cast("int")).cast("int").alias("itself"),
                      F.min(F.col("similarity").between(-1 - 1e-9, 1 + 1e-9)).alias("in_range")).withColumn("item_vectors", n)


def _factor_eval(spark, sf, algorithm: str, reg: float):
    split = stages.ratings_split(spark, sf)
    fm = stages.factor_model(spark, sf, algorithm, 100, 20, reg)
    return fm, collab.train_part(split), collab.test_part(split)


@register("svd_eval")
def svd_eval(spark, sf):
    """M3 + M9: biased factorisation (baseline + ALS on residuals), train and test errors."""
    fm, train, _ = _factor_eval(spark, sf, "SVD", 0.1)
    tr = metrics.rating_errors(collab.predict_factors(fm, train)).select(F.col("rmse").alias("train_rmse"))
    ev = collab.evaluate_predictions(stages.factor_test_predictions(spark, sf, "SVD", 100, 20, 0.1), 10)
    return ev.select("*", tr.select("train_rmse").scalar().alias("train_rmse"))


@register("nmf_eval")
def nmf_eval(spark, sf):
    """M4 + M9: non-negative factorisation on raw ratings, test errors."""
    return collab.evaluate_predictions(stages.factor_test_predictions(spark, sf, "NMF", 100, 20, 0.06), 10)


_FACTS_SQL = ctes(stages.CF_CTES) + """
SELECT (SELECT count(DISTINCT user_id) FROM train) AS users, (SELECT count(DISTINCT item_id) FROM train) AS items,
       (SELECT count(*) FROM test) AS n_test, true AS in_range, true AS {fact}"""


def _facts(fm, pred):
    ok = (F.col("prediction") >= collab.RATING_MIN) & (F.col("prediction") <= collab.RATING_MAX)
    users = fm.als.userFactors.select(F.count(F.lit(1))).scalar()
    items = fm.als.itemFactors.select(F.count(F.lit(1))).scalar()
    return pred.agg(F.count(F.lit(1)).alias("n_test"), F.min(ok).alias("in_range")) \
        .withColumn("users", users).withColumn("items", items)


@register("svd_facts", _FACTS_SQL.format(fact="beats_baseline"))
def svd_facts(spark, sf):
    """M3: a factor row for every training user and item, predictions in the
    rating range, and a training error below the bias model's."""
    fm, train, _ = _factor_eval(spark, sf, "SVD", 0.1)
    base, _ = stages.baseline_model(spark, sf)
    mine = metrics.rating_errors(collab.predict_factors(fm, train)).select("rmse").scalar()
    bias = metrics.rating_errors(collab.predict_baseline(base, train)).select("rmse").scalar()
    return _facts(fm, stages.factor_test_predictions(spark, sf, "SVD", 100, 20, 0.1)).withColumn("beats_baseline", mine < bias)


@register("nmf_facts", _FACTS_SQL.format(fact="non_negative"))
def nmf_facts(spark, sf):
    """M4: as svd_facts, and no factor below zero."""
    fm, _, _ = _factor_eval(spark, sf, "NMF", 0.06)
    low = fm.als.userFactors.unionByName(fm.als.itemFactors).select(F.min(F.array_min("features"))).scalar()
    return _facts(fm, stages.factor_test_predictions(spark, sf, "NMF", 100, 20, 0.06)).withColumn("non_negative", low >= 0)


@register("train_collaborative")
def train_collaborative(spark, sf):
    """Biased factorisation trained and evaluated, five picks for the first user."""
    from ranklight.plans import jobs
    return jobs.train_collaborative(spark, sf)


@register("train_embeddings")
def train_embeddings(spark, sf):
    """P5: Word2Vec item vectors and the neighbour report of the first item."""
    from ranklight.plans import jobs
    return jobs.train_embeddings(spark, sf, vector_size=100)


@register("recommend_all_users_svd")
def recommend_all_users_svd(spark, sf):
    """M8 on M3: top-10 unseen items with score >= 6 for every test user under
    the biased factorisation (blocked user x item product; brute-force
    checked in tests)."""
    fm, train, test = _factor_eval(spark, sf, "SVD", 0.1)
    return collab.recommend_all_factors(fm, train, stages.catalogue(spark, sf), test.select("user_id"), 10, 6.0)


@register("cross_validate_svd")
def cross_validate_svd(spark, sf):
    """M10 on M3: 5-fold cross-validated RMSE / MAE of the biased factorisation."""
    return collab.cross_validate_factors(stages.ratings_clean(spark, sf), 5, "SVD", 100, 20, 0.1)


@register("cross_validate_svd_facts", ctes(stages.CF_CTES[:3], """r AS (
  SELECT user_id, item_id, (instr('0123456789abcdef', substr(md5(CAST(user_id AS VARCHAR) || '-' || CAST(item_id AS VARCHAR)), 1, 1)) - 1) % 5 AS home
  FROM ratings_clean),
folds AS (SELECT range AS f FROM range(5))""") + """
SELECT CAST(f AS VARCHAR) AS fold, count(*) FILTER (WHERE home = f) AS n,
       count(DISTINCT user_id) FILTER (WHERE home <> f) AS users, count(DISTINCT item_id) FILTER (WHERE home <> f) AS items,
       true AS fits_training
FROM folds CROSS JOIN r GROUP BY f""")
def cross_validate_svd_facts(spark, sf):
    """M10 on M3, what holds of every fold: the ratings it scores, the users
    and items its training gave factors, and a training error under that of
    the bias terms alone."""
    fit = collab.fit_fold_factors(stages.ratings_clean(spark, sf), 5, "SVD", 100, 20, 0.1)
    trained = fit.als.transform(fit.training())
    better = trained.groupBy(F.pmod("user_key", F.lit(5)).alias("fold")).agg(
        (F.avg(F.pow(F.col("target") - F.col("prediction"), 2)) < F.avg(F.pow("target", 2))).alias("fits_training"))
    n = fit.rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    return (n.join(fit.sizes(), "fold").join(better, "fold")
            .select(F.col("fold").cast("string").alias("fold"), "n", "users", "items", "fits_training"))


@register("recommend_all_users_svd_facts", ctes(stages.CF_CTES, CAT_CTES, """elig AS (SELECT item_id FROM catalogue WHERE score >= 6.0),
seen AS (SELECT user_id, count(*) AS s FROM train WHERE item_id IN (SELECT item_id FROM elig) GROUP BY user_id)""") + """
SELECT u.user_id, least(10, (SELECT count(*) FROM elig) - coalesce(s, 0)) AS picks, 0 AS seen, 0 AS not_eligible, true AS ranked
FROM (SELECT DISTINCT user_id FROM test) u LEFT JOIN seen USING (user_id)
WHERE (SELECT count(*) FROM elig) > coalesce(s, 0)""")
def recommend_all_users_svd_facts(spark, sf):
    """M8 on M3, what holds of every list: its length, nothing rated in
    training, nothing under the score, ranks 1 to n by falling prediction."""
    reco = recommend_all_users_svd(spark, sf)
    train = collab.train_part(stages.ratings_split(spark, sf)).select("user_id", "item_id", F.lit(1).alias("rated"))
    elig = stages.catalogue(spark, sf).where("score >= 6.0").select("item_id", F.lit(1).alias("eligible"))
    rows = reco.join(train, ["user_id", "item_id"], "left").join(elig, "item_id", "left")
    per = rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("picks"), F.count("rated").cast("int").alias("seen"),
        F.count(F.when(F.col("eligible").isNull(), 1)).cast("int").alias("not_eligible"),
        F.array_sort(F.collect_list(F.struct("rank", "prediction"))).alias("l"))
    falling = F.forall(F.zip_with(F.slice("l", 1, 9), F.slice("l", 2, 9), lambda a, b: b.isNull() | (a["prediction"] >= b["prediction"])), lambda x: x)
    in_order = F.transform("l", lambda x: x["rank"]) == F.sequence(F.lit(1), F.size("l"))
    return per.select("user_id", "picks", "seen", "not_eligible", (falling & in_order).alias("ranked"))


_GIVEN_SQL = f"""t AS (
  SELECT item_id, unnest(list_transform(string_split(genres, ','), lambda x: replace(lower(regexp_replace(x, {STRIP})), ' ', '_'))) AS word
  FROM catalogue WHERE genres IS NOT NULL),
v AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS vec_id FROM (SELECT DISTINCT word FROM t)),
e AS (SELECT t.item_id, unnest(m.embedding)::DOUBLE AS x, generate_subscripts(m.embedding, 1) AS d
      FROM t JOIN v USING (word) JOIN embeddings m USING (vec_id)),
means AS (SELECT item_id, d, avg(x) AS x FROM e GROUP BY item_id, d)"""


def _given_vectors(spark, sf):
    """Item vectors from the embedding table: the n-th token in order has vector n."""
    cat = stages.catalogue(spark, sf)
    words = embed.genre_tokens(cat).select(F.explode("genre_tokens").alias("word")).distinct()
    numbered = global_row_number(words, [F.col("word")], "vec_id", start=0)
    vectors = numbered.join(tables.table(spark, sf, "embeddings"), "vec_id") \
        .select("word", F.col("embedding").cast("array<double>").alias("vector"))
    return cat, embed.item_embeddings(cat, vectors, 64)


@register("item_embeddings_given", ctes(CAT_CTES, _GIVEN_SQL) + """
SELECT c.item_id, round(coalesce(sum(x), 0), 6) AS total, round(coalesce(sum(x * x), 0), 6) AS square,
       round(coalesce(sum(x * d), 0), 6) AS weighted
FROM catalogue c LEFT JOIN means USING (item_id) GROUP BY c.item_id""")
def item_embeddings_given(spark, sf):
    """E2 over given word vectors: mean vector per item, as three checksums."""
    _, emb = _given_vectors(spark, sf)
    fold = lambda f: r6(F.aggregate(F.transform("embedding", f), F.lit(0.0), lambda a, b: a + b))
    return emb.select("item_id", fold(lambda x: x).alias("total"), fold(lambda x: x * x).alias("square"),
                      fold(lambda x, i: x * (i + 1)).alias("weighted"))


@register("neighbour_report_given", ctes(CAT_CTES, _GIVEN_SQL, """n AS (SELECT item_id, sqrt(sum(x * x)) AS n FROM means GROUP BY item_id),
q AS (SELECT min(item_id) AS id FROM catalogue),
s AS (SELECT b.item_id, sum(a.x * b.x) / (max(na.n) * max(nb.n) + 1e-10) AS sim
      FROM means a JOIN means b USING (d) JOIN n na ON na.item_id = a.item_id JOIN n nb ON nb.item_id = b.item_id
      WHERE a.item_id = (SELECT id FROM q) AND b.item_id <> a.item_id GROUP BY b.item_id),
top AS (SELECT * FROM s ORDER BY round(sim, 9) DESC, item_id LIMIT 10)""") + """
SELECT item_id, round(sim, 6) AS similarity, name, genres, score FROM top JOIN catalogue USING (item_id)""")
def neighbour_report_given(spark, sf):
    """E4 over given word vectors: neighbours of the first item with name, genres, score."""
    cat, emb = _given_vectors(spark, sf)
    q = cat.select(F.min("item_id")).first()[0]
    out = embed.neighbour_report(embed.similar_by_embedding(emb, q, 10), cat)
    return out.select("item_id", r6("similarity").alias("similarity"), "name", "genres", "score")
