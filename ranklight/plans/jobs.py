"""End-to-end jobs: compositions of the operators with
stage tables written between steps.

Each stage is written as parquet under ``out`` and reused when present,
so a rerun after a lost executor or a failed step resumes from the last
written stage instead of recomputing everything.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.operators import clean, collab, content, embed, hybrid, metrics, profile
from ranklight.plans import stages
from ranklight.sources import io


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS")))


def stage(spark: SparkSession, out: str, name: str, build, **params) -> DataFrame:
    """Write ``build()`` to out/name unless it is already there; read it.
    ``params`` are what the stage depends on besides the input: they are part
    of the folder's name, so another value builds another table."""
    path = os.path.join(out, "-".join([name, *[f"{k}={v}" for k, v in sorted(params.items())]]))
    if not _exists(spark, path):
        io.write_table(build(), path)
    return spark.read.parquet(path)


def train_all(spark: SparkSession, sf: str, out: str, min_ratings: int = 30, rank: int = 100,
              max_iter: int = 20, reg: float = 0.1) -> DataFrame:
    """Clean, filter popular, fit content, biases and factors, evaluate
    both CF models, store the hybrid config, profile; one row per stage with
    its size."""
    p = {"min_ratings": min_ratings}
    cat = stage(spark, out, "catalogue", lambda: stages.catalogue(spark, sf))
    rat = stage(spark, out, "ratings", lambda: stages.ratings_clean(spark, sf))
    pop_cat, pop_rat = clean.popular_filter(cat, rat, min_ratings)
    cat = stage(spark, out, "catalogue_popular", lambda: pop_cat, **p)
    rat = stage(spark, out, "ratings_popular", lambda: pop_rat, **p)
    cb = content.fit(cat)
    weights = stage(spark, out, "content_weights", lambda: cb.weights, **p)
    split = stage(spark, out, "ratings_split", lambda: collab.split_train_test(rat), **p)
    train, test = collab.train_part(split), collab.test_part(split)
    base = collab.fit_baseline(train)
    item_bias = stage(spark, out, "item_bias", lambda: base.item_bias, **p)
    user_bias = stage(spark, out, "user_bias", lambda: base.user_bias, **p)
    base = collab.Baseline(base.mu, item_bias, user_bias)
    ev = stage(spark, out, "cf_metrics", lambda: collab.evaluate_predictions(collab.predict_baseline(base, test)), **p)

    def factor_metrics():
        fm = collab.fit_factors(train, "SVD", rank, max_iter, reg)
        io.save_factor_model(fm, os.path.join(out, f"factor_model-{rank}-{max_iter}-{reg}-{min_ratings}"))
        pred = stage(spark, out, "factor_predictions", lambda: collab.predict_factors(fm, test), rank=rank, max_iter=max_iter, reg=reg, **p)
        return collab.evaluate_predictions(pred)
    fev = stage(spark, out, "factor_metrics", factor_metrics, rank=rank, max_iter=max_iter, reg=reg, **p)
    io.save_hybrid_config(spark, os.path.join(out, "hybrid_config"), *hybrid.hybrid_weights(0.4, 0.6), "weighted")
    tables = {"catalogue": cat, "ratings": rat, "content_weights": weights, "ratings_split": split,
              "item_bias": item_bias, "user_bias": user_bias, "cf_metrics": ev, "factor_metrics": fev}
    for name, df in profile.profile_all(cat).items():
        tables[f"profile_{name}"] = stage(spark, out, f"profile_{name}", lambda df=df: df, **p)
    rows = None
    for name, df in tables.items():
        r = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
        rows = r if rows is None else rows.unionByName(r)
    return rows


def train_content(spark: SparkSession, sf: str, out: str | None = None) -> DataFrame:
    """Fit the content model, store it (S11), five neighbours of the first item."""
    cat = stages.catalogue(spark, sf)
    model = stages.content_model(spark, sf)
    if out:
        io.save_content_model(model, os.path.join(out, "content_model"))
    first = cat.select(F.min("item_id").alias("doc_id"))
    return content.recommend_batch(model, first, 5)


def train_collaborative(spark: SparkSession, sf: str, out: str | None = None, rank: int = 100,
                        max_iter: int = 20, reg: float = 0.1) -> DataFrame:
    """Split, biased factorisation, evaluation, store (S12), five picks
    for the first user.  Returns the evaluation row with the picks' ids."""
    split = stages.ratings_split(spark, sf)
    train = collab.train_part(split)
    fm = stages.factor_model(spark, sf, "SVD", rank, max_iter, reg)
    if out:
        io.save_factor_model(fm, os.path.join(out, "factor_model"))
    ev = collab.evaluate_predictions(stages.factor_test_predictions(spark, sf, "SVD", rank, max_iter, reg), 10)
    user = train.select(F.min("user_id")).first()[0]
    picks = collab.recommend_user(fm, train, stages.catalogue(spark, sf), user, 5, 6.0)
    ids = picks.select(F.sort_array(F.collect_list("item_id"))).scalar()
    return ev.withColumn("first_user_picks", ids)


def train_hybrid(spark: SparkSession, sf: str, out: str | None = None) -> DataFrame:
    """Weights (H1), stored config (S13), five picks for the first item."""
    cat = stages.catalogue(spark, sf)
    cb = stages.content_model(spark, sf)
    model, split = stages.baseline_model(spark, sf)
    cf = hybrid.CFSide(model, collab.train_part(split), cat)
    cw, fw = hybrid.hybrid_weights(0.4, 0.6)
    if out:
        io.save_hybrid_config(spark, os.path.join(out, "hybrid_config"), cw, fw, "weighted")
    item = cat.select(F.min("item_id")).first()[0]
    return hybrid.weighted(cb, cf, item, None, 5, 0.0, cw, fw)


def train_embeddings(spark: SparkSession, sf: str, out: str | None = None, vector_size: int = 100) -> DataFrame:
    """P5: Word2Vec (E1), item vectors (E2), store (S14), neighbour report
    of the first item (E4); E5 coordinates are written when ``out`` is set."""
    cat = stages.catalogue(spark, sf)
    vec = stages.word_vectors(spark, sf, vector_size)
    emb = embed.item_embeddings(cat, vec, vector_size)
    if out:
        io.write_table(vec, os.path.join(out, "word2vec", "vectors"))
        coords, _ = embed.embedding_2d(emb)
        io.write_table(coords, os.path.join(out, "embedding_2d"))
    item = cat.select(F.min("item_id")).first()[0]
    return embed.neighbour_report(embed.similar_by_embedding(emb, item, 10), cat)


def metrics_report(spark: SparkSession, sf: str, out: str | None = None) -> DataFrame:
    """Metrics of every model in long form (model, metric, k, value),
    optionally written as JSON (S9)."""
    _, split = stages.baseline_model(spark, sf)
    pred = stages.baseline_test_predictions(spark, sf)
    ranked = collab.ranked_lists(pred, 20)
    relevant = pred.filter(F.col("rating") >= collab.RELEVANT_AT).select("user_id", "item_id")
    cf_long = metrics.evaluate_all(pred, ranked, relevant).select(F.lit("collaborative").alias("model"), "*")
    cb = stages.content_model(spark, sf)
    hy = hybrid.evaluate_on_held_out(pred, collab.train_part(split), cb.weights, 10)
    hy_long = hy.select(F.explode(F.array(
        F.struct(F.lit("precision").alias("metric"), F.lit(10).alias("k"), F.col("precision_at_10").cast("double").alias("value")),
        F.struct(F.lit("recall").alias("metric"), F.lit(10).alias("k"), F.col("recall_at_10").cast("double").alias("value")))).alias("x")) \
        .select(F.lit("hybrid").alias("model"), "x.*")
    report = cf_long.unionByName(hy_long)
    if out:
        io.write_metrics_json(report, os.path.join(out, "metrics"))
    return report


def discover_page(spark: SparkSession, sf: str, min_score: float = 5.0, item_type: str | None = None,
                  top_n: int = 20) -> DataFrame:
    """Header figures (items, mean score, distinct genres, types) with
    the top-n discover list."""
    from ranklight.operators import catalog
    cat = stages.catalogue(spark, sf)
    head = profile.catalogue_stats(cat)
    types = catalog.type_list(cat).select(F.count(F.lit(1))).scalar()
    lst = catalog.discover(cat, min_score, item_type, "score", top_n).select("item_id", "name", "score", "type")
    h = head.select("n_items", "mean_score", "n_genres").withColumn("n_types", types)
    hs = h.select(F.struct(*h.columns)).scalar()
    return lst.select(*[F.col(c) for c in lst.columns],
                      *[hs.getField(c).alias(c) for c in h.columns])
