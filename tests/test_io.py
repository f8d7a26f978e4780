"""Sources, sinks and model round trips (S1-S14), and D12 / H8."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ranklight.operators import clean, collab, content, embed, hybrid
from ranklight.plans import stages
from ranklight.sources import io
from tests.conftest import SF_SMALL


def _tmp():
    return tempfile.mkdtemp(prefix="rl-io-")


def test_missing_catalogue_path_raises(spark):
    with pytest.raises(Exception):
        io.scan_catalogue(spark, os.path.join(_tmp(), "nope.csv"), "csv").count()


def test_csv_round_trip_keeps_schema(spark):
    raw = stages.catalogue_raw(spark, SF_SMALL)
    path = os.path.join(_tmp(), "cat")
    io.write_table(raw, path, "csv")
    back = io.scan_catalogue(spark, path, "csv")
    assert back.schema == io.CATALOGUE_SCHEMA
    assert back.count() == raw.count()


def test_factor_model_round_trip(spark):
    _, split = stages.baseline_model(spark, SF_SMALL)
    train, test = collab.train_part(split), collab.test_part(split)
    fm = collab.fit_factors(train, "SVD", rank=4, max_iter=3, reg=0.1)
    path = os.path.join(_tmp(), "fm")
    io.save_factor_model(fm, path)
    fm2 = io.load_factor_model(spark, path)
    a = collab.predict_factors(fm, test).select("user_id", "item_id", F.round("prediction", 9).alias("p"))
    b = collab.predict_factors(fm2, test).select("user_id", "item_id", F.round("prediction", 9).alias("p"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hybrid_config_round_trip(spark):
    path = os.path.join(_tmp(), "hy")
    io.save_hybrid_config(spark, path, 0.4, 0.6, "weighted")
    assert io.load_hybrid_config(spark, path) == {"content_weight": 0.4, "collaborative_weight": 0.6,
                                                  "strategy": "weighted"}


def test_word2vec_round_trip(spark):
    cat = stages.catalogue(spark, SF_SMALL)
    model = embed.word2vec_fit(cat, 8, 5, 2, 3, 42)
    path = os.path.join(_tmp(), "w2v")
    io.save_word2vec(model, path)
    a = embed.word_vectors(model)
    b = io.load_word_vectors(spark, path)
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_content_model_round_trip_same_lists(spark):
    m = stages.content_model(spark, SF_SMALL)
    path = os.path.join(_tmp(), "cb")
    io.save_content_model(m, path)
    m2 = io.load_content_model(spark, path)
    q = m.items.select(F.min("item_id")).first()[0]
    a = content.recommend(m, q, 10).select("item_id", "rank")
    b = content.recommend(m2, q, 10).select("item_id", "rank")
    assert sorted(a.collect()) == sorted(b.collect())


def test_min_counts_until_stable(spark):
    r = stages.ratings_clean(spark, SF_SMALL)
    once = clean.min_item_ratings(clean.min_user_ratings(r, 3), 3)
    stable = clean.min_counts_stable(r, 3, 3)
    users = stable.groupBy("user_id").count().agg(F.min("count")).first()[0]
    items = stable.groupBy("item_id").count().agg(F.min("count")).first()[0]
    assert users >= 3 and items >= 3
    assert stable.count() <= once.count()


def test_recommend_any_dispatch(spark):
    cat = stages.catalogue(spark, SF_SMALL)
    cb = stages.content_model(spark, SF_SMALL)
    model, split = stages.baseline_model(spark, SF_SMALL)
    cf = hybrid.CFSide(model, collab.train_part(split), cat)
    models = {"content": cb, "collaborative": cf}
    item = cat.select(F.min("item_id")).first()[0]
    user = collab.train_part(split).select(F.min("user_id")).first()[0]
    assert hybrid.recommend_any(models, "content", item_id=item, top_n=5).count() == 5
    assert hybrid.recommend_any(models, "collaborative", user_id=user, top_n=5).count() == 5
    assert hybrid.recommend_any(models, "hybrid", item_id=item, user_id=user, top_n=5).count() == 5
    with pytest.raises(ValueError):
        hybrid.recommend_any(models, "popularity", item_id=item)


def test_switching_cold_user_without_item_is_empty(spark):
    cat = stages.catalogue(spark, SF_SMALL)
    cb = stages.content_model(spark, SF_SMALL)
    model, split = stages.baseline_model(spark, SF_SMALL)
    cf = hybrid.CFSide(model, collab.train_part(split), cat)
    out = hybrid.switching(cb, cf, None, 10 ** 12, 10)  # unknown user: cold, no item
    assert out.count() == 0 and out.columns == ["item_id", "score_value", "source"]


def test_approximate_options_run_and_are_close(spark):
    from ranklight.operators import profile
    raw = stages.catalogue_raw(spark, SF_SMALL)
    exact = clean.fill_median(raw).agg(F.avg("score")).first()[0]
    approx = clean.fill_median(raw, exact=False).agg(F.avg("score")).first()[0]
    assert abs(exact - approx) < 0.5
    assert clean.iqr_filter(clean.fill_median(raw), exact=False).count() > 0
    r = stages.ratings_clean(spark, SF_SMALL)
    a = profile.ratings_stats(r, exact=False).first()
    b = profile.ratings_stats(r, exact=True).first()
    assert abs(a.n_users - b.n_users) <= 0.05 * b.n_users and a.n_ratings == b.n_ratings


def test_weighted_batch_equals_single_queries(spark):
    cat = stages.catalogue(spark, SF_SMALL)
    cb = stages.content_model(spark, SF_SMALL)
    model, split = stages.baseline_model(spark, SF_SMALL)
    train = collab.train_part(split)
    cf = hybrid.CFSide(model, train, cat)
    users = [r.user_id for r in train.select("user_id").distinct().orderBy("user_id").limit(3).collect()]
    items = [r.item_id for r in cat.select("item_id").orderBy("item_id").limit(3).collect()]
    q = spark.createDataFrame(list(zip(users, items)), "user_id long, item_id long")
    batch = hybrid.weighted_batch(cb, model, train, cat, q, 5)
    for u, i in zip(users, items):
        one = hybrid.weighted(cb, cf, i, u, 5).select("item_id", "hybrid_score").collect()
        got = batch.filter(F.col("user_id") == u).select("item_id", "hybrid_score").collect()
        assert sorted(map(tuple, one)) == sorted(map(tuple, got))


def test_edges_per_recommender(spark):
    cat = stages.catalogue(spark, SF_SMALL)
    model, split = stages.baseline_model(spark, SF_SMALL)
    train = collab.train_part(split)
    # CF, unknown user: the item biases alone decide, still a full list
    out = collab.recommend_user_baseline(model, train, cat, 10 ** 12, 5, 0.0).orderBy("rank").collect()
    assert len(out) == 5 and [r.rank for r in out] == [1, 2, 3, 4, 5]
    # CF, one-item catalogue: at most that item
    one = cat.orderBy("item_id").limit(1)
    assert collab.recommend_user_baseline(model, train, one, 10 ** 12, 5, 0.0).count() <= 1
    # hybrid: neither an item nor a user
    cb = stages.content_model(spark, SF_SMALL)
    with pytest.raises(ValueError):
        hybrid.weighted(cb, hybrid.CFSide(model, train, cat), None, None)
    # embeddings: unknown id gives an empty list; single vector has no neighbour
    from ranklight.sources import tables
    emb = tables.table(spark, SF_SMALL, "embeddings")
    assert embed.similar_by_embedding(emb, -5, 10, "vec_id", "embedding").count() == 0
    first = emb.orderBy("vec_id").limit(1)
    vid = first.first().vec_id
    assert embed.similar_by_embedding(first, vid, 10, "vec_id", "embedding").count() == 0


def test_switching_and_mixed_batch_equal_single_queries(spark):
    cat = stages.catalogue(spark, SF_SMALL)
    cb = stages.content_model(spark, SF_SMALL)
    model, split = stages.baseline_model(spark, SF_SMALL)
    train = collab.train_part(split)
    cf = hybrid.CFSide(model, train, cat)
    users = [r.user_id for r in train.groupBy("user_id").count().filter("count >= 10")
             .orderBy("user_id").limit(2).collect()]
    item = cat.select(F.min("item_id")).first()[0]
    q = spark.createDataFrame([(users[0], item), (users[1], None)], "user_id long, item_id long")
    sw = hybrid.switching_batch(cb, model, train, cat, q, 5)
    one_item = hybrid.switching(cb, cf, item, users[0], 5).select("item_id", "source").collect()
    one_cf = hybrid.switching(cb, cf, None, users[1], 5).select("item_id", "source").collect()
    assert sorted(map(tuple, sw.filter(F.col("user_id") == users[0]).select("item_id", "source").collect())) \
        == sorted(map(tuple, one_item))
    assert sorted(map(tuple, sw.filter(F.col("user_id") == users[1]).select("item_id", "source").collect())) \
        == sorted(map(tuple, one_cf))
    qm = spark.createDataFrame([(users[0], item)], "user_id long, item_id long")
    mb = hybrid.mixed_batch(cb, model, train, cat, qm, 6, 0.0, 0.5).select("position", "item_id").collect()
    ms = hybrid.mixed(cb, cf, item, users[0], 6, 0.0, 0.5).select("position", "item_id").collect()
    assert sorted(map(tuple, mb)) == sorted(map(tuple, ms))
