"""Invariants of the learned operators (no SQL twin)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ranklight.operators import collab, embed, metrics
from ranklight.plans import stages
from tests.conftest import SF_SMALL


def _planted(spark, n_users=60, n_items=40, rank=3, seed=1):
    rng = np.random.default_rng(seed)
    u = rng.normal(size=(n_users, rank))
    v = rng.normal(size=(n_items, rank))
    r = np.clip(5.5 + u @ v.T, 1, 10)
    rows = [(int(i), int(j), float(r[i, j])) for i in range(n_users) for j in range(n_items) if rng.random() < 0.6]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def test_svd_beats_baseline_on_train(spark):
    train = _planted(spark)
    base = collab.fit_baseline(train)
    b_rmse = metrics.rating_errors(collab.predict_baseline(base, train)).first().rmse
    fm = collab.fit_factors(train, "SVD", rank=5, max_iter=10, reg=0.05)
    s_rmse = metrics.rating_errors(collab.predict_factors(fm, train)).first().rmse
    assert s_rmse < b_rmse


def test_svd_same_seed_same_result(spark):
    train = _planted(spark)
    a = collab.fit_factors(train, "SVD", rank=4, max_iter=5, reg=0.1, seed=3)
    b = collab.fit_factors(train.repartition(3), "SVD", rank=4, max_iter=5, reg=0.1, seed=3)
    ra = metrics.rating_errors(collab.predict_factors(a, train)).first().rmse
    rb = metrics.rating_errors(collab.predict_factors(b, train)).first().rmse
    assert ra == pytest.approx(rb, abs=1e-6)


def test_nmf_factors_non_negative(spark):
    train = _planted(spark)
    fm = collab.fit_factors(train, "NMF", rank=4, max_iter=5, reg=0.1)
    for df in (fm.als.userFactors, fm.als.itemFactors):
        assert df.select(F.min(F.array_min("features"))).first()[0] >= 0


def test_unknown_user_falls_back_to_biases(spark):
    train = _planted(spark)
    fm = collab.fit_factors(train, "SVD", rank=3, max_iter=3, reg=0.1)
    pairs = spark.createDataFrame([(10_000, 1)], "user_id long, item_id long")
    p = collab.predict_factors(fm, pairs).first()
    assert p.prediction is not None and 1.0 <= p.prediction <= 10.0


def test_word2vec_vocabulary_and_embeddings(spark):
    cat = stages.catalogue(spark, SF_SMALL)
    model = embed.word2vec_fit(cat, 16, 5, 2, 5, 42)
    vocab = {r.word for r in embed.word_vectors(model).collect()}
    toks = (cat.filter(F.col("genres").isNotNull())
            .select(F.explode(F.transform(F.split("genres", ","), lambda x: F.lower(F.trim(x)))).alias("w"))
            .groupBy("w").count().filter("count >= 2"))
    assert vocab == {r.w.replace(" ", "_") for r in toks.collect()}
    emb = embed.item_embeddings(cat, embed.word_vectors(model), 16)
    assert emb.count() == cat.count()
    assert emb.select(F.min(F.size("embedding")), F.max(F.size("embedding"))).first() == (16, 16)


def test_pca_variance_order(spark):
    from ranklight.sources import tables
    coords, pca = embed.embedding_2d(tables.table(spark, SF_SMALL, "embeddings"), "vec_id", "embedding")
    ev = pca.explainedVariance.toArray()
    assert ev[0] >= ev[1]
    assert coords.columns == ["vec_id", "x", "y"]


def test_lsa_singular_values_non_increasing(spark):
    from ranklight.operators import content
    cb = content.fit(stages.catalogue(spark, SF_SMALL))
    svd, _ = embed.lsa(cb.weights, 5)
    s = svd.s.toArray()
    assert all(s[i] >= s[i + 1] - 1e-9 for i in range(len(s) - 1))


def test_lsa_explained_variance(spark):
    from ranklight.operators import content
    cb = content.fit(stages.catalogue(spark, SF_SMALL))
    rows = embed.lsa_report(cb.weights, 5).orderBy("component").collect()
    ratios = [r.explained_variance_ratio for r in rows]
    assert all(x >= -1e-9 for x in ratios) and sum(ratios) <= 1 + 1e-9
    # cross-check against numpy on the same matrix
    import numpy as np
    w = cb.weights.toPandas()
    terms = sorted(w.term.unique()); docs = sorted(w.doc_id.unique())
    X = np.zeros((len(docs), len(terms)))
    X[np.searchsorted(docs, w.doc_id), np.searchsorted(terms, w.term)] = w.w
    s = np.linalg.svd(X, compute_uv=False)[:5]
    assert np.allclose([r.singular_value for r in rows], s, rtol=1e-6, atol=1e-8)


def test_recommend_all_factors_matches_brute_force(spark):
    train = _planted(spark, 40, 30)
    fm = collab.fit_factors(train, "SVD", rank=3, max_iter=5, reg=0.1)
    cat = spark.createDataFrame([(i, 7.0) for i in range(30)] + [(99, 8.0)], "item_id long, score double")
    users = train.select("user_id").distinct()
    got = collab.recommend_all_factors(fm, train, cat, users, top_n=5, min_score=6.0)
    # brute force: every (user, eligible item) pair predicted, seen removed
    all_items = cat.select(F.collect_list("item_id")).first()[0]  # 31 ids: fixture only
    pairs = users.select("user_id", F.explode(F.array(*[F.lit(i) for i in all_items])).alias("item_id")) \
        .join(train.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    pred = collab.predict_factors(fm, pairs)
    want = collab.ranked_from_predictions(pred, 5).select("user_id", "item_id", F.col("rank").cast("int").alias("rank"))
    assert sorted(map(tuple, got.select("user_id", "item_id", "rank").collect())) == sorted(map(tuple, want.collect()))


def _folded(spark, rank=3):
    return _planted(spark, 30, 25, rank).withColumn("fold", collab.fold_of(3))


def test_folds_side_by_side_solve_each_fold_alone(spark):
    """After the last step every user's factors solve the normal equations of
    their own fold: that fold's training rows and its items' factors only."""
    ratings = _folded(spark)
    fit = collab.fit_fold_factors(ratings.drop("fold"), 3, "SVD", rank=4, max_iter=6, reg=0.1)
    user = {r.id: np.array(r.features) for r in fit.als.userFactors.collect()}
    item = {r.id: np.array(r.features) for r in fit.als.itemFactors.collect()}
    users, items = (ratings.select(c).distinct().orderBy(c).toPandas()[c].tolist() for c in ("user_id", "item_id"))
    for f in range(3):
        train = ratings.where(F.col("fold") != f).drop("fold")
        base = collab.fit_baseline(train)
        rows = collab.predict_baseline(base, train, clip_output=False).collect()
        by_user = {}
        for r in rows:
            by_user.setdefault(users.index(r.user_id) * 3 + f, []).append((items.index(r.item_id) * 3 + f, r.rating - r.raw_prediction))
        assert {k for k in user if k % 3 == f} == set(by_user)
        assert {k for k in item if k % 3 == f} == {i for rated in by_user.values() for i, _ in rated}
        for k, rated in by_user.items():
            q, t = np.array([item[i] for i, _ in rated]), np.array([x for _, x in rated])
            want = np.linalg.solve(q.T @ q + 0.1 * len(t) * np.eye(4), q.T @ t)
            assert np.allclose(user[k], want, atol=1e-4)


def test_folds_side_by_side_equal_single_fits(spark):
    # Data with one factor and enough steps: one optimum, so the random start no longer shows.
    ratings = _folded(spark, 1)
    got = {r.fold: r for r in collab.cross_validate_factors(ratings.drop("fold"), 3, "SVD", 1, 40, 0.05).collect()}
    singles = []
    for f in range(3):
        fm = collab.fit_factors(ratings.where(F.col("fold") != f).drop("fold"), "SVD", 1, 40, 0.05)
        e = metrics.rating_errors(collab.predict_factors(fm, ratings.where(F.col("fold") == f).drop("fold"))).first()
        singles.append(e.rmse)
        assert got[str(f)].rmse == pytest.approx(e.rmse, abs=2e-5) and got[str(f)].mae == pytest.approx(e.mae, abs=2e-5)
    assert got["mean"].rmse == pytest.approx(np.mean(singles), abs=2e-5)
    assert sum(got[str(f)].n for f in range(3)) == got["mean"].n == ratings.count()


def test_nonnegative_folds_solve_each_fold_alone(spark):
    """With one factor the last step has a closed form (the raw ratings settle
    too slowly from different starts to compare whole fits)."""
    ratings = _folded(spark)
    fit = collab.fit_fold_factors(ratings.drop("fold"), 3, "NMF", rank=1, max_iter=4, reg=0.1)
    user = {r.id: r.features[0] for r in fit.als.userFactors.collect()}
    item = {r.id: r.features[0] for r in fit.als.itemFactors.collect()}
    users, items = (ratings.select(c).distinct().orderBy(c).toPandas()[c].tolist() for c in ("user_id", "item_id"))
    rows = ratings.collect()
    for f in range(3):
        for u in users:
            qt = [(item[items.index(r.item_id) * 3 + f], r.rating) for r in rows if r.user_id == u and r.fold != f]
            want = max(0.0, sum(q * t for q, t in qt) / (sum(q * q for q, _ in qt) + 0.1 * len(qt)))
            assert user[users.index(u) * 3 + f] == pytest.approx(want, abs=1e-4)


def test_folds_with_items_and_users_of_one_fold(spark):
    """An item or user rated in its own fold alone has no factors there: the bias terms decide."""
    rows = [(u, i, float(1 + (u * i) % 9)) for u in range(12) for i in range(8)] + [(500, 3, 7.0), (2, 900, 4.0), (501, 901, 10.0)]
    ratings = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    got = collab.cross_validate_factors(ratings, 3, "SVD", 2, 3, 0.1).collect()
    assert sum(r.n for r in got if r.fold != "mean") == len(rows)
    assert all(r.rmse == r.rmse and r.rmse < 10 for r in got)


def test_unknown_algorithm_of_folds_raises(spark):
    with pytest.raises(ValueError):
        collab.cross_validate_factors(_planted(spark), 3, "KNN")


def test_lsa_variances_need_no_row_per_document_and_component(spark):
    rng = np.random.default_rng(4)
    m = np.where(rng.random((40, 12)) < 0.5, rng.random((40, 12)), 0)
    w = spark.createDataFrame([(int(i), f"t{j}", float(m[i, j])) for i, j in zip(*np.nonzero(m), strict=True)], "doc_id long, term string, w double")
    report = embed.lsa_report(w, 4)
    assert "Join" not in report._jdf.queryExecution().executedPlan().toString()
    coords = m @ np.linalg.svd(m)[2][:4].T
    assert np.allclose([r.explained_variance for r in report.orderBy("component").collect()], coords.var(0), atol=1e-9)
    assert report.select(F.first("explained_variance_ratio")).count() == 1
